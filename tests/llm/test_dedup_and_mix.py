from __future__ import annotations

import hashlib
import random
import re

import pytest

from galecast.llm import exact_dedup, mixing, ngram_join
from galecast.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
NULLS_LAST = lambda r: tuple((x is None, "" if x is None else x) for x in r)


def test_exact_duplicates(odd_docs, odd_rows):
    groups: dict[str, list] = {}
    for r in odd_rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    want = []
    for r in odd_rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_duplicates(odd_docs).collect()]
    assert sorted(got, key=NULLS_LAST) == sorted(want, key=NULLS_LAST)
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    stayed = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=NULLS_LAST)
    assert stayed == sorted(((max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()), key=NULLS_LAST)


def test_one_row_of_repeated_rows_and_of_null_ids_stays(spark):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "same")] * 3 + [(None, "lost")] * 3 + [(4, near), (4, near), (4, near + " a"), (None, near + " b"), (None, None), (None, ""), (9, "other")]
    docs = spark.createDataFrame([(*r, {"a": i}) for i, r in enumerate(rows)], "doc_id long, text string, extra map<string,int>").repartition(4)
    exact = sorted(((r.doc_id, r.text or "") for r in exact_dedup.drop_exact_duplicates(docs).collect()), key=NULLS_LAST)
    assert exact == sorted([(1, "same"), (None, "lost"), (4, near), (4, near + " a"), (None, near + " b"), (None, ""), (9, "other")], key=NULLS_LAST)
    apart = sorted(((r.doc_id, (r.text or "")[:5]) for r in ngram_join.one_of_each_group(docs).collect()), key=NULLS_LAST)
    assert apart == sorted([(1, "same"), (None, "lost"), (4, "w0 w1"), (None, ""), (None, ""), (9, "other")], key=NULLS_LAST)


def test_texts_that_share_length_and_prefix_differ(spark):
    long = "p" * 500
    docs = spark.createDataFrame([(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, "q" * 501)], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1)}


def test_no_documents(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0
    assert ngram_join.similar_groups(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


def test_native_plans(odd_docs):
    for df in (exact_dedup.exact_duplicates(odd_docs), mixing.mix(odd_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def brute_groups(rows: list[tuple], n: int, similarity: int) -> list[tuple]:
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), r[0] if not sets[i] else least.get(find(i))) for i, r in enumerate(rows)]


@pytest.mark.parametrize("n,similarity", [(4, 85), (5, 80), (1, 50)])
def test_similar_groups(odd_docs, odd_rows, n, similarity):
    got = [tuple(r) for r in ngram_join.similar_groups(odd_docs, n, similarity).collect()]
    assert sorted(got, key=NULLS_LAST) == sorted(brute_groups(odd_rows, n, similarity), key=NULLS_LAST)


def test_similar_groups_in_slices(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", 20)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):  # near copies that link in chains, and a passage that many share
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(80)] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(base[:40] + [f"own{i}x{j}" for j in range(20)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in ngram_join.similar_groups(docs, 4, 85).collect())
    assert got == sorted(brute_groups(rows, 4, 85))
    kept = sorted(r.doc_id for r in ngram_join.one_of_each_group(docs, 4, 85).collect())
    assert kept == sorted({r[2] for r in got})


def test_another_text_under_a_dropped_id_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(3, base), (5, base + " end"), (5, "quite another text under the same number"), (7, None), (None, base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.one_of_each_group(docs).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[2], rows[3]], key=str)  # the equal text without an id goes


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(7, 7)]
    label: dict[int, int] = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in range(200):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == label


def plain_targets(sizes: dict, weights=(5, 2, 1), share=1.5, epochs=2) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        rate = left / sum(w[s] for s in free)
        above = {s for s in free if rate * w[s] > epochs * sizes[s]}
        for s in above or free:
            target[s] = epochs * sizes[s] if above else rate * w[s]
        left -= sum(target[s] for s in above)
        free = free - above if above else set()
    return target


def test_mix(odd_docs, odd_rows):
    size = lambda t: len(WORD.findall(t or ""))
    sizes: dict = {}
    for r in odd_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    targets = plain_targets(sizes)
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    taken: dict = {}
    largest: dict = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    assert sum(taken.values()) == int(sum(targets.values()) + 1e-6)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 1
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs.repartition(7)).collect()))
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    out: dict = {}
    for r in mixed.collect():
        key = (r.source, r.doc_id, r.text)
        out[key] = out.get(key, 0) + 1
    have: dict = {}
    for r in odd_rows:
        key = (r[3], r[0], r[1])
        have[key] = have.get(key, 0) + 1
    assert out and all(size(k[2]) > 0 and n <= 2 * have[k] for k, n in out.items())
    for s in sizes:
        words = sum(size(k[2]) * n for k, n in out.items() if k[0] == s)
        assert targets[s] - 2 * largest[s] - 1 <= words <= targets[s] + largest[s] + 1
    once = {(r.source, r.doc_id): r.taken // r.size for r in rows if r.size and r.doc_id is not None and have.get((r.source, r.doc_id, next(x[1] for x in odd_rows if x[0] == r.doc_id))) == 1}
    assert once and all(sum(n for k, n in out.items() if k[:2] == key) == n for key, n in once.items())


def test_mixing_one_id_three_thousand_times(spark):
    rows = [(7, "a b c", "big")] * 3000 + [(i, "x y z", "small") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    target = {r.source: r.target for r in mixing.mix(docs).collect()}
    words: dict = {}
    for r in mixing.mixed_documents(docs).collect():
        words[r.source] = words.get(r.source, 0) + 3
    assert target["big"] < 18_000 and all(abs(words[s] - target[s]) <= 6 for s in target)


def test_no_whole_text_is_shuffled_to_mix(spark, tmp_path):
    spark.range(50).selectExpr("id AS doc_id", "concat('word ', id) AS text", "'s' AS source").write.parquet(str(tmp_path / "d"))
    plan = mixing.mixed_documents(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan
    assert plan.count("Scan parquet") == 2
