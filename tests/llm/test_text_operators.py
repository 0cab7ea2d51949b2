from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from galecast.llm import infill, suffixes, variants
from galecast.llm.boundaries import ArrayContainer, BitmapContainer, BoundarySet, RunContainer

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# ---- fill in the middle ----------------------------------------------------


def test_boundary_sets_in_every_form():
    rng = np.random.default_rng(1)
    parts = [np.flatnonzero(rng.random(70_000) < share) + at for share, at in ((0.3, 0), (0.01, 200_000), (1.0, 400_000), (0.0001, 900_000))]
    positions = np.concatenate(parts)
    found = BoundarySet(positions)
    assert {type(c) for c in found.containers} == {ArrayContainer, BitmapContainer, RunContainer}
    k = rng.integers(0, len(positions), 5000)
    assert (found.select(k) == positions[k]).all() and len(found) == len(positions)
    assert len(BoundarySet(np.zeros(0, np.int64))) == 0 and len(BoundarySet(np.zeros(0, np.int64)).select(np.zeros(0, np.int64))) == 0
    full = BoundarySet(np.arange(1 << 17))
    assert (full.select(np.arange(1 << 17)) == np.arange(1 << 17)).all()


def brute_infill(doc_id, text) -> tuple:
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text)
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_infill_against_brute_force(spark, odd_docs, odd_rows):
    marked = [(i, t) for i in range(400, 440) for t in ("a <P> b", "x <S", "<", "a<M>", "S> <P a <P >", "  two  ", "é <\tM>")]
    rows = [(r[0], r[1]) for r in odd_rows] + marked
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = infill.fill_in_middle(docs).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())
    assert got == Counter(brute_infill(*r) for r in rows)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    assert Counter((r.doc_id, r.back) for r in made.collect()) == Counter((i, t or "") for i, t in rows)


def test_infill_keeps_columns_and_takes_nothing(spark, odd_docs, no_docs):
    made = infill.fill_in_middle(odd_docs.withColumn("output", F.lit("own")).withColumn("_text", F.lit("own")))
    assert [c for c in made.columns if c not in odd_docs.columns] == ["_text", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert made.select("doc_id", "page", "node").exceptAll(odd_docs.select("doc_id", "page", "node")).count() == 0
    assert made.where("output = 'own'").count() == 0
    assert infill.fill_in_middle(no_docs).count() == 0


def test_infill_shares_are_parameters(odd_docs):
    everything = infill.fill_in_middle(odd_docs, transformed_percent=100, spm_percent=0, keep=["doc_id", "text"])
    forms = {r.form for r in everything.where("text <> '' and not text like '%<_>%'").collect()}
    assert forms == {"psm"}


# ---- spelling variants -----------------------------------------------------


def brute_words(rows, every: int = 97) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts: dict[str, int]) -> list[tuple]:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def spelled(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(40)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(30):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "a", "É", "×"]) + w[at + rng.randint(0, 1) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "1", ", "]).join(words)))
    return rows + [(None, "wortes wortes wortes"), (9, None), (10, ""), (11, "z" * 50_000), (12, ("z" * 49_999 + " ") * 3), (13, ("z" * 50_000 + " ") * 9)]


@pytest.mark.parametrize("slice_size", [variants.SLICE, 7])
def test_variants_against_brute_force(spark, slice_size):
    rows = spelled(3)
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string").repartition(5)
    got = variants.spelling_variants(docs, slice_size=slice_size).collect()
    want = brute_variants(brute_words(rows))
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a chain of forms


def test_variants_of_odd_and_no_texts(odd_docs, odd_rows, no_docs):
    got = variants.spelling_variants(odd_docs).collect()
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got) == brute_variants(brute_words([(r[0], r[1]) for r in odd_rows]))
    assert variants.spelling_variants(no_docs).count() == 0


def test_every_pair_of_words_once():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 7))) for _ in range(200)})
    found = []
    for longer in range(5, 9):
        for suffix in (False, True):
            groups: dict[str, list[str]] = {}
            for w in words:
                if len(w) in (longer, longer - 1):
                    half = longer // 2
                    groups.setdefault(w[len(w) - half :] if suffix else w[:half], []).append(w)
            for group in groups.values():
                found += [(group[i], group[j]) for i, j in variants.near_pairs(group, None, suffix, longer)]
    assert sorted(tuple(sorted(p)) for p in found) == [(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)]


# ---- repeated passages -----------------------------------------------------


def brute_passages(rows, window: int = 50) -> list[tuple]:
    last = float("inf")
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, float] = {}
    for i, b in texts:
        for p in range(len(b) - window + 1):
            s = b[p : p + window]
            least[s] = min(least.get(s, last), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if least[b[p : p + window]] < i:
                gone[p : p + window] = b"\1" * window
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((None if i == last else i, len(b), tuple(spans), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def passages(seed: int) -> list[tuple]:
    rng = random.Random(seed)

    def text(n: int) -> str:
        return "".join(rng.choice("abcdé ") for _ in range(n))

    shared = [text(n) for n in (44, 49, 50, 51, 62, 63, 80, 400)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(text(rng.randint(0, 90)))
            piece = rng.choice(shared)
            a = rng.randrange(len(piece))
            parts.append(rng.choice([piece, piece, piece[a:], piece[:a], piece + piece]))
        rows.append((rng.choice([i, i, None, i % 7]), "".join(parts)))
    rows += [rows[3], rows[3], (1000, rows[5][1]), (2, rows[5][1]), (None, rows[5][1]), (5, "x" * 300), (6, "x" * 49), (7, "x" * 50), (4, "x" * 60)]
    rows += [(8, None), (9, ""), (None, None), (11, "long " * 9000), (12, "long " * 9000 + "end")]
    return rows


def flat(rows) -> list[tuple]:
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.length) for s in r.spans), bytes(r.kept)) for r in rows), key=repr)


@pytest.mark.parametrize("parts,window", [(1, 50), (7, 50), (3, 26)])
def test_passages_against_brute_force(spark, parts, window):
    rows = passages(parts)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, block int, kind int").repartition(parts)
    assert flat(suffixes.repeated_passages(docs, window=window).collect()) == brute_passages(rows, window)


def test_passages_of_odd_and_no_texts(odd_docs, odd_rows, no_docs):
    rows = [(r[0], r[1]) for r in odd_rows if r[0] != 308]
    assert flat(suffixes.repeated_passages(odd_docs.where("doc_id is null or doc_id <> 308")).collect()) == brute_passages(rows)
    assert suffixes.repeated_passages(no_docs).count() == 0
    with pytest.raises(ValueError):
        suffixes.repeated_passages(no_docs, window=20)


def test_texts_are_not_moved_to_their_messages(odd_docs):
    plan = suffixes.repeated_passages(odd_docs)._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("Bucketed: true")
    assert "Exchange" not in plan[: scan]


def test_cover_meets_every_pair_of_places():
    for i in range(suffixes.PERIOD):
        for j in range(suffixes.PERIOD):
            assert any((i + d) % 13 in suffixes.COVER and (j + d) % 13 in suffixes.COVER for d in range(13))


def test_buckets_in_turn_are_bounded_and_complete(monkeypatch):
    monkeypatch.setattr(suffixes, "ENTRIES_AT_ONCE", 500)
    rng = np.random.default_rng(2)
    names = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (3000, 1, 700)] + [np.zeros(0, np.uint64)]
    seen, sizes = [[] for _ in names], []
    for parts in suffixes._in_turn(names):
        sizes.append(sum(p.stop - p.start for p in parts))
        for s, x, p in zip(seen, names, parts):
            s.append(x[p])
    assert max(sizes) < 1500 and all((np.concatenate(s) == x).all() for s, x in zip(seen, names))
    a, b = np.array([3, 8, 9], np.uint64), np.array([1, 9, 30], np.uint64)
    rows = pd.DataFrame({"block": [1, 2], "bucket": [0, 0], "kind": [1, 1], "payload": [suffixes.packed(a), suffixes.packed(b)]})
    found = suffixes._names_in_several_blocks(rows)
    assert [suffixes._flags(p, 3).tolist() for p in found["payload"]] == [[False, False, True], [False, True, False]]
