from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from galecast.llm import mixing
from tests.llm.conftest import sentence
from tests.llm.test_dedup_and_mix import brute_groups
from tests.llm.test_search_and_output import WORD, brute_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain(rows) -> Counter:
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in rows)


def test_stages_against_brute_force(spark, odd_docs, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    docs, kept = odd_docs.select(*COLUMNS), [odd_docs.select(*COLUMNS).collect()]
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, "")
        if name != "best_fit_packing":
            assert result.columns == COLUMNS
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    given, spoken, unique, apart, mixed, packed = kept

    lettered = [r for r in given if r.text and any(c.isalpha() for c in r.text)]
    gone = plain(lettered) - plain(spoken)
    assert not plain(spoken) - plain(lettered)
    assert all(r[0] in (307, 309) for r in gone)  # of other letters, of one letter; the clean ones stay

    largest: dict = {}
    for r in spoken:
        largest[r.text] = max(largest.get(r.text, -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.text) for r in unique) == Counter((i, t) for t, i in largest.items())
    assert not plain(unique) - plain(spoken)

    groups = brute_groups([(r.doc_id, r.text) for r in unique], 5, 80)
    wanted = Counter(g[0] for g in groups if g[0] is None or g[0] == g[2])
    assert Counter(r.doc_id for r in apart) == wanted
    assert not plain(apart) - plain(unique)

    times = Counter(r.doc_id for r in mixed)
    taken: dict = {}
    for r in mixing.mix(spark.read.parquet(str(tmp_path / "ngram_jaccard_join"))).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + (r.taken // r.size if r.size else 0)
    copies = Counter(r.doc_id for r in apart)
    assert all(times[d] == n for d, n in taken.items() if copies[d] == 1)
    assert set(plain(mixed)) <= set(plain(apart)) and max(times.values()) <= 2 * max(copies.values())

    lengths = Counter()
    for r, ids in zip(mixed, brute_ids(WORD, [r.text for r in mixed], 1)):
        lengths[r.doc_id] += len(ids)
    placed = Counter()
    for r in packed:
        placed[r.doc_id] += r.length
    assert placed == lengths


def test_stages_of_no_documents(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs.select(*COLUMNS), "").count() == 0


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    fills = rows.groupBy("sequence_id").sum("length").collect()
    assert fills and max(r[1] for r in fills) <= 4096


def test_gibberish_goes_and_clean_texts_of_every_language_stay(spark):
    rng = random.Random(8)
    clean = [(i, sentence(rng, "en" if i % 2 else "de", rng.randint(8, 60)), "en" if i % 2 else "de") for i in range(400)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)) for n in (8, 20, 40, 200)]
    junk += ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "Все люди рождаются свободными и равными"]
    rows = clean + [(1000 + i, t, None) for i, t in enumerate(junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stayed = {r.doc_id for r in corpus_pipeline.identified_language(spark, docs, "").collect()}
    assert not {i for i in stayed if i >= 1000}
    assert len(stayed) >= 0.98 * len(clean)
