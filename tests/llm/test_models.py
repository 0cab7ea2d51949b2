from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from galecast.llm import brown, language, licenses, quality
from galecast.llm.queries import fold
from galecast.llm.textblocks import text_buffers
from tests.llm.conftest import sentence

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_language_of_held_out_rows(odd_docs, odd_rows):
    model = language.fit(*map(list, zip(*language.training_sample(odd_docs, fold(5) != 0))))
    found = language.identify(odd_docs, model)
    assert found.columns == [*odd_docs.columns, "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert 0 <= r.score <= 1
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 300:
            assert r.lang_pred == r.lang


def test_language_kernel_counts_common_grams():
    model = language.fit(["abc abd", "xyz xyw", "abab"], ["a", "x", "a"])
    data, off = text_buffers(pa.array(["Abc", "", "zz"]))
    present = model.presences(data, off, model.column_of())

    def grams(text: str) -> set:
        b = text.lower().encode()
        return {b[i : i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    known = grams("abc abd") | grams("xyz xyw") | grams("abab")
    order = ["abc abd", "abab", "xyz xyw"]
    for i, text in enumerate(["abc", "", "zz"]):
        own = grams(text) & known
        want = [len(own & grams(t)) / math.sqrt(max(1, len(own)) * len(grams(t))) for t in order]
        assert np.allclose(model.kernel(present)[i], want, atol=1e-6)


def test_nothing_to_learn_languages_from(no_docs, odd_docs):
    model = language.fit([], [])
    assert language.training_sample(no_docs, F.lit(True)) == []
    assert {r.lang_pred for r in language.identify(odd_docs, model).collect()} == {"und"}
    assert language.identify(no_docs, language.fit(["abc"], ["a"])).count() == 0


def plain_features(net: quality.QualityNet, text: bytes) -> np.ndarray:
    step = quality.CHUNK - quality.OVERLAP
    chunks = [text[i : i + quality.CHUNK] for i in range(0, max(1, len(text) - quality.OVERLAP), step)]
    pooled = []
    for c in chunks:
        best = np.full(quality.FILTERS, -np.inf)
        for a in range(max(1, len(c) - quality.WIDTH + 1)):
            window = (c[a : a + quality.WIDTH] + bytes(quality.WIDTH))[: quality.WIDTH]
            best = np.maximum(best, sum(net.tables[k][window[k]] for k in range(quality.WIDTH)))
        pooled.append(np.maximum(best + net.bias, 0))
    return np.mean(pooled, axis=0)


def test_convolution_matches_a_plain_one_and_covers_whole_texts():
    net = quality.fit(["aa bb cc", "!!## $$"], [1, 0], epochs=1)
    texts = ["", "a", "abcdefg", "x" * 255 + "!?", "ab" * 400, "e" * 1000 + "#"]
    data, off = text_buffers(pa.array(texts))
    got = net.features(data, off)
    for i, t in enumerate(texts):
        assert np.allclose(got[i], plain_features(net, t.encode()), atol=1e-4), i
        alone, bounds = text_buffers(pa.array([t]))
        assert np.allclose(net.features(alone, bounds)[0], got[i], atol=1e-5)


def test_every_byte_is_seen():
    net = quality.fit(["aa bb cc", "!!## $$"], [1, 0], epochs=1)
    net.tables[:, ord("#"), :] = 50
    for n in (1, 5, 6, 7, 255, 256, 257, 470, 480, 481, 1001):
        plain = net.score(*text_buffers(pa.array(["e" * n])))[0]
        texts = ["e" * i + "#" + "e" * (n - i - 1) for i in range(n)]
        found = net.features(*text_buffers(pa.array(texts)))
        assert (found > net.features(*text_buffers(pa.array(["e" * n])))).any(axis=1).all(), n
        assert not np.isnan(plain)


def test_quality_of_held_out_rows(spark, no_docs):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        text = sentence(rng, "en", 60)
        docs.append((i, text if good else re.sub(r"(\w+)", r"\1###", text)))
        labels.append((i, int(good), 0))
    docs += [(500, None), (501, ""), (502, "a"), (None, "x y z"), (503, "w " * 60_000)]
    labels += [(500, 1, 0), (None, 1, 0), (900, 0, 0), (3, None, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = quality.training_sample(d.select("doc_id", "text"), lab, fold(5) != 0)
    net = quality.fit([t for t, _ in sample], [y for _, y in sample])
    rows = quality.score_quality(d, net).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    assert quality.score_quality(no_docs, net).count() == 0
    assert quality.fit([], []).score(*text_buffers(pa.array(["a"])))[0] == 0.5


def plain_scores(rows: list[tuple], learns) -> tuple[dict, int]:
    tokens = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(r[1] or "")] + [None] for r in rows]
    counts = Counter(t for r, ts in zip(rows, tokens) if learns(r[0]) for t in ts)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts) for ts in tokens]
    return [(r[0], len(ts), sum(counts[t] > 0 for t in ts), n, b) for r, ts, b in zip(rows, tokens, base)], counts


def test_class_scores(odd_docs, odd_rows):
    learns = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    want, _ = plain_scores(odd_rows, learns)
    for frequent in (1 << 18, 40):  # all words in every task, or few
        rows = brown.class_scores(odd_docs, fold(7) != 2, classed=8, n_classes=3, frequent=frequent).collect()
        got = sorted((tuple(r)[:5] for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        ordered = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        assert [g[:4] for g in got] == [w[:4] for w in ordered]
        assert np.allclose([g[4] for g in got], [w[4] for w in ordered])
        assert all(r.score < 0 for r in rows)
    first = {(r.doc_id, r.n_tokens): r.score for r in rows}
    again = brown.class_scores(odd_docs.repartition(7), fold(7) != 2, classed=8, n_classes=3, frequent=40).collect()
    assert all(abs(first[(r.doc_id, r.n_tokens)] - r.score) < 1e-6 for r in again)


def test_class_model_scores_follow_their_formula(spark):
    texts = ["a x a x b y", "b y a x", "a y b x", "a x q"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in brown.class_scores(docs, F.col("doc_id") < 3, classed=4, n_classes=2).collect()}
    tokens = [t.split() + [None] for t in texts]
    counts = Counter(w for t in tokens[:3] for w in t)
    ids = {w: i + 2 for i, (w, _) in enumerate(sorted(((w, c) for w, c in counts.items() if w), key=lambda x: -x[1]))}
    ids[None] = 0
    n = len(ids) + 1
    big = np.zeros((n, n))
    for t in tokens[:3]:
        for a, b in zip([None, *t], t):
            big[ids[a], ids[b]] += 1
    # The classes that the data suggest: {a, b} and {x, y}.
    cls = np.array([0, 1, *[2 if w in "ab" else 3 for w in sorted(ids, key=lambda w: ids[w]) if w]])
    member = np.eye(4)[cls]
    pairs = member.T @ big @ member + brown.SMOOTHING
    step = np.log10(pairs / pairs.sum(axis=1, keepdims=True))
    size = np.maximum(big.sum(axis=0) @ member, 1)
    for k, t in enumerate(tokens[:3]):
        want, before = 0.0, 0
        for w in t:
            i = ids[w]
            want += step[cls[before], cls[i]] + math.log10(big[:, i].sum() / size[cls[i]])
            before = i
        assert abs(want - got[k]) < 1e-6


def test_every_other_word_joins_the_class_that_fits_best():
    rng = np.random.default_rng(3)
    m, n = 6, 40
    pairs = rng.integers(0, 200, (m, m)).astype(float)
    after, before = (rng.poisson(0.4, (n, m)).astype(float) for _ in range(2))
    xlogx = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())

    def value(p: np.ndarray) -> float:
        return xlogx(p) - xlogx(p.sum(axis=0)) - xlogx(p.sum(axis=1))

    for w, got in enumerate(brown.best_classes(pairs, after, before)):
        # The word's own bigrams with a class join that class on both sides; the margins are those of all its tokens.
        values = []
        for c in range(2, m):
            p = pairs.copy()
            p[c, :] += after[w]
            p[:, c] += before[w]
            left, right = pairs.sum(axis=1), pairs.sum(axis=0)
            left[c] += after[w].sum()
            right[c] += before[w].sum()
            values.append(xlogx(p) - xlogx(left) - xlogx(right))
        assert values[got - 2] >= max(values) - 1e-9 and value(pairs) is not None


def test_every_training_word_has_a_class_and_probabilities_sum_up(odd_docs):
    seen = []
    kept = brown._class_model
    try:
        brown._class_model = lambda *a: seen.append(a) or kept(*a)
        brown.class_scores(odd_docs, fold(7) != 2, classed=8, n_classes=3)
    finally:
        brown._class_model = kept
    lexicon, counts, followed, n_other = seen[0]
    assert n_other == 0 and len(lexicon.known) > 8 and (lexicon.cls > brown.OTHER).all()
    assert followed[:, brown.OTHER].sum() == 0  # no token of a training text is without a class
    model = kept(*seen[0])
    assert np.allclose((10.0**model.step).sum(axis=1), 1)
    assert np.allclose(np.bincount(lexicon.cls, weights=10.0**model.emit)[2:], 1)


def objective(big: np.ndarray, cls: np.ndarray) -> float:
    member = np.eye(cls.max() + 1)[cls]
    pairs = member.T @ big @ member
    f = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return f(pairs) - f(pairs.sum(axis=0)) - f(pairs.sum(axis=1))


def test_exchange_raises_the_likelihood_and_finds_blocks():
    rng = np.random.default_rng(0)
    truth = np.concatenate([[0, 1], 2 + np.arange(40) % 4])
    strong = rng.random((6, 6)) ** 6
    big = rng.poisson(40 * strong[truth][:, truth]).astype(float)
    start = np.concatenate([[0, 1], 2 + rng.permutation(40) % 4])
    found = brown.exchange_classes(big, 4, 20)
    assert objective(big, found) >= objective(big, start)
    assert objective(big, found) >= objective(big, truth) - 1e-6 * abs(objective(big, truth))
    assert found[0] == 0 and found[1] == 1 and (found[2:] >= 2).all()


def test_class_scores_of_little(spark, no_docs, odd_docs, odd_rows):
    assert brown.class_scores(no_docs, F.lit(True)).count() == 0
    rows = brown.class_scores(odd_docs, F.lit(False)).collect()
    assert len(rows) == len(odd_rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_license_scan(spark, odd_docs, no_docs):
    model = licenses.train(odd_docs)
    texts = [
        (1, "Plain words\nReleased under the MIT License."), (2, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."),
        (3, "The bar lost its license last year."), (4, None), (5, ""), (6, "x " * 40_000 + "\nThis work is licensed under the GNU General Public License, version 3."),
        (None, "Released under the MIT License."), (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (9, "the of and with this work under"),
        (1, "Plain words\nReleased under the MIT License."),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("family", F.lit("x")).withColumn("line", F.lit(3))
    result = licenses.scan(docs, model)
    rows = result.collect()
    assert len(rows) == len(texts)
    got = {r.doc_id: r.families for r in rows}
    assert got == {1: "MIT", 2: "Apache-2.0,CC-BY-NC-4.0", 3: "", 4: "", 5: "", 6: "GPL-3.0", None: "MIT", 8: "MIT", 9: ""}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.scan(no_docs, model).count() == 0
    assert licenses.train(no_docs).families == model.families


def plain_license(text: str, model: licenses.LicenseModel) -> set:
    """Families confirmed in a text, line by line, from the weights alone."""
    found = set()
    for line in (text or "").split("\n"):
        words = [w.rstrip(".") if w.endswith(".") else w for w in re.sub(r"[^\w.]+|_", " ", line.lower()).split()]
        words = [w for w in words if w]
        def of(n):
            return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
        sums = list(model.intercepts)
        terms = [t for t in of(1) | of(2) | of(3) if t in model.weights]
        if not terms or not set(words) & set(model.anchors):
            continue
        for t in terms:
            sums = [s + w for s, w in zip(sums, model.weights[t])]
        odds = [math.exp(min(s, 50.0)) for s in sums]
        best = max(zip(odds, model.families))
        if sum(odds) / (1 + sum(odds)) < model.threshold:
            continue
        for template in licenses.TEMPLATES[best[1]]:
            t = [w.rstrip(".") for w in re.sub(r"[^\w.]+|_", " ", template.lower()).split()]
            t = [w for w in t if w]
            pairs = {" ".join(t[i : i + 2]) for i in range(len(t) - 1)}
            shared = len(pairs & of(2))
            if shared >= 0.5 * min(len(of(2)), len(pairs)) and shared >= min(6, 0.75 * len(pairs)):
                found.add(best[1])
    return found


def test_licenses_against_plain_scores_where_a_third_of_the_rows_has_headers(spark):
    rng = random.Random(12)
    families = ["Apache-2.0", "MIT", "ISC", "GPL-2.0", "AGPL-3.0"]
    rows, truth = [], {}
    for i in range(600):
        body = "\n".join(sentence(rng, "en", 12) for _ in range(4))
        if i % 3 == 0:
            family = families[0] if i % 6 == 0 else rng.choice(families)
            words = rng.choice([t for t in licenses.TEMPLATES[family] if len(t.split()) > 20] or licenses.TEMPLATES[family]).split()
            header = "\n".join(" * " + " ".join(words[k : k + 12]) for k in range(0, len(words), 12))  # wrapped, behind comment signs
            rows.append((i, header + "\n" + body))
            truth[i] = family
        else:
            rows.append((i, body))
    rows += [(1000, "a copy of this software"), (1001, "Licensed under the terms"), (1002, "SPDX-License-Identifier: ISC"), (1003, "SPDX-License-Identifier: WTFPL")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = licenses.train(docs)
    got = {r.doc_id: set(r.families.split(",")) - {""} for r in licenses.scan(docs, model).collect()}
    assert {i: f for i, f in got.items() if f} == {i: f for i, t in rows if (f := plain_license(t, model))}
    assert sum(truth[i] in got[i] for i in truth) >= 0.9 * len(truth)
    assert sum(bool(got[i]) for i, _ in rows if i < 1000 and i not in truth) <= 2
    assert not got[1000] and not got[1001] and got[1002] == {"ISC"} and not got[1003]


def test_licenses_learn_from_every_paragraph(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join([sentence(rng, "en", 12), "no copyright applies here" if i % 10 == 0 else "nothing applies here"])) for i in range(600)]
    rows += [(1000 + i, "Released under the MIT License.") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses._ordinary(docs)
    assert found.agg(F.sum("n")).first()[0] == 1200  # all lines but those that a template confirms
    model = licenses.train(docs, background=8)
    assert "copyright" not in model.anchors  # in a twentieth of all paragraphs, whatever eight of them hold
    assert {r.doc_id for r in licenses.scan(docs, model).where("license = 'MIT'").collect()} == {r[0] for r in rows[600:]}


def test_language_learns_from_every_row(spark, odd_docs):
    d = odd_docs.select("doc_id", "text", "lang")
    rows = [r for r in d.select("text", "lang").where((fold(5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).orderBy(F.xxhash64("doc_id", F.lit("lang")), "text").collect()]
    model, plain = language.learn(d, fold(5) != 0, 3), language.fit([r.text for r in rows], [r.lang for r in rows], 3)
    assert model.languages == plain.languages and np.array_equal(model.grams, plain.grams)
    assert np.allclose(model.weights, plain.weights, atol=1e-3) and np.allclose(model.bias, plain.bias, atol=1e-3)


def test_fluency_counts_every_row(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, "en", 8), "en") for i in range(3000)] + [(5000, "qqq zzz qqq", "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    fluency = language.learn_fluency(d, F.lit(True), F.col("doc_id") % 2 == 0, ["en"])
    codes = Counter(c for t in pa.array([r[1] for r in rows]).to_pylist() for _, part in language.letter_trigrams(pa.array([t])) for c in part.tolist())
    prefixes = Counter()
    for c, n in codes.items():
        prefixes[c >> 8] += n
    wanted = {c: math.log10(n / prefixes[c >> 8]) for c, n in codes.items() if n / prefixes[c >> 8] > 1e-4}
    assert dict(zip(fluency.grams.tolist(), fluency.logs[:-1, 0].tolist())) == pytest.approx(wanted, abs=1e-5)
    given = pa.array([t for i, t, _ in rows if i % 2 == 0])
    value, n = fluency.values(given, np.zeros(len(given), int), fluency.column_of())
    assert fluency.least[0] <= np.quantile(value + language.SLACK / np.sqrt(n), language.CLEAN_SHARE) + 1e-9
