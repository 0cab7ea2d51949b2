"""Terms of runs of template words: every n-gram within a run, none across runs."""

from __future__ import annotations

import pytest

licenses = pytest.importorskip("galecast.llm.licenses")

from pyspark.sql import functions as F  # noqa: E402


def spelled(run):
    words = run.split(" ")
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def test_terms_are_the_n_grams_of_every_run(spark):
    rows = [[], ["the"], ["of", "the", "of"], ["the software", "of"], ["as is without any warranty", "any", "any warranty of"], ["a a a a"]]
    df = spark.createDataFrame([(i, runs) for i, runs in enumerate(rows)], "id int, runs array<string>")
    found = dict(df.select("id", licenses.run_terms(F.col("runs"))).collect())
    assert found == {i: sorted(set().union(*map(spelled, runs))) for i, runs in enumerate(rows)}


def test_a_run_is_cut_into_words_once():
    assert str(licenses.run_terms(F.col("runs"))).count("split(") == 1


def test_normal_words_lose_signs_and_one_last_point(spark):
    texts = ["A.b  c.- d.. . .. e.\n...", " \t", "", None, "\u00c4\u00df\u2028x.\u0085 1.0, (c)\u00a0y_z."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    assert [r.w for r in df.select("id", licenses.normal_words(F.col("text")).alias("w")).orderBy("id").collect()] == [
        ["a.b", "c", "d.", ".", "e", ".."], [], [], None, ["\u00e4\u00df", "x", "1.0", "c", "y", "z"]
    ]
