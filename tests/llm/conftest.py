from __future__ import annotations

import random

import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, shard int, page string, rank int, size double, node string, _c0 int, key string"
WORDS = {
    "en": "the of and to in that is was for with as his they at be this from have".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine".split(),
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", ",", "x"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, near copies."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        rows.append((i, sentence(rng, lang, rng.randint(5, 60)), lang, f"s{i % 4}"))
    base = sentence(rng, "en", 80)
    rows += [(100 + i, base + f" tail{i} end{i}", "en", "s0") for i in range(6)]
    rows += [(200 + i, base, "en", "s1") for i in range(4)]
    rows += [
        (300, None, "en", "s1"), (301, "", "en", None), (302, " \t\n\r\x0b\x0c", "de", "s2"), (303, "Word", None, None),
        (304, "one two three", "en", "s2"), (305, "One TWO three", "en", "s2"), (306, "12 34 !!", "en", "s9"), (307, "é ßtraße naïve 日本語 x 🙂", "de", "s2"),
        (308, sentence(rng, "en", 30_000), "en", "s3"), (309, "x" * 200_000, "en", "s3"), (310, "it's (so-called) 'tis I'LL go<|endoftext|>on", "en", "s1"),
        (None, "text without an id", "en", "s1"), (None, None, None, None),
    ]
    rows += [rows[0], rows[0], rows[61], rows[-1]]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    full = [(*r, None if r[1] is None else len(r[1]), 1, "p", None, 0.5, "n", 7, None) for r in odd_rows]
    return spark.createDataFrame(full, FIELDS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], FIELDS)
