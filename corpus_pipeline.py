"""From raw documents to packed training sequences: five stages, each stored and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``; null texts and repeated rows are handled
as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from galecast.llm import exact_dedup, language, mixing, ngram_join, packing
from galecast.llm.queries import WORD_TOKENIZER, documents, fold
from galecast.llm.session import fresh_path, ready


def identified_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language that was learned; texts without a letter, and those not fluent in the language that claims them, go."""
    model = language.learn(docs, fold(5) != 0)
    fluency = language.learn_fluency(docs, fold(5) != 0, fold(5) == 0, model.languages)
    return language.identify(docs, model, fluency).where("fluent").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares five-word shingles to 0.8 or more, that with the smallest doc_id."""
    return ngram_join.one_of_each_group(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them whole."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, WORD_TOKENIZER, remembered=50_000)  # workers of earlier stages are still there


STAGES = [
    ("language_id", identified_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mix_sources", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

#: The stages learn models and walk trees; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(ready(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
