"""Licence scan: a trained classifier of paragraphs, and templates that confirm what it says.

Paragraphs are the lines of a text. A sparse logistic regression over word
1-, 2- and 3-grams tells licence families from ordinary text. It learns from
template paragraphs and spans of them, from sentences that use such words
otherwise, and from all paragraphs of the corpus, where those with the same
terms are one weighted example. The least probability that counts is set on a
quarter of the paragraphs kept from training, so that next to no ordinary
paragraph reaches it; below it a paragraph is unknown.
A family found is confirmed where the paragraph and one of its templates share
enough word pairs: half of those of the shorter, and ``LEAST_SHARED`` of them or,
of a short template, nearly all. What a template confirms by this measure is
never taken for ordinary text in training, however common licences are.

Scoring is joins and aggregates on the JVM. A term counts for a family only
with its rarest word, so a text that has none of these words has no paragraph
that could leave the unknown class, and its n-grams are never spelled out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.llm.license_texts import OTHER_USES, TEMPLATES
from galecast.llm.session import ready, written

UNKNOWN = "unknown"
BACKGROUND = 4000
VOCABULARY = 1 << 14
COMMON_SHARE = 0.01
FALSE_SHARE = 0.001
STEPS = 1 << 16
LEAST_PROBABILITY = 0.5
LEAST_OVERLAP = 0.5
LEAST_SHARED = 6
SHORT_SHARE = 0.75
SPAN_SHARES = (1.0, 0.75, 0.5, 0.25)


def _table(spark: SparkSession, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """A small table of fixed or learned values as one literal."""
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")))


def normal_words(text: Column) -> Column:
    """Lower-case words of letters, digits and inner points; array."""
    cleaned = F.regexp_replace(F.lower(text), r"\.(?![\p{L}\p{N}.])|[^\p{L}\p{N}. ]+", " ")
    return F.array_remove(F.split(cleaned, " "), "")


def _plain_words(text: str) -> list[str]:
    """``normal_words`` of a template, which has letters and digits of ASCII only."""
    cleaned = re.sub(r"[^a-z0-9.]+", " ", text.lower())
    return [w for w in re.sub(r"\.(?= |$)", "", cleaned).split(" ") if w]


def grams(words: Column, sizes: Sequence[int]) -> Column:
    """Distinct word n-grams of the given sizes, joined by blanks; array."""

    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def _spans(paragraphs: DataFrame) -> DataFrame:
    """Whole paragraphs and runs of their words, half of each run apart."""
    words = paragraphs.withColumn("words", normal_words(F.col("paragraph")))
    size = F.greatest(F.least(F.size("words"), F.lit(4)), F.ceil(F.size("words") * F.col("share")).cast("int"))
    cut = words.withColumn("share", F.explode(F.array(*[F.lit(s) for s in SPAN_SHARES]))).withColumn("n", size)
    starts = F.sequence(F.lit(1), F.size("words") - F.col("n") + 1, F.greatest(F.lit(1), F.floor(F.col("n") / 4).cast("int")))
    return cut.withColumn("at", F.explode(starts)).select("family", F.slice("words", F.col("at"), F.col("n")).alias("words")).distinct()


def run_terms(runs: Column) -> Column:
    """Distinct 1-, 2- and 3-grams within runs of words (texts), sorted; most runs are one word, which is all there is to spell."""
    # Cut once a run: what is bound by name is not worked out anew for every n-gram.
    several = F.transform(F.filter(runs, lambda run: F.contains(run, F.lit(" "))), lambda run: F.split(run, " "))
    single = F.filter(runs, lambda run: ~F.contains(run, F.lit(" ")))
    spelled = F.flatten(F.transform(several, lambda words: grams(words, (1, 2, 3))))
    return F.sort_array(F.array_distinct(F.concat(single, spelled)))


@dataclass(frozen=True)
class LicenseModel:
    """``weights``: term to one number per family, each minus that of ``unknown``; ``intercepts`` likewise.

    ``anchors``: the rarest word of every term that speaks for a family.
    """

    families: list[str]
    weights: dict[str, list[float]]
    intercepts: list[float]
    anchors: list[str]
    threshold: float


def _template_grams(spark: SparkSession) -> DataFrame:
    rows = [{"family": f, "template": i, "paragraph": p} for f, paragraphs in TEMPLATES.items() for i, p in enumerate(paragraphs)]
    table = _table(spark, rows, "family: string, template: int, paragraph: string")
    pairs = table.withColumn("pairs", grams(normal_words(F.col("paragraph")), (2,)))
    return pairs.select("family", "template", F.size("pairs").alias("template_size"), F.explode("pairs").alias("pair"))


def _speaks(shared: Column, n_pairs: Column, template_size: Column) -> Column:
    """Whether a paragraph of ``n_pairs`` word pairs that shares ``shared`` of them with a template is taken for it."""
    return (shared >= LEAST_OVERLAP * F.least(n_pairs, template_size)) & (shared >= F.least(F.lit(LEAST_SHARED), SHORT_SHARE * template_size))


def paragraphs_of(docs: DataFrame) -> DataFrame:
    """doc_id, line, paragraph of all lines that have a letter."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line", "paragraph"))
    return lines.where(F.col("paragraph").rlike(r"\p{L}"))


def _ordinary(docs: DataFrame) -> DataFrame:
    """fold, terms, n: every paragraph of the corpus that no template confirms, those with equal terms counted in one row.

    ``terms`` are the distinct 1-, 2- and 3-grams of words that templates have,
    sorted; no other n-gram can be in the vocabulary. A quarter of the
    paragraphs, by their hash, is fold 0. Stored, as training reads it often.
    """
    templates = [normal for paragraphs in _template_words().values() for normal in paragraphs]
    pairs = [sorted({" ".join(x) for x in zip(w, w[1:])}) for w in templates]
    spoken_pairs = sorted({x for each in pairs for x in each})
    fewest = min(min(float(LEAST_SHARED), SHORT_SHARE * len(each)) for each in pairs)
    listed = F.from_json(F.lit(json.dumps([{"size": len(x), "pairs": x} for x in pairs])), "array<struct<size: int, pairs: array<string>>>")

    lines = paragraphs_of(docs.select("doc_id", "text"))
    worded = lines.select(F.xxhash64("paragraph", "doc_id", "line").alias("key"), normal_words(F.col("paragraph")).alias("words"))
    known = F.transform("words", lambda w: F.when(w.isin(sorted({x for w in templates for x in w})), w).otherwise(""))
    runs = F.array_remove(F.split(F.btrim(F.array_join(known, " ")), " {2,}"), "")
    termed = worded.withColumn("runs", F.array_distinct(runs)).withColumn("terms", run_terms(F.col("runs")))
    # Few paragraphs share word pairs enough with all templates together to be compared with each.
    near = F.size(F.filter("terms", lambda t: t.isin(spoken_pairs))) >= fewest
    paired = termed.withColumn("pairs", F.when(near, grams(F.col("words"), (2,))))
    confirmed = F.exists(listed, lambda t: _speaks(F.size(F.array_intersect(t["pairs"], F.col("pairs"))), F.size("pairs"), t["size"]))
    judged = paired.select(
        F.when(F.pmod("key", F.lit(4)) == 0, 0).otherwise(1).alias("fold"), "terms",
        (F.col("pairs").isNull() | ~confirmed).alias("ordinary"),
    )
    counted = written(judged.groupBy("fold", "terms", "ordinary").agg(F.count(F.lit(1)).alias("n")), "paragraphs")
    return counted.where("ordinary").drop("ordinary")


def _template_words() -> dict[str, list[list[str]]]:
    """Words of every template paragraph, as ``normal_words`` gives them."""
    return {f: [_plain_words(p) for p in paragraphs] for f, paragraphs in TEMPLATES.items()}


def _reached(probabilities: DataFrame) -> float:
    """The probability that at most ``FALSE_SHARE`` of the rows (probability, n) are above, counted in steps of 1 / ``STEPS``."""
    steps = probabilities.groupBy(F.floor(F.col("probability") * STEPS).alias("step")).agg(F.sum("n").alias("n"), F.max("probability").alias("most")).collect()
    above, allowed = 0, FALSE_SHARE * sum(r["n"] for r in steps)
    for row in sorted(steps, key=lambda r: -r["step"]):
        above += row["n"]
        if above > allowed:
            return row["most"]
    return 0.0


def train(docs: DataFrame, background: int = BACKGROUND) -> LicenseModel:
    """Learns from the templates and all paragraphs of ``docs``; an empty table leaves the templates alone.

    Paragraphs of the corpus weigh together as much as ``background`` sentences
    of other uses at most, so that a large corpus does not drown these.
    """
    spark = ready(docs.sparkSession)
    rows = [{"family": f, "paragraph": p} for f, paragraphs in TEMPLATES.items() for p in paragraphs]
    rows += [{"family": UNKNOWN, "paragraph": p} for p in OTHER_USES]
    spans = _spans(_table(spark, rows, "family: string, paragraph: string"))
    known = spans.select("family", grams(F.col("words"), (1, 2, 3)).alias("terms"), F.lit(1.0).alias("weight")).cache()
    corpus = _ordinary(docs)
    sizes = {r["fold"]: r["n"] for r in corpus.groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    n_ordinary = max(1, sum(sizes.values()))
    # In how many ordinary paragraphs a word is; a term is as telling as its rarest word.
    words = corpus.select("n", F.explode("terms").alias("word")).where(~F.col("word").contains(" "))
    common = {r["word"]: r["n"] for r in words.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # words of templates
    share = min(1.0, 0.75 * background / max(1, sizes.get(1, 0)))
    learned = known.unionByName(
        corpus.where("fold = 1").select(F.lit(UNKNOWN).alias("family"), "terms", (F.col("n") * share).alias("weight"))
    )
    # Families weigh alike, and all of them together as much as ordinary text.
    totals = {r["family"]: r["total"] for r in known.groupBy("family").agg(F.sum("weight").alias("total")).collect()}
    totals[UNKNOWN] += share * sizes.get(1, 0)
    each = F.create_map(*[F.lit(x) for f, total in totals.items() for x in (f, (len(TEMPLATES) if f == UNKNOWN else 1) / total)])
    weighted = learned.withColumn("weight", F.col("weight") * each[F.col("family")])
    vectors = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=VOCABULARY).fit(
        known.where(F.col("family") != UNKNOWN)  # what no licence says tells none from another
    )
    labels = StringIndexer(inputCol="family", outputCol="label", stringOrderType="alphabetAsc").fit(known)
    model = LogisticRegression(weightCol="weight", family="multinomial", maxIter=100, regParam=2e-6, elasticNetParam=0.5, standardization=False).fit(
        labels.transform(vectors.transform(weighted)).select("label", "features", "weight")
    )
    at = labels.labels.index(UNKNOWN)
    families = [x for x in labels.labels if x != UNKNOWN]
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    places = [labels.labels.index(x) for x in families]
    weights, anchors = {}, set()
    for k, term in enumerate(vectors.vocabulary):
        margin = [float(matrix[p, k] - matrix[at, k]) for p in places]
        rarest = min(term.split(" "), key=lambda w: (common.get(w, 0), -len(w), w))
        if max(margin) > 1e-9 and common.get(rarest, 0) <= COMMON_SHARE * n_ordinary:
            weights[term] = margin
            anchors.add(rarest)
        elif max(margin) <= 1e-9 and min(margin) < -1e-9:
            weights[term] = margin
    unscaled = LicenseModel(families, weights, [float(intercepts[p] - intercepts[at]) for p in places], sorted(anchors), 0.0)
    kept = corpus.where("fold = 0").select("terms", "n")
    reached = _reached(_term_probabilities(kept.withColumn("term", F.explode("terms")), ["terms", "n"], unscaled))
    known.unpersist()
    return LicenseModel(families, weights, unscaled.intercepts, unscaled.anchors, max(LEAST_PROBABILITY, reached))


def _probabilities(paragraphs: DataFrame, model: LicenseModel) -> DataFrame:
    """doc_id, line, words, family, probability of every paragraph (doc_id, line, words) that has a term.

    ``probability`` is that of any family, one minus that of ``unknown``: close
    relatives may share it. ``family`` is the most probable one. Rows that repeat in all three columns are one paragraph.
    """
    keys = ["doc_id", "line", "words"]
    terms = paragraphs.distinct().withColumn("term", F.explode(grams(F.col("words"), (1, 2, 3))))
    return _term_probabilities(terms, keys, model)


def _term_probabilities(terms: DataFrame, keys: Sequence[str], model: LicenseModel) -> DataFrame:
    """``keys``, family, probability of whatever ``keys`` tell apart, from rows of its terms."""
    rows = [{"term": t, "w": w} for t, w in model.weights.items()]
    weights = F.broadcast(_table(terms.sparkSession, rows, "term: string, w: array<double>"))  # at most VOCABULARY terms
    sums = terms.join(weights, "term").groupBy(*keys).agg(
        *[F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(len(model.families))]
    )
    odds = [F.exp(F.least(F.col(f"s{i}") + F.lit(model.intercepts[i]), F.lit(50.0))) for i in range(len(model.families))]
    options = F.array(*[F.struct(o.alias("odds"), F.lit(f).alias("family")) for o, f in zip(odds, model.families)])
    total = F.aggregate(F.array(*odds), F.lit(1.0), lambda a, b: a + b)
    best = sums.withColumn("best", F.array_max(options)).withColumn("total", total)
    return best.select(*keys, F.col("best.family").alias("family"), ((F.col("total") - 1) / F.col("total")).alias("probability"))


def licensed_paragraphs(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """doc_id, line, family, probability, overlap, confirmed of all paragraphs above the threshold.

    Rows of ``docs`` that repeat id and line have it once. Null and empty texts
    have no paragraph.
    """
    anchors = F.array(*[F.lit(a) for a in model.anchors]) if model.anchors else F.array().cast("array<string>")
    possible = docs.select("doc_id", "text").where(F.arrays_overlap(normal_words(F.col("text")), anchors))
    lines = paragraphs_of(possible).withColumn("words", normal_words(F.col("paragraph"))).where(F.arrays_overlap("words", anchors))
    scored = _probabilities(lines.select("doc_id", "line", "words"), model).where(F.col("probability") >= model.threshold)
    pairs = scored.withColumn("pairs", grams(F.col("words"), (2,))).withColumn("n_pairs", F.size("pairs"))
    templates = F.broadcast(_template_grams(docs.sparkSession))
    shared = pairs.withColumn("pair", F.explode_outer("pairs")).join(templates, ["family", "pair"], "left")
    keys = ["doc_id", "line", "words", "family", "probability"]
    compared = shared.groupBy(*keys, "template").agg(
        F.count("template").alias("shared"), F.min("n_pairs").alias("n_pairs"), F.min("template_size").alias("template_size")
    ).withColumns({
        "overlap": F.col("shared") / F.least("n_pairs", "template_size"),
        "speaks": _speaks(F.col("shared"), F.col("n_pairs"), F.col("template_size")),
    })
    best = compared.groupBy(*keys).agg(
        F.coalesce(F.max("overlap"), F.lit(0.0)).alias("overlap"), F.coalesce(F.max("speaks"), F.lit(False)).alias("confirmed")
    )
    return best.select("doc_id", "line", "family", "probability", "overlap", "confirmed")


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, license (``none`` without a confirmed paragraph), probability, n_paragraphs, families.

    ``license`` is the family of the most probable confirmed paragraph, ties
    to the earlier line; ``families`` lists all, sorted. Null ids are one id.
    """
    found = licensed_paragraphs(docs, model).where("confirmed")
    each = found.groupBy("doc_id").agg(
        F.max_by("family", F.struct("probability", -F.col("line"), "family")).alias("license"), F.max("probability").alias("probability"),
        F.count(F.lit(1)).alias("n_paragraphs"), F.array_join(F.sort_array(F.collect_set("family")), ",").alias("families"),
    ).withColumnRenamed("doc_id", "_id")
    joined = docs.select("doc_id").join(each, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select(
        "doc_id", F.coalesce("license", F.lit("none")).alias("license"), F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families"),
    )
