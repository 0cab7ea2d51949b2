"""The registered query of every operator, over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.llm import bitplanes, brown, exact_dedup, infill, language, licenses, mixing, ngram_join, packing, quality, suffixes, topk, variants
from galecast.llm.session import ready

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def fold(folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def held_out(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).alias("held_out")


def _columns(rows: list[tuple]) -> tuple[list, list]:
    return [r[0] for r in rows], [r[1] for r in rows]


def op1_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 50 == 0)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_TOKENIZER)


def op3_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown.class_scores(documents(spark, sf_dir), fold(7) != 2)
    return scored.withColumn("held_out", held_out(fold(7) == 2))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.learn(docs, fold(5) != 0)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(fold(5) == 0), "lang_pred", "score")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = bitplanes.write_ids(documents(spark, sf_dir), BYTE_TOKENIZER)
    return bitplanes.read_spans(spark, path)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licenses.scan(docs, licenses.train(docs))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.fit(*_columns(quality.training_sample(docs, labels, fold(5) != 0)))
    return quality.score_quality(docs, net).select("doc_id", held_out(fold(5) == 0), "score", "predicted")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir), n_words=4, similarity=85)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(documents(spark, sf_dir), keep=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_passages(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP7_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(rank % 3 + 1)::INT]::DOUBLE AS w, (source_size * 2)::DOUBLE AS lim FROM s),
r AS (
  SELECT *, ((sum(source_size) OVER () * 1.5)::DOUBLE - coalesce(sum(lim) OVER up, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER up, 0)) AS rate,
         coalesce(sum(w) OVER up, 0) AS w_before
  FROM w WINDOW up AS (ORDER BY lim / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, (SELECT arg_min(rate, w_before) FROM r WHERE rate * w <= lim) AS free_rate FROM r),
t AS (SELECT source, rank, source_size, CASE WHEN free_rate IS NULL THEN lim ELSE least(lim, free_rate * w) END AS target FROM f),
p AS (
  SELECT d.doc_id, d.size, t.rank, t.source_size, t.target,
         (sum(d.size) OVER (PARTITION BY t.rank ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (stop + epoch * source_size) / target AS finish
  FROM p, (VALUES (0), (1)) AS e(epoch) WHERE target > 0 AND size > 0),
q AS (SELECT *, (sum(size) OVER (ORDER BY finish, rank, epoch, stop, size ROWS UNBOUNDED PRECEDING))::BIGINT AS reached FROM c),
b AS (SELECT floor(sum(target) + 1e-6)::BIGINT AS budget FROM t),
k AS (
  SELECT doc_id, rank, stop, sum(greatest(0, least(size, budget - reached + size)))::BIGINT AS taken
  FROM q, b GROUP BY doc_id, rank, stop)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM p LEFT JOIN k ON p.doc_id IS NOT DISTINCT FROM k.doc_id AND p.rank = k.rank AND p.stop = k.stop AND p.size > 0
"""


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [floor(x::DOUBLE * 256) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)] END) AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS reached FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.reached) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, s.s
"""


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


OP12_SQL = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
g AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS key, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY ALL),
h AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || [('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT for i in range(octet_length(encode(key)))],
    lambda a, b: list_reduce([xor(a, b)] || range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))) AS h
  FROM g),
l AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM l WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
q AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pattern, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM p),
e AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM q a JOIN q b ON a.pattern = b.pattern AND a.word <> b.word
  UNION SELECT q.word, w.word, w.n FROM q JOIN w ON q.less = w.word
  UNION SELECT w.word, q.word, q.n FROM q JOIN w ON q.less = w.word),
b AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM e),
f AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM w LEFT JOIN b ON w.word = b.word AND b.place = 1),
s AS (
  SELECT word, word AS at FROM f UNION ALL
  SELECT s.word, f.form FROM s JOIN f ON s.at = f.word AND f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN s ON f.word = s.word JOIN f AS t ON s.at = t.word AND t.form IS NULL
"""


OP13_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, unnest(range(0, len(x) // 2 - 49, 512)) AS c, x FROM d),
k AS (SELECT doc_id, c, substr(x, 2 * c + 1, 1122) AS x FROM c),
o AS (SELECT doc_id, c, x, unnest(range(0, len(x) // 2 - 49)) AS o FROM k),
w AS (SELECT doc_id, c + o AS i, substr(x, 2 * o + 1, 100) AS s FROM o),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
r AS (SELECT DISTINCT w.doc_id, w.i FROM w JOIN m ON w.s = m.s WHERE m.least < w.doc_id),
n AS (SELECT doc_id, i, (i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) + 50)::INT AS opens FROM r),
g AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM n),
p AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, g),
t AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM p GROUP BY doc_id),
e AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM p
  UNION ALL SELECT d.doc_id, max(p.b), len(any_value(x)) // 2 FROM p JOIN d ON p.doc_id = d.doc_id GROUP BY d.doc_id),
f AS (SELECT e.doc_id, string_agg(substr(x, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT), '' ORDER BY a) AS x FROM e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
       coalesce(t.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(f.x, d.x))) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN f ON d.doc_id = f.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_kd_top_k": OP1_SQL, "op7_exact_dedup": OP7_SQL, "op8_mix_sources": OP8_SQL, "op10_ngram_join": OP10_SQL,
        "op11_fill_in_middle": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_suffix_dedup": OP13_SQL,
    }
