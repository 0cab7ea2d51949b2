"""Exact top-k inner products with a KD-tree per shard.

Rows are dealt into shards; each shard is a tree of median splits whose nodes
have tight bounding boxes. A query goes through a tree best node first: the
largest inner product that a box allows orders the nodes, and a node below the
kth best score so far is left with all its rows. Every query first searches
one shard; its kth score goes with it to all other shards, which then need
only look where they can beat it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.session import ready, written

SHARD_ROWS = 8192
LEAF_ROWS = 64
QUERY_BLOCK = 256
SCALE = 256
TREES = "shard int, dim int, n int, ids binary, vectors binary, lows binary, highs binary, spans binary, least_ids binary"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, vector: floor(scale * x) of every component; rows with null ids or unusable vectors are left out."""
    usable = (
        F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    )
    floors = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return table.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), floors.alias("vector"))


class Tree:
    """Rows in tree order; a node is a span of rows, its children the two halves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.lexsort((ids,))
        self.ids, self.vectors = ids[order], vectors[order]
        spans, lows, highs, least = [], [], [], []
        waiting = [(0, len(ids), None)]
        # A node's children follow it in ``spans`` as positions; leaves have -1.
        while waiting:
            a, b, parent = waiting.pop()
            at = len(spans)
            block = self.vectors[a:b]
            low, high = block.min(axis=0), block.max(axis=0)
            spans.append([a, b, -1, -1])
            lows.append(low)
            highs.append(high)
            least.append(self.ids[a:b].min())
            if parent is not None:
                spans[parent[0]][parent[1]] = at
            width = high - low
            if b - a > leaf_rows and width.max() > 0:
                middle = (b - a) // 2
                order = np.argpartition(block[:, int(width.argmax())], middle)
                self.vectors[a:b], self.ids[a:b] = block[order], self.ids[a:b][order]
                waiting += [(a, a + middle, (at, 2)), (a + middle, b, (at, 3))]
        self.spans, self.least = np.array(spans, np.int64), np.array(least, np.int64)
        self.lows, self.highs = np.array(lows), np.array(highs)

    @classmethod
    def stored(cls, row: dict) -> "Tree":
        self, dim = cls.__new__(cls), row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(-1, dim)
        self.lows = np.frombuffer(row["lows"], np.int64).reshape(-1, dim)
        self.highs = np.frombuffer(row["highs"], np.int64).reshape(-1, dim)
        self.spans = np.frombuffer(row["spans"], np.int64).reshape(-1, 4)
        self.least = np.frombuffer(row["least_ids"], np.int64)
        return self

    def row(self, shard: int) -> dict:
        return {
            "shard": shard, "dim": self.vectors.shape[1], "n": len(self.ids), "ids": self.ids.tobytes(),
            "vectors": self.vectors.tobytes(), "lows": self.lows.tobytes(), "highs": self.highs.tobytes(),
            "spans": self.spans.tobytes(), "least_ids": self.least.tobytes(),
        }

    def search(self, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, kth_id: np.ndarray, k: int) -> Iterator[tuple[int, list]]:
        """Per query its best (score, -id) here that can be among the k best; ``kth`` and ``kth_id`` are those known so far.

        Products are taken in doubles where all sums stay below 2**53 and so
        are exact, else in 64-bit integers.
        """
        largest = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * queries.shape[1]
        kind = np.float64 if largest < 2**53 else np.int64
        q, rows = queries.astype(kind), self.vectors.astype(kind)
        # The best inner product in a box takes the high side where the query is positive, else the low side.
        bounds = np.maximum(q, 0) @ self.highs.astype(kind).T + np.minimum(q, 0) @ self.lows.astype(kind).T
        spans, least = self.spans.tolist(), self.least.tolist()
        for i, own in enumerate(query_ids.tolist()):
            best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
            floor = (int(kth[i]), -int(kth_id[i]))
            bound = bounds[i].astype(np.int64).tolist()
            nodes = [(-bound[0], 0)]
            while nodes:
                minus, at = heapq.heappop(nodes)
                limit = max(floor, best[0]) if len(best) == k else floor
                if -minus < limit[0]:
                    break
                if (-minus, -least[at]) < limit:
                    continue
                a, b, left, right = spans[at]
                if left >= 0:
                    for child in (left, right):
                        if (bound[child], -least[child]) >= limit:
                            heapq.heappush(nodes, (-bound[child], child))
                    continue
                scores = (rows[a:b] @ q[i]).astype(np.int64)
                for j in np.flatnonzero(scores >= limit[0]).tolist():
                    one = (int(scores[j]), -int(self.ids[a + j]))
                    if one[1] == -own or one < floor:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, one)
                    elif one > best[0]:
                        heapq.heapreplace(best, one)
            yield own, best


LOWEST, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    dim = int(key[1])
    vectors = np.array(rows["vector"].tolist(), np.int64).reshape(-1, dim)
    return pd.DataFrame([Tree(rows["vec_id"].to_numpy(np.int64), vectors).row(int(key[0]))])


def _search(k: int):
    def search(key: tuple, trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in trees.to_dict("records"):
            tree = Tree.stored(row)
            for i in range(0, len(asked), QUERY_BLOCK):
                block = asked.iloc[i : i + QUERY_BLOCK]
                queries = np.array(block["vector"].tolist(), np.int64).reshape(len(block), row["dim"])
                found = tree.search(block["query_id"].to_numpy(), queries, block["kth"].to_numpy(), block["kth_id"].to_numpy(), k)
                out += [(own, -minus, score) for own, best in found for score, minus in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def top_k(table: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query with the other rows, ties to the smaller id.

    ``table`` has vec_id and an integer ``vector`` (see ``integer_vectors``);
    only vectors of equal length meet. A query's own row is the one with its
    id; rows that repeat an id are candidates of other queries each, and
    queries that repeat an id are asked once, with the largest of their vectors.
    """
    spark = ready(table.sparkSession)
    rows = written(table.select("vec_id", "vector", F.size("vector").alias("dim")), "vectors")
    n = rows.groupBy("dim").count().collect()  # one row per vector length
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Equally many shards for every length; a length with few rows leaves some empty.
    shards = max(-(-r["count"] // shard_rows) for r in n)
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    trees = written(rows.groupBy(shard.alias("shard"), "dim").applyInPandas(_build, TREES), "trees")
    queries = (
        rows.where(is_query).groupBy("dim", F.col("vec_id").alias("query_id")).agg(F.max("vector").alias("vector"))
    )
    home = F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int")
    search = _search(k)

    def asked(df: DataFrame) -> DataFrame:
        return trees.groupBy("shard", "dim").cogroup(df.groupBy("shard", "dim")).applyInPandas(search, FOUND)

    first_asked = queries.withColumns({"shard": home, "kth": F.lit(int(LOWEST)).cast("long"), "kth_id": F.lit(int(NO_ID)).cast("long")})
    first = written(asked(first_asked), "first-shard")
    # The kth score of the first shard, where it had k rows.
    best = F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("minus"))), asc=False)
    kth = first.groupBy("query_id").agg(F.try_element_at(best, F.lit(k)).alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    with_kth = queries.join(kth.select("query_id", "kth"), "query_id", "left").select(
        "dim", "query_id", "vector", F.coalesce("kth.score", F.lit(int(LOWEST)).cast("long")).alias("kth"),
        F.coalesce(-F.col("kth.minus"), F.lit(int(NO_ID)).cast("long")).alias("kth_id"),
    )
    others = with_kth.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != home)
    rest = asked(others) if shards > 1 else first.limit(0)
    ranked = (
        first.unionByName(rest).groupBy("query_id")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("minus"))), asc=False), 1, k).alias("best"))
    )  # at most k rows of every shard
    return ranked.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), (-F.col("one.minus")).alias("vec_id"), F.col("one.score").alias("score")
    )
