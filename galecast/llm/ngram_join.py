"""Near duplicates by the Jaccard similarity of word n-grams, with signature trees.

1. Every text becomes a set of 64-bit shingle hashes. Texts with equal sets
   are one node; the links of copies are not spelled out.
2. Two sets that are similar enough share a shingle among the first few of
   either, in any order that is the same for all (prefix filter). Shingles
   come first whose rarest word is rare: a shingle is in no more documents than
   each of its words is, so passages and phrases of many documents stay out of
   these few. Word counts are kept in a table of fixed size, where words may
   share a slot; that only makes the order less sharp. The first few are taken
   long enough that similar sets share several of them, so nodes that share
   fewer with nodes of fitting size drop out. The others are joined to clusters
   by the shingles they share. So all links lie within clusters.
3. Within a cluster a signature tree holds the OR of its documents' bitmaps
   and their range of sizes at every node. Walking two trees at once, a pair of
   nodes is left when the largest overlap that bitmaps and sizes allow is too
   small, or when all below is in one component already; what remains is
   compared exactly. A cluster of more than ``SLICE`` nodes is cut in slices,
   and pairs of slices are separate pieces of work.
4. Components of the links give every document its class.

Hashes are 64 bits wide; that two of N different sets or shingles meet is a
matter of N**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.components import components
from galecast.llm.exact_dedup import comparable, marked_pages, with_flag
from galecast.llm.session import ready, written
from galecast.llm.textblocks import LOWER_VALUES, mixed, span_hashes, text_blocks, words

N_WORDS = 5
SIMILARITY = 80  # hundredths
WORD_SLOTS = 1 << 22
PAGE = 1 << 12
TASKS_PER_SUM = 32
FLUSH = 1 << 20
NODES_PER_BUCKET = 8192
SLICE = 2048
LEAF = 16
MAP_BITS = 1 << 23
MAP_PAGE = 1 << 15
_STEP, _SHORT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def word_slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(WORD_SLOTS - 1)).astype(np.int64)


def shingle_sets(data: np.ndarray, off: np.ndarray, n_words: int, levels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Sorted distinct shingle hashes of every text of a block, A-Z lower-cased, and the level of the rarest word of each.

    ``levels``: magnitude of the count in every word slot. A text with fewer
    words has its whole sequence as its one shingle; one without has none.
    """
    starts, ends, rows = words(data, off)
    h = span_hashes(data, starts, ends, LOWER_VALUES)
    n_texts = len(off) - 1
    n = max(0, len(h) - n_words + 1)
    whole, inside = h[:n].copy(), np.zeros(0, bool)
    own = None if levels is None else levels[word_slots(h)]
    least = None if own is None else own[:n].copy()
    for j in range(1, n_words):
        whole *= _STEP
        whole += h[j : n + j]
        if least is not None:
            np.minimum(least, own[j : n + j], out=least)
    if n:
        inside = rows[:n] == rows[n_words - 1 :]
    shingles, owner = mixed(whole[inside]), rows[:n][inside]
    least = None if least is None else least[inside]
    cuts = np.searchsorted(owner, np.arange(n_texts + 1))
    first_word = np.searchsorted(rows, np.arange(n_texts + 1))
    for i in range(n_texts):
        a, b = cuts[i], cuts[i + 1]
        if b > a and least is None:
            yield np.unique(shingles[a:b]), None
        elif b > a:
            found, first = np.unique(shingles[a:b], return_index=True)
            yield found, least[a:b][first]
        elif first_word[i + 1] > first_word[i]:
            value = np.array([first_word[i + 1] - first_word[i]], np.uint64) * _SHORT
            for word in h[first_word[i] : first_word[i + 1]]:
                value = value * _STEP + word
            yield mixed(value), np.zeros(1, np.uint8)
        else:
            yield np.zeros(0, np.uint64), np.zeros(0, np.uint8)


def set_digest(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    total = mixed(shingles ^ _SHORT).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def shared_at_least(n):
    """How many of their first shingles similar sets share, as looked for in a set of ``n``."""
    return 1 + n // 32


def prefix_length(n: int, similarity: int) -> int:
    """How many first shingles of a set of ``n`` hold as many common ones.

    A similar set lacks at most ``n`` minus ceil(similarity * n) of them; so
    the first common shingles are within that many and their own number, for
    either set.
    """
    return min(n, n - -(-similarity * n // 100) + shared_at_least(n))


# ---- 1: sets, and how common words are -----------------------------------------------

SETS = "doc_id long, n_shingles long, node long, text_hash long, page int, slots binary, counts binary, some int"
_SETS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("text_hash", pa.int64()), ("page", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary()), ("some", pa.int32())
])


def _describe(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros(WORD_SLOTS, np.int64), TaskContext.get().partitionId() // TASKS_PER_SUM
        for batch, data, off in text_blocks(batches):
            starts, ends, _rows = words(data, off)
            slots, n = np.unique(word_slots(span_hashes(data, starts, ends, LOWER_VALUES)), return_counts=True)
            counts[slots] += n
            sets = [s for s, _ in shingle_sets(data, off, n_words)]
            n_shingles = [len(s) for s in sets]
            node = [set_digest(s) if len(s) else None for s in sets]
            empty = [pa.nulls(len(sets), f.type) for f in list(_SETS_ARROW)[4:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_shingles, pa.int64()), pa.array(node, pa.int64()), batch.column("text_hash"), *empty], schema=_SETS_ARROW
            )
        pages = [(i, np.flatnonzero(p), p) for i, p in enumerate(counts.reshape(-1, PAGE))]
        pages = [(i, at.astype(np.uint16).tobytes(), p[at].tobytes(), some) for i, at, p in pages if len(at)]
        if pages:
            empty = [pa.nulls(len(pages), f.type) for f in list(_SETS_ARROW)[:4]]
            yield pa.RecordBatch.from_arrays([*empty, *[pa.array(c, f.type) for c, f in zip(zip(*pages), list(_SETS_ARROW)[4:])]], schema=_SETS_ARROW)

    return run


def _page_levels(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"page": rows["page"].iloc[:1], "levels": [np.frexp(_page_sum(rows))[1].astype(np.uint8).tobytes()]})


def _page_sum(rows: pd.DataFrame) -> np.ndarray:
    total = np.zeros(PAGE, np.int64)
    for slots, counts in zip(rows["slots"], rows["counts"]):
        total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.int64)
    return total


def _summed_pages(rows: pd.DataFrame) -> pd.DataFrame:
    total = _page_sum(rows)
    at = np.flatnonzero(total)
    return pd.DataFrame({"page": rows["page"].iloc[:1], "slots": [at.astype(np.uint16).tobytes()], "counts": [total[at].tobytes()]})


def _levels(described: DataFrame) -> np.ndarray:
    """Magnitude of the count in every word slot: ``WORD_SLOTS`` bytes at any input size."""
    parts = described.where("page is not null").select("page", "slots", "counts", "some")
    parts = parts.groupBy("page", "some").applyInPandas(_summed_pages, "page int, slots binary, counts binary")
    pages = parts.groupBy("page").applyInPandas(_page_levels, "page int, levels binary")
    out = np.zeros(WORD_SLOTS, np.uint8)
    for row in pages.collect():
        out[row["page"] * PAGE : (row["page"] + 1) * PAGE] = np.frombuffer(row["levels"], np.uint8)
    return out


# ---- 2: prefixes and clusters ---------------------------------------------------------

POSTINGS = "bucket int, keys binary, nodes binary, sizes binary"
_POSTINGS_ARROW = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])


def _top_bits(values: np.ndarray, bits: int) -> np.ndarray:
    return (values.astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _packed(place: np.ndarray, keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> tuple:
    """Columns of POSTINGS rows: each place once, with its postings as arrays of bytes."""
    order = np.argsort(place, kind="stable")
    present, at = np.unique(place[order], return_index=True)
    spans = list(zip(at.tolist(), [*at[1:].tolist(), len(place)]))
    return (present.astype(np.int32), *[[x[order][a:b].tobytes() for a, b in spans] for x in (keys, nodes, sizes.astype(np.int32))])


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kinds = (("keys", np.uint64), ("nodes", np.int64), ("sizes", np.int32))
    keys, nodes, sizes = (np.frombuffer(b"".join(rows[c]), kind) for c, kind in kinds)
    return keys, nodes, sizes.astype(np.int64)


def _prefixes(n_words: int, similarity: int, held_levels, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = held_levels.value
        keys, nodes, sizes, n_waiting, met = [], [], [], 0, set()

        def flush() -> pa.RecordBatch:
            k, each = np.concatenate(keys), [len(x) for x in keys]
            columns = _packed(_top_bits(k, bits), k, np.repeat(np.array(nodes, np.int64), each), np.repeat(np.array(sizes, np.int64), each))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _POSTINGS_ARROW)], schema=_POSTINGS_ARROW)

        for _, data, off in text_blocks(batches):
            for found, level in shingle_sets(data, off, n_words, levels):
                if not len(found):
                    continue
                node = set_digest(found)
                if node in met:
                    continue
                if len(met) < FLUSH:  # only saves repeats
                    met.add(node)
                p = prefix_length(len(found), similarity)
                order = (level.astype(np.uint64) << np.uint64(56)) | (found >> np.uint64(8))
                first = np.argpartition(order, p - 1)[:p] if p < len(found) else slice(None)
                keys.append(found[first])
                nodes.append(node)
                sizes.append(len(found))
                n_waiting += p
                if n_waiting >= FLUSH:
                    yield flush()
                    keys, nodes, sizes, n_waiting = [], [], [], 0
        if keys:
            yield flush()

    return run


def _of_several(rows: pd.DataFrame, similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Postings by key, then size, and whether each and the next share the key and could be similar by size.

    Between two nodes that could be similar lie only such, so neighbours tell.
    """
    keys, nodes, sizes = _unpacked(rows)
    by_key = np.argsort(keys)
    same = keys[by_key][1:] == keys[by_key][:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    pick = by_key[twice]
    pick = pick[np.lexsort((nodes[pick], sizes[pick], keys[pick]))]
    keys, nodes, sizes = keys[pick], nodes[pick], sizes[pick]
    once = np.ones(len(keys), bool)  # copies of one node come from several tasks
    once[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes, sizes = keys[once], nodes[once], sizes[once]
    return keys, nodes, sizes, (keys[1:] == keys[:-1]) & (100 * sizes[:-1] >= similarity * sizes[1:])


def _shared_postings(similarity: int, bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Postings whose shingle another fitting node has, packed by node."""
        keys, nodes, sizes, near = _of_several(rows, similarity)
        shared = np.zeros(len(keys), bool)
        shared[1:] |= near
        shared[:-1] |= near
        columns = _packed(_top_bits(nodes[shared], bits), keys[shared], nodes[shared], sizes[shared])
        return pd.DataFrame(dict(zip(("bucket", "keys", "nodes", "sizes"), columns)))

    return run


def _kept_postings(bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Postings of nodes that share enough, packed by shingle again."""
        keys, nodes, sizes = _unpacked(rows)
        _, where, n = np.unique(nodes, return_inverse=True, return_counts=True)
        keep = n[where] >= shared_at_least(sizes)
        columns = _packed(_top_bits(keys[keep], bits), keys[keep], nodes[keep], sizes[keep])
        return pd.DataFrame(dict(zip(("bucket", "keys", "nodes", "sizes"), columns)))

    return run


def _neighbours(similarity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Pairs of neighbours by size among the nodes of a shingle; a gap in size that rules out a link cuts the chain."""
        _, nodes, _, near = _of_several(rows, similarity)
        pairs = np.unique(np.stack([nodes[:-1][near], nodes[1:][near]], axis=1), axis=0) if near.any() else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


# ---- 3: trees of signatures -----------------------------------------------------------


class SignatureTree:
    """Documents in the order of their smallest hash, so that similar ones share leaves; levels halve up to the root."""

    def __init__(self, sets: list[np.ndarray], index: np.ndarray, bits: int):
        self.index = index[np.lexsort(([len(sets[i]) for i in index], [sets[i][0] for i in index]))]
        n = len(self.index)
        own = np.zeros((n, bits // 64), np.uint64)
        for row, i in enumerate(self.index.tolist()):
            flags = np.zeros(bits, np.uint8)
            flags[(sets[i] & np.uint64(bits - 1)).astype(np.int64)] = 1
            own[row] = np.packbits(flags, bitorder="little").view(np.uint64)
        size = np.array([len(sets[i]) for i in self.index], np.int64)
        excess = size - np.bitwise_count(own).sum(axis=1, dtype=np.int64)
        self.own, self.size, self.excess = own, size, excess
        cuts = np.arange(0, n, LEAF)
        level = [np.bitwise_or.reduceat(own, cuts), np.minimum.reduceat(size, cuts), np.maximum.reduceat(size, cuts), np.maximum.reduceat(excess, cuts)]
        self.levels = [level]
        while len(level[0]) > 1:
            cuts = np.arange(0, len(level[0]), 2)
            level = [f.reduceat(x, cuts) for f, x in zip((np.bitwise_or, np.minimum, np.maximum, np.maximum), level)]
            self.levels.append(level)

    def rows(self, depth: int, at: int) -> tuple[int, int]:
        """Span of documents below a node; depth 0 are the leaves."""
        width = LEAF << depth
        return at * width, min(len(self.index), (at + 1) * width)


def _possible(overlap, least_a, least_b, most_a, most_b, similarity: int):
    """Whether sizes and a bound of the overlap leave room for a link."""
    overlap = np.minimum(overlap, np.minimum(most_a, most_b))
    return (
        ((100 + similarity) * overlap >= similarity * (least_a + least_b))
        & (100 * most_a >= similarity * least_b) & (100 * most_b >= similarity * least_a)
    )


def spanning_links(sets: list[np.ndarray], similarity: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions in ``sets``) that connect whatever links connect; with ``sides`` only links between side 0 and 1 are sought."""
    if len(sets) < 2:
        return []
    bits = 256
    while bits < 16 * np.median([len(s) for s in sets]) and bits < 1 << 17:
        bits *= 2
    everything = np.arange(len(sets))
    one = SignatureTree(sets, everything if sides is None else everything[sides == 0], bits)
    two = one if sides is None else SignatureTree(sets, everything[sides == 1], bits)
    label, links = np.arange(len(sets)), []

    def united(a: tuple[int, int], b: tuple[int, int]) -> bool:
        x, y = label[one.index[a[0] : a[1]]], label[two.index[b[0] : b[1]]]
        return x[0] == y[0] and (x == x[0]).all() and (y == y[0]).all()

    def compare(a: tuple[int, int], b: tuple[int, int]) -> None:
        p, q = slice(*a), slice(*b)
        overlap = np.bitwise_count(one.own[p][:, None] & two.own[q][None]).sum(axis=2, dtype=np.int64)
        overlap += np.minimum(one.excess[p][:, None], two.excess[q][None])
        sa, sb = one.size[p][:, None], two.size[q][None]
        for i, j in np.argwhere(_possible(overlap, sa, sb, sa, sb, similarity)).tolist():
            x, y = one.index[a[0] + i], two.index[b[0] + j]
            if label[x] == label[y]:
                continue
            small, large = sorted((sets[x], sets[y]), key=len)
            at = np.searchsorted(large, small)
            common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            if 100 * common >= similarity * (len(small) + len(large) - common):
                links.append((int(x), int(y)))
                label[label == label[y]] = label[x]

    top_one, top_two = len(one.levels) - 1, len(two.levels) - 1
    waiting = [(top_one, 0, top_two, 0)]
    while waiting:
        da, a, db, b = waiting.pop()
        ra, rb = one.rows(da, a), two.rows(db, b)
        if united(ra, rb):
            continue
        if not (one is two and da == db and a == b):
            la, lb = [x[a] for x in one.levels[da]], [x[b] for x in two.levels[db]]
            overlap = int(np.bitwise_count(la[0] & lb[0]).sum(dtype=np.int64)) + min(la[3], lb[3])
            if not _possible(overlap, la[1], lb[1], la[2], lb[2], similarity):
                continue
        if da == 0 and db == 0:
            compare(ra, rb)
            continue
        if da >= db:
            children = [(da - 1, c) for c in (2 * a, 2 * a + 1) if c < len(one.levels[da - 1][0])]
        if one is two and da == db and a == b:
            waiting += [(x[0], x[1], y[0], y[1]) for i, x in enumerate(children) for y in children[i:]]
        elif da >= db:
            waiting += [(x[0], x[1], db, b) for x in children]
        else:
            waiting += [(da, a, db - 1, c) for c in (2 * b, 2 * b + 1) if c < len(two.levels[db - 1][0])]
    return links


SET_ROWS = "node long, shingles binary"


def _wanted_sets(n_words: int, held_map):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, met = held_map.value, set()
        for _, data, off in text_blocks(batches):
            rows = []
            for found, _ in shingle_sets(data, off, n_words):
                if not len(found):
                    continue
                node = set_digest(found)
                at = node & (MAP_BITS - 1)
                if wanted[at >> 3] >> (at & 7) & 1 and node not in met:
                    if len(met) < FLUSH:
                        met.add(node)
                    rows.append((node, found.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["node", "shingles"]
                )

    return run


def _node_map(nodes: DataFrame) -> np.ndarray:
    """A bitmap of hashed nodes, 1 MB at any input size; others may be in it by chance."""
    slot = F.col("node").bitwiseAND(MAP_BITS - 1)
    pages = nodes.groupBy((slot / MAP_PAGE).cast("int").alias("page")).agg(F.bitmap_construct_agg(slot % MAP_PAGE).alias("bits"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for row in pages.collect():
        at = row["page"] * (MAP_PAGE // 8)
        out[at : at + MAP_PAGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _unit_links(similarity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, low, high), group in rows.groupby(["component", "low", "high"], sort=False):
            group = group.drop_duplicates("node")
            nodes = group["node"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            sides = None if low == high else (group["slice"] == high).to_numpy().astype(int)
            out += [(nodes[i], nodes[j]) for i, j in spanning_links(sets, similarity, sides)]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def similar_groups(docs: DataFrame, n_words: int = N_WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when 100 * common >= similarity * united shingles;
    ``component_id`` is the smallest doc_id that links reach. Null texts and
    texts without words have no shingles and stay alone, with their own id.
    Rows that repeat an id are nodes of their own; null ids are passed over
    where another id is reachable. An empty table gives no rows.
    """
    return _hashed_groups(docs, n_words, similarity).drop("text_hash", "component")


def _text_hash(text: Column) -> Column:
    """Tells rows that repeat an id from those with equal texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _hashed_groups(docs: DataFrame, n_words: int, similarity: int) -> DataFrame:
    """As ``similar_groups``, with the text_hash of every row and the component of its words, null without words."""
    spark = ready(docs.sparkSession)
    context = spark.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = texts.withColumn("text_hash", _text_hash(F.col("text")))
    described = written(hashed.mapInArrow(_describe(n_words), SETS), "shingles")
    rows = described.where("page is null").select("doc_id", "n_shingles", "node", "text_hash")
    levels = context.broadcast(_levels(described))

    n_rows = rows.count()
    bits = max(3, (n_rows // NODES_PER_BUCKET).bit_length())
    postings = texts.select("text").mapInArrow(_prefixes(n_words, similarity, levels, bits), POSTINGS)
    shared = postings.groupBy("bucket").applyInPandas(_shared_postings(similarity, bits), POSTINGS)
    kept = shared.groupBy("bucket").applyInPandas(_kept_postings(bits), POSTINGS)
    clusters = written(components(kept.groupBy("bucket").applyInPandas(_neighbours(similarity), "a long, b long")), "clusters")
    levels.destroy()  # workers that stay for later stages need not hold it

    wanted = context.broadcast(_node_map(clusters))
    sets = texts.select("text").mapInArrow(_wanted_sets(n_words, wanted), SET_ROWS)
    slices = clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    sliced = clusters.join(slices, "component").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    units = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // NODES_PER_BUCKET)
    work = sliced.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "node", "component", "slice", F.least("slice", "other").alias("low"), F.greatest("slice", "other").alias("high"),
        F.when(F.col("slices") == 1, F.pmod(F.xxhash64("component"), F.lit(units)))
        .otherwise(F.xxhash64("component", F.least("slice", "other"), F.greatest("slice", "other"))).alias("unit"),
    )
    links = sets.join(work, "node").groupBy("unit").applyInPandas(_unit_links(similarity), "a long, b long")
    linked = components(links)

    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    classed = written(
        nodes.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "least"), "classes"
    )
    wanted.destroy()
    ids = classed.groupBy("component").agg(F.min("least").alias("component_id"))
    node_ids = classed.join(ids, "component").select("node", "component_id", "component")
    found = rows.where("node is not null").join(node_ids, "node").select("doc_id", "n_shingles", "component_id", "text_hash", "component")
    alone = rows.where("node is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("long").alias("component")
    )
    return found.unionByName(alone)


def one_of_each_group(docs: DataFrame, n_words: int = N_WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: exactly one of each group of linked or equal sets.

    It is the one with the smallest id; null ids come last, and of rows that
    repeat the id one stays. Texts without words all stay. Rows that share an
    id are judged by the group of their own text. Only texts that may have a
    partner, told by a bitmap of 1 MB, are shuffled.
    """
    members = written(_hashed_groups(docs, n_words, similarity).where("component is not null").select("text_hash", "component"), "members")
    shared = members.groupBy("component").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("component")
    groups = written(members.join(shared, "component").select(F.col("text_hash").alias("_partner_hash"), F.col("component").alias("_group")).distinct(), "groups")

    own = [f"_d{i}" for i in range(len(docs.columns))]  # own names: those of ``docs`` may clash
    named = dict(zip(docs.columns, own))
    rows = docs.toDF(*own).withColumn("_hash", _text_hash(F.col(named["text"])))
    rows = with_flag(rows, marked_pages(groups.select(F.col("_partner_hash").alias("_hash")), ["_hash"]), ["_hash"], "_maybe")
    placed = rows.where("_maybe").join(groups, F.col("_hash") == F.col("_partner_hash"), "left")
    order = F.struct(F.col(named["doc_id"]).isNull(), F.col(named["doc_id"]), F.xxhash64(*[named[c] for c in comparable(docs)]))
    kept = placed.where("_group is not null").groupBy("_group").agg(F.min_by(F.struct(*own), order).alias("_row")).select("_row.*")
    return (
        rows.where(~F.col("_maybe")).select(*own).unionByName(placed.where("_group is null").select(*own))
        .unionByName(kept).toDF(*docs.columns)
    )
