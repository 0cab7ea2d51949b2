"""Fill-in-the-middle: documents cut in prefix, middle and suffix at two token boundaries, in the order a model is to read them.

The ends of all tokens of a block of texts are one ``BoundarySet`` over the
bytes of the block; a document's k-th boundary is the one k places behind the
last of the documents before it, so both cuts of all documents are found by
two calls of ``select``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.boundaries import BoundarySet
from galecast.llm.session import ready
from galecast.llm.textblocks import SPACE, text_blocks, words

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # fixed values
SEED = "42"
TRANSFORMED_PERCENT = 50
SPM_PERCENT = 80
ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Cuts:
    """Per text of a block: number of tokens, and the byte offsets of both cuts."""

    n: np.ndarray
    first: np.ndarray
    second: np.ndarray


def token_ends(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the last bytes of all tokens, and how many tokens each text has.

    A token is white space and the word behind it, or white space that ends a text.
    """
    _, ends, rows = words(data, off)
    n = np.bincount(rows, minlength=len(off) - 1)
    full = np.diff(off) > 0
    trailing = np.zeros(len(full), bool)
    trailing[full] = SPACE[data[off[1:][full] - 1]]
    last = np.sort(np.concatenate([ends - 1, off[1:][trailing] - 1]))
    return last, n + trailing


def cuts(data: np.ndarray, off: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> Cuts:
    """Cuts behind h1 % (n + 1) and h2 % (n + 1) tokens, the smaller first."""
    last, n = token_ends(data, off)
    before = np.cumsum(n) - n
    boundaries = BoundarySet(last)

    def offset(tokens: np.ndarray) -> np.ndarray:
        out = off[:-1].copy()
        some = tokens > 0
        out[some] = boundaries.select(before[some] + tokens[some] - 1) + 1
        return out

    a, b = h1 % (n + 1), h2 % (n + 1)
    return Cuts(n, offset(np.minimum(a, b)), offset(np.maximum(a, b)))


def draws(ids: list[int | None], seed: str) -> np.ndarray:
    """Four unsigned 32-bit numbers of every id, from the SHA-256 of seed, colon and id; a null id is no digits."""
    found = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(found, ">u4").reshape(-1, 4).astype(np.int64)


def _cutter(seed: str, transformed: int, spm: int, kept: list[str], at_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in text_blocks(batches, "_text"):
            h = draws(batch.column(at_id).to_pylist(), seed)
            found = cuts(data, off, h[:, 0], h[:, 1])
            raw = data.tobytes()
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            prefix_chars = (chars[found.first] - chars[off[:-1]]).tolist()
            middle_chars = (chars[found.second] - chars[found.first]).tolist()
            is_spm, chosen = h[:, 3] % 100 < spm, h[:, 2] % 100 < transformed
            forms, texts = [], []
            bounds = zip(off[:-1].tolist(), found.first.tolist(), found.second.tolist(), off[1:].tolist())
            for i, (a, b, c, d) in enumerate(bounds):
                text = raw[a:d]
                if not chosen[i] or not text or b"<P>" in text or b"<S>" in text or b"<M>" in text:
                    forms.append("plain")
                    texts.append(text)
                    prefix_chars[i] = middle_chars[i] = None
                elif is_spm[i]:
                    forms.append("spm")
                    texts.append(b"".join((b"<S>", raw[c:d], b"<P>", raw[a:b], b"<M>", raw[b:c])))
                else:
                    forms.append("psm")
                    texts.append(b"".join((b"<P>", raw[a:b], b"<S>", raw[c:d], b"<M>", raw[b:c])))
            added = [
                pa.array(found.n, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix_chars, pa.int64()),
                pa.array(middle_chars, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], *added], names=[*kept, *[x.split()[0] for x in ADDED.split(", ")]])

    return run


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = SEED,
    transformed_percent: int = TRANSFORMED_PERCENT, spm_percent: int = SPM_PERCENT, keep: list[str] | None = None,
) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) and n, form, prefix_chars, middle_chars, output.

    ``n`` counts tokens. ``form`` is ``psm``, ``spm`` or ``plain``; plain are
    empty and null texts, texts that hold a marker, and those not drawn, and
    their output is the text (null: empty). What is drawn depends on seed and
    id alone: rows that repeat an id are drawn alike, null ids too. Columns of
    ``docs`` named like an added one are left out. No rows give no rows.
    """
    ready(docs.sparkSession)
    names = [x.split()[0] for x in ADDED.split(", ")]
    given = [c for c in (docs.columns if keep is None else keep) if c not in names]
    kept = [f"_c{i}" for i in range(len(given))]  # own names: those of ``docs`` may clash
    rows = docs.select(
        *[F.col(c).alias(k) for c, k in zip(given, kept)],
        F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    types = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    made = rows.mapInArrow(_cutter(seed, transformed_percent, spm_percent, kept, "_id"), f"{types}, {ADDED}" if types else ADDED)
    return made.withColumnsRenamed(dict(zip(kept, given)))


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from output and form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
