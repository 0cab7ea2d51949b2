"""Token ids of whole texts with a public tokenizer, remembering the chunks a worker has met.

A tokenizer splits text before it merges, and never merges across white space.
So a text's ids are those of its chunks, one after another, and a chunk that
occurs again need not be merged again. ``tests/llm`` compares with encoding
whole texts. Special tokens of the file that a text spells out have their own
ids, as when whole texts are encoded with the file as it is.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

from tokenizers import Tokenizer

from galecast.llm.textblocks import BYTE_VALUES, LOWER_VALUES, SPACE, span_hashes, words

KIND = np.zeros(256, np.uint8)  # 1 letter, 2 punctuation, 3 apostrophe, all of ASCII
KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
KIND[[c for c in range(65, 123) if chr(c).isalpha()]] = 1
KIND[ord("'")] = 3

REMEMBERED = 200_000
_encoders: dict[tuple[str, bool, int], "ChunkEncoder"] = {}


def encoder(path: str, spaces_matter: bool, remembered: int = REMEMBERED) -> "ChunkEncoder":
    """One encoder per worker process, so that what it remembers serves later tasks too."""
    key = (path, spaces_matter, remembered)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, spaces_matter, remembered)
    return _encoders[key]


def _inner_cuts(data: np.ndarray) -> np.ndarray:
    """Where an ASCII letter meets ASCII punctuation; both patterns end a piece there.

    Not after an apostrophe, which may open a contraction.
    """
    kind = KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = ((kind[:-1] == 1) & (kind[1:] >= 2)) | ((kind[:-1] == 2) & (kind[1:] == 1))
    return cut


def spaced_chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that cover all bytes; white space opens the span of what follows it.

    A byte-level pattern ends a piece before white space that follows anything
    else. Where the character before may itself be white space beyond ASCII, no
    cut is made, and the chunk is only longer.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    space = SPACE[data]
    cut = _inner_cuts(data)
    at_space = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    two, three = data[np.maximum(at_space - 2, 0)], data[np.maximum(at_space - 3, 0)]
    doubtful = (data[at_space - 1] >= 0x80) & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3)))
    cut[at_space[~doubtful]] = True
    cut[off[:-1][off[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def word_chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans between white space, cut further where letters meet punctuation."""
    starts, ends, _ = words(data, off)
    if len(data):
        inner = _inner_cuts(data)
        inner[starts] = False
        inner = np.flatnonzero(inner)
        starts, ends = np.sort(np.append(starts, inner)), np.sort(np.append(ends, inner))
    return starts, ends, np.searchsorted(off, starts, "right") - 1


class ChunkEncoder:
    """``spaces_matter``: white space and case belong to the ids (byte level), or neither does.

    At most twice ``remembered`` chunks are kept; the older half goes first.
    Bytes that are no UTF-8 count as U+FFFD.
    """

    def __init__(self, path: str, spaces_matter: bool, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaces_matter = spaces_matter
        self.remembered = remembered
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _known(self, keys: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        found = [young.get(k) for k in keys]
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                ids = old.get(keys[i])
                if ids is None:
                    missing.append(i)
                else:
                    found[i] = young[keys[i]] = ids
        if missing:
            new = self.tokenizer.encode_batch_fast(
                [keys[i].decode("utf-8", "replace") for i in missing], add_special_tokens=False
            )
            for i, encoding in zip(missing, new):
                found[i] = young[keys[i]] = array("I", encoding.ids).tobytes()
        if len(young) > self.remembered:
            self.old, self.young = young, {}
        return found

    def _chunks(self, data: np.ndarray, off: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans to encode one by one, with their texts; a special token is a span, and texts are cut around it."""
        chunks = spaced_chunks if self.spaces_matter else word_chunks
        found = []
        for special in self.specials:
            at = raw.find(special)
            while at >= 0:
                text = int(np.searchsorted(off, at, "right")) - 1
                if at + len(special) <= off[text + 1]:
                    found.append((at, at + len(special)))
                at = raw.find(special, at + len(special))
        if not found:
            return chunks(data, off)
        begins, stops = np.array(sorted(found), np.int64).T
        starts, ends, _ = chunks(data, np.unique(np.concatenate([off, begins, stops])))
        before = np.searchsorted(begins, starts, "right") - 1
        plain = (before < 0) | (starts >= stops[before])
        starts, ends = np.concatenate([starts[plain], begins]), np.concatenate([ends[plain], stops])
        order = np.argsort(starts)
        return starts[order], ends[order], np.searchsorted(off, starts[order], "right") - 1

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, each with its end id, and n + 1 offsets into them."""
        raw = data.tobytes()
        starts, ends, rows = self._chunks(data, off, raw)
        values = BYTE_VALUES if self.spaces_matter else LOWER_VALUES
        _, first, inverse = np.unique(span_hashes(data, starts, ends, values), return_index=True, return_inverse=True)
        raw = raw if self.spaces_matter else raw.lower()
        ids = self._known([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        begins = np.cumsum(sizes) - sizes
        each = sizes[inverse]
        where = np.arange(each.sum()) + np.repeat(begins[inverse] - (np.cumsum(each) - each), each)
        n = len(off) - 1
        per_text = np.bincount(rows, weights=each, minlength=n).astype(np.int64) if n else np.zeros(0, np.int64)
        text_ends = np.cumsum(per_text)
        out = np.insert(flat[where], text_ends, np.uint32(end_id))
        return out, np.concatenate([[0], text_ends + np.arange(1, n + 1)])
