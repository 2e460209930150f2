"""Arrow batches of texts, cut to a bounded size, and their words as codes.

Shared by the operators that read whole texts in Arrow batches. A word is a run
of bytes other than the ASCII white space 0x09-0x0D and 0x20; words never span
two texts. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a longer single text is handled alone.
BATCH_BYTES = 8 << 20

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = False


def plain_texts(column: pa.Array) -> pa.Array:
    """The column as strings with 64-bit offsets, nulls as empty texts."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding at most ``limit`` text bytes, or one row."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and the offset of each text (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or len(offsets) < 2:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return body, offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch: ``vocabulary[codes[i]]`` is word i; text t has words
    ``bounds[t]`` to ``bounds[t + 1]``; word i starts at byte ``starts[i]``."""

    vocabulary: pa.Array
    codes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def words_of(texts: pa.Array, word_bytes: np.ndarray = _IS_WORD) -> Words:
    """Runs of the bytes that ``word_bytes`` marks."""
    body, offsets = byte_view(texts)
    inside = word_bytes[body]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(body)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    lengths = np.flatnonzero(inside & ~after) - starts + 1
    bounds = np.searchsorted(starts, offsets)
    spelled = pa.Array.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)), pa.py_buffer(body[inside])],
    )
    coded = spelled.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy().astype(np.int64), bounds, starts, lengths)


@dataclass
class Ragged:
    """Rows of unequal length in one array: row i is ``values[ends[i]:ends[i + 1]]``."""

    values: np.ndarray
    ends: np.ndarray

    def take(self, rows: np.ndarray) -> Ragged:
        """The rows with these numbers, in this order."""
        size = self.values.itemsize
        table = pa.Array.from_buffers(
            pa.large_binary(),
            len(self.ends) - 1,
            [None, pa.py_buffer((self.ends * size).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.values))],
        )
        body, offsets = byte_view(table.take(pa.array(rows)))
        return Ragged(body.view(self.values.dtype), offsets // size)

    def joined(self, other: Ragged) -> Ragged:
        return Ragged(
            np.concatenate([self.values, other.values]), np.concatenate([self.ends, self.ends[-1] + other.ends[1:]])
        )


def stretches(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end, as strings."""
    sizes = (end - start).astype(np.int64)
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - start, sizes)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(body[at])])


class KnownWords:
    """Ids of words already met, so that a worker encodes a common word once.

    Holds at most ``limit`` words; later ones are encoded whenever they come.
    """

    def __init__(self, encode: Callable[[pa.Array], Ragged], limit: int):
        self.encode, self.limit = encode, limit
        self.words = pa.array([], type=pa.large_binary())
        self.coded = Ragged(np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))

    def ids(self, words: pa.Array) -> Ragged:
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        fresh = self.encode(words.take(pa.array(new)))
        known = len(self.words)
        at[new] = known + np.arange(len(new))
        both = self.coded.joined(fresh)
        if known + len(new) <= self.limit:
            self.words = pa.concat_arrays([self.words, words.take(pa.array(new))])
            self.coded = both
        return both.take(at)


_known: dict[str, KnownWords] = {}


def known_words(name: str, encode: Callable[[pa.Array], Ragged], limit: int = 800_000) -> KnownWords:
    """The worker's own store of this name; tasks that share a worker share it."""
    return _known.setdefault(name, KnownWords(encode, limit))
