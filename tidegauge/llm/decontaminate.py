"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared in lower case (ASCII and Latin-1 letters) with each run of
white space as one blank. A benchmark item is searched as segments of ``SEGMENT``
bytes, one from each of its bytes on, so a passage that holds any such part of an
item is found as well. A segment of w bytes within e edits shares at least
w + 1 - q (e + 1) of its q-grams with the text, all near one diagonal (text
position less item position):

1. Every position's q-gram is looked up among the benchmark's. Positions with too
   few hits around them for any segment are passed over.
2. The hits left are dealt per item to overlapping bands of diagonals, each as wide
   as ``BAND`` plus the edit budget, so that a match lies in one whole. In a band
   sorted by item position, runs of as many hits as the lemma asks for give the
   starts of all segments that meet its bound.
3. Segments found whole, as unbroken runs of hits on one diagonal, are taken as they
   are; the others are verified by an alignment within the band.

For items of 10-15, 20-23 and 30-31 bytes the lemma asks for no 8-gram at all; they
have an index of their own, of 5-grams, of which it asks for at least one.

Nothing is shuffled: documents are read once per slice of the benchmark. A slice
has at most about ``SLICE_BYTES`` of item text, and its index goes to the tasks;
larger benchmarks take more slices, with the same result.

Edge cases: null and empty texts and items match nothing; an item of fewer than
``Q`` bytes is no evidence and is not searched. Repeated items or documents each
give their own rows. Items with a null id keep it. Empty tables give an empty
result. Only keys and texts are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.text_batches import byte_view, pieces, plain_texts

#: A segment starts every STEP bytes: at each.
Q, SHORT_Q, SEGMENT, STEP, EDIT_SHARE = 8, 5, 96, 1, 0.1
BAND = 16
TABLE_BITS = 20
SLICE_BYTES = 8 << 20
#: Segments aligned at once, and text bytes handled at once.
ALIGNED, BATCH = 2048, 4 << 20
#: Pairs of a hit and its place in an item handled at once; those of a single text
#: that has more are handled alone.
PAIRS = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def budget(size: int) -> int:
    return int(size * EDIT_SHARE)


def least_shared(size: int, q: int) -> int:
    """The q-gram lemma's bound."""
    return size + 1 - q * (budget(size) + 1)


def gram_size(size: int) -> int:
    """The q for segments of this size: the bound is at least 1."""
    return Q if least_shared(size, Q) >= 1 else SHORT_Q


def plain(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case with single blanks; which bytes were kept; the texts' offsets."""
    upper = (body >= 0x41) & (body <= 0x5A)
    lead = np.zeros(len(body), dtype=bool)
    lead[1:] = body[:-1] == 0xC3
    upper |= lead & (body >= 0x80) & (body <= 0x9E) & (body != 0x97)
    lower = body + upper.astype(np.uint8) * 0x20
    space = _SPACE[body]
    lower[space] = 0x20
    again = np.zeros(len(body), dtype=bool)
    again[1:] = space[1:] & space[:-1]
    starts = offsets[:-1][offsets[:-1] < len(body)]
    again[starts] = False
    kept = np.flatnonzero(~again)
    return lower[kept], kept, np.searchsorted(kept, offsets)


def grams(body: np.ndarray, q: int) -> np.ndarray:
    """The q bytes from each position on, at most Q = 8, as one number."""
    if len(body) < q:
        return np.zeros(0, dtype=np.uint64)
    if q < Q:
        body = np.append(body, np.zeros(Q - q, dtype=np.uint8))
    out = np.empty(len(body) - Q + 1, dtype=np.uint64)
    for shift in range(Q):
        count = (len(body) - shift) // Q
        out[shift::Q] = np.frombuffer(body[shift : shift + count * Q].tobytes(), dtype="<u8")
    return out & np.uint64((1 << 8 * q) - 1)


def bucket(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Index:
    """Items of a benchmark slice that are searched by this q, and where their
    q-grams occur. An item has a number among them; ``size`` is that of its segments."""

    q: int
    items: list
    item: np.ndarray
    body: np.ndarray
    start: np.ndarray
    length: np.ndarray
    size: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    number: np.ndarray
    place: np.ndarray
    table: np.ndarray


def build_index(items: list[tuple], q: int = Q) -> Index | None:
    texts = plain_texts(pa.array([t for _, t in items], type=pa.string()))
    body, _, offsets = plain(*byte_view(texts))
    length = np.diff(offsets)
    fit = np.array([s >= Q and gram_size(s) == q for s in range(SEGMENT + 1)])
    item = np.flatnonzero(fit[np.minimum(length, SEGMENT)])
    if not len(item):
        return None
    start, length = offsets[item], length[item]
    counts = length - q + 1
    number = np.repeat(np.arange(len(item)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    codes = grams(body, q)[start[number] + place]
    order = np.argsort(codes, kind="stable")
    distinct, first = np.unique(codes[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[bucket(distinct)] = True
    return Index(
        q, [k for k, _ in items], item, body, start, length, np.minimum(length, SEGMENT), distinct,
        np.append(first, len(codes)), number[order], place[order], table,
    )


def dense_hits(index: Index, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of benchmark q-grams with enough of them around, and the q-grams'
    numbers in the index."""
    codes = grams(body, index.q)
    likely = np.flatnonzero(index.table[bucket(codes)])
    # A q-gram that leaves its text is none.
    end = offsets[np.searchsorted(offsets, likely, side="right")]
    likely = likely[likely + index.q <= end]
    at = np.minimum(np.searchsorted(index.codes, codes[likely]), len(index.codes) - 1)
    true = index.codes[at] == codes[likely]
    hits, at = likely[true], at[true]
    if not len(hits):
        return hits, at
    sizes = np.unique(index.size)
    enough = np.zeros(len(hits), dtype=bool)
    for size in sizes.tolist():
        need, reach = least_shared(size, index.q), size - index.q + budget(size) + 1
        if need <= 1:
            enough[:] = True
            break
        if len(hits) < need:
            continue
        # Runs of ``need`` hits that fit in a match's length.
        run = np.flatnonzero(hits[need - 1 :] - hits[: len(hits) - need + 1] < reach)
        mark = np.zeros(len(hits) + 1, dtype=np.int64)
        np.add.at(mark, run, 1)
        np.add.at(mark, run + need, -1)
        enough |= np.cumsum(mark[:-1]) > 0
    return hits[enough], at[enough]


def per_size(index: Index, rule: Callable[[int], int]) -> np.ndarray:
    """The rule's value for the segment size of each item."""
    return np.array([rule(s) for s in range(SEGMENT + 1)])[index.size]


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, 0), (i, 1), ... as often as counts[i] says, for each i."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def candidates(
    index: Index, hits: np.ndarray, at: np.ndarray, texts: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(text, item number, first diagonal of the band, start in the item) of each
    segment that meets the lemma's bound and is not found whole, and the stretches
    of segments found whole as rows of :func:`align`. Diagonals count from the
    text's start."""
    which, entry = spread(index.first[at + 1] - index.first[at])
    entry += index.first[at][which]
    number, text, place = index.number[entry], texts[which], index.place[entry]
    need, spare = per_size(index, lambda size: least_shared(size, index.q)), per_size(index, budget)
    reach = index.size - index.q + 1
    longest = int(index.length.max())
    diagonal = hits[which] - offsets[text] - place + longest
    band = diagonal // BAND
    before = np.flatnonzero(diagonal % BAND < spare[number])
    hit = np.concatenate([np.arange(len(entry)), before])
    key = np.concatenate([band, band[before] - 1]) + 1
    width = int(key.max(initial=0)) + 1
    joint = (text * len(index.size) + number)[hit] * width + key
    bands, code, shared = np.unique(joint, return_inverse=True, return_counts=True)
    full = shared[code] >= need[number[hit]]
    hit, code = hit[full], code[full]
    order = np.lexsort((place[hit], code))
    hit, code = hit[order], code[order]
    # A q-gram of the item counts once, however often the band's text has it.
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (place[hit[1:]] != place[hit[:-1]])
    near, code = hit[new], code[new]
    own, spot = number[near], place[near]
    # Runs of ``need`` hits that fit in a segment, and the starts of such segments.
    last = np.arange(len(near)) + need[own] - 1
    last[last >= len(near)] = -1
    run = np.flatnonzero((last >= 0) & (code[last] == code) & (spot[last] - spot < reach[own]))
    own, code_of = own[run], code[run]
    low = np.maximum(spot[last[run]] - reach[own] + 1, 0)
    high = np.minimum(spot[run], (index.length - index.size)[own])
    # Neither bound falls within a band: starts of the run before are left out.
    again = np.flatnonzero(code_of[1:] == code_of[:-1]) + 1
    low[again] = np.maximum(low[again], high[again - 1] + 1)
    which, step = spread(np.maximum(high - low + 1, 0))
    code_of, start = code_of[which], low[which] + step

    # Unbroken runs on one diagonal, as long as a segment.
    hit = np.unique(hit)
    pair = text[hit] * len(index.size) + number[hit]
    hit = hit[np.lexsort((place[hit], diagonal[hit], pair))]
    broken = np.ones(len(hit) + 1, dtype=bool)
    broken[1:-1] = (
        (text[hit[1:]] != text[hit[:-1]]) | (number[hit[1:]] != number[hit[:-1]])
        | (diagonal[hit[1:]] != diagonal[hit[:-1]]) | (place[hit[1:]] != place[hit[:-1]] + 1)
    )
    edges = np.flatnonzero(broken)
    long = np.flatnonzero(np.diff(edges) >= reach[number[hit[edges[:-1]]]])
    first, sizes = hit[edges[long]], np.diff(edges)[long]
    begin = offsets[text[first]] + diagonal[first] - longest + place[first]
    whole = np.stack([text[first], number[first], begin, begin + sizes + index.q - 1, np.zeros_like(begin)], axis=1)
    which, step = spread(sizes - reach[number[first]] + 1)
    first = first[which]
    joint = (text[first] * len(index.size) + number[first]) * width + band[first] + 1
    starts = place[first] + step
    early = diagonal[first] % BAND < spare[number[first]]
    known = np.concatenate([joint, joint[early] - 1]), np.concatenate([starts, starts[early]])
    rest = np.isin(code_of * longest + start, np.searchsorted(bands, known[0]) * longest + known[1], invert=True)

    joint, start = bands[code_of[rest]], start[rest]
    owner, key = joint // width, joint % width - 1
    parts = [owner // len(index.size), owner % len(index.size), key * BAND - longest, start]
    return np.stack(parts, axis=1), whole


def align(index: Index, segments: np.ndarray, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, item number, start, end, edits) of the segments within their edit
    budget; start and end are positions in ``body``."""
    if not len(segments):
        return np.zeros((0, 5), dtype=np.int64)
    most = budget(SEGMENT)
    width = BAND + 3 * most + 1
    text, number, diagonal, at = segments.T
    origin = offsets[text] + diagonal + at - most
    low, high = offsets[text], offsets[text + 1]
    # A column per segment: the text along its band, nothing outside the text.
    where = origin + np.arange(width + SEGMENT)[:, None]
    near = np.full(where.shape, -1, dtype=np.int16)
    inside = (where >= low) & (where < high)
    near[inside] = body[where[inside]]
    spot = index.start[number] + at + np.arange(SEGMENT)[:, None]
    wanted = index.body[np.minimum(spot, len(index.body) - 1)].astype(np.int16)
    scale, k = np.int32(1 << 10), np.arange(width, dtype=np.int32)[:, None]
    cost = np.repeat(k, len(segments), axis=1)
    size = index.size[number]
    best = np.full((len(segments), 2), 1 << 40)
    for j in range(int(size.max()) + 1):
        # Extra text bytes move along a column.
        cost = np.minimum.accumulate(cost - k * scale, axis=0) + k * scale
        done = np.flatnonzero(size == j)
        if len(done):
            last = cost[:, done].argmin(axis=0)
            best[done, 0], best[done, 1] = cost[last, done], last
        if j == size.max():
            break
        step = cost + (near[j : j + width] != wanted[j]) * scale
        # A segment byte that the text lacks.
        step[:-1] = np.minimum(step[:-1], cost[1:] + scale)
        cost = step
    edits, first, last = best[:, 0] // scale, best[:, 0] % scale, best[:, 1]
    start = np.clip(origin + first, low, high)
    end = np.clip(origin + last + size, low, high)
    good = (edits <= per_size(index, budget)[number]) & (end > start)
    return np.stack([text, number, start, end, edits], axis=1)[good]


def merged(index: Index, found: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, fewest edits of a segment): one row per stretch."""
    rows = sorted((t, int(index.item[i]), a, b, e) for t, i, a, b, e in found.tolist())
    out: list[list[int]] = []
    for t, i, a, b, e in rows:
        if out and out[-1][:2] == [t, i] and a <= out[-1][3]:
            out[-1][3], out[-1][4] = max(out[-1][3], b), min(out[-1][4], e)
        else:
            out.append([t, i, a, b, e])
    return [tuple(r) for r in out]


def dealt(index: Index, at: np.ndarray, owner: np.ndarray) -> Iterator[slice]:
    """Slices of the hits, each of whole texts, with at most PAIRS pairs or one text."""
    ends = np.cumsum(index.first[at + 1] - index.first[at])
    start = 0
    while start < len(at):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, side="right"))
        if stop < len(at):
            stop = int(np.searchsorted(owner, owner[stop]))
        if stop <= start:
            stop = int(np.searchsorted(owner, owner[start], side="right"))
        yield slice(start, stop)
        start = stop


def find_leaks(index: Index, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits): start and end in characters of the text."""
    raw, raw_offsets = byte_view(texts)
    body, kept, offsets = plain(raw, raw_offsets)
    hits, at = dense_hits(index, body, offsets)
    if not len(hits):
        return []
    owner = np.searchsorted(offsets, hits, side="right") - 1
    found = []
    for own in dealt(index, at, owner):
        segments, whole = candidates(index, hits[own], at[own], owner[own], offsets)
        parts = range(0, len(segments), ALIGNED)
        found += [whole, *(align(index, segments[i : i + ALIGNED], body, offsets) for i in parts)]
    rows = merged(index, np.concatenate(found))
    if not rows:
        return []
    characters = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    text, item, start, end, edits = (np.array(c) for c in zip(*rows, strict=True))
    base = characters[raw_offsets[text]]
    first, last = characters[kept[start]] - base, characters[kept[end - 1] + 1] - base
    return list(zip(text.tolist(), item.tolist(), first.tolist(), last.tolist(), edits.tolist(), strict=True))


def indexes(items: DataFrame, item_key: str, item_text: str) -> Iterator[Index]:
    """Indexes of the benchmark's slices; none holds much more than SLICE_BYTES. Items
    too short for 8-grams have one of their own."""
    slim = items.select(F.col(item_key).alias("key"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, math.ceil(total / SLICE_BYTES))
    for i in range(slices):
        part = slim if slices == 1 else slim.filter(F.pmod(F.xxhash64("key", "text"), F.lit(slices)) == i)
        rows = [tuple(r) for r in part.collect()]
        yield from filter(None, (build_index(rows, q) for q in (Q, SHORT_Q)))


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """key, item key, start, end, edits: a row per stretch of a benchmark item
    found in a document, offsets in characters."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = slim.schema["__key"].dataType
    item_kind = items.schema[item_key].dataType
    schema = f"__key {kind.simpleString()}, item {item_kind.simpleString()}, start bigint, end bigint, edits int"
    found = None
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, "__text", BATCH):
                    rows = find_leaks(shared.value, plain_texts(piece.column("__text")))
                    if rows:
                        doc, item, start, end, edits = zip(*rows, strict=True)
                        names = [shared.value.items[i] for i in item]
                        yield pa.RecordBatch.from_arrays(
                            [
                                piece.column("__key").take(pa.array(doc)), pa.array(names),
                                pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(edits, pa.int32()),
                            ],
                            names=["__key", "item", "start", "end", "edits"],
                        )

        part = slim.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    return found.select(F.col("__key").alias(key), F.col("item").alias(item_key), "start", "end", "edits")


def drop_leaked(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    place, kept = docs.columns.index(text), docs
    for index in indexes(items, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = [f"c{i}" for i in range(batch.num_columns)]
                for piece in pieces(pa.RecordBatch.from_arrays(batch.columns, names=names), f"c{place}", BATCH):
                    clean = np.ones(piece.num_rows, dtype=bool)
                    clean[[r[0] for r in find_leaks(shared.value, plain_texts(piece.column(place)))]] = False
                    yield pa.RecordBatch.from_arrays(piece.filter(pa.array(clean)).columns, names=batch.schema.names)

        kept = kept.mapInArrow(run, docs.schema)
    return kept
