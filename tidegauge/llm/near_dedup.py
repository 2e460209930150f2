"""Near-duplicate documents by BagMinHash over word shingles.

A text is the multiset of its five-word shingles (all its words, if fewer). Texts
are alike if the weighted Jaccard similarity of their multisets, the sum of the
smaller counts over the sum of the larger, is at least 0.8; classes are the
connected components of alike texts.

1. BagMinHash: the counts of a shingle are cut into dyadic blocks [0, 1), [1, 2),
   [2, 4), [4, 8), ... Each (shingle, block) has its own Poisson process, whose
   points fall on a signature component and on a level of the block; points at
   levels below the shingle's count are taken. A component holds the time of its
   earliest point, so two texts share it with a chance equal to their weighted
   Jaccard similarity. A process stops once it is past the latest component.
2. Equal multisets collapse to one node by a 128-bit content hash.
3. Signatures are cut into bands; nodes that share a band form a bucket. Buckets
   with the same members count once.
4. In a bucket the multisets themselves are compared, breadth first, so that a
   node is compared only with nodes not linked yet, and only a star per cluster
   leaves the task. Buckets of more than ``CHUNK`` nodes or ``CHUNK_BYTES`` bytes of
   text are dealt by hash as pairs of chunks of about that size, each pair a group of
   its own: memory is bounded, but for a longer single text, and no link is lost.
5. Components of the stars by large-star and small-star steps, on tables in the
   shared folder.

At similarity 0.8 two texts miss each other in all bands with a chance of 7e-6.

Edge cases: null, empty and wordless texts have the empty multiset and are one
class. Rows with null or equal keys are told apart by a row number that the first
table fixes. An empty table gives an empty result. Extra columns travel along;
names that start with two underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.quality import word_hashes
from tidegauge.llm.shared import written
from tidegauge.llm.text_batches import Words, pieces, plain_texts, words_of

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 30, 5
PARTS = BANDS * ROWS
CHUNK, CHUNK_BYTES = 1024, 4 << 20
MAX_ROUNDS = 60

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def salted(x: np.ndarray, *numbers: int) -> np.ndarray:
    salt = sum((n + 1) * f for n, f in zip(numbers, (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), strict=False))
    return mix(x + _U(salt % (1 << 64)))


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each shingle in text order."""
    hashed = mix(word_hashes(words.vocabulary))[words.codes]
    sizes = np.diff(words.bounds)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + words.bounds[:-1][text]
    out = np.zeros(len(text), dtype=np.uint64)
    for step in range(SHINGLE):
        # A text of fewer words has one shingle of all of them.
        inside = place + step < words.bounds[1:][text]
        at = np.minimum(place + step, max(0, len(hashed) - 1))
        out = np.where(inside, out * _U(0x9E3779B97F4A7C15) + hashed[at] + _U(1), out)
    return text, mix(out)


def multisets(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count), in order of text."""
    joint = mix(hashes + text.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    codes, kinds = pd.factorize(joint)
    first = np.full(len(kinds), len(codes), dtype=np.int64)
    np.minimum.at(first, codes, np.arange(len(codes)))
    return text[first], hashes[first], np.bincount(codes, minlength=len(kinds))


def signatures(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """BagMinHash components, a row per text; infinite for the empty multiset."""
    parts = [(text, salted(hashes, 0), np.zeros(len(text), dtype=np.int64), counts)]
    block, base = 1, 1
    while (more := counts > base).any():
        parts.append((text[more], salted(hashes[more], block), np.full(int(more.sum()), base), counts[more]))
        block, base = block + 1, base * 2
    owner, seed, base, count = (np.concatenate(p) for p in zip(*parts, strict=True))
    size = np.maximum(base, 1)
    time = np.zeros(len(owner))
    earliest = np.full(texts * PARTS, np.inf)
    latest = np.full(texts, np.inf)
    step = 0
    while len(owner):
        point = salted(seed, step, step)
        time = time - np.log(((point >> _U(11)).astype(np.float64) + 1) * 2.0**-53) / size
        live = time < latest[owner]
        owner, seed, base, count, size, time = (x[live] for x in (owner, seed, base, count, size, time))
        drawn = mix(point[live] + _U(1))
        part = ((drawn >> _U(32)) * _U(PARTS) >> _U(32)).astype(np.int64)
        level = base + (drawn & (size - 1).astype(np.uint64)).astype(np.int64)
        taken = level < count
        np.minimum.at(earliest, owner[taken] * PARTS + part[taken], time[taken])
        latest = earliest.reshape(texts, PARTS).max(axis=1)
        step += 1
    return earliest.reshape(texts, PARTS)


def node_names(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int) -> pa.Array:
    """A 128-bit hash of each text's multiset, as 32 hex digits."""
    halves = []
    for salt in (1, 2):
        own = salted(hashes, salt, salt) * counts.astype(np.uint64)
        sums = np.zeros(texts, dtype=np.uint64)
        np.add.at(sums, text, own)
        halves.append(mix(sums + _U(salt)))
    return pa.array([f"{a:016x}{b:016x}" for a, b in zip(*(h.tolist() for h in halves), strict=True)])


def band_keys(signature: np.ndarray) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2]).copy()
    for row in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + bits[:, :, row])
    return key.astype(np.int64)


def _signed(place: int, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            for piece in pieces(pa.RecordBatch.from_arrays(batch.columns, names=names), f"c{place}", 4 << 20):
                words = words_of(plain_texts(piece.column(place)))
                bag = multisets(*shingles(words))
                nodes = node_names(*bag, piece.num_rows)
                keys = band_keys(signatures(*bag, piece.num_rows))
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(piece.num_rows + 1) * BANDS, pa.int32()), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays([*piece.columns, nodes, bands], names=schema_names)

    return run


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``__row``, ``__bytes`` (of the text), ``__node`` and ``__bands``,
    written to the shared folder."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    numbered = docs.withColumns({"__row": F.monotonically_increasing_id(), "__bytes": size})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    names = [*numbered.columns, "__node", "__bands"]
    run = _signed(numbered.columns.index(text), names)
    table = numbered.mapInArrow(run, schema + ", __node string, __bands array<bigint>")
    return written(table, "near-signed", compression="zstd")


def buckets(table: DataFrame) -> DataFrame:
    """(band, node, chunks): members of buckets with two nodes or more. A node is
    named by its first row."""
    nodes = table.groupBy("__node").agg(F.min(F.struct("__row", "__bytes", "__bands")).alias("first"))
    members = nodes.select("first.__row", "first.__bytes", F.explode("first.__bands").alias("__band"))
    sets = members.groupBy("__band").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("__row")).alias("x"),
        F.bit_xor(F.xxhash64("__row", F.lit(1))).alias("y"),
        F.sum("__bytes").alias("bytes"),
    )
    # More chunks than nodes part nothing.
    chunks = F.least("n", F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("bytes") / CHUNK_BYTES)))
    kept = (
        sets.filter("n > 1")
        .groupBy("n", "x", "y", "bytes")
        .agg(F.min("__band").alias("__band"))
        .select("__band", chunks.cast("int").alias("__chunks"))
    )
    return members.join(kept, "__band")


def dealt(members: DataFrame) -> DataFrame:
    """One row per member and pair of chunks it belongs to; one pair where a bucket
    is one chunk."""
    chunk = F.pmod(F.xxhash64("__row", F.lit(2)), F.col("__chunks")).cast("int")
    others = F.sequence(F.lit(0), F.col("__chunks") - 1)
    paired = members.withColumn("__chunk", chunk).withColumn("__other", F.explode(others))
    return paired.withColumns(
        {"__low": F.least("__chunk", "__other"), "__high": F.greatest("__chunk", "__other")}
    ).drop("__other", "__chunks")


def linked(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Stars (centre, member) of the components of alike multisets.

    Each multiset is an array of distinct hashes. A visited set is compared with
    all sets not linked yet at once, by its marks in a table of all hashes.
    """
    sizes = np.array([len(s) for s in sets])
    codes, kinds = pd.factorize(np.concatenate(sets))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    marks = np.zeros(len(kinds), dtype=bool)
    rest, stars = np.arange(len(sets)), []
    while len(rest):
        centre, queue, rest = int(rest[0]), [int(rest[0])], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            own = codes[bounds[one] : bounds[one + 1]]
            close = rest[(sizes[rest] >= THRESHOLD * sizes[one]) & (THRESHOLD * sizes[rest] <= sizes[one])]
            if not len(close):
                continue
            marks[own] = True
            counts = sizes[close]
            starts = np.cumsum(counts) - counts
            at = np.arange(counts.sum()) - np.repeat(starts - bounds[close], counts)
            shared = np.add.reduceat(marks[codes[at]], starts, dtype=np.int64)
            marks[own] = False
            # 0.8 as a ratio of whole numbers, so that a tie counts as alike.
            found = close[5 * shared >= 4 * (counts + len(own) - shared)]
            stars += [(centre, int(f)) for f in found]
            queue += found.tolist()
            rest = np.setdiff1d(rest, found, assume_unique=True)
    return stars


def _links(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("__row").sort_values("__row")
    text, hashes, counts = multisets(*shingles(words_of(plain_texts(pa.array(frame["__text"], pa.string())))))
    copies = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    # The k-th copy of a shingle is an element of its own: overlap of plain sets.
    elements = mix(np.repeat(hashes, counts) + copies.astype(np.uint64) * _U(0xD1B54A32D192ED03))
    ends = np.searchsorted(np.repeat(text, counts), np.arange(len(frame)), side="right")
    names = frame["__row"].to_numpy()
    stars = linked(np.split(elements, ends[:-1]))
    return pd.DataFrame([(names[a], names[b]) for a, b in stars], columns=["u", "v"], dtype="int64")


def links(table: DataFrame, text: str = "text") -> DataFrame:
    """(u, v): verified links between nodes, a star per cluster and bucket."""
    members = dealt(buckets(table))
    texts = table.select("__row", F.col(text).alias("__text"))
    held = members.select("__row", "__band", "__low", "__high").join(texts, "__row")
    found = held.groupBy("__band", "__low", "__high").applyInPandas(_links, "u bigint, v bigint")
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(first, label): the smallest node of each linked node's component."""
    current, before = written(edges.select("u", "v"), "near-edges"), None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = written(small.filter("u <> v").distinct(), "near-edges")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("__first"), F.col("v").alias("__label"))


def classed(table: DataFrame, text: str = "text") -> DataFrame:
    """The rows of :func:`signed` with the label of their class."""
    labels = components(links(table, text))
    nodes = table.groupBy("__node").agg(F.min("__row").alias("__first"))
    named = nodes.join(labels, "__first", "left").select("__node", F.coalesce("__label", "__first").alias("__label"))
    return table.join(named, "__node")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, class_id (smallest key of the class), class_size."""
    table = signed(docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")), "__text")
    rows = classed(table, "__text").select("__key", "__label")
    classes = rows.groupBy("__label").agg(F.min("__key").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(classes, "__label").select(F.col("__key").alias(key), "class_id", "class_size")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that with the smallest key, with all its columns."""
    table = signed(docs, text)
    rows = classed(table.select(F.col(key).alias("__key"), "__row", "__bytes", "__node", "__bands", F.col(text).alias("__text")), "__text")
    first = rows.groupBy("__label").agg(F.min(F.struct("__key", "__row")).alias("first")).select("first.__row")
    return table.join(first, "__row", "left_semi").select(docs.columns)
