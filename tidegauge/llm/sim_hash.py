"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A text, ASCII capitals lowered, is the multiset of its four-word shingles (all its
words, if fewer), each hashed by XXH64 with seed 42. A bit of the 64-bit fingerprint
is 1 if it is set in over half of the hashes. Fingerprints link if at most ``NEAR``
bits differ; a document's component is that of its fingerprint.

1. Fingerprints in Arrow batches; equal ones collapse to one node each.
2. Pigeonhole blocks: the 64 bits are cut into m blocks. Two fingerprints that differ
   in at most 4 bits agree on m - 4 blocks, so for each choice of m - 4 blocks a node
   goes to the bucket of its bits there. m is 5, or what keeps a bucket of random
   fingerprints below ``CROWD``: 15 choices of two blocks in 6, 35 of three in 7, ...
3. In a bucket all distances are told at once, or, in a large one, breadth first: a
   node is compared only with those not linked yet, and only a star per cluster
   leaves the task. A bucket of more than ``CHUNK`` nodes is dealt by hash in chunks.
4. What chunks leave open: buckets of several chunks that still hold two components
   are cut again, their free bits in five, by the same argument. Each round fixes a
   fifth of the free bits, and a bucket of at most 12 free bits is one chunk, so
   rounds end; copies of one page, linked by then, do not go through them.
5. Components by large-star and small-star steps on tables in the shared folder.

No task holds more than a batch of texts or ``CHUNK`` fingerprints; links are exact,
no candidate is left out.

Edge cases: null, empty and wordless texts have fingerprint zero, which links like
any other. Equal rows and equal or null keys are rows of their own; a component of
null keys alone is named null. An empty table gives an empty result. Other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.near_dedup import components
from tidegauge.llm.shared import written
from tidegauge.llm.text_batches import byte_view, pieces, plain_texts, words_of

SHINGLE, SEED, BITS, NEAR = 4, 42, 64, 4
CROWD, CHUNK = 256, 4096
#: Up to so many nodes, a bucket's distances are told at once.
SMALL = 64
BATCH, AT_ONCE = 4 << 20, 1 << 16

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 32
_SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the number of each text's."""
    words = words_of(texts)
    body, _ = byte_view(texts)
    ends = np.cumsum(words.lengths + 1)
    # All words with a space after each.
    spaced = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
    letters = np.ones(len(spaced), dtype=bool)
    letters[ends - 1] = False
    spaced[letters] = _LOWERED[body[~np.isin(body, _SPACES)]]
    sizes = np.diff(words.bounds)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + words.bounds[:-1][text]
    last = np.minimum(first + SHINGLE, words.bounds[1:][text]) - 1
    starts, stops = (ends - words.lengths - 1)[first], ends[last] - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    told = (digest(raw[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True))
    return np.fromiter(told, dtype=np.uint64, count=len(first)), counts


def fingerprints(texts: pa.Array) -> np.ndarray:
    hashes, counts = shingle_hashes(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    ones = np.zeros((len(counts), BITS), dtype=np.int64)
    for start in range(0, len(hashes), AT_ONCE):
        some, owner = hashes[start : start + AT_ONCE], text[start : start + AT_ONCE]
        bits = np.unpackbits(some.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        change = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        ones[owner[change]] += np.add.reduceat(bits, change, axis=0, dtype=np.int64)
    majority = 2 * ones > counts[:, None]
    return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "__text", BATCH):
            found = fingerprints(plain_texts(piece.column("__text")))
            yield pa.RecordBatch.from_arrays([piece.column("__key"), pa.array(found.view(np.int64))], names=["__key", "__print"])


def printed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(__key, __print) per row, written to the shared folder."""
    rows = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    return written(rows.mapInArrow(_printed, f"__key {kind}, __print bigint"), "sim-prints")


def parted(bits: list[int], parts: int) -> list[int]:
    """The bits as so many masks of neighbouring ones."""
    cuts = [i * len(bits) // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[low:high]) for low, high in itertools.pairwise(cuts)]


def block_masks(nodes: int) -> list[int]:
    """Masks of which close fingerprints agree on at least one."""
    parts = NEAR + 1
    while parts < 16 and nodes >> (BITS * (parts - NEAR) // parts) > CROWD:
        parts += 1
    return [sum(chosen) for chosen in itertools.combinations(parted(list(range(BITS)), parts), parts - NEAR)]


def finer_masks(mask: int) -> list[int]:
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | part for part in parted(free, NEAR + 1)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def stars(prints: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(centre, members): a star for each cluster of linked fingerprints."""
    if len(prints) <= SMALL:
        close = np.bitwise_count(prints[:, None] ^ prints) <= NEAR
        if close.sum() == len(prints):
            return []
    found, rest = [], prints
    while len(rest):
        centre, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            close = np.bitwise_count(rest ^ queue.pop()) <= NEAR
            if close.any():
                near = rest[close]
                found.append((int(centre), near))
                queue.extend(near)
                rest = rest[~close]
    return found


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks, one after another, to their links."""

    def answer(columns: list[np.ndarray]) -> pa.RecordBatch:
        prints = columns[-1].view(np.uint64)
        cuts = np.concatenate(([0], changes(columns), [len(prints)]))
        told = [star for low, high in itertools.pairwise(cuts) if high - low > 1 for star in stars(prints[low:high])]
        u = np.repeat(np.array([c for c, _ in told], dtype=np.uint64), [len(m) for _, m in told])
        v = np.concatenate([m for _, m in told]) if told else np.zeros(0, dtype=np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (u, v)], names=["u", "v"])

    def changes(columns: list[np.ndarray]) -> np.ndarray:
        return np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)) + 1

    held = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("mask", "value", "chunk", "__print")]
        held = columns if held is None else [np.concatenate(both) for both in zip(held, columns, strict=True)]
        # The last chunk may go on in the next batch.
        cut = changes(held)
        if len(cut):
            yield answer([c[: cut[-1]] for c in held])
            held = [c[cut[-1] :] for c in held]
    if held is not None and len(held[0]):
        yield answer(held)


def dealt(members: DataFrame) -> DataFrame:
    """(mask, value, __print, label, chunks, chunk) of the buckets that hold nodes of
    different labels. Written to the shared folder."""
    bucket = ["mask", "value"]
    placed = members.withColumn("value", F.col("__print").bitwiseAND(F.col("mask")))
    sizes = (
        placed.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("n"), (F.min("label") < F.max("label")).alias("open"))
        .filter("open")
        .select(*bucket, F.ceil(F.col("n") / CHUNK).alias("chunks"))
    )
    # Other masks deal the same nodes otherwise, so that their chunks meet.
    chunk = F.pmod(F.xxhash64("__print", "mask"), F.col("chunks"))
    return written(placed.join(sizes, bucket).withColumn("chunk", chunk), "sim-buckets")


def chunk_links(members: DataFrame) -> DataFrame:
    """(u, v): links within each chunk."""
    chunk = ["mask", "value", "chunk"]
    rows = members.select(*chunk, "__print").repartition(*chunk).sortWithinPartitions(*chunk)
    return written(rows.mapInArrow(_linked, "u bigint, v bigint"), "sim-links")


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The nodes with the label of their component."""
    labels = components(links).withColumnsRenamed({"__first": "__print", "__label": "new"})
    joined = nodes.drop("label").join(labels, "__print", "left")
    return joined.withColumn("label", F.coalesce("new", "__print")).drop("new")


def finer(spark: SparkSession, members: DataFrame) -> DataFrame:
    """The members under the finer masks of their bucket's."""
    # There are at most five times as many masks in each round, whatever the rows.
    masks = [r["mask"] for r in members.select("mask").distinct().collect()]
    rows = [(m, signed(f)) for m in masks for f in finer_masks(m % (1 << BITS))]
    table = F.broadcast(spark.createDataFrame(rows, "mask bigint, finer bigint"))
    split = members.join(table, "mask").select(F.col("finer").alias("mask"), "__print", "label")
    # Two buckets may share a finer mask and value.
    return split.distinct()


def links(nodes: DataFrame) -> DataFrame:
    """(u, v): links whose components are those of all close fingerprints."""
    spark = nodes.sparkSession
    masks = F.array(*[F.lit(signed(m)).cast("bigint") for m in block_masks(nodes.count())])
    members = dealt(nodes.select("__print", F.col("__print").alias("label"), F.explode(masks).alias("mask")))
    found = chunk_links(members)
    while not (crowded := members.filter("chunks > 1")).isEmpty():
        # Buckets whose nodes are one component by now are done.
        told = labelled(crowded.select("mask", "__print"), found)
        members = dealt(finer(spark, told))
        found = written(found.unionByName(chunk_links(members)), "sim-links")
    return found


def sim_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (smallest key of the component)."""
    prints = printed(docs, key, text)
    nodes = prints.groupBy("__print").agg(F.min("__key").alias("least"))
    named = labelled(nodes, links(nodes))
    classes = named.groupBy("label").agg(F.min("least").alias("component_id"))
    own = named.join(classes, "label").select("__print", "component_id")
    digits = F.lpad(F.lower(F.hex("__print")), 16, "0").alias("fingerprint")
    return prints.join(own, "__print").select(F.col("__key").alias(key), digits, "component_id")
