"""Token ids as range-coded binary blocks in ascending key order.

Texts are sorted into ranges of the key, tokenised, and written as a table of
blocks: one row per block, whose payload holds the documents in it and their
ids coded by :mod:`tidegauge.llm.range_coder`. Every block resets its model and
carries a checksum, so any block can be read alone and a damaged one is found.

A block closes at the end of a document once it holds ``BLOCK_IDS`` ids. A
document of more than ``CUT_IDS`` ids is cut into blocks of its own; its checksum
is put together from the parts, each shifted by the ids that follow it.

Each distinct pre-token goes through the tokenizer library once: every rule of a
word-level vocabulary (white space dropped) stays within a run of non-space
characters, so a text's ids are those of its words in turn. Words of Latin letters
and marks are cut into their pre-tokens first; all others go to the library whole.

Edge cases: a null or empty text holds the end id alone. Null keys come first.
Rows with equal keys are ordered by a hash of their text; equal rows keep both
copies. An empty table writes no block and reads back empty. Other columns are
not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.bpe import encode_split
from tidegauge.llm.range_coder import decode_block, encode_block
from tidegauge.llm.shared import fresh_path
from tidegauge.llm.text_batches import Ragged, known_words, pieces, plain_texts, stretches, words_of

BLOCK_IDS = 1 << 20
CUT_IDS = 1 << 22
#: Pre-tokens given to the library as one line.
LINE = 64
#: Text bytes handled at once, and pre-tokens kept per worker.
BATCH, KEPT = 12 << 20, 1_000_000
BLOCK_SCHEMA = "part int, block int, n_ids bigint, ids_before bigint, cut boolean, payload binary"
DOCUMENT = struct.Struct("<?qqqq")


class LibraryEncoder:
    """Ids of words by the tokenizer library, each distinct pre-token once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Pre-tokens are in lower case and cut already: the library's rules would leave them
        # as they are. They go to its model by way of bytes alone.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.known = known_words(f"library {path}", self.encode_distinct, KEPT)

    def encode_distinct(self, parts: pa.Array) -> Ragged:
        """Many pre-tokens to a call, apart by blanks; the library numbers them."""
        spelled = parts.cast(pa.large_string())
        lines = [" ".join(spelled[i : i + LINE].to_pylist()) for i in range(0, len(spelled), LINE)]
        found = self.pieces.encode_batch(lines, add_special_tokens=False)
        counts = np.array([len(e) for e in found], dtype=np.int64)
        total = int(counts.sum())
        flat = np.fromiter(chain.from_iterable(e.ids for e in found), dtype=np.uint32, count=total)
        owner = np.fromiter(chain.from_iterable(e.word_ids for e in found), dtype=np.int64, count=total)
        owner += np.repeat(np.arange(len(found)) * LINE, counts)
        held = np.bincount(owner, minlength=len(spelled))
        return Ragged(flat, np.concatenate(([0], np.cumsum(held))).astype(np.int64))

    def encode_pieces(self, spelled: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Ragged:
        coded = stretches(spelled, starts, starts + lengths).dictionary_encode()
        distinct = self.known.ids(coded.dictionary.cast(pa.large_binary()))
        return distinct.take(coded.indices.to_numpy().astype(np.int64))

    def encode_odd(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode_words(self, words: pa.Array) -> Ragged:
        return encode_split(words, self.encode_pieces, self.encode_odd)


@cache
def library_encoder(path: str) -> LibraryEncoder:
    """One for all tasks of a worker: the vocabulary is read once."""
    return LibraryEncoder(path)


def pack_block(documents: list[tuple], ids: np.ndarray) -> bytes:
    """Documents: (key or None, ids in this block, ids ahead of them in the
    document, ids after them in the document)."""
    head = [struct.pack("<I", len(documents))]
    head += [DOCUMENT.pack(key is None, key or 0, *rest) for key, *rest in documents]
    table = b"".join(head)
    return struct.pack("<I", zlib.crc32(table)) + table + encode_block(ids)


def unpack_block(payload: bytes) -> tuple[list[tuple], np.ndarray]:
    (check, count) = struct.unpack_from("<II", payload)
    end = 8 + count * DOCUMENT.size
    if zlib.crc32(payload[4:end]) != check:
        raise ValueError("checksum of a block's documents does not match")
    rows = [
        (None if no_key else key, *rest) for no_key, key, *rest in DOCUMENT.iter_unpack(payload[8:end])
    ]
    return rows, decode_block(payload[end:])


def _write_blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = library_encoder(path)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        documents: list[tuple] = []
        held: list[np.ndarray] = []
        size = 0

        def close(documents: list[tuple], ids: np.ndarray, cut: bool) -> pa.RecordBatch:
            nonlocal block, before
            row = {
                "part": part, "block": block, "n_ids": len(ids), "ids_before": before, "cut": cut,
                "payload": pack_block(documents, ids),
            }
            block, before = block + 1, before + len(ids)
            return pa.RecordBatch.from_pylist([row], schema=ARROW_BLOCK)

        for batch in batches:
            for piece in pieces(batch, "__text", BATCH):
                words = words_of(plain_texts(piece.column("__text")))
                coded = library.encode_words(words.vocabulary).take(words.codes)
                bounds = coded.ends[words.bounds].tolist()
                for key, i, j in zip(piece.column("__key").to_pylist(), bounds, bounds[1:], strict=False):
                    ids = np.append(coded.values[i:j], np.uint32(end_id))
                    if len(ids) > CUT_IDS:
                        if documents:
                            yield close(documents, np.concatenate(held), False)
                            documents, held, size = [], [], 0
                        for at in range(0, len(ids), CUT_IDS):
                            own = ids[at : at + CUT_IDS]
                            yield close([(key, len(own), at, len(ids) - at - len(own))], own, True)
                        continue
                    documents.append((key, len(ids), 0, 0))
                    held.append(ids)
                    size += len(ids)
                    if size >= BLOCK_IDS:
                        yield close(documents, np.concatenate(held), False)
                        documents, held, size = [], [], 0
        if documents:
            yield close(documents, np.concatenate(held), False)

    return run


ARROW_BLOCK = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("ids_before", pa.int64()),
        ("cut", pa.bool_()), ("payload", pa.binary()),
    ]
)


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text", path: str | None = None
) -> str:
    """Write the texts' ids in ascending key order; the key is a whole number.

    Returns the folder of the block table, by default one in the shared folder.
    """
    path = path or fresh_path(docs.sparkSession, "tokens")
    slim = docs.select(F.col(key).cast("bigint").alias("__key"), F.col(text).alias("__text"))
    ordered = slim.repartitionByRange("__key", F.xxhash64("__text")).sortWithinPartitions("__key", F.xxhash64("__text"))
    ordered.mapInArrow(_write_blocks(tokenizer, end_id), BLOCK_SCHEMA).write.option("compression", "none").parquet(path)
    return path


def crc_after(crc: int, zeros: int) -> int:
    """The checksum's state after this many more zero bytes (a linear map)."""
    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit

    def apply(matrix: list[int], value: int) -> int:
        out = 0
        for i in range(32):
            if value >> i & 1:
                out ^= matrix[i]
        return out

    bits = zeros * 8
    while bits:
        if bits & 1:
            crc = apply(step, crc)
        step = [apply(step, row) for row in step]
        bits >>= 1
    return crc


def _read_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            documents, ids = unpack_block(row["payload"])
            body = memoryview(ids.astype("<u4")).cast("B")
            keys, starts, counts, checks, at = [], [], [], [], 0
            for key, count, ahead, after in documents:
                keys.append(key)
                starts.append(row["ids_before"] + at - ahead)
                counts.append(count)
                checks.append(crc_after(zlib.crc32(body[4 * at : 4 * (at + count)]), 4 * after))
                at += count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(keys), pa.int32()), pa.array(keys, pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(checks, pa.int64()),
                ],
                names=["part", "key", "at", "n_tokens", "ids_crc32"],
            )


def _read_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            documents, ids = unpack_block(row["payload"])
            ends = np.cumsum([d[1] for d in documents])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d[0] for d in documents], pa.int64()),
                    pa.array([d[2] for d in documents], pa.int64()),
                    pa.array(np.split(ids, ends[:-1]), pa.list_(pa.int32())),
                ],
                names=["key", "ids_ahead", "ids"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """key, ids_ahead, ids: a row per document, or per part of a cut document."""
    return spark.read.parquet(path).select("payload").mapInArrow(_read_ids, "key bigint, ids_ahead bigint, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """key, start, n_tokens and ids_crc32 of every document in the block table."""
    blocks = spark.read.parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("held"))
    parts = sizes.select(
        "part", (F.expr("sum(held) OVER (ORDER BY part)") - F.col("held")).alias("offset")
    )
    schema = "part int, key bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    needed = blocks.select("part", "ids_before", "cut", "payload")
    whole = needed.filter("NOT cut").drop("cut").mapInArrow(_read_digests, schema)
    cut = needed.filter("cut").drop("cut").mapInArrow(_read_digests, schema)
    joined = cut.groupBy("part", "key", "at").agg(
        F.sum("n_tokens").alias("n_tokens"), F.bit_xor("ids_crc32").alias("ids_crc32")
    )
    return (
        whole.unionByName(joined)
        .join(parts, "part")
        .select("key", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
    )
