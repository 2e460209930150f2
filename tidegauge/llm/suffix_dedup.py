"""Repeated byte strings, by prefix-free parsing and suffix order.

Every byte covered by a string of ``length`` bytes that also starts somewhere else
is removed; strings never cross texts, overlapping copies count, and all strings
are judged on the input.

1. Parse. A rolling hash runs over each text. The trigger of a string of
   ``length`` bytes is its smallest hash, so each string has one, and equal strings
   have theirs at equal places. Triggers cut the text into phrases; the strings of
   one trigger follow one another and start in the phrase ahead of it.
2. Dictionary. A trigger's context is all that its strings cover: the phrase's
   suffix before it and the bytes that follow. Contexts are told apart by hashes; a context met twice is repeated
   throughout. Triggers met once, nearly all, are done with.
3. Suffix order. Contexts that share a trigger with others are fetched, and the
   parse's suffixes behind each trigger are sorted. The common prefixes of
   neighbours in that order say, for every depth, which suffixes agree; joined
   with the phrase's own suffix of the missing length, they put all positions of
   the phrase into corpus order, and equal ones of ``length`` bytes are found.
   A trigger with more than ``CHUNK`` contexts is dealt as pairs of chunks.
4. The strings found at one trigger all cover it, so they are one stretch; the
   stretches of a text are merged and cut out.

Texts are shuffled once, into buckets of their row; after that only hashes and the
contexts in question are. Every shuffle is aggregated ahead or spread over row numbers, and
intermediate tables lie in the shared folder.

Edge cases: a null text counts as empty; texts shorter than ``length`` lose
nothing. Equal rows count as copies of each other, so both lose all they share.
Rows with null or equal keys are told apart by a row number that the first table
fixes. An empty table gives an empty result. Extra columns travel along; names
that start with two underscores are reserved.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import bucketed, written
from tidegauge.llm.text_batches import byte_view, pieces, plain_texts, stretches

LENGTH = 200
GRAM = 32
CHUNK = 4096
#: Contexts compared at once.
MEMBERS = 16_384

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(200).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Rolling:
    """Hashes of any stretch of some bytes, from one pass over them."""

    def __init__(self, body: np.ndarray):
        self.total = np.zeros(len(body) + 1, dtype=np.uint64)
        np.cumsum(_VALUE[body] * powers(len(body), _BASE), out=self.total[1:])
        # The inverse of an odd base modulo 2 ** 64 exists.
        self.back = powers(len(body) + 1, pow(_BASE, -1, 1 << 64))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.total[end] - self.total[start]) * self.back[start])

    def grams(self, size: int) -> np.ndarray:
        return _mix((self.total[size:] - self.total[:-size]) * self.back[: len(self.back) - size])


def sliding(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick over values[i : i + width] for every i that has as many."""
    count = len(values)
    rows = -(-count // width)
    grid = np.full(rows * width, fill, dtype=values.dtype)
    grid[:count] = values
    grid = grid.reshape(rows, width)
    ahead = pick.accumulate(grid, axis=1).ravel()
    behind = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: count - width + 1], ahead[width - 1 : count])


def triggers(body: np.ndarray, offsets: np.ndarray, rolling: Rolling, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(place of the trigger, first and last string that it is the trigger of).

    The trigger of the string of ``length`` bytes from i on is the leftmost of its
    smallest gram hashes. Strings with one trigger follow one another.
    """
    width = length - gram + 1
    none = np.zeros(0, dtype=np.int64)
    if len(body) < length:
        return none, none, none
    hashes = rolling.grams(gram)
    least = sliding(hashes, width, np.minimum, (1 << 64) - 1)
    # Strings that would cross into the next text have none.
    step = np.zeros(len(body) + 2, dtype=np.int32)
    long = np.diff(offsets) >= length
    step[offsets[:-1][long]] += 1
    np.add.at(step, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(step)[: len(least)] > 0
    starts = np.zeros(len(least), dtype=bool)
    starts[offsets[:-1][long]] = True
    # Runs of strings with one smallest hash.
    change = valid.copy()
    change[1:] &= starts[1:] | (least[1:] != least[:-1])
    first = np.flatnonzero(change)
    if not len(first):
        return none, none, none
    value = least[first]
    stops = np.append(first[1:], len(least))
    held = np.concatenate(([0], np.cumsum(valid)))
    last = first + (held[stops] - held[first]) - 1
    # A run may have several triggers, equal grams, each for the strings up to it.
    # Places are looked up among those that are smallest within some string.
    edge = np.zeros(width - 1, dtype=np.uint64)
    capped = np.concatenate([edge, np.where(valid, least, 0), edge])
    places = np.flatnonzero(sliding(capped, width, np.maximum, 0) == hashes)
    kinds, codes = np.unique(hashes[places], return_inverse=True)
    scale = len(body) + 1
    ordered = np.sort(codes * scale + places)
    code = np.searchsorted(kinds, value) * scale
    begin, end = np.searchsorted(ordered, code + first), np.searchsorted(ordered, code + last)
    counts = end - begin + 1
    run = np.repeat(np.arange(len(first)), counts)
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = ordered[begin[run] + rank] % scale
    low = np.where(rank == 0, first[run], np.concatenate(([0], at[:-1])) + 1)
    return at, low, np.minimum(at, last[run])


def parse(body: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Per trigger: its text, place in it, gram and context hashes, and the bytes
    ahead of it in the first (``most``) and last (``least``) string it stands for."""
    rolling = Rolling(body)
    at, low, high = triggers(body, offsets, rolling, length, gram)
    text = np.searchsorted(offsets, low, side="right") - 1
    most, least = at - low, at - high
    context = rolling.of(low, high + length)
    shape = (most * length + least).astype(np.uint64)
    return {
        "text": text, "place": at - offsets[text], "most": most, "least": least,
        "gram": _mix(rolling.of(at, at + gram) + _U(1)), "context": _mix(context + shape * _U(_BASE)),
    }


ANCHOR = "gram bigint, context bigint, place bigint, most int, least int"


def _parsed(place: int, names: list[str], length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(batch.num_columns)])
            for piece in pieces(plain, f"c{place}", 4 << 20):
                found = parse(*byte_view(plain_texts(piece.column(place))), length, gram)
                parts = [
                    pa.array(found["gram"].view(np.int64)), pa.array(found["context"].view(np.int64)),
                    pa.array(found["place"], pa.int64()), pa.array(found["most"], pa.int32()),
                    pa.array(found["least"], pa.int32()),
                ]
                anchors = pa.StructArray.from_arrays(parts, names=["gram", "context", "place", "most", "least"])
                ends = np.searchsorted(found["text"], np.arange(piece.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), anchors)
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], names=names)

    return run


def parsed(docs: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """The rows with ``__row`` and their triggers, written to the shared folder in
    buckets of ``__row``, so that no later join by row shuffles the texts."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    struct = "struct<" + ANCHOR.replace(" ", ":").replace(",:", ",") + ">"
    run = _parsed(numbered.columns.index(text), [*numbered.columns, "__anchors"], length, gram)
    found = numbered.repartition(buckets, "__row").mapInArrow(run, f"{schema}, __anchors array<{struct}>")
    table = bucketed(found, "parsed", "__row", buckets)
    _release(spark)
    return table


def _contexts(length: int):
    """Texts with the places in question to rows of phrase and following bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "__text", 4 << 20):
                body, offsets = byte_view(plain_texts(piece.column("__text")))
                wanted = piece.column("wanted")
                rows = wanted.value_parent_indices().to_numpy()
                flat = wanted.flatten()
                at = flat.field("place").to_numpy() + offsets[rows]
                before, after = flat.field("most").to_numpy(), length - flat.field("least").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("gram"), flat.field("context"), piece.column("__row").take(pa.array(rows)),
                        flat.field("place"), stretches(body, at - before, at), stretches(body, at, at + after),
                    ],
                    names=["gram", "context", "__row", "place", "left", "right"],
                )

    return run


def grid(column: pa.Array, width: int, backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of bytes, left-aligned (or from their end on), and lengths."""
    body, offsets = byte_view(column.cast(pa.large_binary()))
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), dtype=np.uint8)
    step = np.arange(width)
    inside = step < sizes[:, None]
    at = (offsets[1:, None] - 1 - step) if backwards else (offsets[:-1, None] + step)
    out[inside] = body[at[inside]]
    return out, sizes


def equal_positions(group: np.ndarray, left: pa.Array, right: pa.Array, length: int, gram: int) -> np.ndarray:
    """Per context, the least and the greatest number of bytes ahead of the trigger
    at which a string starts that another context of its group has as well; -1
    where there is none. A string with a bytes ahead of the trigger is the phrase's
    suffix of length a and the first ``length - a`` bytes of the parse's suffix."""
    most = length - gram
    behind, before = grid(left, most, True)
    ahead, after = grid(right, length, False)
    # The suffix array of the parse, trigger by trigger.
    order = np.lexsort((np.ascontiguousarray(ahead).view(f"S{length}").ravel(), group))
    ahead, group = ahead[order], group[order]
    differs = ahead[1:] != ahead[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
    common[group[1:] != group[:-1]] = -1
    behind, before, after = behind[order], before[order], after[order]
    suffix = np.zeros((len(order), most + 1), dtype=np.uint64)
    np.cumsum(_VALUE[behind] * powers(most, _BASE), axis=1, out=suffix[:, 1:])
    least = np.full(len(order), -1, dtype=np.int64)
    greatest = np.full(len(order), -1, dtype=np.int64)
    for a in range(most + 1):
        depth = length - a
        held = np.flatnonzero((before >= a) & (after >= depth))
        if len(held) < 2:
            continue
        agree = np.concatenate(([0], np.cumsum(common < depth)))
        key = _mix(suffix[held, a] + agree[held].astype(np.uint64) * _U(0xD1B54A32D192ED03))
        by_key = np.argsort(key, kind="stable")
        run = key[by_key]
        twice = np.zeros(len(held), dtype=bool)
        twice[1:] = run[1:] == run[:-1]
        twice[:-1] |= run[1:] == run[:-1]
        found = held[by_key[twice]]
        greatest[found] = a
        least[found] = np.where(least[found] < 0, a, least[found])
    out = np.empty((len(order), 2), dtype=np.int64)
    out[order, 0], out[order, 1] = least, greatest
    return out


def _compared(length: int, gram: int):
    """Batches sorted by group to stretches around the triggers."""

    def answer(table: pa.Table) -> pa.RecordBatch:
        codes = np.zeros(table.num_rows, dtype=np.int64)
        for name in ("gram", "low", "high"):
            column = table.column(name).to_numpy()
            codes[1:] |= column[1:] != column[:-1]
        least, greatest = equal_positions(
            np.cumsum(codes), table.column("left").combine_chunks(), table.column("right").combine_chunks(), length, gram
        ).T
        found = np.flatnonzero(greatest >= 0)
        place = table.column("place").to_numpy()[found]
        rows = table.column("__row").combine_chunks().take(pa.array(found))
        return pa.RecordBatch.from_arrays(
            [rows, pa.array(place - greatest[found]), pa.array(place - least[found] + length)], names=["__row", "start", "end"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            both = pa.Table.from_batches([batch])
            held = both if held is None else pa.concat_tables([held, both])
            if held.num_rows < MEMBERS:
                continue
            # The last group may go on in the next batch.
            new = np.zeros(held.num_rows, dtype=bool)
            for name in ("gram", "low", "high"):
                column = held.column(name).to_numpy()
                new[1:] |= column[1:] != column[:-1]
            cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
            if cut:
                yield answer(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield answer(held)

    return run


def repeated(table: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    """(__row, start, end): stretches of bytes that other places have as well."""
    anchors = table.select("__row", F.explode("__anchors").alias("t")).select("__row", "t.*")
    shared = anchors.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), (F.min("context") == F.max("context")).alias("one")
    )
    hits = written(anchors.join(shared.filter("n > 1").drop("n"), "gram"), "triggers")
    _release(table.sparkSession)

    def stretch(found: DataFrame) -> DataFrame:
        start, end = F.col("place") - F.col("most"), F.col("place") - F.col("least") + length
        return found.select("__row", start.alias("start"), end.alias("end"))

    # Where all occurrences of a trigger have one context, every string is repeated;
    # so it is for any context met twice.
    own, mixed = ["gram", "context"], hits.filter("NOT one")
    asked = mixed.groupBy(*own).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("__row", "place", "most", "least")).alias("first")
    )
    asked = written(asked.select(*own, "copies", "first.*"), "contexts")
    twice = mixed.join(asked.filter("copies > 1").select(*own), own)
    whole = stretch(hits.filter("one")).unionByName(stretch(twice))

    wanted = asked.groupBy("__row").agg(F.collect_list(F.struct(*own, "place", "most", "least")).alias("wanted"))
    texts = table.select("__row", F.col(text).alias("__text")).join(wanted, "__row")
    schema = "gram bigint, context bigint, __row bigint, place bigint, left binary, right binary"
    fetched = texts.select("__row", "__text", "wanted").mapInArrow(_contexts(length), schema)
    sizes = asked.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    many = sizes.filter(F.col("n") > CHUNK).select("gram", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    chunked = fetched.join(many, "gram", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("context"), F.col("chunks")).cast("int")
    dealt = chunked.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    keyed = dealt.select("gram", "low", "high", "__row", "place", "left", "right")
    grouped = keyed.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high")
    found = grouped.mapInArrow(_compared(length, gram), "__row bigint, start bigint, end bigint")
    return written(whole.unionByName(found), "repeated")


def _release(spark) -> None:
    """Let Spark drop the shuffle files of frames that are no longer used."""
    gc.collect()
    spark._jvm.System.gc()


def _cut(place: int, fields: list[str], digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(batch.num_columns)])
            for piece in pieces(plain, f"c{place}"):
                texts = plain_texts(piece.column(place))
                body, offsets = byte_view(texts)
                spans = piece.column(piece.num_columns - 1)
                rows = spans.value_parent_indices().to_numpy()
                flat = spans.flatten()
                mark = np.zeros(len(body) + 1, dtype=np.int64)
                np.add.at(mark, flat.field("start").to_numpy() + offsets[rows], 1)
                np.add.at(mark, flat.field("end").to_numpy() + offsets[rows], -1)
                gone = np.cumsum(mark[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                firsts = offsets[:-1][offsets[:-1] < len(body)]
                opens[firsts] = gone[firsts]
                removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[offsets])
                count = np.diff(np.concatenate(([0], np.cumsum(opens)))[offsets])
                kept = memoryview(body[~gone])
                ends = (offsets - np.concatenate(([0], np.cumsum(removed)))).tolist()
                parts = [bytes(kept[i:j]) for i, j in zip(ends, ends[1:], strict=False)]
                if digests:
                    columns = [
                        piece.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(count),
                        pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()),
                    ]
                else:
                    columns = [*piece.columns[:-1]]
                    # A character that lost one of its bytes goes as a whole.
                    columns[place] = pa.array([p.decode("utf-8", "ignore") for p in parts], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    return run


def _with_spans(table: DataFrame, columns: list[str], text: str, length: int, gram: int) -> DataFrame:
    spans = repeated(table, text, length, gram)
    _release(table.sparkSession)
    grouped = spans.groupBy("__row").agg(F.collect_list(F.struct("start", "end")).alias("__spans"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = table.select("__row", *columns).join(grouped, "__row", "left")
    return joined.select(*columns, F.coalesce("__spans", empty).alias("__spans"))


def dedup_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    table = parsed(slim, "__text", length, gram)
    kind = slim.schema["__key"].dataType.simpleString()
    fields = ["__key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = f"__key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    joined = _with_spans(table, ["__key", "__text"], "__text", length, gram)
    return joined.mapInArrow(_cut(1, fields, True), schema).withColumnRenamed("__key", key)


def drop_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows with all their columns, the text without its repeated bytes."""
    table = parsed(docs, text, length, gram)
    joined = _with_spans(table, docs.columns, text, length, gram)
    return joined.mapInArrow(_cut(docs.columns.index(text), docs.columns, False), docs.schema)
