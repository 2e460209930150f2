"""Quality rules: base rules on words, and a calibrated logistic regression.

The model sees hashed words, word pairs and character trigrams, each as its share
of the text. It is fitted on a bounded sample of labelled rows, its margin is
turned into a probability on rows held back from the fit, and whole texts are
scored in Arrow batches against a fixed threshold.

Words are runs of characters other than the ASCII white space 0x09-0x0D and 0x20.

Edge cases: a null or empty text has no words and fails the base rules. Without
labelled rows of both classes the base rules alone decide. Ties do not arise: the
verdict of a text depends on that text and the model alone, so repeated rows get
equal verdicts. An empty table gives an empty result. All columns pass through
the filter unread but for the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.labelled import labelled_sample
from tidegauge.llm.text_batches import Words, byte_view, pieces, plain_texts, words_of

#: The fit's bounds: rows of either class, and bytes of one text.
TRAIN_ROWS, TRAIN_BYTES = 1_000, 1 << 14
SLOTS = 1 << 18
#: Text bytes handled at once.
BATCH = 4 << 20
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return np.diff(total[offsets])


@dataclass
class BaseCounts:
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    @property
    def failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > MAX_REPEATED_PERCENT * self.n_words)


def repeated_lines(body: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Per text, lines with a word that equal an earlier line."""
    ends = np.unique(np.concatenate([np.flatnonzero(body == 0x0A), offsets[1:] - 1]))
    ends = ends[ends >= 0]
    starts = np.concatenate(([0], ends[:-1] + 1))
    # A break at a line's end is no part of it.
    size = ends + 1 - starts - (body[ends] == 0x0A) if len(ends) else ends
    table = pa.Array.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size))).astype(np.int64)), pa.py_buffer(body[body != 0x0A])],
    )
    codes = table.dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    held = np.searchsorted(words.starts, ends + 1) > np.searchsorted(words.starts, starts)
    text, codes = text[held], codes[held]
    distinct = np.unique(text * (int(codes.max(initial=0)) + 1) + codes)
    texts = len(offsets) - 1
    lines = np.bincount(text, minlength=texts)
    return lines - np.bincount(distinct // (int(codes.max(initial=0)) + 1), minlength=texts)


def repeated_words(words: Words) -> np.ndarray:
    """Per text, words inside a three-word window found twice or more in the text."""
    texts, total = len(words.bounds) - 1, len(words.codes)
    text = np.repeat(np.arange(texts), np.diff(words.bounds))
    if total < 3:
        return np.zeros(texts, dtype=np.int64)
    at = np.flatnonzero(text[:-2] == text[2:])
    kinds = max(1, len(words.vocabulary))
    # Exact: each step numbers the distinct pairs before the next is joined on.
    pair = pd.factorize(text[at] * kinds + words.codes[at])[0]
    pair = pd.factorize(pair * kinds + words.codes[at + 1])[0]
    window = pd.factorize(pair * kinds + words.codes[at + 2])[0]
    again = at[np.bincount(window)[window] > 1]
    inside = np.zeros(total, dtype=bool)
    for step in range(3):
        inside[again + step] = True
    return between(inside, words.bounds)


def base_counts(texts: pa.Array, words: Words) -> BaseCounts:
    body, offsets = byte_view(texts)
    spaces = np.zeros(256, dtype=bool)
    spaces[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
    characters = ~spaces[body] & ((body & 0xC0) != 0x80)
    return BaseCounts(
        np.diff(words.bounds),
        between(characters, offsets),
        between(_SYMBOL[body], offsets),
        repeated_lines(body, offsets, words),
        repeated_words(words),
    )


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes, 0 for an empty one."""
    body, offsets = byte_view(vocabulary)
    sizes = np.diff(offsets)
    out = np.zeros(len(vocabulary), dtype=np.uint64)
    if not len(body):
        return out
    place = np.arange(len(body)) - np.repeat(offsets[:-1], sizes)
    factor = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    spread = (body.astype(np.uint64) + np.uint64(1)) * factor[place]
    out[sizes > 0] = np.add.reduceat(spread, offsets[:-1][sizes > 0])
    return out


def slot(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - 18)).astype(np.int64)


def views(texts: pa.Array, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature slots in text order and their bounds by text: words, word pairs,
    character trigrams. The slots of the three views do not overlap."""
    hashed = word_hashes(words.vocabulary)[words.codes]
    pairs = hashed[:-1] * np.uint64(3) ^ hashed[1:]
    body, offsets = byte_view(texts)
    wide = body.astype(np.uint32)
    grams = (wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]) if len(body) > 2 else wide[:0]
    grams = ((grams * np.uint32(2654435761)) >> np.uint32(32 - 18)).astype(np.int64)
    return [
        (slot(hashed), words.bounds),
        (slot(pairs) + SLOTS, words.bounds),
        (grams + 2 * SLOTS, offsets),
    ]


def spans(bounds: np.ndarray, size: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one feature of each text, of features that reach over
    ``reach`` further items and must not leave the text."""
    start = np.minimum(bounds[:-1], size)
    return start, np.maximum(start, np.minimum(bounds[1:] - reach, size))


def means(weights: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Per text, the sum over views of the mean weight of their features."""
    out = np.zeros(len(found[0][1]) - 1)
    for (features, bounds), reach in zip(found, (0, 1, 2), strict=True):
        start, stop = spans(bounds, len(features), reach)
        total = np.concatenate(([0.0], np.cumsum(weights[features], dtype=np.float64)))
        out += (total[stop] - total[start]) / np.maximum(stop - start, 1)
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * means(self.weights, found) + self.offset, -50, 50)))


def fit_logistic(rows: np.ndarray, slots: np.ndarray, shares: np.ndarray, labels: np.ndarray, steps: int = 120) -> np.ndarray:
    """Weights by Adam on the regularised logistic loss of balanced classes."""
    width = 3 * SLOTS
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    used, place = np.unique(slots, return_inverse=True)
    w, first, second = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, steps + 1):
        margin = np.bincount(rows, w[place] * shares, len(labels))
        miss = weight * (labels - 1 / (1 + np.exp(-margin)))
        slope = np.bincount(place, miss[rows] * shares, len(used)) - 1e-6 * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    out = np.zeros(width, dtype=np.float32)
    out[used] = w
    return out


def fit_platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a margin into a probability (Newton steps)."""
    scale = max(float(margin.std()), 1e-9)
    x, a, b = margin / scale, 1.0, 0.0
    # Smoothed targets keep separable margins finite.
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        bend = p * (1 - p) + 1e-6
        g = np.array([((target - p) * x).sum(), (target - p).sum()])
        h = np.array([[(bend * x * x).sum() + 1e-3, (bend * x).sum()], [(bend * x).sum(), bend.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        a, b = a + move[0], b + move[1]
    return float(a / scale), float(b)


def fit_quality(texts: pa.Array, labels: np.ndarray) -> QualityModel | None:
    """Every fifth row is held back to calibrate on."""
    if len(set(labels.tolist())) < 2:
        return None
    rows, slots, shares = [], [], []
    found = views(texts, words_of(texts))
    for (features, bounds), reach in zip(found, (0, 1, 2), strict=True):
        for text, (i, j) in enumerate(zip(*spans(bounds, len(features), reach), strict=True)):
            own, counts = np.unique(features[i:j], return_counts=True)
            rows.append(np.full(len(own), text, dtype=np.int32))
            slots.append(own.astype(np.int32))
            shares.append((counts / max(1, j - i)).astype(np.float32))
    rows, slots, shares = (np.concatenate(part) for part in (rows, slots, shares))
    held = np.arange(len(labels)) % 5 == 4
    if len(set(labels[~held].tolist())) < 2 or len(set(labels[held].tolist())) < 2:
        held = np.zeros(len(labels), dtype=bool)
    fitted = ~held[rows]
    number = np.cumsum(~held) - 1
    weights = fit_logistic(number[rows[fitted]], slots[fitted], shares[fitted], labels[~held])
    margin = means(weights, found)
    check = held if held.any() else ~held
    slope, offset = fit_platt(margin[check], labels[check])
    return QualityModel(weights, slope, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel | None:
    return fit_quality(*labelled_sample(docs, labels, label, TRAIN_ROWS, TRAIN_BYTES))


def verdicts(texts: pa.Array, model: QualityModel | None) -> tuple[BaseCounts, np.ndarray, np.ndarray]:
    """Base counts, probability of good quality, and whether a text is kept."""
    words = words_of(texts)
    counts = base_counts(texts, words)
    chance = model.probability(views(texts, words)) if model else np.ones(len(texts))
    return counts, chance, ~counts.failed & (chance >= THRESHOLD)


def judge_quality(docs: DataFrame, model: QualityModel | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the base counts, base_failed, kept, probability."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = slim.schema["__key"].dataType.simpleString()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "__text", BATCH):
                counts, chance, kept = verdicts(plain_texts(piece.column("__text")), shared.value)
                numbers = [pa.array(getattr(counts, n), pa.int64()) for n in names]
                rest = [pa.array(counts.failed), pa.array(kept), pa.array(chance, pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("__key"), *numbers, *rest], names=["__key", *names, "base_failed", "kept", "chance"]
                )

    numbers = ", ".join(f"{n} bigint" for n in names)
    judged = slim.mapInArrow(run, f"__key {kind}, {numbers}, base_failed boolean, kept boolean, chance double")
    return judged.select(F.col("__key").alias(key), *names, "base_failed", "kept", "chance")


def keep_good(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            plain = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for piece in pieces(plain, f"c{place}", BATCH):
                kept = verdicts(plain_texts(piece.column(place)), shared.value)[2]
                out = piece.filter(pa.array(kept))
                yield pa.RecordBatch.from_arrays(out.columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
