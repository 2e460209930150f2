"""Toxic spans by a linear-chain conditional random field.

Words are tagged toxic or not. A word's own potential sums weights of its hashed
lower-case form and of its beginnings and endings; the chain adds transitions
between neighbouring words. The field is trained on labelled tokens: a word of a
toxic document is labelled toxic if one of its forms is far more common among
toxic documents than among others. Forward-backward gives each word's marginal;
a document's score comes from the chance that at least one word is toxic,
calibrated on rows held back from the fit; offending offsets are the runs of words
whose marginal is one half or more.

The marginals of a batch are computed for all texts at once. With two states the
ratio of the forward values follows a Moebius map, so a batch is cut into lanes
of ``LANE`` words whose maps are composed side by side; the carries between lanes
are exact, and a text's first word starts afresh.

Edge cases: a null or empty text has no words and gets the lowest score. Without
labelled rows of both classes every score is 0. Scores depend on the text and the
model alone; repeated rows score alike. An empty table gives an empty result.
Columns other than the key and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.labelled import labelled_sample
from tidegauge.llm.quality import fit_platt, word_hashes
from tidegauge.llm.text_batches import Words, byte_view, pieces, plain_texts, words_of

#: The fit's bounds: rows of either class, and bytes of one text.
TRAIN_ROWS, TRAIN_BYTES = 1_500, 1 << 14
SLOT_BITS = 20
LANE = 64
#: Bytes of the beginnings and endings that are features.
BEGINNINGS, ENDINGS = (4, 5, 6, 7, 8), (5, 7)
#: A form is a sign of toxicity from this many toxic documents and odds on.
LEAST_DOCS, LEAST_ODDS = 4, 25.0
LIMIT = 12.0
FEATURES = 1 + len(BEGINNINGS) + len(ENDINGS)


def word_features(vocabulary: pa.Array) -> np.ndarray:
    """Hash slots of each word's features, 0 for one that it is too short for."""
    trimmed = pc.utf8_trim(vocabulary.cast(pa.large_string()), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    lower = pc.utf8_lower(trimmed).cast(pa.large_binary())
    size = pc.binary_length(lower).to_numpy()
    columns = [np.where(size > 0, slots(word_hashes(lower), 1), 0)]
    for kind, length in enumerate(BEGINNINGS, 2):
        part = pc.binary_slice(lower, 0, length)
        columns.append(np.where(size >= length, slots(word_hashes(part.cast(pa.large_binary())), kind), 0))
    for kind, length in enumerate(ENDINGS, 2 + len(BEGINNINGS)):
        part = pc.binary_slice(lower, -length)
        columns.append(np.where(size >= length, slots(word_hashes(part.cast(pa.large_binary())), kind), 0))
    return np.stack(columns, axis=1)


def slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    salt = np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = (hashes + salt) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    return (mixed % np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) + 1


@dataclass
class Field:
    """Weights by slot (0 unused), a bias, log transitions [from, to], and the
    calibration of the document score."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def potentials(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[features].sum(axis=1) + self.bias, -LIMIT, LIMIT)


def ratios(local: np.ndarray, fresh: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """r[t] = local[t] * (m01 + m11 r[t-1]) / (m00 + m10 r[t-1]), and local[t]
    where ``fresh``: the ratio of the forward values of the two states."""
    total = len(local)
    lanes = -(-total // LANE)
    e, f = np.ones(lanes * LANE), np.zeros(lanes * LANE, dtype=bool)
    e[:total], f[:total] = local, fresh
    e, f = e.reshape(lanes, LANE).T.copy(), f.reshape(lanes, LANE).T.copy()
    (m00, m01), (m10, m11) = moves
    # Each lane as one map r -> (a + b r) / (c + d r).
    a, b, c, d = np.zeros(lanes), np.ones(lanes), np.ones(lanes), np.zeros(lanes)
    for t in range(LANE):
        a, b, c, d = e[t] * (m01 * c + m11 * a), e[t] * (m01 * d + m11 * b), m00 * c + m10 * a, m00 * d + m10 * b
        a, b, c, d = np.where(f[t], e[t], a), np.where(f[t], 0, b), np.where(f[t], 1, c), np.where(f[t], 0, d)
        size = a + b + c + d
        a, b, c, d = a / size, b / size, c / size, d / size
    begin, r = np.empty(lanes), 1.0
    for lane, (p, q, s, u) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        begin[lane] = r
        r = (p + q * r) / (s + u * r)
    out, r = np.empty((LANE, lanes)), begin
    for t in range(LANE):
        r = np.where(f[t], e[t], e[t] * (m01 + m11 * r) / (m00 + m10 * r))
        out[t] = r
    return out.T.ravel()[:total]


def marginals(field: Field, local: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance of toxic per word; and the forward and backward ratios."""
    if not len(local):
        return local, local, local
    e, moves = np.exp(local), np.exp(field.moves)
    inner = bounds[:-1][bounds[:-1] < bounds[1:]]
    first = np.zeros(len(e), dtype=bool)
    first[inner] = True
    last = np.zeros(len(e), dtype=bool)
    last[bounds[1:][bounds[:-1] < bounds[1:]] - 1] = True
    ahead = ratios(e, first, moves)
    back = ratios(e[::-1], last[::-1], moves.T)[::-1]
    odds = ahead * back / e
    return odds / (1 + odds), ahead, back


def fit_field(words: Words, features: np.ndarray, tags: np.ndarray, steps: int = 40) -> Field:
    """Adam on the regularised log-likelihood of the tag sequences."""
    used, place = np.unique(features, return_inverse=True)
    place = place.reshape(features.shape)
    weights, bias, moves = np.zeros(len(used)), -3.0, np.zeros((2, 2))
    kinds, total = len(features), len(words.codes)
    truth = np.bincount(words.codes, tags, kinds)
    same = np.ones(max(0, total - 1), dtype=bool)
    cut = words.bounds[1:-1]
    same[cut[(cut > 0) & (cut < total)] - 1] = False
    pairs = np.bincount((tags[:-1] * 2 + tags[1:])[same], minlength=4).reshape(2, 2)
    state = {k: [0.0, 0.0] for k in ("weights", "bias", "moves")}
    weight = 1.0 / max(1, tags.sum())
    for step in range(1, steps + 1):
        values = np.where(used == 0, 0, weights)
        field = Field(values, bias, moves)
        local = np.clip(values[place].sum(axis=1) + bias, -LIMIT, LIMIT)[words.codes]
        chance, ahead, back = marginals(field, local, words.bounds)
        miss = truth - np.bincount(words.codes, chance, kinds)
        pull = np.zeros(len(used))
        for column in place.T:
            pull += np.bincount(column, miss, len(used))
        a, q, m = ahead[:-1][same], back[1:][same], np.exp(moves)
        joint = np.stack([np.full(len(a), m[0, 0]), m[0, 1] * q, m[1, 0] * a, m[1, 1] * a * q])
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        grads = {
            "weights": pull * weight - 1e-3 * weights, "bias": miss.sum() * weight,
            "moves": (pairs - expected) * weight - 1e-2 * moves,
        }
        move = {}
        for name, grad in grads.items():
            state[name][0] = 0.9 * state[name][0] + 0.1 * grad
            state[name][1] = 0.99 * state[name][1] + 0.01 * grad**2
            move[name] = (state[name][0] / (1 - 0.9**step)) / (np.sqrt(state[name][1] / (1 - 0.99**step)) + 1e-9)
        weights, bias, moves = weights + 0.25 * move["weights"], bias + 0.1 * float(move["bias"]), moves + 0.05 * move["moves"]
    full = np.zeros((1 << SLOT_BITS) + 1)
    full[used] = weights
    full[0] = 0
    return Field(full, bias, moves)


def tag_tokens(words: Words, features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """1 for the words of toxic documents that carry a sign of toxicity."""
    texts = len(labels)
    text = np.repeat(np.arange(texts), np.diff(words.bounds))
    kinds = len(features)
    seen = np.unique(text * kinds + words.codes)
    doc, word = seen // kinds, seen % kinds
    toxic_docs, clean_docs = int(labels.sum()), int((1 - labels).sum())
    sign = np.zeros(kinds, dtype=bool)
    for column in features.T:
        slot = column[word]
        distinct = np.unique(doc * (1 << (SLOT_BITS + 1)) + slot)
        owner, slot = distinct >> (SLOT_BITS + 1), distinct & ((1 << (SLOT_BITS + 1)) - 1)
        toxic = np.bincount(slot[labels[owner] == 1], minlength=1 << (SLOT_BITS + 1))
        clean = np.bincount(slot[labels[owner] == 0], minlength=1 << (SLOT_BITS + 1))
        odds = ((toxic + 0.5) / (toxic_docs + 1)) / ((clean + 0.5) / (clean_docs + 1))
        strong = (toxic >= LEAST_DOCS) & (odds >= LEAST_ODDS)
        strong |= (toxic >= 4 * LEAST_DOCS) & (odds >= LEAST_ODDS / 2)
        strong[0] = False
        sign |= strong[column]
    return (sign[words.codes] & (labels[text] == 1)).astype(np.int64)


def evidence(chance: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the log of minus the log of the chance that no word is toxic."""
    none = np.concatenate(([0.0], np.cumsum(-np.log1p(-np.minimum(chance, 1 - 1e-9)))))
    return np.log(np.maximum(none[bounds[1:]] - none[bounds[:-1]], 0) + 1e-4)


def fit_toxicity(texts: pa.Array, labels: np.ndarray) -> Field | None:
    """Every fourth row of either class is held back to calibrate on."""
    if len(set(labels.tolist())) < 2:
        return None
    held = np.arange(len(labels)) % 4 == 3
    if len(set(labels[held].tolist())) < 2 or len(set(labels[~held].tolist())) < 2:
        held = np.zeros(len(labels), dtype=bool)
    own = texts.filter(pa.array(~held))
    words = words_of(own)
    features = word_features(words.vocabulary)
    tags = tag_tokens(words, features, labels[~held])
    field = fit_field(words, features, tags)
    check = held if held.any() else ~held
    chosen = words_of(texts.filter(pa.array(check)))
    chance, _, _ = marginals(field, field.potentials(word_features(chosen.vocabulary))[chosen.codes], chosen.bounds)
    field.slope, field.offset = fit_platt(evidence(chance, chosen.bounds), labels[check])
    field.slope = max(field.slope, 0.0)
    return field


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", only=None) -> Field | None:
    return fit_toxicity(*labelled_sample(docs, labels, label, TRAIN_ROWS, TRAIN_BYTES, only))


def score_texts(field: Field | None, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores, and toxic spans as character offsets [start, end)."""
    if field is None:
        return np.zeros(len(texts)), [[] for _ in range(len(texts))]
    words = words_of(texts)
    local = field.potentials(word_features(words.vocabulary))[words.codes]
    chance, _, _ = marginals(field, local, words.bounds)
    margin = field.slope * evidence(chance, words.bounds) + field.offset
    score = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
    body, offsets = byte_view(texts)
    bad = np.flatnonzero(chance >= 0.5)
    found: list[list[dict]] = [[] for _ in range(len(texts))]
    owner = np.searchsorted(words.bounds, bad, side="right") - 1
    characters = np.concatenate(([0], np.cumsum((body & 0xC0) != 0x80)))
    base = characters[offsets[owner]]
    start = characters[words.starts[bad]] - base
    end = characters[words.starts[bad] + words.lengths[bad]] - base
    previous = -2
    for word, text, i, j in zip(bad.tolist(), owner.tolist(), start.tolist(), end.tolist(), strict=True):
        if word == previous + 1 and found[text]:
            found[text][-1]["end"] = j
        else:
            found[text].append({"start": i, "end": j})
        previous = word
    return score, found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def score_toxicity(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, spans."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = slim.schema["__key"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "__text", 4 << 20):
                score, found = score_texts(shared.value, plain_texts(piece.column("__text")))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("__key"), pa.array(score, pa.float64()), pa.array(found, SPANS)],
                    names=["__key", "score", "spans"],
                )

    scored = slim.mapInArrow(run, f"__key {kind}, score double, spans array<struct<start:bigint,end:bigint>>")
    return scored.select(F.col("__key").alias(key), "score", "spans")
