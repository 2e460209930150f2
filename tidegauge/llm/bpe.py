"""BPE encoding and decoding with a contiguous rank array per short word.

Every short word holds its part boundaries and the merge rank of each pair of
neighbouring parts in one contiguous row. The smallest rank is found by a scan,
its boundary is deleted, the ranks beside it are refreshed, until no pair has a
rank. Words of one length form a matrix, so that each scan is one array
operation over all of them. Words beyond ``SHORT`` parts would make the scan
quadratic; they use a heap of ranks with the same result.

Texts are split at ASCII white space, no rule of the vocabulary reaches over it,
so each distinct word of a batch is encoded once. Nothing is shuffled.

Edge cases: a null or empty text, or one of white space alone, has no ids and
decodes to the empty text. Repeated rows and null keys are encoded like any
other row. An empty table gives an empty result. Input columns other than the
key and the text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.text_batches import Ragged, byte_view, known_words, pieces, plain_texts, words_of

SHORT = 48
#: Words in one matrix of ranks.
ROWS = 50_000
NO_RANK = np.int32(1 << 30)

# White space and the split rule as the vocabulary file states them.
WHITE = r"\t-\r " + "".join(
    map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)

def latin(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes in lower case, which of them make Latin-1 letters, which are
    ASCII marks other than those with a rule of their own."""
    upper = (body >= 0x41) & (body <= 0x5A)
    letter = upper | (body >= 0x61) & (body <= 0x7A)
    lead = np.zeros(len(body) + 1, dtype=bool)
    lead[:-1] = body == 0xC3
    second = np.zeros(len(body), dtype=bool)
    second[1:] = lead[:-2] & (body[1:] != 0x97) & (body[1:] != 0xB7)
    lead[:-2] &= second[1:]
    upper |= second & (body <= 0x9E)
    mark = (body > 0x20) & (body < 0x7F) & ~letter & ~((body >= 0x30) & (body <= 0x39))
    mark &= (body != 0x27) & (body != 0x3C)
    return body + upper.astype(np.uint8) * 0x20, letter | second | lead[:-1], mark


class Rows:
    """Collects rows of ids, given by their number in any order."""

    def __init__(self, count: int):
        self.sizes, self.parts = np.zeros(count, dtype=np.int64), []

    def put(self, numbers: np.ndarray, rows: np.ndarray) -> None:
        self.sizes[numbers] = rows.shape[1]
        self.parts.append((numbers, rows))

    def ragged(self) -> Ragged:
        ends = np.concatenate(([0], np.cumsum(self.sizes)))
        values = np.empty(ends[-1], dtype=np.uint32)
        for numbers, rows in self.parts:
            values[ends[numbers][:, None] + np.arange(rows.shape[1])] = rows
        return Ragged(values, ends)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    place = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
    return [chr(place[b]) for b in range(256)]


#: Ids of pre-tokens given as stretches of bytes; and ids of any words.
Pieces = Callable[[np.ndarray, np.ndarray, np.ndarray], Ragged]
Odd = Callable[[list[str]], list[list[int]]]


def encode_split(words: pa.Array, encode_pieces: Pieces, encode_odd: Odd) -> Ragged:
    """Ids of many words at once.

    Words of Latin letters that end in punctuation or not, nearly all words of
    Western text, are split and put in lower case as arrays of bytes. All
    others go to ``encode_odd``. The results are the same.
    """
    body, offsets = byte_view(words)
    lower, letter, mark = latin(body)
    count = np.diff(offsets)
    letters = np.add.reduceat(np.append(letter, 0), offsets[:-1]) * (count > 0) if len(words) else count
    marks = np.add.reduceat(np.append(mark, 0), offsets[:-1]) * (count > 0) if len(words) else count
    turned = np.zeros(len(body) + 1, dtype=np.int64)
    turned[1:-1] = mark[:-1] & letter[1:] if len(body) > 1 else 0
    turned[offsets[1:-1]] = 0
    plain = (letters + marks == count) & (np.add.reduceat(turned, offsets[:-1]) == 0) if len(words) else count > 0
    starts = np.stack([offsets[:-1], offsets[:-1] + letters], axis=1)[plain].ravel()
    lengths = np.stack([letters, marks], axis=1)[plain].ravel()
    parts = encode_pieces(lower, starts[lengths > 0], lengths[lengths > 0])
    held = np.zeros(len(lengths), dtype=np.int64)
    held[lengths > 0] = np.diff(parts.ends)
    sizes = np.zeros(len(words), dtype=np.int64)
    sizes[plain] = held.reshape(-1, 2).sum(axis=1)
    odd = np.flatnonzero(~plain)
    slow = encode_odd([words[i].as_py().decode() for i in odd.tolist()])
    sizes[odd] = [len(ids) for ids in slow]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    values = np.empty(ends[-1], dtype=np.uint32)
    from_parts = np.ones(len(values), dtype=bool)
    for i, ids in zip(odd.tolist(), slow, strict=True):
        values[ends[i] : ends[i + 1]] = ids
        from_parts[ends[i] : ends[i + 1]] = False
    values[from_parts] = parts.values
    return Ragged(values, ends)


class RankArrayBPE:
    """Encoder and decoder for a word-level BPE vocabulary file (JSON).

    The file's truncation and padding are not used.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.added).items()}
        self.alphabet = byte_alphabet()
        self.first = np.array([self.ids[c] for c in self.alphabet], dtype=np.int32)
        self.last = np.array([self.ids[c + self.end] for c in self.alphabet], dtype=np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([(self.ids[a] << 17) | self.ids[b] for a, b in merges], dtype=np.int64)
        self.made = np.array([self.ids[a + b] for a, b in merges], dtype=np.int32)
        order = np.argsort(pairs, kind="stable")
        self.keys, self.ranks = pairs[order], order.astype(np.int32)
        self.rank_of = dict(zip(pairs.tolist(), range(len(pairs)), strict=True))
        rule = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.rule = regex.compile(rule.replace(r"\s", WHITE))
        self.white = regex.compile(f"[{WHITE}]+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")

    def parts(self, word: str) -> list[str | int]:
        """A word's normalised pre-tokens, and the ids of special tokens in it."""
        found: list[str | int] = []
        for piece in self.special.split(word):
            if piece in self.added:
                found.append(self.added[piece])
            elif piece:
                plain = self.white.sub(" ", unicodedata.normalize("NFC", piece))
                found += self.rule.findall("".join(c.lower() for c in plain))
        return found

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, ``NO_RANK`` where there is none."""
        wanted = (left.astype(np.int64) << 17) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merged ids of words with equally many parts: (row numbers, ids)."""
        numbers = np.arange(len(rows))
        ranks = self.rank(rows[:, :-1], rows[:, 1:])
        while rows.shape[1] > 1:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            open_ = best < NO_RANK
            if not open_.all():
                yield numbers[~open_], rows[~open_]
                rows, ranks, at, best, numbers = rows[open_], ranks[open_], at[open_], best[open_], numbers[open_]
            if not len(rows):
                return
            width, every = rows.shape[1], np.arange(len(rows))
            rows[every, at] = self.made[best]
            stay = np.ones(rows.shape, dtype=bool)
            stay[every, at + 1] = False
            rows = rows[stay].reshape(-1, width - 1)
            if width == 2:
                break
            stay = np.ones(ranks.shape, dtype=bool)
            stay[every, at] = False
            ranks = ranks[stay].reshape(-1, width - 2)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.rank(rows[left, at[left] - 1], rows[left, at[left]])
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self.rank(rows[right, at[right]], rows[right, at[right] + 1])
        yield numbers, rows

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges by a heap, for words too long to scan again and again."""
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        rank = self.rank_of.get

        def entry(i: int):
            return (rank((ids[i] << 17) | ids[after[i]]), i, ids[i], ids[after[i]])

        heap = [e for i in range(len(ids) - 1) if (e := entry(i))[0] is not None]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = int(self.made[best]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (e := entry(i))[0] is not None:
                    heapq.heappush(heap, e)
            if before[i] >= 0 and (e := entry(before[i]))[0] is not None:
                heapq.heappush(heap, e)
        return [x for x in ids if x >= 0]

    def encode_pieces(self, spelled: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Ragged:
        """Ids of pre-tokens given as stretches of lower-case bytes."""
        out = Rows(len(starts))
        for length in np.unique(lengths).tolist():
            which = np.flatnonzero(lengths == length)
            for at in range(0, len(which), ROWS):
                chosen = which[at : at + ROWS]
                grid = spelled[starts[chosen][:, None] + np.arange(length)]
                rows = self.first[grid]
                rows[:, -1] = self.last[grid[:, -1]]
                if length > SHORT:
                    for number, row in zip(chosen.tolist(), rows.tolist(), strict=True):
                        out.put(np.array([number]), np.array([self.merge_long(row)]))
                    continue
                for numbers, merged in self.merge_rows(rows):
                    out.put(chosen[numbers], merged)
        return out.ragged()

    def encode_odd(self, words: list[str]) -> list[list[int]]:
        """Any words, by the rules as the vocabulary file states them."""
        split = [self.parts(w) for w in words]
        distinct = list({p for parts in split for p in parts if isinstance(p, str)})
        spelled = [p.encode() for p in distinct]
        lengths = np.array([len(p) for p in spelled], dtype=np.int64)
        body = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        coded = self.encode_pieces(body, np.cumsum(lengths) - lengths, lengths)
        ids, ends = coded.values.tolist(), coded.ends.tolist()
        known = {p: ids[ends[i] : ends[i + 1]] for i, p in enumerate(distinct)}
        return [[i for p in parts for i in (known[p] if isinstance(p, str) else (p,))] for parts in split]

    def encode_words(self, words: pa.Array) -> Ragged:
        return encode_split(words, self.encode_pieces, self.encode_odd)

    def encode(self, text: str) -> list[int]:
        words = words_of(plain_texts(pa.array([text])))
        coded = self.encode_words(words.vocabulary)
        return coded.take(words.codes).values.tolist()

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by blanks: the vocabulary file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


def _code_batches(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = RankArrayBPE(path)
        known = known_words(f"rank array {path}", bpe.encode_words)
        shown = pa.array([f"{bpe.tokens.get(i, '')} ".encode() for i in range(max(bpe.tokens) + 1)], pa.large_binary())
        for batch in batches:
            for piece in pieces(batch, "__text"):
                words = words_of(plain_texts(piece.column("__text")))
                coded = known.ids(words.vocabulary)
                spelled, at = byte_view(shown.take(pa.array(coded.values)))
                ids = coded.take(words.codes)
                text = Ragged(spelled, at[coded.ends]).take(words.codes)
                body, decoded = memoryview(ids.values.astype("<u4")).cast("B"), memoryview(text.values)
                a, b = ids.ends[words.bounds].tolist(), text.ends[words.bounds].tolist()
                spans = [(4 * i, 4 * j) for i, j in zip(a, a[1:], strict=False)]
                # The blank after a text's last token is not part of it.
                texts = [(i, max(i, j - 1)) for i, j in zip(b, b[1:], strict=False)]
                if digests:
                    left = pa.array([hashlib.sha256(body[i:j]).hexdigest() for i, j in spans])
                    right = pa.array([hashlib.sha256(decoded[i:j]).hexdigest() for i, j in texts])
                else:
                    left = pa.array([bytes(body[i:j]) for i, j in spans], type=pa.binary())
                    right = pa.array([str(decoded[i:j], "utf-8") for i, j in texts], type=pa.string())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("__key"), pa.array(np.diff(a)), left, right],
                    names=["__key", "n_tokens", "left", "right"],
                )

    return run


def _coded(docs: DataFrame, path: str, key: str, text: str, digests: bool, names: tuple[str, str]) -> DataFrame:
    slim = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = slim.schema["__key"].dataType.simpleString()
    schema = f"__key {kind}, n_tokens bigint, left {'string' if digests else 'binary'}, right string"
    coded = slim.mapInArrow(_code_batches(path, digests), schema)
    return coded.select(
        F.col("__key").alias(key), "n_tokens", F.col("left").alias(names[0]), F.col("right").alias(names[1])
    )


def bpe_code(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's ids (little-endian 32-bit) and the text that they decode to."""
    return _coded(docs, path, key, text, False, ("ids", "decoded"))


def bpe_digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``bpe_code``, with hex SHA-256 in place of the ids and the decoded text."""
    return _coded(docs, path, key, text, True, ("ids_sha256", "decoded_sha256"))
