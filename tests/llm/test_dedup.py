"""Repeated strings and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCS, prose
from tidegauge.llm import near_dedup, suffix_dedup
from tidegauge.llm.text_batches import plain_texts, words_of


def brute_repeats(texts: list[str | None], length: int):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    for body in bodies:
        gone = np.zeros(len(body), dtype=bool)
        for i in range(len(body) - length + 1):
            if seen[body[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate(([False], gone))[:-1]).sum())
        yield len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def check_repeats(docs, length=200, gram=32):
    rows = docs.collect()
    expected = [(r["doc_id"], *d) for r, d in zip(rows, brute_repeats([r["text"] for r in rows], length), strict=True)]
    got = [tuple(r) for r in suffix_dedup.dedup_digest(docs, length=length, gram=gram).collect()]
    assert Counter(got) == Counter(expected)


@pytest.mark.parametrize("table", ["documents", "clashing"])
def test_repeats(request, table):
    check_repeats(request.getfixturevalue(table))


def test_repeats_in_a_small_alphabet(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab"), int(n))) for n in rng.integers(0, 400, 60)]
    texts += [texts[0][3:], "a" * 90, "ab" * 60, "a" * 90 + "b"]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    check_repeats(docs, length=16, gram=5)


def test_hot_triggers_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 3)
    monkeypatch.setattr(suffix_dedup, "MEMBERS", 8)
    shared = prose(9, 60)
    texts = [prose(100 + i, 5) + shared + prose(200 + i % 7, 30) for i in range(20)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    check_repeats(docs)


def test_drop_repeats_keeps_columns_and_valid_text(spark, clashing, no_rows):
    got = suffix_dedup.drop_repeats(clashing)
    assert got.dtypes == clashing.dtypes and got.count() == clashing.count()
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] in (1, 5)}
    assert texts[1].startswith("One two") and texts[5] == prose(1, 30_000)
    assert suffix_dedup.drop_repeats(no_rows).count() == 0
    assert suffix_dedup.dedup_digest(no_rows).count() == 0


def multiset(text: str | None) -> Counter:
    words = (text or "").split()
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar(a: Counter, b: Counter) -> bool:
    both = sum((a & b).values())
    return 5 * both >= 4 * (sum(a.values()) + sum(b.values()) - both)


def brute_classes(rows):
    bags = [multiset(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(bags[i], bags[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r["doc_id"])
    out = []
    for keys in groups.values():
        least = min((k for k in keys if k is not None), default=None)
        out += [(k, least, len(keys)) for k in keys]
    return Counter(out)


@pytest.fixture(scope="module")
def edited(spark):
    """Copies with words changed, in multisets with and without repeats."""
    rng = np.random.default_rng(3)
    rows = []
    for base in range(12):
        words = (prose(base, 60) if base % 2 else prose(base, 20) + " " + prose(base, 20) * 3).split()
        for copy in range(9):
            own = list(words)
            for at in rng.integers(0, len(own), rng.integers(0, 4)):
                own[at] = f"w{rng.integers(50)}"
            rows.append((len(rows), " ".join(own), "en", "s", copy))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("table", ["edited", "clashing", "documents"])
def test_classes(request, table):
    docs = request.getfixturevalue(table)
    got = Counter(tuple(r) for r in near_dedup.near_classes(docs).collect())
    assert got == brute_classes(docs.collect())


def test_hot_buckets_are_dealt_in_chunks(edited, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 2)
    got = Counter(tuple(r) for r in near_dedup.near_classes(edited).collect())
    assert got == brute_classes(edited.collect())


def test_buckets_of_long_texts_are_dealt_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", 40_000)
    long = prose(77, 2000).split(" ")
    rows = [(i, " ".join([*long[: 50 * i], f"word{i}", *long[50 * i :]]), "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    assert {tuple(r)[1:] for r in near_dedup.near_classes(docs).collect()} == {(0, 40)}
    members = near_dedup.dealt(near_dedup.buckets(near_dedup.signed(docs))).collect()
    assert len({r["__row"] for r in members}) == 40
    groups = Counter()
    for r in {(r["__band"], r["__low"], r["__high"], r["__row"], r["__bytes"]) for r in members}:
        groups[r[:3]] += r[4]
    total = sum(len(r[1]) for r in rows)
    assert total > 8 * 40_000 and max(groups.values()) <= 4 * 40_000


def test_one_of_each_class_stays(edited, clashing, no_rows):
    kept = near_dedup.keep_one(edited)
    assert kept.dtypes == edited.dtypes
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c, _ in brute_classes(edited.collect())}
    kept = near_dedup.keep_one(clashing)
    assert kept.dtypes == clashing.dtypes
    # Null, empty and blank texts are one class; equal rows are another.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, None, 5, 6, 6, 7, 8, 9])
    assert near_dedup.keep_one(no_rows).count() == 0
    assert near_dedup.near_classes(no_rows).count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(7)
    errors = []
    for trial in range(60):
        kinds = [f"t{trial}x{i}" for i in range(12)]
        pair = [Counter({k: int(n) for k, n in zip(kinds, rng.integers(0, 9, 12), strict=True) if n}) for _ in range(2)]
        hashes = {k: near_dedup.mix(np.array([hash(k) & (2**63 - 1)], dtype=np.uint64))[0] for k in kinds}
        text = np.repeat([0, 1], [len(p) for p in pair])
        elements = np.array([hashes[k] for p in pair for k in p], dtype=np.uint64)
        counts = np.array([n for p in pair for n in p.values()])
        a, b = near_dedup.signatures(text, elements, counts, 2)
        truth = sum((pair[0] & pair[1]).values()) / sum((pair[0] | pair[1]).values())
        errors.append((a == b).mean() - truth)
    assert abs(np.mean(errors)) < 4 * 0.04 / np.sqrt(60)
    assert np.std(errors) < 0.06


def test_shingles_of_short_texts():
    texts = plain_texts(pa.array(["a b", "a b", "a", "", "a b c d e", "a b c d e f"]))
    text, hashes = near_dedup.shingles(words_of(texts))
    assert text.tolist() == [0, 1, 2, 4, 5, 5]
    assert hashes[0] == hashes[1] != hashes[2] and hashes[3] == hashes[4]
