"""SimHash components against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidegauge.llm import sim_hash
from tidegauge.llm.queries import QUERIES
from tests.llm.conftest import DOCS, prose


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest reachable index, all pairs compared."""
    values = np.array(prints, dtype=np.uint64)
    close = np.bitwise_count(values[:, None] ^ values) <= 4
    out = [-1] * len(prints)
    for i in range(len(prints)):
        queue = [i] if out[i] < 0 else []
        while queue:
            one = queue.pop()
            if out[one] < 0:
                out[one] = i
                queue += np.flatnonzero(close[one]).tolist()
    return out


def expected(rows):
    """(key, fingerprint, component) of (key, text) rows; null keys are never named."""
    prints = [plain_print(t) for _, t in rows]
    parts = plain_components(prints)
    least = {}
    for (key, _), part in zip(rows, parts, strict=True):
        known = [k for k in (least.get(part), key) if k is not None]
        least[part] = min(known, default=None)
    return Counter((k, f"{p:016x}", least[c]) for (k, _), p, c in zip(rows, prints, parts, strict=True))


def test_query_equals_brute_force(spark, sf_dir, documents):
    got = Counter(map(tuple, QUERIES["op13_sim_components"](spark, sf_dir).collect()))
    assert got == expected([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()])
    assert len({c for _, _, c in got}) < len(got)


def test_odd_rows(spark, clashing, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in clashing.select("doc_id", "text").collect()]
    assert Counter(map(tuple, sim_hash.sim_classes(clashing).collect())) == expected(rows)
    assert sim_hash.sim_classes(no_rows).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id bigint, text string")
    assert [r["component_id"] for r in sim_hash.sim_classes(nameless).collect()] == [None, None]


@pytest.mark.parametrize("at_once", [7, 1 << 16])
def test_long_texts_are_summed_in_parts(monkeypatch, at_once):
    monkeypatch.setattr(sim_hash, "AT_ONCE", at_once)
    texts = ["A b", "", prose(5, 500), "x", prose(6, 4), "one  two\tthree\x0bfour\nFIVE ÉTÉ x", prose(7, 90)]
    got = sim_hash.fingerprints(pa.array(texts, pa.large_string()))
    assert got.tolist() == [plain_print(t) for t in texts]


@pytest.fixture(scope="module")
def dense():
    """Clusters around centres, chains of four bits, and random fingerprints."""
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(600)]
    for centre in prints[:4]:
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(150)]
    for _ in range(200):
        prints.append(prints[-1] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(3, 6))))
    # Alike in the low bits, so that they crowd one bucket, and far apart elsewhere.
    prints += [(rng.getrandbits(51) << 13) | 5 for _ in range(300)]
    return sorted(set(prints))


@pytest.mark.parametrize(("chunk", "crowd"), [(4096, 256), (64, 256), (9, 256), (4096, 0)])
def test_links_over_chunks_and_finer_blocks(spark, monkeypatch, dense, chunk, crowd):
    monkeypatch.setattr(sim_hash, "CHUNK", chunk)
    monkeypatch.setattr(sim_hash, "CROWD", crowd)
    # More blocks than five make thousands of masks; seven are enough for a test.
    few = sim_hash.block_masks
    monkeypatch.setattr(sim_hash, "block_masks", lambda n: few(n) if crowd else few(1 << 24))
    as_long = [p - (1 << 64) if p >> 63 else p for p in dense]
    nodes = spark.createDataFrame([(p,) for p in as_long], "__print bigint")
    named = sim_hash.labelled(nodes, sim_hash.links(nodes))
    got = {r["__print"]: r["label"] for r in named.collect()}
    want = plain_components(dense)
    classes = {}
    for p, part in zip(as_long, want, strict=True):
        classes.setdefault(part, []).append(p)
    assert got == {p: min(own) for own in classes.values() for p in own}


def test_masks_cover_all_close_pairs():
    rng = random.Random(1)
    for nodes in (0, 10**6, 10**8, 10**10, 10**13):
        masks = sim_hash.block_masks(nodes)
        assert nodes >> min(m.bit_count() for m in masks) <= 2 * sim_hash.CROWD
        for _ in range(200):
            differ = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not m & differ for m in masks)
    for mask in sim_hash.block_masks(0):
        finer = sim_hash.finer_masks(mask)
        assert len(finer) == 5 and all(f & mask == mask and f != mask for f in finer)


def test_stars_of_a_dense_cluster_are_few():
    rng = np.random.default_rng(1)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3000, 2), dtype=np.uint64), axis=1)
    prints = np.unique(np.uint64(1 << 40) ^ flips)
    told = sim_hash.stars(prints)
    assert sum(len(members) for _, members in told) == len(prints) - 1
