"""Token blocks and the BPE codec against the tokenizer library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidegauge.llm import token_output
from tidegauge.llm.bpe import RankArrayBPE, bpe_code, bpe_digest
from tidegauge.llm.queries import word_bpe
from tidegauge.llm.range_coder import decode_block, encode_block
from tidegauge.llm.token_output import crc_after, read_digests, read_ids, write_tokens

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(word_bpe())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def same_rows(left, right):
    def order(row):
        return [(v is None, v) for v in row]

    assert sorted(left, key=order) == sorted(right, key=order)


@pytest.mark.parametrize("table", ["awkward", "clashing", "documents"])
def test_codec_equals_library(request, library, table):
    docs = request.getfixturevalue(table)
    expected = []
    for row in docs.collect():
        ids = ids_of(library, row["text"])
        decoded = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        digests = (hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        expected.append((row["doc_id"], len(ids), *digests))
    same_rows([tuple(r) for r in bpe_digest(docs, word_bpe()).collect()], expected)


def test_codec_returns_ids_and_text(awkward, library):
    for row in bpe_code(awkward, word_bpe()).collect():
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["n_tokens"]
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_heap_and_scan_merge_alike():
    bpe = RankArrayBPE(word_bpe())
    for word in ("internationalisation", "aaaaaaaa", "thththththere", "x"):
        spelled = np.frombuffer(word.encode(), np.uint8)
        start = bpe.first[spelled].tolist()
        start[-1] = int(bpe.last[spelled[-1]])
        assert bpe.merge_long(start) == bpe.encode(word)


def test_coder_needs_fewer_bits_than_order_0(library):
    """A block of real texts against the entropy of its own id frequencies."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id")
    found, held = [], 0
    for batch in texts.to_batches(500):
        for coded in library.encode_batch([t or "" for t in batch["text"].to_pylist()], add_special_tokens=False):
            found.append(np.array([*coded.ids, 2]))
            held += len(found[-1])
        if held >= token_output.BLOCK_IDS:
            break
    ids = np.concatenate(found)[: token_output.BLOCK_IDS]
    shares = np.bincount(ids)[np.unique(ids)] / len(ids)
    block = encode_block(ids)
    assert (decode_block(block) == ids).all()
    assert 8 * len(block) < -(shares * np.log2(shares)).sum() * len(ids)


def test_coder_of_ids_far_apart():
    ids = np.array([1_000_000, 5, 1_000_000, 0, 999_999] * 300, dtype=np.uint32)
    block = encode_block(ids)
    assert (decode_block(block) == ids).all()
    for at in (9, 25, 30, len(block) - 1):
        broken = block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :]
        with pytest.raises(ValueError, match="checksum"):
            decode_block(broken)


@pytest.mark.parametrize("count", [1, 2, 255, 256, 1000, 70_000])
@pytest.mark.parametrize("kind", ["any", "one", "few", "last"])
def test_coder_round_trip(count, kind):
    rng = np.random.default_rng(count)
    ids = {
        "any": rng.integers(0, 49_408, count), "one": np.zeros(count, int),
        "few": rng.integers(0, 3, count), "last": np.full(count, 49_407),
    }[kind]
    block = encode_block(ids)
    assert (decode_block(block) == ids).all()
    if kind == "one" and count > 50_000:
        assert len(block) < count / 4


def test_damaged_blocks_are_found():
    block = bytearray(encode_block(np.arange(1000)))
    block[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        decode_block(bytes(block))
    with pytest.raises(ValueError, match="not a block"):
        decode_block(b"nothing")


def test_checksums_join():
    a, b, c = b"some", b"bytes and", b"more"
    parts = crc_after(zlib.crc32(a), len(b + c)) ^ crc_after(zlib.crc32(b), len(c)) ^ zlib.crc32(c)
    assert parts == zlib.crc32(a + b + c)


def expected_digests(rows, library):
    out, start = [], 0
    for key, text in rows:
        ids = [*ids_of(library, text), 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_blocks_equal_library(spark, documents, library):
    rows = [(r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").collect()]
    got = read_digests(spark, write_tokens(documents, word_bpe()))
    assert [tuple(r) for r in got.orderBy("key").collect()] == expected_digests(rows, library)


def test_long_documents_are_cut(spark, awkward, library, monkeypatch):
    monkeypatch.setattr(token_output, "CUT_IDS", 700)
    monkeypatch.setattr(token_output, "BLOCK_IDS", 300)
    docs = awkward.filter("doc_id <> 6")
    path = write_tokens(docs.repartition(1), word_bpe())
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    got = read_digests(spark, path).orderBy("key").collect()
    assert [tuple(r) for r in got] == expected_digests(rows, library)
    parts = [r for r in read_ids(spark, path).orderBy("ids_ahead").collect() if r["key"] == 5]
    assert [i for r in parts for i in r["ids"]] == [*ids_of(library, dict(rows)[5]), 2]


def test_repeated_and_null_keys(spark, clashing, library):
    got = read_digests(spark, write_tokens(clashing, word_bpe())).orderBy("start").collect()
    assert got[0]["key"] is None and got[0]["start"] == 0
    assert [r["key"] for r in got].count(6) == 3
    assert sum(r["n_tokens"] for r in got) == got[-1]["start"] + got[-1]["n_tokens"]


def test_empty_table(spark, no_rows):
    assert bpe_digest(no_rows, word_bpe()).count() == 0
    assert read_digests(spark, write_tokens(no_rows, word_bpe())).count() == 0


def test_blocks_are_written_as_before_and_without_the_reader_s_tables(monkeypatch):
    """The table of slots, 2^20 entries a refresh, is the decoder's alone."""
    ids = (np.arange(30_001, dtype=np.int64) ** 2 % 977 * (1 + np.arange(30_001) // 20_000)).astype(np.uint32)
    with monkeypatch.context() as patched:
        patched.setattr("tidegauge.llm.range_coder.Model.slots", None)
        block = encode_block(ids)
    assert hashlib.sha256(block).hexdigest() == "916d77e432aacde936fe4c1d0286cdde0add2c115e14d2ae6ff8d03e2a6e6b7e"
    assert (decode_block(block) == ids).all()


def test_plain_pieces_need_no_rules_of_the_library(library):
    """All letters of Latin-1 and all marks that are cut ahead of the library."""
    encoder = token_output.library_encoder(word_bpe())
    assert token_output.library_encoder(word_bpe()) is encoder
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<"]
    words = letters + marks + [f"{a}{b}" for a in letters for b in "eZé.,"] + [a + b for a in marks for b in marks]
    words += [w + m for w in ("straße", "ÉTÉ", "A") for m in marks]
    coded = encoder.encode_words(token_output.pa.array([w.encode() for w in words], token_output.pa.large_binary()))
    rows = [coded.values[i:j].tolist() for i, j in zip(coded.ends, coded.ends[1:], strict=False)]
    assert rows == [ids_of(library, w) for w in words]
