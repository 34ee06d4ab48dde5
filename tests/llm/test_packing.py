"""Packed sequences against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from likewise.llm import packing
from .helpers import awkward, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(spark, docs, length=2048, **options):
    """Every id in one piece, pieces gapless, only the last sequence not full."""
    sequences = packing.pack(docs, PATH, length, **options)
    found = sequences.collect()
    tokenizer = Tokenizer.from_file(PATH)
    runs, total = defaultdict(list), 0
    for s in found:
        ids = np.frombuffer(s.ids, "<u4")
        assert s.n_tokens == sum(p.length for p in s.pieces)
        assert len(ids) == (s.n_tokens if s.n_tokens.bit_count() == 1 else length)
        assert (ids[s.n_tokens:] == 0).all()
        at = 0
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            runs[p.doc_id].append((p.start, p.doc_tokens, ids[at:at + p.length].tobytes()))
            at += p.length
        total += s.n_tokens
    assert sorted(s.sequence_id for s in found) == list(range(-(-total // length)))
    assert all(s.n_tokens == length for s in found if s.sequence_id + 1 < len(found))
    expected = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID]
        expected[r.doc_id].append(np.array(ids, "<u4").tobytes())
    assert set(runs) == set(expected)
    for doc, texts in expected.items():
        # Pieces of one id's documents joined are its documents' ids.
        assert sum(len(x[2]) for x in runs[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            parts = sorted(runs[doc])
            assert b"".join(x[2] for x in parts) == texts[0]
            assert [x[0] for x in parts] == list(np.cumsum([0, *[len(x[2]) // 4 for x in parts]])[:-1])
            assert all(x[1] == len(texts[0]) // 4 for x in parts)
    crc = {(r.sequence_id, r.offset): r.ids_crc32 for r in packing.pieces(sequences).collect()}
    for s in found:
        for p in s.pieces:
            assert crc[s.sequence_id, p.offset] == zlib.crc32(s.ids[4 * p.offset:4 * (p.offset + p.length)])
    return found


@pytest.mark.parametrize("length, chunk", [(2048, 2 << 20), (64, 300), (7, 40), (1, 50)])
def test_awkward_documents(spark, length, chunk):
    check(spark, awkward(spark).repartition(4), length, chunk_bytes=chunk)


def test_sequences_over_many_small_chunks(spark):
    """One sequence made of many partitions' boundary records."""
    docs = documents(spark, [(i, f"word number {i}", "en", "s") for i in range(200)]).repartition(40)
    found = check(spark, docs, 512, chunk_bytes=20)
    assert max(len(s.pieces) for s in found) > 40


def test_power_of_two_is_not_padded(spark):
    rows = check(spark, documents(spark, [(i, "", "en", "s") for i in range(8)]))
    assert [(r.n_tokens, len(r.ids)) for r in rows] == [(8, 32)]


def test_special_literals_and_width(spark):
    texts = ["<|endoftext|> a<|startoftext|>b", "ÀÉ ﬁ ½ Ⅷ 東京 😀 ’s don't", "a" * 5000, "x\u0000y\r\n\tz"]
    check(spark, documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), 16, chunk_bytes=64)


def test_empty(spark):
    assert check(spark, documents(spark, [])) == []


def test_cut_of_a_chunk():
    found = packing.cut(5, ["a", "b"], np.array([4, 9]), 8)
    assert [(s, o, x, y) for s, o, x, y, _ in found] == [(0, 5, 0, 3), (1, 0, 3, 11), (2, 0, 11, 13)]
    assert [(p["doc_id"], p["start"], p["length"], p["offset"]) for *_, ps in found for p in ps] == [
        ("a", 0, 3, 5), ("a", 3, 1, 0), ("b", 0, 7, 1), ("b", 7, 2, 0)]
