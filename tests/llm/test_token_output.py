import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from likewise.llm import stretch_encoder, token_output as T
from likewise.llm.stretch_encoder import StretchEncoder, lowercase_stretches

from .helpers import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encode(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, counts = StretchEncoder(PATH).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum(counts)
    return [ids[e - n:e].tolist() for e, n in zip(ends, counts)]


PARTS = list("aZé ñ×÷\n\t.,'s’\"12“  中!|\r\x0b") + ["  ", "\n\n", " 's", "'ll ", "I'm", "<|endoftext|>", "😀", "À.", " Ça,"]


def test_stretches_encode_like_whole_texts():
    rng = random.Random(6)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(5000)]
    assert encode(texts) == plain(texts)


def test_lowercase_stretches_encode_like_whole_texts():
    """A tokenizer that lower-cases, composes and drops white space."""
    rng = random.Random(16)
    path = public_tokenizers.path("word_bpe_49k.json")
    parts = [*PARTS, "\u0301", "J", "I", "K\u030c", "T", "<|ENDOFTEXT|>", "7", "_", "e\u0301", "\u0323\u0307", "Σ", "ΑΣ", "İ", "ß", "\u00a0", "\u2028", "\x1c", "\x85", "ﬁ",
             "<|startoftext|>", "<|endof", "text|>", "\u1100\u1161", "ก็", "½", "Ⅷ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(8000)]
    tokenizer = Tokenizer.from_file(path)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, counts = StretchEncoder(path, lowercase_stretches).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == want


def thue_morse(n, a, b):
    """Texts whose power sums agree with those of the text with both letters swapped."""
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


def test_stretches_are_told_apart_by_their_bytes():
    texts = [thue_morse(n, *pair) for n in (1024, 2048, 4096) for pair in ("ab", "ba", "xy", "yx")]
    assert encode(texts) == plain(texts)


def test_what_an_encoder_knows_is_bounded(monkeypatch):
    monkeypatch.setattr(stretch_encoder, "KNOWN_STRETCHES", 50)
    monkeypatch.setattr(stretch_encoder, "BLOCK_BYTES", 200)
    rng = random.Random(2)
    texts = [" ".join(str(rng.randint(0, 400)) for _ in range(20)) for _ in range(200)] + ["z" * 5000]
    assert encode(texts) == plain(texts)


@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 1), (2, 1), (9, 1), (1000, 1), (5000, 7), (5000, 400)])
def test_grammar_round_trip(n, kinds):
    ids = np.random.default_rng(n).integers(0, kinds, n)
    rules, sequence = T.compress(ids, 500)
    assert (T.expand(sequence, rules.astype(np.int64), 500) == ids).all()
    assert n < 1000 or kinds > 7 or len(sequence) < 0.6 * n


def test_random_access_and_lengths():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 60, 200)
    ids = rng.integers(0, 5, counts.sum())
    shard = T.Shard(T.write_shard(np.arange(200), np.arange(200) == 9, counts, ids, 5))
    ends = np.cumsum(counts)
    for k in range(200):
        assert (shard.document(k) == ids[ends[k] - counts[k]:ends[k]]).all()
    whole = [len(T.expand(np.array([5 + r]), shard.rules, 5)) for r in range(len(shard.rules))]
    assert shard.lengths.tolist() == whole


def check(spark, docs, **options):
    got = [tuple(r) for r in T.token_table(docs, PATH, **options).collect()]
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [np.array(x + [0], "<u4") for x in plain([r[1] or "" for r in rows])]
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == sorted(
        (r[0] is not None, r[0] or 0, len(x), zlib.crc32(x)) for r, x in zip(rows, ids))
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in by_start] == [0, *np.cumsum([r[2] for r in by_start])[:-1].tolist()][:len(by_start)]
    assert [r[0] for r in by_start] == [r[0] for r in rows]


def test_awkward_rows(spark):
    check(spark, awkward(spark))
    check(spark, awkward(spark), shard_bytes=10)


def test_many_shards_in_order(spark):
    docs = spark.range(0, 4000, 1, 7).selectExpr("4000 - id AS doc_id", "concat('text number ', id, ' é.') AS text")
    check(spark, docs, shard_bytes=500)


def test_thue_morse_documents(spark):
    """In one worker, one after the other."""
    texts = [thue_morse(2048, *pair) for pair in ("ab", "ba", "ab", "ba")]
    check(spark, documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]).coalesce(1))


def test_null_and_extreme_ids(spark):
    rows = [(i, f"text {i}", None, None) for i in (-(1 << 63), -(1 << 63) + 1, None, 0, (1 << 63) - 1)]
    check(spark, documents(spark, rows), shard_bytes=8)


def test_empty_table(spark):
    assert T.token_table(documents(spark, []), PATH).count() == 0


def test_added_tokens_encode_like_whole_texts(spark):
    rng = random.Random(7)
    parts = ["<|endoftext|>", "<|endof", "text|>", "<", "|>", "'", "s", " a", "  ", "\n", "é", "中", ".", "\r\n", "ll"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    # A literal that only two neighbouring texts make together is none.
    texts += ["x <|endof", "text|> y", "<|endoftext|>", "", "<|endoftext|><|endoftext|>"]
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(50256 in ids for ids in want) > 500
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, counts = StretchEncoder(PATH).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == want
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in T.token_table(docs, PATH, shard_bytes=4000).collect()}
    assert got == {i: (len(x) + 1, zlib.crc32(np.array(x + [0], "<u4"))) for i, x in enumerate(want)}


def test_grammar_goes_on_to_the_least_count():
    rng = np.random.default_rng(8)
    passage = rng.integers(0, 500, 1000)
    for ids in (np.tile(passage, 1000), rng.integers(0, 60, 200_000), rng.zipf(1.3, 100_000) % 500, np.zeros(5000, int)):
        rules, sequence = T.compress(ids, 500)
        assert (T.expand(sequence, rules.astype(np.int64), 500) == ids).all()
        pairs = sequence[:-1].astype(np.int64) << 32 | sequence[1:]
        assert not len(pairs) or np.unique(pairs, return_counts=True)[1].max() < T.MIN_COUNT
    assert len(T.compress(np.tile(passage, 1000), 500)[1]) < 1_000_000 / 500
