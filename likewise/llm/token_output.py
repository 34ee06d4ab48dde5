"""Token ids as grammar-compressed binary shards (Re-Pair).

Documents are range-partitioned by id, so the partitions hold ascending ids.
A task encodes whole texts and packs runs of documents into shards.  In each
shard the most frequent pairs of neighbouring symbols are repeatedly replaced
by new symbols (nonterminals) until no pair is seen ``MIN_COUNT`` times; the shard holds the rules, the shortened
sequence, every rule's expansion length and each document's token count.  With
those lengths a document's tokens are found and decoded without expanding the
rest of the shard.

Whole texts are encoded by their distinct stretches (``stretch_encoder``), exactly as
a plain encode does.

File format: a Parquet table, one row per shard, in ascending document order:
``part, seq, n_docs, n_tokens, payload``.  ``payload`` is little-endian:

    8 bytes   b"GRAMMAR2"
    5 x u32   documents, tokens, terminals (first nonterminal id), rules, symbols
    i64 x d   document ids (null: 0)
    u8  x d   1 where the document id is null
    u32 x d   tokens of each document
    u32 x 2r  rules, as pairs of symbols
    u32 x r   expansion length of each rule
    u32 x s   the sequence of symbols
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.session import shared_path
from ..plans.sizing import broadcast_if_small
from .common import col, map_arrow, row_blocks, run_starts, utf8_bytes
from .stretch_encoder import shared_encoder

MAGIC = b"GRAMMAR2"
END_ID = 0
SHARD_BYTES = 6 << 20
RULES_PER_ROUND = 8192
MIN_COUNT = 16
_PAIR_BITS = 21
def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int = END_ID) -> np.ndarray:
    """``ids`` with ``end_id`` after each document."""
    return np.insert(ids, np.cumsum(counts), end_id)


# --------------------------------------------------------------------------
# Re-Pair
# --------------------------------------------------------------------------

def _buckets(left: np.ndarray, right: np.ndarray, turn: int) -> np.ndarray:
    """A hash of every pair, another one each turn."""
    mixed = left.view(np.uint32) * np.uint32(0x9E3779B1 + 2 * turn & 0xFFFFFFFF)
    mixed ^= mixed >> np.uint32(15)
    mixed += right.view(np.uint32) * np.uint32(0x85EBCA6B + 4 * turn & 0xFFFFFFFF)
    mixed *= np.uint32(0x2C1B3C6D)
    mixed >>= np.uint32(32 - _PAIR_BITS)
    return mixed


def _counted(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(held left, held right, bucket, counts)`` of the pairs at ``at``, one by one."""
    pair = left[at].astype(np.int64) << 32 | right[at]
    held, bucket, counts = np.unique(pair, return_inverse=True, return_counts=True)
    return (held >> 32).astype(np.int32), (held & 0xFFFFFFFF).astype(np.int32), bucket, counts


def compress(ids: np.ndarray, terminals: int, rounds: int | None = None,
             rules_per_round: int = RULES_PER_ROUND,
             min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """``(rules, sequence)``: each round gives the ``rules_per_round`` most frequent
    pairs (seen at least ``min_count`` times) nonterminals and replaces them from
    left to right.  It goes on until no pair is seen that often, or for ``rounds``."""
    sequence = ids.astype(np.int32)
    rules: list[np.ndarray] = []
    symbols, fresh = terminals, None
    for r in count() if rounds is None else range(rounds):
        if len(sequence) < 2:
            break
        left, right = sequence[:-1], sequence[1:]
        if fresh is not None:
            # All pairs seen often are replaced: only new symbols can make others.
            new = sequence >= fresh
            at = np.flatnonzero(new[:-1] | new[1:])
            held_left, held_right, bucket, counts = _counted(left, right, at)
            often = np.flatnonzero(counts >= min_count)
            if not len(often):
                fresh = None
        if fresh is None:
            # Pairs are counted by a hash; of pairs that meet in a bucket one is
            # counted, so a rare miss is made up for later.
            bucket = _buckets(left, right, r)
            full = np.bincount(bucket, minlength=1 << _PAIR_BITS) >= min_count
            everywhere = np.flatnonzero(full[bucket])
            bucket, own_left, own_right = bucket[everywhere], left[everywhere], right[everywhere]
            held_left, held_right = np.zeros((2, 1 << _PAIR_BITS), np.int32)
            held_left[bucket], held_right[bucket] = own_left, own_right
            same = (held_left[bucket] == own_left) & (held_right[bucket] == own_right)
            at, bucket = everywhere[same], bucket[same]
            counts = np.bincount(bucket, minlength=1 << _PAIR_BITS)
            often = np.flatnonzero(counts >= min_count)
            if not len(often):
                # What is left is counted one by one, so that no miss ends it early.
                at = everywhere
                held_left, held_right, bucket, counts = _counted(left, right, at)
                often = np.flatnonzero(counts >= min_count)
                if not len(often):
                    break
        fresh = symbols if len(often) <= rules_per_round else None
        often = often[np.lexsort((held_right[often], held_left[often], -counts[often]))][:rules_per_round]
        symbol_of = np.full(len(counts), -1, np.int32)
        symbol_of[often] = symbols + np.arange(len(often))
        given = symbol_of[bucket]
        at, given = at[given >= 0], given[given >= 0]
        # In a run of overlapping pairs every second one is replaced.
        head = np.ones(len(at), bool)
        head[1:] = at[1:] != at[:-1] + 1
        run = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run) % 2 == 0
        at, given = at[take], given[take]
        rules.append(np.stack([held_left[often], held_right[often]], axis=1))
        sequence[at] = given
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence = sequence[keep]
        symbols += len(often)
    joined = np.concatenate(rules) if rules else np.zeros((0, 2), np.int32)
    return joined.astype("<u4"), sequence.astype("<u4")


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Tokens of each rule; a rule only uses terminals and earlier rules."""
    lengths = np.zeros(len(rules), np.int64)
    sides = rules.astype(np.int64) - terminals
    todo = np.arange(len(rules))
    while len(todo):
        part = sides[todo]
        sizes = np.where(part < 0, 1, lengths[np.maximum(part, 0)])
        done = (sizes > 0).all(axis=1)
        lengths[todo[done]] = sizes[done].sum(axis=1)
        todo = todo[~done]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The tokens of a sequence of symbols; every pass puts the terminals in their
    places and opens the nonterminals."""
    symbols, rules = symbols.astype(np.int32), rules.astype(np.int32)
    lengths = np.append(expansion_lengths(rules, terminals), 1)

    def sizes(of: np.ndarray) -> np.ndarray:
        return lengths[np.where(of >= terminals, of - terminals, -1)]

    ends = np.cumsum(sizes(symbols))
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    place = ends - sizes(symbols)
    while len(symbols):
        opened = symbols >= terminals
        out[place[~opened]] = symbols[~opened]
        left, right = rules[symbols[opened] - terminals].T
        place = place[opened]
        symbols, place = np.concatenate([left, right]), np.concatenate([place, place + sizes(left)])
    return out


def write_shard(doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray,
                terminals: int, rounds: int | None = None) -> bytes:
    rules, sequence = compress(ids, terminals, rounds)
    lengths = expansion_lengths(rules, terminals)
    return b"".join([
        MAGIC, struct.pack("<5I", len(doc_ids), len(ids), terminals, len(rules), len(sequence)),
        doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), counts.astype("<u4").tobytes(), rules.tobytes(),
        lengths.astype("<u4").tobytes(), sequence.tobytes()])


class Shard:
    """A shard read back; documents are decoded one by one or all together."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a grammar shard")
        docs, self.n_tokens, self.terminals, n_rules, n_symbols = struct.unpack_from("<5I", payload, 8)
        at = 28

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(payload, kind, n, at)
            at += part.nbytes
            return part

        self.doc_ids, self.nulls = take("<i8", docs), take("u1", docs).astype(bool)
        self.counts = take("<u4", docs).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths, self.sequence = take("<u4", n_rules).astype(np.int64), take("<u4", n_symbols)
        self.starts = np.cumsum(self.counts) - self.counts

    def tokens(self) -> np.ndarray:
        return expand(self.sequence, self.rules, self.terminals)

    def document(self, k: int) -> np.ndarray:
        """Tokens of the ``k``-th document, from the symbols that cover it."""
        symbols = self.sequence.astype(np.int64)
        size = np.ones(len(symbols), np.int64)
        opened = symbols >= self.terminals
        size[opened] = self.lengths[symbols[opened] - self.terminals]
        ends = np.cumsum(size)
        low, high = int(self.starts[k]), int(self.starts[k] + self.counts[k])
        if low == high:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(ends, low, side="right"))
        last = int(np.searchsorted(ends, high, side="left"))
        before = int(ends[first] - size[first])
        return expand(self.sequence[first:last + 1], self.rules,
                      self.terminals)[low - before:high - before]


# --------------------------------------------------------------------------
# Tables
# --------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
                 rounds: int | None = None) -> str:
    """Encode ``docs`` into grammar shards at ``path`` in ascending id order.

    A null text is an empty one (its end id is still written); null ids come
    first; rows with one id follow each other in order of a hash of their text,
    repeated rows one after the other.  An empty table writes no shard.  Other
    columns are not read.
    """
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # The range bounds come from a sample of the keys; the texts move once.
    rows = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
    rows = rows.select("id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = None, 0
        for batch in batches:
            encoder = encoder or shared_encoder(tokenizer_path)
            ids, nulls = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(False)
            data, offsets = utf8_bytes(batch.column(1))
            for low, high in row_blocks(offsets, shard_bytes):
                tokens, counts = encoder.encode(data[offsets[low]:offsets[high]],
                                                offsets[low:high + 1] - offsets[low])
                tokens = with_end(tokens, counts, end_id)
                payload = write_shard(ids[low:high], nulls[low:high], counts + 1, tokens, encoder.terminals, rounds)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([batch.column(2)[0].as_py()], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "n_docs": pa.array([high - low], pa.int64()),
                    "n_tokens": pa.array([len(tokens)], pa.int64()),
                    "payload": pa.array([payload], pa.binary())})
                seq += 1

    shards = map_arrow(rows, run, "part int, seq int, n_docs bigint, n_tokens bigint, payload binary")
    shards.write.parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the
    shards at ``path``: ``start`` counts the ids of all documents before it."""
    shards = spark.read.parquet(path)
    # One small row per shard, payloads not read.
    starts = broadcast_if_small(run_starts(shards.select("part", "seq", "n_tokens")))
    rows = shards.select("part", "seq", "payload").join(starts, ["part", "seq"]).select("base", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(payload.as_py())
                tokens = shard.tokens().astype("<u4")
                sums = [zlib.crc32(tokens[s:s + n]) for s, n in zip(shard.starts, shard.counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, mask=shard.nulls),
                     pa.array(shard.starts + base), pa.array(shard.counts),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(rows, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_table(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` as shards below the shared folder and read them back."""
    path = shared_path(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, write_tokens(docs, path, tokenizer_path, **options))
