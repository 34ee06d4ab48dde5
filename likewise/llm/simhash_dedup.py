"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits; two texts are linked when theirs differ in at most
``max_bits``.  The fingerprint is cut into ``max_bits // 2 + 1`` segments, so
few that linked fingerprints differ by at most one bit in at least one of
them (2 bits: two halves).  Every fingerprint is indexed under, for each
segment and each bit of it, the segment with that bit left out: 64 one-wildcard
variants.  Two fingerprints with a segment at most one bit apart share a
variant, so an equality match on the variants finds every link, and the full
64 bits verify it.

Work is on distinct fingerprints, so any number of copies is one row.  Rows
of a variant stream sorted through a task; per variant only a spanning
forest of its links goes on, never all its pairs.  A variant with more than
``max_bucket`` members is not compared pairwise: its members are indexed under
all variants with ``max_bits`` bits left out of the whole fingerprint.
Members of such a variant are linked to each other outright and are at most
``2**max_bits`` different values, so this finds the same links with a fixed
number of rows per member.

Components come from alternating large-star and small-star steps over a
table written to the shared folder after each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import col, map_arrow, materialize

SHINGLE = 3
MAX_BITS = 2
SEED = 42
MAX_BUCKET = 2048
_ALL = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def text_fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text, unsigned: bit ``i`` is 1 if set in over half of
    the XXH64 hashes of its word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest, total, counts, block = xxhash.xxh64_intdigest, 0, np.zeros(64, np.int64), []
    for s in shingles:
        block.append(digest(s, seed))
        if len(block) == 1 << 16:
            total, counts, block = total + len(block), counts + _bit_counts(block), []
    total, counts = total + len(block), counts + _bit_counts(block)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    if not hashes:
        return np.zeros(64, np.int64)
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(id, text_hash, fp)``, one row per input row; ``fp`` as a signed long."""
    source = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("text_hash"),
                         col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [0 if t is None else _signed(text_fingerprint(t.encode(), shingle, seed))
                   for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                ["id", "text_hash", "fp"])

    id_type = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {id_type}, text_hash bigint, fp bigint")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' component over edges (i, j)."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            return root
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up


def _bucket_links(fp: np.ndarray, run: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the verified pairs inside runs of equal variants."""
    at, root = np.arange(len(fp)), np.arange(len(fp))
    step, left = 1, []
    while True:
        at = at[at + step < len(fp)]
        at = at[run[at] == run[at + step]]
        if not len(at):
            break
        # Unsigned, as bits of a negative number are counted by its magnitude.
        near = np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= max_bits
        left.append((at[near], at[near] + step))
        if sum(len(x) for x, _ in left) > 1 << 21:
            root = _forest(len(fp), *(np.concatenate(x) for x in zip(*left)))
            left = [(np.arange(len(fp)), root)]
        step += 1
    if left:
        root = _forest(len(fp), *(np.concatenate(x) for x in zip(*left)))
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def _variant_masks(max_bits: int) -> list[int]:
    """For each of the 64 bits, the mask of its segment without that bit."""
    cuts = np.linspace(0, 64, max_bits // 2 + 2).astype(int)
    masks = []
    for low, high in zip(cuts, cuts[1:]):
        segment = ((1 << int(high)) - 1) ^ ((1 << int(low)) - 1)
        masks += [segment & ~(1 << b) for b in range(int(low), int(high))]
    return masks


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS,
                      max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints (column ``fp``) whose
    transitive closure is that of all pairs at most ``max_bits`` apart."""
    variants = fps.select("fp", F.posexplode(F.array(
        *[col("fp").bitwiseAND(F.lit(_signed(m))) for m in _variant_masks(max_bits)])))
    variants = variants.select(F.col("pos").cast("tinyint").alias("pos"),
                               F.col("col").alias("key"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kept, hot = ["a", "b", "hot"], None, None
        for batch in batches:
            rows = [np.asarray(batch.column(i)) for i in range(3)]
            if kept is not None:
                rows = [np.concatenate(x) for x in zip(kept, rows)]
            pos, key, fp = rows
            if not len(fp):
                continue
            new = np.ones(len(fp), bool)
            new[1:] = (pos[1:] != pos[:-1]) | (key[1:] != key[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(fp)))
            last = starts[-1]
            is_hot = sizes > max_bucket
            if hot == (pos[0], key[0]):
                is_hot[0] = True
            # The last run may go on in the next batch; a hot one need not wait.
            wait = not is_hot[-1]
            hot = None if wait else (pos[-1], key[-1])
            kept = [x[last:] for x in rows] if wait else None
            end = last if wait else len(fp)
            of = np.repeat(np.arange(len(starts)), sizes)[:end]
            flagged = is_hot[of]
            members = fp[:end][flagged]
            if len(members):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(members), pa.array(members),
                     pa.array(np.ones(len(members), bool))], names)
            pick = ~flagged & (sizes[of] > 1)
            a, b = _bucket_links(fp[:end][pick], of[pick], max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.zeros(len(a), bool))], names)
        if kept is not None and len(kept[2]) > 1:
            a, b = _bucket_links(kept[2], np.zeros(len(kept[2]), np.int64), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.zeros(len(a), bool))], names)

    dealt = variants.repartition("pos", "key").sortWithinPartitions("pos", "key", "fp")
    found = materialize(map_arrow(dealt, run, "a bigint, b bigint, hot boolean").distinct(),
                        "simhash-links")
    links = found.filter(~F.col("hot")).select("a", "b")
    hot = found.filter("hot").select(F.col("a").alias("fp"))
    if not hot.isEmpty():
        links = links.unionByName(_hot_links(hot, max_bits)).distinct()
    return links


def _hot_links(hot: DataFrame, max_bits: int) -> DataFrame:
    """Links among the members of over-full variants, by leaving every choice
    of ``max_bits`` bits out of the whole fingerprint."""
    masks = [_signed(_ALL ^ sum(1 << b for b in bits))
             for bits in combinations(range(64), max_bits)]
    rows = hot.select("fp", F.explode(F.lit(masks)).alias("mask"))
    rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    low = F.min("fp").over(Window.partitionBy("mask", "key"))
    return (rows.withColumn("b", low).filter("fp != b")
            .select(F.col("fp").alias("a"), "b").distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected links ``(a, b)``;
    ``root`` is the smallest node reachable."""
    edges = materialize(links.select(F.greatest("a", "b").alias("a"),
                                     F.least("a", "b").alias("b"))
                        .filter("a != b").distinct(), "component-edges")
    state = None
    while True:
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = new
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "component-edges")


def label_components(rows: DataFrame, max_bits: int = MAX_BITS,
                     max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct ``fp`` of ``(id, fp)``
    rows: the component's smallest fingerprint and smallest id."""
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    roots = connected_components(fingerprint_links(nodes.select("fp"), max_bits, max_bucket))
    linked = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        nodes["fp"], "low", F.coalesce("root", nodes["fp"]).alias("root"))
    linked = materialize(linked, "simhash-roots")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    return linked.join(lows, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row per input row.

    Null and word-free texts have the fingerprint of zeros and are linked like
    any other.  A repeated row is returned as often as it occurs.  A null id
    never is a component's smallest id; a component of null ids has a null
    ``component_id``.  An empty table gives no rows.  Other columns are not read.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    labels = label_components(rows, max_bits, max_bucket)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select("id", "fp").join(labels, "fp").select(
        F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                         max_bucket: int = MAX_BUCKET) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: that with the
    smallest id (null ids last; among equal ids the smallest text hash).  All
    columns of ``docs`` are kept as they are."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    labels = label_components(rows, max_bits, max_bucket)
    first = Window.partitionBy("root").orderBy(F.asc_nulls_last("id"), "text_hash")
    kept = (rows.join(labels.select("fp", "root"), "fp")
            .withColumn("n", F.row_number().over(first)).filter("n = 1")
            .select(F.col("id").alias("_keep_id"), F.col("text_hash").alias("_keep_hash")))
    once = Window.partitionBy("_row_id", "_row_hash").orderBy("_row_id")
    out = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_row"),
                      col(id_col).alias("_row_id"), F.xxhash64(col(text_col)).alias("_row_hash"))
    return (out.join(kept, out["_row_id"].eqNullSafe(kept["_keep_id"])
                     & (out["_row_hash"] == kept["_keep_hash"]))
            .withColumn("_n", F.row_number().over(once)).filter("_n = 1").select("_row.*"))


