"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

Code.  A vector ``x`` is turned by ``ROTATIONS`` random rotations and only the
signs are kept, one bit per turned component.  With signs ``c`` as -1 and 1 the
code stands for ``u``, the sum of the rotations back of ``c``; stored beside it are
the norms of ``x`` and ``u`` and the alignment ``cos(x, u)``.

Estimate.  For an anchor ``q`` the product ``<q, u>`` is the sum of the turned
components of ``q`` times ``c``.  They are rounded to ``QUERY_BITS`` bits, so the sum
is popcounts of the code and the bit planes of ``q``; what rounding may lose is at
most the sum of the rounding errors' magnitudes.

Interval.  ``x = |x| (cos v + sin e)`` with ``v = u / |u|`` and a unit vector ``e``
across ``v``, and by Cauchy-Schwarz ``|<q, e>| <= sqrt(|q|**2 - <q, v>**2)``.  So
``<q, x>`` lies in an interval, always and not just likely.  What an interval rules
out is dropped; the rest is scored with integers.  The result is exact.

All rows meet the anchors in blocks: a grid of row blocks and anchor blocks, both of
bounded size, is dealt out by a hash of the two block numbers.  Rows never meet
rows, and labels deal out nothing, so a hot label is no hot task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, map_arrow, materialize
from ..plans.session import ship_package

ROTATIONS = 8
QUERY_BITS = 6
SEED = 11
ROW_BLOCK = 16384
ANCHOR_BLOCK = 4096
# Pairs of one pass over popcounts, so that they stay in the processor's cache.
TILE_ROWS, TILE_ANCHORS = 4096, 16
# Floating-point slack of an interval, as a share of both norms.
SLACK = 1e-9
# Every score is below this by Cauchy-Schwarz, and every component an int.
MAX_SQUARED_NORM = float(1 << 62)

CODED = "id bigint, label bigint, dim int, vector array<int>, code binary, norm double, code_norm double, align double"
_rotations: dict[int, np.ndarray] = {}


def rotations(dim: int) -> np.ndarray:
    """``ROTATIONS * dim`` rows: seeded random rotations one below the other."""
    if dim not in _rotations:
        draw = np.random.default_rng([SEED, dim])
        _rotations[dim] = np.concatenate([
            np.linalg.qr(draw.standard_normal((dim, dim)))[0] for _ in range(ROTATIONS)]) \
            if dim else np.zeros((0, 0))
    return _rotations[dim]


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, filled up with zeros."""
    words = -(-bits.shape[1] // 64)
    wide = np.zeros((len(bits), 64 * words), np.uint8)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64).reshape(len(bits), words)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, norm, code_norm, align)`` of the rows of a matrix."""
    turn = rotations(vectors.shape[1])
    signs = vectors @ turn.T >= 0
    u = (2.0 * signs - 1.0) @ turn
    norm, code_norm = np.linalg.norm(vectors, axis=1), np.linalg.norm(u, axis=1)
    scale = norm * code_norm
    align = np.divide((vectors * u).sum(axis=1), scale, out=np.zeros(len(scale)), where=scale > 0)
    return pack_bits(signs), norm, code_norm, np.clip(align, -1.0, 1.0)


def planes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors for popcounts: ``(planes, scale, lost)``.  A turned component is about
    ``low + step * t``; ``planes[:, j]`` has bit ``j`` of every ``t``, ``scale`` is ``low``,
    ``step`` and the sum of ``t``, and ``lost`` the sum of all rounding errors' magnitudes."""
    turned = vectors @ rotations(vectors.shape[1]).T
    low = turned.min(axis=1, initial=0.0)
    step = (turned.max(axis=1, initial=0.0) - low) / ((1 << QUERY_BITS) - 1)
    safe = np.where(step > 0, step, 1.0)
    t = np.clip(np.rint((turned - low[:, None]) / safe[:, None]), 0, (1 << QUERY_BITS) - 1)
    lost = np.abs(turned - (low[:, None] + step[:, None] * t)).sum(axis=1)
    t = t.astype(np.uint8)
    bits = [pack_bits(t >> j & 1) for j in range(QUERY_BITS)]
    return np.stack(bits, axis=1), np.stack([low, step, t.sum(axis=1, dtype=np.float64)]), lost


def products(codes: np.ndarray, plane: np.ndarray, scale: np.ndarray, width: int) -> np.ndarray:
    """Estimates of ``<q, u>`` for all anchors (rows) and codes (columns) by popcounts."""
    low, step, total = scale
    out = np.empty((len(plane), len(codes)))
    for a in range(0, len(plane), TILE_ANCHORS):
        p = plane[a:a + TILE_ANCHORS]
        for b in range(0, len(codes), TILE_ROWS):
            c = codes[b:b + TILE_ROWS]
            sums = np.zeros((len(p), len(c)), np.int32)
            for j in range(QUERY_BITS):
                ones = np.zeros((len(p), len(c)), np.uint16)
                for w in range(codes.shape[1]):
                    ones += np.bitwise_count(p[:, j, w, None] & c[None, :, w])
                sums += ones.astype(np.int32) << j
            out[a:a + TILE_ANCHORS, b:b + TILE_ROWS] = sums
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.float64)
    # Components times 2 * bit - 1.
    return 2 * step[:, None] * out + 2 * low[:, None] * ones[None, :] - (low * width + step * total)[:, None]


def intervals(anchors: np.ndarray, rows: dict) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of all anchors (rows) and rows (columns)."""
    vectors = anchors.astype(np.float64)
    plane, scale, lost = planes(vectors)
    width = ROTATIONS * vectors.shape[1]
    estimate = products(rows["codes"], plane, scale, width)
    q = np.linalg.norm(vectors, axis=1)[:, None]
    code_norm = np.where(rows["code_norm"] > 0, rows["code_norm"], 1.0)
    # <q, v> is within ``off`` of ``on``.
    on, off = estimate / code_norm, lost[:, None] / code_norm
    on, off = np.clip(on, -q, q), off + SLACK * q
    nearest = np.maximum(np.abs(on) - off, 0.0)
    across = np.sqrt(np.maximum(q * q - nearest * nearest, 0.0))
    align = rows["align"]
    half = np.abs(align) * off + np.sqrt(1.0 - align * align) * across + SLACK * q
    return rows["norm"] * (align * on - half) - 1, rows["norm"] * (align * on + half) + 1


def _columns(table: pa.Table) -> dict:
    """A block's Arrow table as arrays."""
    n = table.num_rows
    flat = pc.list_flatten(table.column("vector")).to_numpy()
    dim = table.column("dim")[0].as_py() if n else 0
    codes = b"".join(table.column("code").to_pylist())
    out = {c: table.column(c).to_numpy() for c in ("id", "label", "norm", "code_norm", "align")}
    return out | {"vectors": flat.reshape(n, dim).astype(np.int64),
                  "codes": np.frombuffer(codes, np.uint64).reshape(n, -1) if codes else np.zeros((n, 0), np.uint64)}


def bounds(anchors: dict, rows: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(place, lower, upper)`` of each anchor: its bounds to all rows.  Few anchors are
    taken at a time, so that their matrices stay small."""
    for first in range(0, len(anchors["id"]), TILE_ANCHORS):
        low, high = intervals(anchors["vectors"][first:first + TILE_ANCHORS], rows)
        for i in range(len(low)):
            yield first + i, low[i], high[i]


def _nth_largest(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first by score descending, then id."""
    return np.lexsort((ids, -scores))[:n]


def _positives(anchors: dict, rows: dict, n: int) -> pa.Table:
    """The block's first ``n`` rows of each anchor's label."""
    found = []
    for a, low, high in bounds(anchors, rows):
        own = anchors["id"][a]
        same = np.flatnonzero((rows["label"] == anchors["label"][a]) & (rows["id"] != own))
        same = same[high[same] >= _nth_largest(low[same], n)]
        scores = rows["vectors"][same] @ anchors["vectors"][a]
        best = _first(rows["id"][same], scores, n)
        found.append((np.full(len(best), own), rows["id"][same[best]], scores[best]))
    ids, others, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)) \
        if found else (np.zeros(0, np.int64),) * 3
    return pa.table({"anchor_id": ids, "positive_id": others, "positive_score": scores})


def _negatives(anchors: dict, wanted: list[list[dict]], rows: dict, n: int, share: tuple[int, int, int]) -> pa.Table:
    """The block's first ``n`` rows of other labels in the window of each positive."""
    found = []
    for a, low, high in bounds(anchors, rows):
        own, other = anchors["id"][a], rows["label"] != anchors["label"][a]
        for positive in wanted[a]:
            score = positive["positive_score"]
            # least * score <= whole * x <= most * score, for integers x.
            least, most = -(-share[0] * score // share[2]), share[1] * score // share[2]
            can = np.flatnonzero(other & (low <= most) & (high >= least))
            sure = low[can][(low[can] >= least) & (high[can] <= most)]
            can = can[high[can] >= _nth_largest(sure, n)]
            scores = rows["vectors"][can] @ anchors["vectors"][a]
            inside = (scores >= least) & (scores <= most)
            can, scores = can[inside], scores[inside]
            best = _first(rows["id"][can], scores, n)
            found += [(own, positive["positive_id"], score, x, s)
                      for x, s in zip(rows["id"][can[best]], scores[best])]
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pa.table([pa.array([f[i] for f in found], pa.int64()) for i in range(5)], names)


def encode_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (``id, label, vector array<double>`` of whole numbers) with their codes.
    Rows with a null, or a vector with a null, a non-finite component or a squared norm
    of 2**62 or more, are left out; of rows with one id the least by label and vector
    counts."""
    ok = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MAX_SQUARED_NORM ** 0.5))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(ok)
    rows = rows.filter(squares < MAX_SQUARED_NORM)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select(
        "id", "r.label", F.col("r.vector").cast("array<int>").alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                some = batch.take(pa.array(at))
                flat = some.column(2).flatten().to_numpy(zero_copy_only=False)
                codes, norm, code_norm, align = encode(flat.reshape(len(at), dim).astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(np.full(len(at), dim, np.int32)), some.column(2),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(code_norm),
                     pa.array(align)],
                    ["id", "label", "dim", "vector", "code", "norm", "code_norm", "align"])

    return map_arrow(rows, run, CODED)


def _in_blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int):
    """Both sides on the grid of row blocks ``r`` and anchor blocks ``a``."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    row_blocks = max(-(-n_rows // ROW_BLOCK), min(2 * tasks, n_rows), 1)
    anchor_blocks = max(-(-n_anchors // ANCHOR_BLOCK), 1)

    def block(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.select("*", block(1, row_blocks).alias("r"), all_of(anchor_blocks).alias("a"))
    anchors = anchors.select("*", block(2, anchor_blocks).alias("a"), all_of(row_blocks).alias("r"))
    return rows.groupBy("r", "a", "dim"), anchors.groupBy("r", "a", "dim")


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3,
         share: tuple[int, int, int] = (50, 95, 100)) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has ``id, label, vector`` with whole numbers as components; ``is_anchor`` is a
    condition on ``id``.  An anchor's positives are its first ``n_positives`` other rows
    of its label, all if there are fewer; its negatives for a positive the first
    ``n_negatives`` rows of other labels with
    ``share[0] * positive <= share[2] * score <= share[1] * positive``.  Scores are integer
    products, higher ones come first, ties by id.

    Which rows take no part, and which of repeated ids counts, is told in ``encode_rows``.
    Vectors of different lengths are never compared; empty vectors score 0.  Without
    rows or anchors the result is empty.  Other columns are not read.
    """
    spark = rows.sparkSession
    coded = materialize(encode_rows(rows.select("id", "label", "vector")), "negatives-codes")
    anchors = coded.filter(is_anchor)
    n_rows, n_anchors = coded.count(), anchors.count()
    ship_package(spark)

    def positives(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            right = right.slice(0, 0)
        return _positives(_columns(right), _columns(left), n_positives)

    left, right = _in_blocks(coded, anchors, n_rows, n_anchors)
    first = left.cogroup(right).applyInArrow(
        positives, "anchor_id bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = first.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n_positives)
    # At most ``n_positives`` of an anchor.
    wanted = first.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("wanted"))
    asking = materialize(anchors.join(wanted, "id"), "negatives-anchors")

    def negatives(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            right = right.slice(0, 0)
        return _negatives(_columns(right), right.column("wanted").to_pylist(), _columns(left), n_negatives, share)

    left, right = _in_blocks(coded, asking, n_rows, n_anchors)
    found = left.cogroup(right).applyInArrow(
        negatives, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                        "positive_score", "negative_score")


def mine_sql() -> str:
    """DuckDB SQL for the query over ``embeddings``."""
    return """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""
