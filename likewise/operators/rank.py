"""Ranking scored candidates and cutting the top k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import (COMPAT_SCORE_COLUMN, NAMES_COLUMN, attr, attribute_names, digits_from_mask,
                                 matched_names_from_mask)
from ..plans.session import materialize
from ..plans.sizing import MAX_BROADCAST_ROWS
from .lookup import one_row_per_id
from .score import similarity_score

# Copies of a histogram too large to broadcast.
RANK_SALTS = 64
# Up to this many attributes the histogram is small by itself.
MAX_HISTOGRAM_ATTRIBUTES = 16
SCORE_COLUMNS = ("score", "match_count", "mask")


def rank_candidates(scored: DataFrame, order: str = "fixed", m: int | None = None,
                    score_col: str | None = None) -> DataFrame:
    """Add ``rank`` with the semantics of SQL ``rank()`` over all candidates.

    * ``order='compat'``: ``rank()`` over ``concatealldiffcols`` ascending,
      nulls first, as the original job does; the best candidate has the
      highest rank and both NULL scores share rank 1.
    * ``order='fixed'``: ``rank()`` over ``score`` descending; best is 1.

    ``rank`` is a bigint, in the compat order an int as in the original job.

    A window without a partition key would send every candidate to one task.
    Instead the rank is read from a histogram of the distinct scores: each
    task counts its scores before the shuffle.  ``m`` attributes bound it by
    ``2**m + 1`` rows; up to ``MAX_HISTOGRAM_ATTRIBUTES`` it is numbered at once and
    broadcast.  Otherwise the histogram is sorted by ranges, each range numbers its
    own scores, and the ranges' totals (one row per range) give where each starts.
    It is broadcast back if it is counted to be small, else joined by the score,
    salted: its rows are copied ``RANK_SALTS`` times, so candidates of one score go
    to as many tasks.
    """
    if order not in ("compat", "fixed"):
        raise ValueError("order must be 'compat' or 'fixed'")
    score_col = score_col or (COMPAT_SCORE_COLUMN if order == "compat" else "score")
    key = F.asc_nulls_first("_hs") if order == "compat" else F.desc_nulls_last("_hs")
    hist = scored.groupBy(F.col(score_col).alias("_hs")).agg(F.count(F.lit(1)).alias("_hn"))
    kind = "int" if order == "compat" else "bigint"
    if m is not None and m <= MAX_HISTOGRAM_ATTRIBUTES:
        # At most 2**m + 1 rows, numbered in one small window.
        earlier = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        small = hist.select("_hs", (F.coalesce(F.sum("_hn").over(earlier), F.lit(0)) + 1).cast(kind).alias("rank"))
        return scored.join(F.broadcast(small), scored[score_col].eqNullSafe(small["_hs"])).drop("_hs")
    # Stored, as the ranges must be the same ones for numbers and totals.
    hist = materialize(hist.repartitionByRange(key).sortWithinPartitions(key)
                       .withColumn("_part", F.spark_partition_id()), "rank-histogram")
    first = (Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = hist.groupBy("_part").agg(F.sum("_hn").alias("_total")).select(
        "_part", F.coalesce(F.sum("_total").over(first), F.lit(0)).alias("_start"))
    before = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("_hn").over(before), F.lit(0)) + F.col("_start") + 1
    hist = hist.join(starts, "_part").select("_hs", rank.cast(kind).alias("rank"))
    if hist.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        return scored.join(F.broadcast(hist), scored[score_col].eqNullSafe(hist["_hs"])).drop("_hs")
    hist = hist.select("*", F.explode(F.sequence(F.lit(0), F.lit(RANK_SALTS - 1))).alias("_hsalt"))
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64(*[attr(c) for c in scored.columns]),
                                               F.lit(RANK_SALTS)).cast("int"))
    return salted.join(hist, salted[score_col].eqNullSafe(hist["_hs"])
                       & (salted["_salt"] == hist["_hsalt"])).drop("_hs", "_salt", "_hsalt")


def top_k_similar(flat: DataFrame, sku, k: int = 10, id_col: str = "sku",
                  unique_ids: bool = False) -> DataFrame:
    """The ``k`` items most similar to ``sku``, best first.

    Order is ``score desc, id asc``: more matches first, then the match on the
    earlier attribute name, then the smaller id, so ties are cut the same way
    on every run.  ``orderBy(...).limit(k)`` plans as a per-task top-k whose
    k rows per task are merged once (``TakeOrderedAndProject``); nothing is
    shuffled.  An unknown id raises ``ItemNotFound`` (the look-up is one small
    job); ``k < 0`` raises ``ValueError`` and ``k = 0`` is empty.

    Null ids are no candidates, and of rows with one id the same one counts as
    everywhere (``one_row_per_id``), which costs a shuffle on the id.  For a
    catalog whose ids are known to be unique, ``unique_ids`` saves it.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    if not unique_ids:
        flat = one_row_per_id(flat, id_col)
    scored = similarity_score(flat, sku, id_col)
    return scored.orderBy(F.desc("score"), F.asc(id_col)).limit(k)


def top_k_names(top: DataFrame, id_col: str = "sku") -> DataFrame:
    """Only the ids, in one column named as the original job names it."""
    return top.select(F.col(id_col).alias(NAMES_COLUMN))


def top_k_weights(top: DataFrame, id_col: str = "sku") -> DataFrame:
    """The ids with their weights: ``sku, rank, score, match_count, mask,
    digits, matched``.

    ``digits`` is the original job's digit string (for up to ten attributes)
    and ``matched`` the matched attribute names, comma separated.  ``rank``
    is numbered over the ``k`` rows only.
    """
    names = [c for c in attribute_names(top, id_col) if c not in SCORE_COLUMNS]
    w = Window.orderBy(F.desc("score"), F.asc(id_col))
    return top.select(
        id_col,
        F.row_number().over(w).alias("rank"),
        "score", "match_count", "mask",
        digits_from_mask(F.col("mask"), names).alias("digits"),
        matched_names_from_mask(F.col("mask"), names).alias("matched"))
