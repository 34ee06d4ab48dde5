"""Numbering rows of groups without sending a group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .session import materialize
from .sizing import broadcast_if_small


def numbered(rows: DataFrame, group: str, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 in ``order`` within ``group`` (not null), and
    ``n``, the rows of the group.

    Rows are range-partitioned by ``group`` and ``keys``; the sizes of the ranges (one row per
    group and range) give where each range's rows start.  ``keys`` sort as ``order`` does, as
    far as they go, and should tell equal rows apart, so that they can be split; rows
    with equal keys are in one range.
    """
    # Stored, as sizes and places must come from the same ranges.
    ranged = materialize(rows.repartitionByRange(group, *keys).sortWithinPartitions(group, *order)
                         .withColumn("part", F.spark_partition_id()), "numbered-ranges")
    sizes = ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy(group)).alias("n"))
    place = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    return (ranged.withColumn("place", place).join(broadcast_if_small(starts), [group, "part"])
            .withColumn("idx", F.col("before") + F.col("place")).drop("part", "place", "before"))
