"""Equality joins with keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is hot with more than one part in HOT_FACTOR of a partition's even share.
HOT_FACTOR = 4


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_counted(rows: DataFrame, counted: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined to ``counted``, which has one row per ``key``.

    ``size`` is a column of ``counted``: at least the rows of the key in ``rows``; the
    sizes add up to ``total`` or less.  So at most ``HOT_FACTOR * partitions`` keys are hot,
    which bounds what is broadcast; the rows of the other keys are shuffled, and none of
    those keys fills a task.
    """
    at_most = total / (HOT_FACTOR * partitions(rows))
    hot = F.broadcast(counted.filter(F.col(size) > at_most))
    cold = counted.filter(F.col(size) <= at_most)
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key))
