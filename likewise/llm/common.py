"""Helpers shared by the operators of this subpackage (``materialize`` comes from
``plans.session``)."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..plans.session import materialize, ship_package  # noqa: F401


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Texts of one Arrow batch, so that long texts don't make a batch large.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def give_back() -> None:
    """Return a worker's unused memory to the system, so that a reused worker does not
    keep what an earlier task or stage needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package shipped to the workers, batches bounded
    in bytes, and a worker's unused memory given back after each task.

    Spark reads the bound when a plan runs, so it is set on the session and stays set."""
    spark = df.sparkSession
    ship_package(spark)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def run_starts(blocks: DataFrame) -> DataFrame:
    """``(part, seq, base)``: the ids before each block of ``(part, seq, n_tokens)``, from the
    totals of the partitions (one row each) and the blocks of its own partition."""
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    return own.join(totals, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))


def utf8_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array and its offsets;
    a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32, len(column) + 1,
                            column.offset * (8 if wide else 4)).astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else \
        np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int):
    """``(first, last)`` row ranges of at most ``limit`` bytes each (one row
    alone may be longer)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
