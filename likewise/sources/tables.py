"""Appending to a table and counting it.

``append_rows`` appends whatever it is given.  ``append_once`` takes a batch id and appends a
batch at most once, however often it is replayed: the rows go to a folder of the batch,
and a commit manifest below ``_commits`` says which batches are there.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException


def append_rows(df: DataFrame, table_path: str) -> None:
    """Append ``df`` to the parquet table at ``table_path`` (created if absent).

    Each append writes new files with a job commit, so a failed or retried
    task never leaves a partial file visible to readers.
    """
    df.write.mode("append").parquet(table_path)


def table_rows(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.parquet(table_path)


def append_and_count(df: DataFrame, table_path: str) -> int:
    """Append ``df`` to the table and return the table's row count."""
    append_rows(df, table_path)
    return table_rows(df.sparkSession, table_path).count()


COMMITS = "batch string, rows bigint"


def commits(spark: SparkSession, table_path: str) -> DataFrame:
    """``(batch, rows)`` of the batches in the table; none for a table not there yet."""
    try:
        found = spark.read.schema(COMMITS).parquet(f"{table_path}/_commits")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], COMMITS)
    # A commit that was written twice is one.
    return found.groupBy("batch").agg(F.max("rows").alias("rows"))


def append_once(df: DataFrame, table_path: str, batch: str) -> bool:
    """Append ``df`` as ``batch``; False, and nothing is done, if the batch is there.

    The rows are written to the batch's own folder, over what a failed attempt may have
    left there, and counted from the files' footers; the commit comes last.  Until then
    readers (``committed_rows``) don't see them.  Batches of one id must not be written by
    two jobs at once.
    """
    spark = df.sparkSession
    if not commits(spark, table_path).filter(F.col("batch") == batch).isEmpty():
        return False
    folder = f"{table_path}/batches/batch={quote(batch, safe='')}"
    df.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    spark.createDataFrame([(batch, rows)], COMMITS).coalesce(1).write.mode("append").parquet(f"{table_path}/_commits")
    return True


def committed_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of the committed batches, with their ``batch``."""
    done = commits(spark, table_path).select(F.col("batch").alias("_done"))
    rows = spark.read.option("recursiveFileLookup", "false").parquet(f"{table_path}/batches")
    rows = rows.withColumn("batch", F.col("batch").cast("string"))
    return rows.join(F.broadcast(done), rows["batch"] == done["_done"], "left_semi")


def committed_count(spark: SparkSession, table_path: str) -> int:
    """The rows of the table from its manifest; no data file is read."""
    return commits(spark, table_path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def append_once_and_count(df: DataFrame, table_path: str, batch: str) -> int:
    """``append_once``, and the table's row count."""
    append_once(df, table_path, batch)
    return committed_count(df.sparkSession, table_path)
