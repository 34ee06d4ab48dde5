"""Catalogs and term postings stored so that a look-up reads little.

Both are Parquet tables dealt out by ranges of their key and sorted by it, with a Bloom
filter of the key in every row group.  The smallest and largest key of a file and of a
row group rule out nearly all of them, the filter most of the rest, and the page index of
the one that is left all but a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.text import NO_TOKEN, check_term

# Bytes of a row group.
ROW_GROUP_BYTES = 16 << 20


def write_by_key(df: DataFrame, path: str, key: str, row_group_bytes: int = ROW_GROUP_BYTES,
                 files: int | None = None) -> str:
    """Write ``df`` sorted by ``key``, its ranges in ``files`` files (by default as many as
    Spark has shuffle partitions).  Rows of one key are in one range, nulls first."""
    dealt = df.repartitionByRange(files, F.col(key)) if files else df.repartitionByRange(F.col(key))
    (dealt.sortWithinPartitions(key).write
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option("parquet.block.size", str(row_group_bytes)).parquet(path))
    return path


def store_catalog(catalog: DataFrame, path: str, id_col: str = "sku", **options) -> str:
    """Write a catalog, in map or flat form, for look-ups by id (``read_stored``)."""
    return write_by_key(catalog, path, id_col, **options)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored catalog; ``lookup_item`` on it reads a row group, a scan the whole."""
    return spark.read.parquet(path)


def build_term_index(df: DataFrame, column: str, id_col: str, path: str, **options) -> str:
    """Write the postings of a text column: ``(token, id, row, hits)``, one row for each
    distinct token of each row of ``df``, tokens as in ``term_match``.

    Null texts have no tokens; a null id is an id; rows of one id are told apart by ``row``,
    so each keeps its own hits."""
    rows = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(column).alias("text"))
    rows = rows.select("id", "row", F.explode(F.split(F.lower("text"), NO_TOKEN)).alias("token"))
    # A row's tokens are in one task, so most of the counting is done before the shuffle.
    hits = rows.filter("token != ''").groupBy("token", "id", "row").agg(F.count(F.lit(1)).cast("int").alias("hits"))
    return write_by_key(hits, path, "token", **options)


def search_terms(spark: SparkSession, path: str, term: str, id_col: str) -> DataFrame:
    """``term_match`` from the postings at ``path``: the ids with ``hits``."""
    found = spark.read.parquet(path).filter(F.col("token") == F.lit(check_term(term)))
    return found.select(F.col("id").alias(id_col), "hits")
