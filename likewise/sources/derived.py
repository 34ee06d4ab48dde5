"""Catalogs derived from the driver's parquet tables.

Each adapter returns a *flat* catalog: an id column ``sku`` plus one string
column per attribute, named so that alphabetical order is the weight order.
Only the columns an adapter needs are selected, so the parquet scans read
just those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _floor_str(col, divisor: float) -> F.Column:
    return F.floor(col / F.lit(divisor)).cast("bigint").cast("string")


def part10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten attributes per part, ``a`` .. ``j``; ``h``, ``i``, ``j`` are synthetic
    15-value attributes computed from the key."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("sku"),
        F.col("p_brand").alias("a"),
        F.col("p_type").alias("b"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("c"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("d"),
        F.col("p_size").cast("string").alias("e"),
        _floor_str(F.col("p_size"), 10.0).alias("f"),
        _floor_str(F.col("p_retailprice"), 100.0).alias("g"),
        ((key * 7) % 15).cast("string").alias("h"),
        (F.floor(key / F.lit(3.0)).cast("bigint") % 15).cast("string").alias("i"),
        (F.floor(key / F.lit(11.0)).cast("bigint") % 15).cast("string").alias("j"),
    )


def cust5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five attributes per customer, two of them aggregated from its orders.

    The order aggregate is partial-aggregated per task before its shuffle on
    ``o_custkey``; the customer side joins on the same key.
    """
    c = table(spark, sf_dir, "customer")
    o = (table(spark, sf_dir, "orders")
         .groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"),
              F.max_by("o_orderpriority", "o_orderkey").alias("p")))
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
            .select(F.col("c_custkey").alias("sku"),
                    F.col("c_nationkey").cast("string").alias("a"),
                    F.col("c_mktsegment").alias("b"),
                    _floor_str(F.col("c_acctbal"), 1000.0).alias("c"),
                    F.col("n").cast("string").alias("d"),
                    F.col("p").alias("e")))


def docs5(spark: SparkSession, sf_dir: str, labelled_only: bool = False) -> DataFrame:
    """Five attributes per document; ``d`` and ``e`` are missing (null) for
    documents without labels.  ``labelled_only`` keeps just the labelled
    documents (inner join), a catalog that does not cover every document."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return (d.join(lab, "doc_id", "inner" if labelled_only else "left")
            .select(F.col("doc_id").alias("sku"),
                    F.col("lang").alias("a"),
                    F.col("source").alias("b"),
                    _floor_str(F.col("n_chars"), 1000.0).alias("c"),
                    F.col("quality").cast("string").alias("d"),
                    F.col("toxic").cast("string").alias("e")))


def event2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attributes per event; ``k`` is read from the JSON text ``props``."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    props = F.from_json(F.col("props"), "map<string,string>")
    return e.select(F.col("event_id").alias("sku"),
                    F.col("event_type"),
                    F.try_element_at(props, F.lit("k")).alias("k"))


def orders_wide(spark: SparkSession, sf_dir: str, m: int) -> DataFrame:
    """``m`` attributes per customer: attribute ``o<i>`` is the highest priority
    among the customer's orders whose key leaves ``i`` divided by ``m``."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("sku")).agg(*[
        F.max(F.when(F.col("o_orderkey") % m == i, F.col("o_orderpriority"))).alias(f"o{i:02d}")
        for i in range(m)])


def parts_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map form of customers with orders: an attribute ``part<key>`` for each part they
    ordered, its value the highest return flag of those lines.  As many names as parts."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    # One shuffle on the customer serves both groupings.
    long = (li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_partkey", "l_returnflag")
            .repartition("o_custkey").groupBy("o_custkey", "l_partkey").agg(F.max("l_returnflag").alias("value")))
    pair = F.struct(F.concat(F.lit("part"), F.col("l_partkey").cast("string")), "value")
    return long.groupBy(F.col("o_custkey").alias("sku")).agg(
        F.map_from_entries(F.collect_list(pair)).alias("attributes"))


def part10_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part10`` with small parts once more without an id, and every third part
    once more with another value of ``a`` that makes this row the one that counts."""
    p = part10(spark, sf_dir)
    no_id = p.filter(F.col("e").cast("int") <= 10).withColumn("sku", F.lit(None).cast("bigint"))
    again = p.filter(F.col("sku") % 3 == 0).withColumn("a", F.lit("A0"))
    return p.unionByName(no_id).unionByName(again)
