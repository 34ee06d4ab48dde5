"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the corpus over its
own share, in characters.  Each document draws a number of copies from the
Poisson distribution with that mean: a uniform number hashed from seed and id
(from the text where the id is null) is inverted through the distribution.  A document
is exploded by its count and the copies are dealt out globally by a hash of id, text and
copy.  Counts depend on nothing but these, seed and rate, so a retried task draws the
same ones.

Rates above ``PART`` are drawn as a sum of equal independent parts, which is
Poisson again and keeps ``exp(-mean)`` far from underflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.sizing import broadcast_if_small
from .common import col

SEED = 7
# Target weight of a source that no weights are given for: its size to this power.
FLATTEN = 0.5
PART = 32.0
_HEX_DIGITS = 13


def hash_uniform(*parts: Column) -> Column:
    """A number from 0 up to 1 (52 bits) hashed from the parts' texts."""
    texts = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.substring(F.md5(F.concat_ws(":", *texts)), 1, _HEX_DIGITS)
    return F.conv(digest, 16, 10).cast("bigint") / F.lit(float(16 ** _HEX_DIGITS))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None,
                 source_col: str = "source", text_col: str = "text",
                 flatten: float = FLATTEN) -> DataFrame:
    """``(source, size, rate)``: characters of each source (null texts count
    none) and its mean repetition rate.  ``weights`` are relative; sources not
    named weigh nothing.  Without ``weights`` a source weighs its size to the
    power ``flatten``.  The whole keeps its size on average.  A source without
    characters has rate 1 when it weighs anything."""
    sizes = docs.groupBy(col(source_col).alias("source")).agg(
        F.coalesce(F.sum(F.length(col(text_col)).cast("bigint")), F.lit(0)).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(flatten)))
    else:
        given = F.lit(None).cast("double")
        for name, weight in weights.items():
            given = F.when(F.col("source") == name, F.lit(float(weight))).otherwise(given)
        sizes = sizes.withColumn("weight", F.coalesce(given, F.lit(0.0)))
    total = sizes.agg(F.sum("size").alias("all_size"),
                      F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight"))
    totals = total.first()
    all_size, all_weight = float(totals[0] or 0), float(totals[1] or 0)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(
        F.col("weight") > 0,
        F.col("weight") * F.lit(all_size) / (F.lit(all_weight or 1.0) * F.col("size").cast("double"))
    ).otherwise(F.lit(0.0))
    return sizes.select("source", "size", rate.alias("rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """Adds ``parts`` and ``cdf``: the distribution of one of ``parts`` equal
    parts of the rate, up to where it reaches 1 within rounding."""
    return (rates.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int"))
            .withColumn("mean", F.col("rate") / F.col("parts"))
            .withColumn("last", F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 30).cast("int"))
            .withColumn("cdf", F.expr(
                "aggregate(sequence(1, last), struct(array(exp(-mean)) AS cdf, exp(-mean) AS p), "
                "(s, k) -> struct(concat(s.cdf, array(element_at(s.cdf, -1) + s.p * mean / k)) AS cdf, "
                "s.p * mean / k AS p), s -> s.cdf)"))
            .drop("mean", "last"))


def copies(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
           source_col: str = "source", text_col: str = "text", columns: list[str] | None = None,
           seed: int = SEED, flatten: float = FLATTEN) -> DataFrame:
    """``(row, source, copy, shuffle_key)``: one row per copy, numbered from 1;
    ``row`` holds the ``columns`` of ``docs`` (all by default), the order of
    ``shuffle_key`` (0 to 1) is the global random order.

    A null source is a source of its own.  Rows with one id draw the same count, rows
    without an id one by their text, so a repeated row is repeated alike.  An empty table
    gives no rows; a document that draws 0 is left out, which is the operator's task.
    """
    table = broadcast_if_small(poisson_table(source_rates(docs, weights, source_col, text_col, flatten))
                               .withColumnRenamed("source", "rate_source"))
    rows = docs.select(F.struct(*[col(c) for c in columns or docs.columns]).alias("row"),
                       col(id_col).cast("string").alias("id"), F.md5(col(text_col)).alias("digest"),
                       col(source_col).alias("source"))
    rows = rows.withColumn("id", F.coalesce("id", F.concat_ws(":", F.lit("null"), "digest")))
    joined = rows.join(table, rows["source"].eqNullSafe(table["rate_source"]))
    # Each part's uniform number is hashed once, then counted through the distribution.
    uniforms = F.transform(F.sequence(F.lit(1), F.col("parts")),
                           lambda part: hash_uniform(F.lit(seed), part, F.col("id")))
    drawn = F.aggregate(uniforms, F.lit(0),
                        lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    counted = joined.withColumn("n", drawn)
    exploded = counted.filter("n > 0").select(
        "row", "source", "id", "digest", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    return exploded.select("row", "source", "copy", hash_uniform(
        F.lit(seed), F.lit("order"), F.col("id"), F.col("digest"), F.col("copy")).alias("shuffle_key"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None,
                **options) -> DataFrame:
    """``docs`` with every row as often as it is drawn, globally shuffled: a hash
    decides the partition and the place in it.  All columns as they are."""
    return (copies(docs, weights, **options).repartition("shuffle_key")
            .sortWithinPartitions("shuffle_key").select("row.*"))
