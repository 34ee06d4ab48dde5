"""A stored subset index that follows its catalog.

The index of ``operators.batch`` keeps the smallest ids of every subset group, its heads.
Heads merge: the smallest ids of two sets together are among the smallest of each.  So
added items only need heads of their own, a generation, and a request looks at the
heads of all generations.

Removed items are struck off.  Each generation keeps ``slack`` heads more than the
``k + 1`` a request needs; a group that was cut at that many heads, and has fewer than
``k + 1`` left, has lost items it may need to ones beyond the cut.  Such groups, and only
those, are filled again from the items (*whole* heads, which stand for all earlier
generations).  A changed item is removed and added.

Below ``path``: ``about`` (one row), ``log`` (a row per finished update, written last, so that an
update that failed half-way is as if it had not been), and ``items``, ``removed`` and
``heads`` in folders ``gen=<n>``.  An update writes in proportion to what changed; a new
``build_upkept_index`` is only needed to forget old generations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import attr, attribute_names, escaped
from ..plans.session import materialize, shared_path
from ..plans.sizing import MAX_BROADCAST_ROWS, broadcast_if_small
from .batch import (MAX_LATTICE_ATTRIBUTES, _fan_out, _fits_lattice, _group_cols, _hot_groups, _ids_repeat, _pairs,
                    _requests_in_catalog, _spread, class_rows, subset_heads, subset_rows, top_k_from_classes,
                    top_k_from_pairs)
from .lookup import one_row_per_id

GROUP = _group_cols()


def _generations(spark: SparkSession, path: str) -> list[int]:
    """The finished generations; one small row each."""
    return sorted({r[0] for r in spark.read.schema("gen int, batch string").parquet(f"{path}/log").select("gen").collect()})


def _finish(spark: SparkSession, path: str, gen: int, batch: str | None) -> None:
    spark.createDataFrame([(gen, batch)], "gen int, batch string").coalesce(1).write.mode("append").parquet(f"{path}/log")


def _read(spark: SparkSession, path: str, what: str) -> DataFrame:
    """``items``, ``removed`` or ``heads`` of the finished generations, with their ``gen``."""
    gens = _generations(spark, path)
    return spark.read.parquet(f"{path}/{what}").withColumn("gen", F.col("gen").cast("int")).filter(F.col("gen").isin(gens))


def _alive(rows: DataFrame, removed: DataFrame, id_col: str) -> DataFrame:
    """The rows that no later generation removed."""
    last = removed.groupBy(F.col(id_col).alias("_gone")).agg(F.max("gen").alias("_at"))
    last = broadcast_if_small(last)
    return rows.join(last, (rows[id_col] == last["_gone"]) & (rows["gen"] < last["_at"]), "left_anti")


def _about(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/about").first()


def live_items(spark: SparkSession, path: str) -> DataFrame:
    """The items the index stands for."""
    id_col = _about(spark, path)["id_col"]
    return _alive(_read(spark, path, "items"), _read(spark, path, "removed"), id_col).drop("gen")


def live_heads(spark: SparkSession, path: str) -> DataFrame:
    id_col = _about(spark, path)["id_col"]
    return _alive(_read(spark, path, "heads"), _read(spark, path, "removed"), id_col)


def _heads(items: DataFrame, about, id_col: str, among: DataFrame | None = None) -> DataFrame:
    """Heads of the groups of ``items`` (those ``among`` given ones)."""
    names = list(about["names"])
    rows = subset_rows(_spread(items, id_col), names, id_col, about["include_empty"])
    if among is not None:
        rows = rows.join(broadcast_if_small(among), GROUP, "left_semi")
    return subset_heads(rows, about["k"] + about["slack"], id_col, drop_singletons=False)


def _write(items: DataFrame, removed: DataFrame, heads: DataFrame, path: str, gen: int) -> None:
    items.write.mode("overwrite").parquet(f"{path}/items/gen={gen}")
    removed.write.mode("overwrite").parquet(f"{path}/removed/gen={gen}")
    heads.sortWithinPartitions(*GROUP).write.mode("overwrite").parquet(f"{path}/heads/gen={gen}")


def build_upkept_index(flat: DataFrame, k: int, path: str | None = None, id_col: str = "sku",
                       include_empty: bool = True, unique_ids: bool = False, slack: int | None = None) -> str:
    """Write the first generation for up to ``k`` results and return the index's path.

    ``slack`` (``k + 1`` by default) is how many heads beyond ``k + 1`` a group keeps: the more,
    the more removals it takes before a group is filled again.  Null ids are left out and
    one row per id counts.
    """
    spark = flat.sparkSession
    path = path or shared_path(spark, "upkept-index")
    flat = escaped(flat, id_col)
    names = attribute_names(flat, id_col)
    flat = flat.filter(F.col(id_col).isNotNull()) if unique_ids else one_row_per_id(flat, id_col)
    flat = materialize(flat, "upkept-items")
    if not _fits_lattice(flat, names, MAX_LATTICE_ATTRIBUTES):
        raise ValueError(f"an item has more than {MAX_LATTICE_ATTRIBUTES} attributes")
    slack = k + 1 if slack is None else slack
    spark.createDataFrame([(k, slack, names, id_col, include_empty)],
                          "k int, slack int, names array<string>, id_col string, include_empty boolean"
                          ).write.parquet(f"{path}/about")
    about = _about(spark, path)
    none = flat.select(id_col).limit(0)
    _write(flat.select(id_col, *[attr(n) for n in names]), none,
           _heads(flat, about, id_col).withColumn("whole", F.lit(True)), path, 0)
    _finish(spark, path, 0, None)
    return path


def short_groups(heads: DataFrame, alive: DataFrame, need: int, kept: int) -> DataFrame:
    """The groups of ``heads`` (all that were stored) with a table that was cut at ``kept``
    heads and has fewer than ``need`` ``alive``; tables older than a group's last whole
    one don't count."""
    table = [*GROUP, "gen", "whole"]
    stored = heads.groupBy(*table).agg(F.count(F.lit(1)).alias("stored"))
    left = alive.groupBy(*table).agg(F.count(F.lit(1)).alias("left"))
    last = F.max(F.when(F.col("whole"), F.col("gen"))).over(Window.partitionBy(*GROUP))
    both = stored.join(left, table, "left").withColumn("since", F.coalesce(last, F.lit(0)))
    return both.filter((F.col("gen") >= F.col("since")) & (F.col("stored") == kept)
                       & (F.coalesce("left", F.lit(0)) < need)).select(*GROUP).distinct()


def update_index(spark: SparkSession, path: str, added: DataFrame | None = None, removed: DataFrame | None = None,
                 batch: str | None = None) -> int:
    """Take ``added`` rows and ``removed`` ids into the index; returns the generation.

    An added id that is in the index replaces its item.  Ids to be removed that are not in
    the index, and null ids, do nothing; of several added rows of an id one counts.  A
    ``batch`` that was taken in before is not taken in again.  Added rows must have the
    index's attributes (missing ones are null).
    """
    about = _about(spark, path)
    id_col, names = about["id_col"], list(about["names"])
    if batch is not None:
        done = spark.read.schema("gen int, batch string").parquet(f"{path}/log").filter(F.col("batch") == batch).first()
        if done is not None:
            return done["gen"]
    gen = max(_generations(spark, path)) + 1
    old, old_removed = _read(spark, path, "items"), _read(spark, path, "removed")
    live = _alive(old, old_removed, id_col)
    kind = live.schema[id_col].dataType
    if added is None:
        new = live.select(id_col, *[attr(n) for n in names]).limit(0)
    else:
        added = escaped(added, id_col)
        more = set(added.columns) - {id_col, *names}
        if more:
            raise ValueError(f"attributes that the index does not have: {sorted(more)}")
        new = one_row_per_id(added.select(F.col(id_col).cast(kind).alias(id_col), *[
            attr(n).cast("string").alias(n) if n in added.columns else F.lit(None).cast("string").alias(n)
            for n in names]), id_col)
    new = materialize(new, "upkept-added")
    if not _fits_lattice(new, names, MAX_LATTICE_ATTRIBUTES):
        raise ValueError(f"an item has more than {MAX_LATTICE_ATTRIBUTES} attributes")
    gone = new.select(id_col)
    if removed is not None:
        gone = gone.unionByName(removed.select(F.col(id_col).cast(kind).alias(id_col)))
    gone = gone.filter(F.col(id_col).isNotNull()).distinct()
    struck = materialize(live.join(gone, id_col, "left_semi").drop("gen"), "upkept-struck")

    # Only the groups of the removed items can have become short.
    touched = materialize(subset_rows(_spread(struck, id_col), names, id_col, about["include_empty"])
                          .select(*GROUP).distinct(), "upkept-touched")
    heads = materialize(_read(spark, path, "heads").join(broadcast_if_small(touched), GROUP, "left_semi"), "upkept-heads")
    marks = old_removed.select(id_col, "gen").unionByName(struck.select(id_col, F.lit(gen).alias("gen")))
    short = materialize(short_groups(heads, _alive(heads, marks, id_col), about["k"] + 1,
                                     about["k"] + 1 + about["slack"]), "upkept-short")
    still = live.drop("gen").join(struck.select(id_col), id_col, "left_anti").unionByName(new)
    own = _heads(new, about, id_col).join(broadcast_if_small(short), GROUP, "left_anti").withColumn("whole", F.lit(False))
    if not short.isEmpty():
        own = own.unionByName(_heads(still, about, id_col, among=short).withColumn("whole", F.lit(True)))
    _write(new, struck.select(id_col), own, path, gen)
    _finish(spark, path, gen, batch)
    return gen


def top_k_from_upkept(spark: SparkSession, path: str, requests: DataFrame | None = None,
                      k: int | None = None) -> DataFrame:
    """``batch_top_k`` of the live items from the index, for ``requests`` (all of them by
    default) and up to the index's ``k`` results."""
    about = _about(spark, path)
    id_col, names, k = about["id_col"], list(about["names"]), about["k"] if k is None else k
    if k > about["k"]:
        raise ValueError(f"the index is for k <= {about['k']}")
    items, n_req = live_items(spark, path), None
    if requests is not None:
        items, n_req = _requests_in_catalog(items, requests, id_col)
    asked = members = materialize(items, "upkept-requests")
    together = False
    if 0 < k and names and _fan_out(members, names) > MAX_BROADCAST_ROWS:
        # Items equal in all attributes are answered together.
        asked = materialize(class_rows(members, names, id_col), "upkept-classes")
        together = 2 * asked.count() <= members.count() and not _ids_repeat(members, id_col)
        asked = asked if together else members
    rows = subset_rows(_spread(asked, id_col), names, id_col, about["include_empty"])
    heads = live_heads(spark, path).select(*GROUP, id_col).distinct()
    if _fan_out(asked, names) <= MAX_BROADCAST_ROWS:
        pairs = _pairs(F.broadcast(rows), heads, len(names), id_col, build_heads=False)
    else:
        pairs = _pairs(rows, heads, len(names), id_col, _hot_groups(asked, rows, names, None, n_req))
    if together:
        return top_k_from_classes(pairs, asked, members, names, k, id_col, about["include_empty"])
    return top_k_from_pairs(pairs, k, len(names), id_col)
