"""Top k for many requests by joining equal attribute values, frequent values apart.

The long form of the catalog joined to itself on (attribute, value) gives every pair
of items that shares a value; adding the shared attributes' weights gives the score.
A value of ``n`` items makes ``n**2`` rows, so the few frequent ones must not be joined.

A value is heavy when more than one item in ``HEAVY_SHARE`` has it, the ``MAX_HEAVY`` most
frequent at most.  An item's heavy values are a small bit set that goes with its rows.

* Pairs with a shared light value come from the join.  What they share of heavy
  values is told by their two bit sets, without any row.
* Pairs that share heavy values only: of all items whose bit set holds a set ``S`` only
  the ``k + 1`` smallest ids can get into a top k through ``S`` alone, as all of them score
  at least as much.  These heads are found per bit set, of which there are at most
  ``2**MAX_HEAVY``, and looked up once per bit set of the requests.

The same holds for pairs with a shared light value: through one set of light values and one of
heavy ones only the ``k + 1`` smallest ids can get into a top k.  So where items have few
attributes (``MAX_LATTICE_ATTRIBUTES``) the join is of sets of values with these heads, and its
rows grow with the items.  Items equal in all attributes are joined once.

For wider items single values are joined.  The light values' rows are dealt out in blocks of a value's requests, so a value just
under the share is no single task's.  Best where most values are rare; with many frequent
values use the subset index (``batch_top_k``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..errors import TooManyAttributes
from ..functions.columns import (MAX_BIGINT_ATTRIBUTES, attr, attribute_names, bit_of, count_from_score,
                                 escaped, mask_from_score, score_from_mask)
from ..plans.session import materialize
from ..plans.sizing import broadcast_if_small
from .batch import MAX_LATTICE_ATTRIBUTES, _fits_lattice, _ids_repeat, class_rows, subset_rows, top_k_from_classes
from .lookup import one_row_per_id

HEAVY_SHARE = 8
MAX_HEAVY = 10
BLOCK = 4096


def _long(flat: DataFrame, names: list[str], id_col: str) -> DataFrame:
    """``(id, at, value)`` of the present attributes, ``at`` the attribute's place."""
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), attr(n).cast("string").alias("value")) for i, n in enumerate(names)])
    return flat.select(F.col(id_col).alias("id"), F.explode(pairs).alias("p")).filter("p.value IS NOT NULL").select(
        "id", "p.at", "p.value")


def _weight(bits: Column, weights: list[int]) -> Column:
    """The sum of the weights of the set bits; bit ``i`` has ``weights[i]``."""
    terms = [F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(w)).otherwise(F.lit(0)).cast("bigint")
             for i, w in enumerate(weights)]
    return sum(terms, F.lit(0).cast("bigint"))


def _subsets(bits: Column, n: int) -> Column:
    """All subsets of a bit set of ``n`` bits."""
    return F.filter(F.array(*[F.lit(s) for s in range(1 << n)]), lambda s: s.bitwiseAND(bits) == s)


def _first(rows: DataFrame, by: str, n: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy("id")
    return rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n).drop("r")


def _heavy_only(items: DataFrame, asked: DataFrame, weights: list[int], k: int) -> DataFrame:
    """``(request_bits, id, score)``: for every bit set of the requests the best ``k + 1``
    items by their heavy values alone."""
    n = len(weights)
    heads = materialize(_first(items.select("bits", "id"), "bits", k + 1), "join-classes")
    heads = _first(heads.select(F.explode(_subsets(F.col("bits"), n)).alias("s"), "id").distinct(), "s", k + 1)
    sets = asked.select("bits").distinct().select(
        F.col("bits").alias("request_bits"), F.explode(_subsets(F.col("bits"), n)).alias("s"))
    met = sets.join(heads, "s").select("request_bits", "id", _weight(F.col("s"), weights).alias("score"))
    met = met.groupBy("request_bits", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("request_bits").orderBy(F.desc("score"), "id")
    return met.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")


def _light_heads(flat: DataFrame, items: DataFrame, classes: DataFrame, names: list[str], id_col: str,
                 heavy: list[tuple[int, str]], weights: list[int], k: int) -> DataFrame:
    """``(request_sku, id, score)``: the classes' smallest ids with the heads of every set of
    values, one of them light at least, that they have."""
    m = len(names)
    light = []
    for at, name in enumerate(names):
        value = attr(name)
        often = [v for a, v in heavy if a == at]
        light.append((F.when(~value.cast("string").isin(often), value) if often else value).alias(name))
    rows = subset_rows(flat.select(id_col, *light), names, id_col, min_level=1).withColumnRenamed(id_col, "id")
    rows = rows.join(items, "id").select("_k1", "_k2", "_s", "id", F.explode(_subsets(F.col("bits"), len(heavy))).alias("s"))
    key = ["_k1", "_k2", "_s", "s"]
    rows = materialize(rows, "join-sets")
    order = Window.partitionBy(*key).orderBy("id")
    heads = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")
    asking = rows.join(classes.select(F.col(id_col).alias("id")), "id", "left_semi").withColumnRenamed("id", "request_sku")
    of_light = score_from_mask(F.col("_s"), m)
    return asking.join(heads, key).filter("request_sku != id").select(
        "request_sku", "id", (of_light + _weight(F.col("s"), weights)).alias("score"))


def batch_top_k_joined(flat: DataFrame, k: int = 10, requests: DataFrame | None = None, id_col: str = "sku",
                       include_empty: bool = False, unique_ids: bool = False, heavy_share: int = HEAVY_SHARE,
                       max_heavy: int = MAX_HEAVY) -> DataFrame:
    """The result of ``batch_top_k`` (``batch_top_k_indexed`` without ``include_empty``) by an
    equality join of the values; at most 57 attributes.

    Null ids are neither items nor requests and one row per id counts; null values match
    nothing; requests not in the catalog are left out; an empty catalog gives no rows.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    flat = escaped(flat, id_col)
    names = attribute_names(flat, id_col)
    m = len(names)
    if m > MAX_BIGINT_ATTRIBUTES:
        raise TooManyAttributes(f"at most {MAX_BIGINT_ATTRIBUTES} attributes, got {m}")
    flat = flat.filter(F.col(id_col).isNotNull()) if unique_ids else one_row_per_id(flat, id_col)
    flat = materialize(flat, "join-items")
    n_items = flat.count()
    long = _long(flat, names, id_col)
    counts = materialize(long.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "join-counts")
    # At most ``heavy_share`` values of an attribute, and ``max_heavy`` in all.
    frequent = counts.filter(F.col("n") * heavy_share > n_items).orderBy(F.desc("n"), "at", "value").limit(max_heavy)
    heavy = [tuple(r) for r in frequent.select("at", "value").collect()]
    weights = [(1 << m) + bit_of(at, m) for at, _ in heavy]
    bits = sum((F.when(attr(names[at]).cast("string") == F.lit(v), F.lit(1 << b)).otherwise(F.lit(0))
                for b, (at, v) in enumerate(heavy)), F.lit(0))
    items = materialize(flat.select(F.col(id_col).alias("id"), bits.alias("bits")), "join-bits")
    asked = items
    if requests is not None:
        asked = items.join(requests.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")

    if 0 < k and _fits_lattice(flat, names, MAX_LATTICE_ATTRIBUTES) and names and not (
            unique_ids and _ids_repeat(flat, id_col)):
        members = flat if requests is None else flat.join(asked.select(F.col("id").alias(id_col)), id_col, "left_semi")
        classes = materialize(class_rows(flat, names, id_col), "join-equal")
        order = Window.partitionBy(*[attr(n) for n in names]).orderBy(id_col)
        firsts = materialize(flat.withColumn("r_", F.row_number().over(order)).filter(
            F.col("r_") <= k + 1).drop("r_"), "join-firsts")
        met = _light_heads(firsts, items, classes, names, id_col, heavy, weights, k)
        first = items.join(classes.select(F.col(id_col).alias("id")), "id", "left_semi")
        alone = broadcast_if_small(_heavy_only(items, first, weights, k), known_rows=(k + 1) << len(heavy))
        rest = first.select(F.col("id").alias("request_sku"), F.col("bits").alias("request_bits")).join(
            alone, "request_bits").filter("request_sku != id").select("request_sku", "id", "score")
        pairs = met.unionByName(rest).withColumnRenamed("id", id_col)
        pairs = pairs if include_empty else pairs.filter("score > 0")
        return top_k_from_classes(pairs, classes, members, names, k, id_col, include_empty)

    # The light values of every item, with its bit set.
    is_heavy = F.lit(False)
    for at, v in heavy:
        is_heavy = is_heavy | ((F.col("at") == at) & (F.col("value") == F.lit(v)))
    light = counts.filter(~is_heavy).select("at", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = long.filter(~is_heavy).join(light, ["at", "value"]).join(items, "id")
    rows = materialize(rows.select("id", "bits", "at", "blocks", F.xxhash64("value").alias("v1"),
                                   F.xxhash64(F.lit(1), "value").alias("v2")), "join-light")
    left = rows if requests is None else rows.join(asked.select("id"), "id", "left_semi")
    left = left.select(F.col("id").alias("request_sku"), F.col("bits").alias("request_bits"), "at", "v1", "v2",
                       F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    right = rows.select(F.col("id"), F.col("bits"), "at", "v1", "v2",
                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    place = F.pow(F.lit(2.0), F.lit(m - 1) - F.col("at")).cast("bigint") + F.lit(1 << m)
    both = F.col("request_bits").bitwiseAND(F.col("bits"))
    pairs = left.join(right, ["at", "v1", "v2", "block"]).filter("request_sku != id").select(
        "request_sku", "id", place.alias("weight"), _weight(both, weights).alias("heavy"))
    met = pairs.groupBy("request_sku", "id").agg((F.sum("weight") + F.max("heavy")).alias("score"))

    # Bounded by the bit sets: at most 2**max_heavy times k + 1 rows.
    alone = broadcast_if_small(_heavy_only(items, asked, weights, k), known_rows=(k + 1) << len(heavy))
    rest = asked.select(F.col("id").alias("request_sku"), F.col("bits").alias("request_bits")).join(
        alone, "request_bits").filter("request_sku != id").select("request_sku", "id", "score")
    best = met.unionByName(rest).groupBy("request_sku", "id").agg(F.max("score").alias("score"))
    if not include_empty:
        best = best.filter("score > 0")
    order = Window.partitionBy("request_sku").orderBy(F.desc("score"), "id")
    top = best.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)
    return top.select("request_sku", F.col("rn").cast("int").alias("rn"), F.col("id").alias(id_col), "score",
                      count_from_score(F.col("score"), m).alias("match_count"),
                      mask_from_score(F.col("score"), m).alias("mask"))
