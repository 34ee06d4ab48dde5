"""Top-k similar items for many requests at once, without pairing all items.

Pairing every request with every catalog item costs ``requests x items``
comparisons and is a cross join.  Instead the catalog is indexed by
*attribute subsets*.

For an item ``x`` and a subset ``S`` of its present attributes, the group
``(S, x restricted to S)`` holds every item that agrees with ``x`` on all of
``S``.  The **subset index** keeps, per group, only the ``k + 1`` smallest ids
(the *heads*).

Why that is enough.  Let ``x`` be one of the true top k for request ``t`` and
``M`` the set of attributes on which ``x`` equals ``t``.  Every item of the
group ``(M, t restricted to M)`` matches ``t`` on at least ``M``, so it scores
at least as high as ``x``; the ones with a smaller id therefore rank before
``x``.  At most ``k - 1`` other items rank before ``x``, plus ``t`` itself, so
``x`` is among the ``k + 1`` smallest ids of that group: a head.  A request
therefore only has to look at the heads of the groups of its own subsets.

A head ``x`` met through group ``S`` matches ``t`` on at least ``S``.  Taking,
per candidate, the best score over the groups it was met through gives the
exact score for every true top-k item (met through ``S = M``) and at most the
exact score for every other candidate, so the top k by that score are the
exact top k, ties cut by id.  Nothing is capped or sampled.

Cost.  With ``p`` present attributes an item is in ``2**p`` groups, so the
index is built from ``items x 2**p`` rows, and a request meets at most
``2**p x (k + 1)`` candidates, however large the catalog.  The heads are cut
by ``row_number() <= k + 1``, which Spark plans as a per-task group limit
before the shuffle and a final one after it, so a group holding a third of
all items still sends at most ``k + 1`` rows per task through the shuffle.
The request side of the equi-join on the group key can be hot (every request
shares the empty subset); the heads side of each key has at most ``k + 1``
rows.  Groups with more request rows than one task should take are found by
an exact count and salted: their request rows are spread over several
buckets and their few heads copied into each (``_hot_groups``, ``_pairs``).
The last shuffle is on the request id, whose groups are bounded by
``2**p x (k + 1)`` rows.

The exponent is the per-item number of attributes, not the catalog's total, so
open catalogs with many names but few per item stay cheap.  Where some item has
more than ``max_attributes``, or the names are too many for a bigint mask, the
same result comes from posting lists (``operators.postings``).  Null ids are left out and one row per id counts
(``one_row_per_id``), as for a single request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.columns import (MAX_BIGINT_ATTRIBUTES, attr, attribute_names, bit_of,
                                 count_from_score, escaped, mask_from_score, score_from_mask)
from ..plans.session import materialize, shared_path
from ..plans.sizing import MAX_BROADCAST_ROWS
from ..plans.skew import partitions
from .blocks import (MAX_COMPARED, Field, block_levels, coded, next_block_level, next_prefixes, packed, prefix_costs,
                     prefix_levels, repeated_values, settle, top_k_by_blocks, top_k_by_prefixes, value_of, with_num)
from .lookup import one_row_per_id
from .postings import top_k_by_postings

# Above 2**12 groups for some item the posting lists answer instead.
MAX_LATTICE_ATTRIBUTES = 12
# Spark's group limit before the shuffle ends at 1,000 rows of a group.
MAX_GROUP_LIMIT = 1000
# Up to this many attributes all 2**m masks are enumerated and filtered.
DENSE_SUBSET_ATTRIBUTES = 12
# A subset group is hot when its request rows exceed this many times the
# average rows per shuffle partition, and never below MIN_HOT_GROUP_ROWS.
HOT_GROUP_FACTOR = 4
MIN_HOT_GROUP_ROWS = 1 << 20
# Up to this many heads a shuffle partition they are held in a hash table, else sorted.
MAX_HASHED_HEADS = 1 << 20
# With fewer attributes the fan-out is small and a second round costs more
# in extra jobs than it saves (measured at sf0.1: 5 attributes lose, 10 win).
TWO_ROUND_MIN_ATTRIBUTES = 8
TWO_ROUND_MIN_FANOUT = 4_000_000
# Pairs of wide items with a common value from which prefixes come before the posting lists.
MIN_PREFIX_PAIRS = 1 << 26


# Group keys are two 64-bit hashes.  Each present value is hashed twice with
# seeds derived from its attribute position (so equal text in two attributes
# differs), and a subset's key is the XOR of its members' hashes, alongside
# the subset mask itself.
_SEED_A = 0
_SEED_B = -1


def _group_cols() -> list[str]:
    return ["_k1", "_k2", "_s"]


def subset_rows(flat: DataFrame, names: Sequence[str], id_col: str = "sku",
                include_empty: bool = True, min_level: int = 0,
                max_level: int | None = None) -> DataFrame:
    """``(_k1, _k2, _s, id)``: one row per item and subset of its present
    attributes.

    ``_s`` is the subset as a mask (attribute ``i`` is bit ``2**(m-1-i)``).
    ``(_k1, _k2)`` identify the subset's values: each present value is hashed
    to two independent 64-bit numbers seeded by its attribute position, and a
    subset's key is the XOR of its members' hashes.  Rows agree on
    ``(_k1, _k2, _s)`` exactly when they agree on every value of the subset,
    up to a 128-bit hash collision: for ``n`` distinct groups the chance of any
    collision is about ``n**2 / 2**129``, below ``1e-14`` at ``n = 1e12``.  The
    rows stay three numbers and an id wide however long the values are, so
    the fan-out is cheap to shuffle and sort.

    All subsets come from a single ``explode``: for up to
    ``DENSE_SUBSET_ATTRIBUTES`` attributes the masks are enumerated and
    those outside the present attributes filtered out; for more, the subsets of
    the present attributes are built directly by doubling an array once per
    present attribute, so a sparse item never enumerates ``2**m`` masks.  The
    keys of each subset are then computed from the item's per-attribute
    hashes, so only the three key numbers and the id are materialised per row.
    ``min_level`` and ``max_level`` keep only subsets of that many attributes.
    """
    m = len(names)
    mask_type = "int" if m <= 30 else "bigint"
    hashed = flat.select(
        id_col,
        *[F.xxhash64(F.lit(i + _SEED_A), attr(n).cast("string")).alias(f"_u{i}")
          for i, n in enumerate(names)],
        *[F.xxhash64(F.lit(_SEED_B - i), attr(n).cast("string")).alias(f"_v{i}")
          for i, n in enumerate(names)],
        sum((F.when(attr(n).isNotNull(), F.lit(bit_of(i, m))).otherwise(F.lit(0))
             for i, n in enumerate(names)), F.lit(0).cast(mask_type)).alias("_p"))
    if not include_empty:
        min_level = max(min_level, 1)
    if m <= DENSE_SUBSET_ATTRIBUTES:
        # Only the masks of the wanted levels are enumerated, as one literal.
        highest = m if max_level is None else max_level
        masks = [s for s in range(1 << m) if min_level <= s.bit_count() <= highest]
        masks = F.lit(masks) if masks else F.array().cast("array<int>")
        expanded = (hashed.select("*", F.explode(masks).alias("_s"))
                    .filter(F.col("_s").bitwiseAND(F.col("_p")) == F.col("_s")))
    else:
        masks = F.expr(
            f"aggregate(sequence(0, {m - 1}), array(CAST(0 AS BIGINT)), (acc, b) -> "
            f"IF(shiftright(_p, b) & 1 = 1, "
            f"concat(acc, transform(acc, s -> s | shiftleft(CAST(1 AS BIGINT), b))), acc))")
        expanded = hashed.select("*", F.explode(masks).alias("_s"))
        if min_level > 0:
            expanded = expanded.filter(F.bit_count("_s") >= min_level)
        if max_level is not None:
            expanded = expanded.filter(F.bit_count("_s") <= max_level)
    zero = F.lit(0).cast("bigint")
    k1, k2 = zero, zero
    for i in range(m):
        on = F.col("_s").bitwiseAND(F.lit(bit_of(i, m)).cast(mask_type)) != 0
        k1 = k1.bitwiseXOR(F.when(on, F.col(f"_u{i}")).otherwise(zero))
        k2 = k2.bitwiseXOR(F.when(on, F.col(f"_v{i}")).otherwise(zero))
    rows = expanded.select(k1.alias("_k1"), k2.alias("_k2"), "_s", id_col)
    return rows


def subset_heads(rows: DataFrame, k: int, id_col: str = "sku",
                 drop_singletons: bool = True) -> DataFrame:
    """Keep the ``k + 1`` smallest ids of every subset group.

    With ``drop_singletons`` groups with a single member are dropped: their
    only head is the request itself, which never is its own candidate.  The
    count runs over the at most ``k + 1`` rows left per group.
    """
    group = _group_cols()
    w = Window.partitionBy(*group).orderBy(F.asc(id_col))
    if k + 1 > MAX_GROUP_LIMIT:
        # No group limit runs before the shuffle then: cut salted parts first,
        # so a group of all items is cut in many tasks.
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = Window.partitionBy(*group, "_salt").orderBy(F.asc(id_col))
        rows = (rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
                .withColumn("_r", F.row_number().over(salted)).filter(F.col("_r") <= k + 1)
                .drop("_salt", "_r"))
    heads = rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k + 1)
    if drop_singletons:
        heads = heads.withColumn("_c", F.count(F.lit(1)).over(Window.partitionBy(*group))) \
            .filter(F.col("_c") > 1).drop("_c")
    return heads.drop("_r")


def _fits_lattice(flat: DataFrame, names: Sequence[str], max_attributes: int) -> bool:
    """Whether every item's subsets are few enough to be indexed.

    With at most ``max_attributes`` columns nothing needs checking; with more
    (an open catalog flattened to many names), one aggregate finds the largest
    number of attributes any single item has.
    """
    m = len(names)
    if m > MAX_BIGINT_ATTRIBUTES:
        return False
    if m <= max_attributes:
        return True
    present = sum((attr(n).isNotNull().cast("int") for n in names), F.lit(0))
    return (flat.agg(F.max(present)).first()[0] or 0) <= max_attributes


def _spread(flat: DataFrame, id_col: str) -> DataFrame:
    """Hash-partition the catalog on all of its columns before the fan-out.

    A catalog read from a single file is one task; without this the whole
    fan-out would run in it.  One shuffle of the catalog costs a ``2**p``-th
    of the fan-out's own shuffle.  Hashing every column (not just the id)
    keeps the partitions even even if one id were repeated on many rows, and
    is deterministic, so a retried task gets the same rows.  The explicit
    partition count keeps AQE from merging the partitions back into one
    because the catalog itself is small.
    """
    n = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return flat.repartition(n, F.xxhash64(*[attr(c) for c in flat.columns]))


def _requests_in_catalog(flat: DataFrame, requests: DataFrame, id_col: str,
                         max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, int | None]:
    """Catalog rows of the requested ids, and the counted number of distinct
    request ids when it is at most ``max_rows`` (else ``None``).

    A counted id list is broadcast into a semi-join; a longer one is joined
    with a shuffle on the id.
    """
    ids = requests.select(F.col(id_col)).distinct()
    n_ids = ids.limit(max_rows + 1).count()
    if n_ids <= max_rows:
        return flat.join(F.broadcast(ids), id_col, "left_semi"), n_ids
    return flat.join(ids, id_col, "left_semi"), None


def _needed_groups(rows: DataFrame, req: DataFrame, n_req: int | None, m: int,
                   max_rows: int) -> DataFrame:
    """Only the catalog's rows in groups some request belongs to.

    Whole groups are kept, so their heads are unchanged.  When the request
    keys are provably few (``n_req`` counted requests times ``2**m``) they are
    broadcast and the filter runs inside the fan-out stage, before any
    shuffle; otherwise nothing is filtered (a shuffled semi-join would move as
    many rows as the heads step itself).
    """
    if n_req is None or (n_req << m) > max_rows:
        return rows
    keys = req.select(*_group_cols()).distinct()
    return rows.join(F.broadcast(keys), _group_cols(), "left_semi")


def _pairs(req: DataFrame, heads: DataFrame, m: int, id_col: str,
           hot: DataFrame | None = None, build_heads: bool = True) -> DataFrame:
    """Join request rows to the heads of their groups.

    Shuffled hash join, heads as the build side: each heads partition is a
    small hash table (at most ``k + 1`` rows per key) and the request rows
    stream through it without being sorted.  ``hot`` lists the groups with
    too many request rows for one task (``_hot_groups``); their request rows
    are spread over ``_b`` salt buckets by request id and their heads are
    copied into every bucket, so each bucket's task gets a share of the rows
    and the same ``k + 1`` heads.  The result does not change.
    """
    keys = _group_cols()
    if hot is not None:
        req = (req.join(hot, keys, "left")
               .withColumn("_salt", F.when(F.col("_b").isNull(), F.lit(0))
                           .otherwise(F.pmod(F.xxhash64(F.col(id_col)), F.col("_b"))))
               .drop("_b"))
        heads = (heads.join(hot, keys, "left")
                 .withColumn("_salt", F.explode(
                     F.when(F.col("_b").isNull(), F.array(F.lit(0)))
                     .otherwise(F.sequence(F.lit(0), F.col("_b") - 1))))
                 .drop("_b"))
        keys = [*keys, "_salt"]
    r, h = req.alias("r"), (heads.hint("shuffle_hash") if build_heads else heads).alias("h")
    cond = [F.col(f"r.{c}") == F.col(f"h.{c}") for c in keys]
    pairs = r.join(h, cond).select(
        F.col(f"r.{id_col}").alias("request_sku"),
        F.col(f"h.{id_col}").alias(id_col),
        score_from_mask(F.col("r._s"), m).alias("score"))
    return pairs.filter(F.col("request_sku") != F.col(id_col))


def _hot_groups(req_items: DataFrame, req: DataFrame, names: Sequence[str],
                hot_group_rows: int | None, n_req: int | None = None) -> DataFrame | None:
    """Groups whose request rows would overload one join task, with their
    number of salt buckets ``_b``; ``None`` when no group can be that large.

    A group is hot above ``HOT_GROUP_FACTOR`` times the average number of
    request rows per shuffle partition (at least ``MIN_HOT_GROUP_ROWS``).  No
    group has more rows than there are requests, so when the requests are
    fewer than that nothing is counted.  Otherwise one aggregation, combined
    per task before its shuffle, counts the rows of every group.  At most
    ``fan-out / threshold <= partitions / HOT_GROUP_FACTOR`` groups can pass,
    which bounds the broadcast.
    """
    if hot_group_rows is None and n_req is not None and n_req <= MIN_HOT_GROUP_ROWS:
        return None  # counted requests, fewer than any threshold: nothing to check
    spark = req_items.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    present = sum((attr(n).isNotNull().cast("int") for n in names), F.lit(0))
    n_req, fan = req_items.agg(F.count(F.lit(1)),
                               F.sum(F.pow(F.lit(2), present).cast("bigint"))).first()
    n_req, fan = n_req or 0, fan or 0
    threshold = hot_group_rows or max(HOT_GROUP_FACTOR * fan // max(parts, 1),
                                      MIN_HOT_GROUP_ROWS)
    if n_req <= threshold:
        return None
    counts = req.groupBy(*_group_cols()).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > threshold).select(
        *_group_cols(), F.ceil(F.col("_n") / F.lit(threshold)).cast("int").alias("_b"))
    return F.broadcast(hot)


def candidate_pairs(flat: DataFrame, k: int, requests: DataFrame | None = None,
                    id_col: str = "sku", include_empty: bool = True,
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    materialize_index: bool = False,
                    hot_group_rows: int | None = None, min_level: int = 0,
                    max_level: int | None = None) -> DataFrame:
    """``(request_sku, sku, score)``: every head a request meets, with the score
    of the subset it was met through (a lower bound of its exact score).
    ``min_level``/``max_level`` restrict both sides to subsets of that size.

    ``materialize_index`` writes the heads to the shared checkpoint folder
    first (one extra write and read; worth it for long jobs on large
    clusters)."""
    names = attribute_names(flat, id_col)
    m = len(names)
    flat = _spread(flat, id_col)
    levels = dict(min_level=min_level, max_level=max_level)
    rows = subset_rows(flat, names, id_col, include_empty, **levels)
    n_req = None
    if requests is None:
        req_items, req = flat, rows
        heads = subset_heads(rows, k, id_col)
    else:
        req_items, n_req = _requests_in_catalog(flat, requests, id_col, max_broadcast_rows)
        req = subset_rows(req_items, names, id_col, include_empty, **levels)
        heads = subset_heads(_needed_groups(rows, req, n_req, m, max_broadcast_rows),
                             k, id_col)
    if materialize_index:
        heads = materialize(heads, "subset-heads")
    hot = _hot_groups(req_items, req, names, hot_group_rows, n_req)
    hashed = _fan_out(flat, names) <= MAX_HASHED_HEADS * int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _pairs(req, heads, m, id_col, hot, build_heads=hashed)


def class_rows(flat: DataFrame, names: Sequence[str], id_col: str) -> DataFrame:
    """One row per class, the items equal in all attributes: these, and the smallest id."""
    return flat.groupBy(*[attr(n) for n in names]).agg(F.min(id_col).alias(id_col))


def top_k_from_classes(pairs: DataFrame, classes: DataFrame, members: DataFrame, names: Sequence[str], k: int,
                       id_col: str, include_empty: bool) -> DataFrame:
    """The top ``k`` of all ``members`` from the ``pairs`` of their ``classes``' smallest ids.

    The best ``k + 1`` items for a class's values, its own among them, are the same
    for all of its members; each leaves itself out and takes the first ``k``.
    """
    m = len(names)
    present = sum((F.when(attr(n).isNotNull(), F.lit(bit_of(i, m))).otherwise(F.lit(0))
                   for i, n in enumerate(names)), F.lit(0).cast("bigint"))
    own = classes.select(F.col(id_col).alias("request_sku"), id_col, score_from_mask(present, m).alias("score"))
    own = own if include_empty else own.filter("score > 0")
    top = top_k_from_pairs(pairs.unionByName(own), k + 1, m, id_col)
    lists = top.groupBy("request_sku").agg(F.sort_array(F.collect_list(
        F.struct("rn", F.col(id_col).alias("id"), "score"))).alias("best"))
    lists = classes.withColumnRenamed(id_col, "_first").join(lists, F.col("_first") == lists["request_sku"]).select(
        *[attr(n).alias(f"_a{i}") for i, n in enumerate(names)], "best")
    items = members.select(F.col(id_col).alias("request_sku"), *[attr(n).alias(f"_b{i}") for i, n in enumerate(names)])
    same = [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(m)]
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("request_sku")), 1, k)
    met = items.join(lists, same).select("request_sku", F.posexplode(others).alias("at", "x"))
    score = F.col("x.score")
    return met.select("request_sku", (F.col("at") + 1).cast("int").alias("rn"), F.col("x.id").alias(id_col),
                      score.alias("score"), count_from_score(score, m).alias("match_count"),
                      mask_from_score(score, m).alias("mask"))


def top_k_from_pairs(pairs: DataFrame, k: int, m: int, id_col: str = "sku") -> DataFrame:
    """Best score per (request, candidate), then the top ``k`` per request.

    One shuffle on the request id serves both steps.
    """
    best = (pairs.repartition("request_sku")
            .groupBy("request_sku", id_col).agg(F.max("score").alias("score")))
    w = Window.partitionBy("request_sku").orderBy(F.desc("score"), F.asc(id_col))
    top = best.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    return top.select("request_sku", F.col("rn").cast("int").alias("rn"), id_col, "score",
                      count_from_score(F.col("score"), m).alias("match_count"),
                      mask_from_score(F.col("score"), m).alias("mask"))


def _results(top: DataFrame, m: int, id_col: str) -> DataFrame:
    """The result rows of a stored round of lists."""
    return top.select("request_sku", F.col("rn").cast("int").alias("rn"), F.col("id").alias(id_col), "score",
                      count_from_score(F.col("score"), m).alias("match_count"), mask_from_score(F.col("score"), m).alias("mask"))


def _packed_items(flat: DataFrame, names: Sequence[str], wanted: DataFrame | None, k: int,
                  id_col: str) -> tuple[DataFrame, list[Field], list[float]]:
    """``(id, codes, num)`` with unique ids, stored, with the items' values as numbers, where these are, and each
    attribute's share of equal pairs.  ``num`` is null for items that are not ``wanted``."""
    items = coded(flat, names, id_col).repartition(partitions(flat), "id")
    items = with_num(items, k) if wanted is None else items.join(
        wanted.select(F.col(id_col).alias("id"), "num"), "id", "left").select("id", "codes", "num")
    items = materialize(items, "batch-codes")
    share, values = repeated_values(items, len(names))
    items, fields = packed(items, values)
    return materialize(items, "batch-packed"), fields, share


def _by_blocks(items: DataFrame, asked: DataFrame, share: Sequence[float], k: int, id_col: str,
               fields: Sequence[Field] | None = None) -> tuple[list[DataFrame], DataFrame | None, DataFrame | None, int]:
    """Rounds of ``top_k_by_blocks`` over stored ``(id, codes)``, each for what the one before left.

    Gives the results of the finished requests, a table for each round; the unfinished
    requests (``None``: none are); what these have met so far; and the level of the last round
    (``m + 1``: no round was worth it).  A request with all the items it asks for that match on
    ``level`` attributes or more is finished, as no other item matches on as many.
    """
    if asked is items:
        items = asked = with_num(items, k)
    else:
        asked = with_num(asked, k)
    m, left, n = len(share), asked.filter("num IS NOT NULL").count(), items.count()
    done, carried, reached = [], None, m + 1
    levels = block_levels(m)
    while left and reached > levels[-1]:
        level = next_block_level(share, left, reached, MAX_COMPARED)
        if level is None:
            break
        top = materialize(top_k_by_blocks(items, asked, share, level, k, fields=fields), "batch-blocks")
        carried = top.filter("found < num").select("request_sku", F.col("id").alias(id_col), "score")
        finished, items, asked, left = settle(top, items, asked, left, n)
        done.append(_results(finished, m, id_col))
        reached = level
    unfinished = asked.filter("num IS NOT NULL").select(F.col("id").alias(id_col)) if left else None
    return done, unfinished, carried, reached


def _by_prefixes(items: DataFrame, fields: Sequence[Field], share: Sequence[float], k: int,
                 id_col: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Rounds of ``top_k_by_prefixes`` over the stored ``(id, codes, num)``: the results of the finished requests,
    and those left, which match fewer items than they ask for."""
    m, n = len(fields), items.count()
    order = sorted(range(m), key=lambda i: share[i])
    p = sum(((value_of(f) != 0).cast("int") for f in fields), F.lit(0))
    widths = {r[0]: r[1] for r in items.filter("num IS NOT NULL").groupBy(p.alias("p")).count().collect()}
    left = sum(widths.values())
    asked = items if 2 * left > n else materialize(items.filter("num IS NOT NULL"), "wide-asked")
    levels = prefix_levels(max(widths, default=0))
    costs, done, level = prefix_costs(items, fields, order, levels), [], levels[0] + 1
    while left and level > 1:
        level, size = next_prefixes(costs, level, left / n)
        n_rows = max(int(costs[level][size][0]), 1)
        top = materialize(top_k_by_prefixes(items, asked, fields, order, level, size, k, n_rows), "wide-prefixes")
        finished, items, asked, left = settle(top, items, asked, left, n)
        done.append(_results(finished, m, id_col))
    return done, asked.filter("num IS NOT NULL").select(F.col("id").alias(id_col)) if left else None


def _together(done: list[DataFrame], pairs: DataFrame | None, carried: DataFrame | None, k: int, m: int,
              id_col: str, wanted: DataFrame | None = None) -> DataFrame:
    """The rounds' results, and those of the unfinished from ``pairs`` and what is ``carried``."""
    if pairs is not None:
        pairs = pairs if carried is None else pairs.unionByName(carried)
        done = [*done, _as_wanted(top_k_from_pairs(pairs, k, m, id_col), wanted, id_col)]
    top = done[0]
    for more in done[1:]:
        top = top.unionByName(more)
    return top


def _as_wanted(top: DataFrame, wanted: DataFrame | None, id_col: str) -> DataFrame:
    """As many results as each request asks for."""
    if wanted is None:
        return top
    return top.join(wanted.withColumnRenamed(id_col, "request_sku"), "request_sku").filter(
        F.col("rn") <= F.col("num")).drop("num")


def _ids_repeat(flat: DataFrame, id_col: str) -> bool:
    return not flat.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _fan_out(flat: DataFrame, names: Sequence[str]) -> int:
    present = sum((attr(n).isNotNull().cast("int") for n in names), F.lit(0))
    return flat.agg(F.sum(F.pow(F.lit(2), present).cast("bigint"))).first()[0] or 0


def catalog_version(flat: DataFrame, id_col: str = "sku") -> str:
    """A digest of all rows: their number and the sum of their hashes."""
    columns = [attr(c).cast("string") for c in sorted(flat.columns)]
    n, total = flat.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def build_subset_index(flat: DataFrame, k: int, path: str | None = None, id_col: str = "sku",
                       include_empty: bool = True, unique_ids: bool = False) -> str:
    """Write the subset index of ``flat`` for up to ``k`` results and return its path.

    It holds the items themselves (``items``, sorted by id within its files), the
    heads of every subset group (``heads``, sorted by the group's key, so that
    a few keys read few row groups) and one row of what it was built for
    (``about``).  Built once, it answers any number of later requests.

    Where the fan-out is large (as for the two rounds of ``batch_top_k``) the heads are
    those of subsets below ``below`` attributes only, of which there are few, and the items'
    ``codes`` are stored, by which ``top_k_by_blocks`` finds matches on more attributes; ``fields`` tells where
    each attribute's value is in them.
    """
    spark = flat.sparkSession
    path = path or shared_path(spark, "subset-index")
    version = catalog_version(flat, id_col)
    flat = escaped(flat, id_col)
    names = attribute_names(flat, id_col)
    flat = flat if unique_ids else one_row_per_id(flat, id_col)
    flat.sortWithinPartitions(id_col).write.parquet(f"{path}/items")
    flat = spark.read.parquet(f"{path}/items")
    if not _fits_lattice(flat, names, MAX_LATTICE_ATTRIBUTES):
        raise ValueError(f"an item has more than {MAX_LATTICE_ATTRIBUTES} attributes; batch_top_k "
                         "answers requests on such a catalog without an index")
    below = share = fields = None
    if (k > 0 and len(names) >= TWO_ROUND_MIN_ATTRIBUTES and _fan_out(flat, names) >= TWO_ROUND_MIN_FANOUT
            and not (unique_ids and _ids_repeat(flat, id_col))):
        below = block_levels(len(names))[-1]
        codes = materialize(coded(_spread(flat, id_col), names, id_col), "index-values")
        share, values = repeated_values(codes, len(names))
        codes, fields = packed(codes, values)
        codes.write.parquet(f"{path}/codes")
    heads = subset_heads(subset_rows(_spread(flat, id_col), names, id_col, include_empty,
                                     max_level=None if below is None else below - 1), k, id_col)
    heads.sortWithinPartitions(*_group_cols()).write.parquet(f"{path}/heads")
    about = [(k, names, id_col, include_empty, version, below, share, fields)]
    spark.createDataFrame(about, "k int, names array<string>, id_col string, include_empty boolean, "
                          "version string, below int, share array<double>, "
                          "fields array<struct<word: int, shift: int, bits: int>>").write.parquet(f"{path}/about")
    return path


def top_k_from_index(spark: SparkSession, path: str, requests: DataFrame, k: int,
                     flat: DataFrame | None = None, include_empty: bool = True) -> DataFrame:
    """Answer ``requests`` from the subset index at ``path``.

    A larger ``k`` than the index has, another ``include_empty`` or, where
    ``flat`` is given, another catalog raises a ValueError.  Only the requests
    are fanned out; while their rows are counted to be few they are broadcast
    into the scan of the stored heads, which then never move.
    """
    about = spark.read.parquet(f"{path}/about").first()
    id_col, names = about["id_col"], list(about["names"])
    if k > about["k"] or include_empty != about["include_empty"]:
        raise ValueError(f"the index is for k <= {about['k']} and include_empty={about['include_empty']}")
    if flat is not None and catalog_version(flat, id_col) != about["version"]:
        raise ValueError("the index is of another catalog")
    m = len(names)
    items, heads = spark.read.parquet(f"{path}/items"), spark.read.parquet(f"{path}/heads")
    by_blocks = about["below"] is not None and k > 0
    req_items, n_req = _requests_in_catalog(items.select(id_col) if by_blocks else items, requests, id_col)
    req_items = materialize(req_items, "index-requests")
    done, carried = [], None
    if by_blocks:
        codes, ids = spark.read.parquet(f"{path}/codes"), req_items.select(F.col(id_col).alias("id"))
        if 2 * ids.count() > codes.count():
            # Most items are asked for: they are sent once, the asked ones with a num.
            asking = ids.withColumn("num", F.lit(k).cast("int"))
            codes = asked = materialize(codes.join(asking, "id", "left").select("id", "codes", "num"), "index-codes")
        else:
            asked = materialize(codes.join(ids, "id", "left_semi"), "index-codes")
        fields = [Field(*f) for f in about["fields"]]
        done, unfinished, carried, reached = _by_blocks(codes, asked, about["share"], k, id_col, fields)
        if unfinished is None and done:
            return _together(done, None, None, k, m, id_col)
        if unfinished is not None and reached > about["below"]:
            # The stored heads don't reach up to the last round.
            pairs = candidate_pairs(items, k, unfinished, id_col, include_empty, max_level=reached - 1)
            return _together(done, pairs, carried, k, m, id_col)
        req_items = materialize(items.join(req_items if unfinished is None else unfinished, id_col, "left_semi"),
                                "index-unfinished")
    highest = None if about["below"] is None else about["below"] - 1
    req = subset_rows(req_items, names, id_col, include_empty, max_level=highest)
    if _fan_out(req_items, names) <= MAX_BROADCAST_ROWS:
        pairs = _pairs(F.broadcast(req), heads, m, id_col, build_heads=False)
    else:
        pairs = _pairs(req, heads, m, id_col, _hot_groups(req_items, req, names, None, n_req))
    return _together(done, pairs, carried, k, m, id_col)


def _wide_top_k(flat: DataFrame, names: Sequence[str], k: int, wanted: DataFrame | None, id_col: str,
                include_empty: bool, unique_ids: bool) -> DataFrame:
    """The result of ``batch_top_k`` for items of any width; ``flat`` is stored, ids are unique and not null.

    Where many pairs share a value, rounds by prefixes come first; posting lists answer what these leave,
    and catalogs with more names than a mask's bits."""
    m = len(names)
    if 0 < k and m <= MAX_BIGINT_ATTRIBUTES and not (unique_ids and _ids_repeat(flat, id_col)):
        items, fields, share = _packed_items(flat, names, wanted, k, id_col)
        if sum(share) * items.count() ** 2 >= MIN_PREFIX_PAIRS:
            done, left = _by_prefixes(items, fields, share, k, id_col)
            if left is not None:
                left = with_num(left, k) if wanted is None else left.join(wanted, id_col)
                done.append(_by_postings(flat, names, k, materialize(left, "wide-left"), id_col, include_empty))
            if done:
                return _together(done, None, None, k, m, id_col)
    return _by_postings(flat, names, k, wanted, id_col, include_empty)


def _by_postings(flat: DataFrame, names: Sequence[str], k: int, wanted: DataFrame | None, id_col: str,
                 include_empty: bool) -> DataFrame:
    """The result of ``batch_top_k`` by posting lists."""
    m = len(names)
    present = F.filter(F.array(*[F.when(attr(n).isNotNull(), F.struct(
        F.lit(i).alias("at"), F.xxhash64(F.lit(i), attr(n).cast("string")).alias("key")))
        for i, n in enumerate(names)]), lambda x: x.isNotNull())
    items = materialize(flat.select(F.col(id_col).alias("id"), F.transform(present, lambda x: x["key"]).alias("keys"),
                                    F.transform(present, lambda x: x["at"]).alias("at")), "wide-items")
    asked = items.select(F.col("id").alias("request"), "keys", "at")
    if wanted is not None:
        ids = wanted.select(F.col(id_col).alias("request"))
        asked = materialize(asked.join(ids, "request", "left_semi"), "wide-requests")
    top = top_k_by_postings(items.select("id", "keys"), asked, k, include_empty)
    top = top.join(asked.select("request", "at"), "request")
    matched = F.transform("places", lambda p: F.get("at", p))
    if m > MAX_BIGINT_ATTRIBUTES:
        mask = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.when(
            F.array_contains("matched", i), "1").otherwise("0")), "")
    else:
        mask = F.aggregate("matched", F.lit(0).cast("bigint"), lambda a, i: a + F.pow(
            F.lit(2.0), F.lit(m - 1) - i).cast("bigint"))
    top = top.withColumn("matched", matched).withColumn("mask", mask)
    top = top.select(F.col("request").alias("request_sku"), F.col("rn").cast("int").alias("rn"),
                     F.col("id").alias(id_col), score_from_mask(F.col("mask"), m).alias("score"),
                     F.size("places").alias("match_count"), "mask")
    return _as_wanted(top, wanted, id_col)


def batch_top_k(flat: DataFrame, k: int = 10, requests: DataFrame | None = None,
                id_col: str = "sku", include_empty: bool = True,
                max_attributes: int = MAX_LATTICE_ATTRIBUTES,
                materialize_index: bool = False,
                hot_group_rows: int | None = None,
                split_level: int | None = None, unique_ids: bool = False) -> DataFrame:
    """Top ``k`` similar items for every request (all catalog items by default).

    ``requests`` may have a column ``num`` with each request's own number of
    results, up to ``k`` (null: ``k``; of several rows for an id the largest).
    Null ids are neither items nor requests, and one row per id counts;
    ``unique_ids`` tells that the ids are unique and saves that check.

    Result: ``request_sku, rn, sku, score, match_count, mask`` with ``rn``
    from 1 (best) to ``k``, ordered by ``score desc, sku asc``, the same
    order as ``top_k_similar``.  Requests whose id is not in the catalog are
    left out; ``missing_requests`` lists them.  ``include_empty=False`` keeps
    only candidates with at least one match (``batch_top_k_indexed``).

    With at least ``TWO_ROUND_MIN_ATTRIBUTES`` attributes, a fan-out of at least
    ``TWO_ROUND_MIN_FANOUT`` rows and requests too many for the few-requests pruning
    of ``candidate_pairs``, rounds of ``top_k_by_blocks`` come first, which
    send an item once per block of attributes instead of once per subset; only
    requests they leave unfinished meet the heads of the smaller subsets.

    Two rounds of heads (``split_level``, or where the blocks' lists are too long; else one
    round; ``0`` turns it off).  Small subsets make big groups, whose heads are mostly poor
    candidates and make up most of the candidate rows.  Round 1 uses only
    subsets of at least ``split_level`` attributes.  A request that finds
    ``k`` candidates there is finished: those ``k`` items match it on at least
    ``split_level`` attributes, so its whole top ``k`` does, and each of those
    is met through its own exact match set, which round 1 covers.  Only the
    unfinished requests run round 2 over the smaller subsets, together with
    the candidates they already have.  Round 1's result is written to the
    shared checkpoint folder, so it runs once and later steps start from
    stored files.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    wanted = None
    if requests is not None:
        # The requests are read several times (counted, joined, split into
        # finished and unfinished); store them once so their lineage runs once.
        num = F.least(F.coalesce("num", F.lit(k)), F.lit(k)) if "num" in requests.columns else F.lit(k)
        wanted = materialize(requests.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
            F.max(num).cast("int").alias("num")).filter("num > 0"), "batch-requests")
        plain, requests = "num" not in requests.columns, wanted.select(id_col)
    flat = escaped(flat, id_col)
    names = attribute_names(flat, id_col)
    m = len(names)
    # The choice of one row per id is stored, as both fan-outs start from it.
    flat = (flat.filter(F.col(id_col).isNotNull()) if unique_ids
            else materialize(one_row_per_id(flat, id_col), "batch-items"))
    if unique_ids and max_attributes < m <= MAX_BIGINT_ATTRIBUTES:
        # It is aggregated before it is fanned out.
        flat = materialize(flat, "batch-flat")
    if not _fits_lattice(flat, names, max_attributes):
        return _wide_top_k(flat, names, k, wanted, id_col, include_empty, unique_ids)
    lowest = 0 if include_empty else 1
    auto_split = split_level is None
    if auto_split:
        # Three fifths of the attributes (6 of 10): on part10 at sf0.1 this
        # beats half (5 of 10) by about 20%, as the first round gets cheaper
        # while nearly every request still finishes in it.
        split_level = (3 * m + 4) // 5 if m >= TWO_ROUND_MIN_ATTRIBUTES else 0
    split = split_level
    common = dict(id_col=id_col, include_empty=include_empty,
                  materialize_index=materialize_index, hot_group_rows=hot_group_rows)
    if requests is not None:
        n_asked = wanted.count()
        if auto_split and (n_asked << m) <= MAX_BROADCAST_ROWS:
            # Few requests: one round, whose heads are built only for the
            # groups these requests are in, beats fanning the catalog out twice.
            split = 0
        elif 2 * n_asked > flat.count() and (not auto_split or split <= lowest
                                             or _fan_out(flat, names) < TWO_ROUND_MIN_FANOUT):
            # Most items are asked for: all are answered, and the others left out.
            top = batch_top_k(flat, k, None, id_col, include_empty, max_attributes, materialize_index,
                              hot_group_rows, None if auto_split else split_level, True)
            return _as_wanted(top, wanted, id_col)
        wanted = None if plain else wanted
    elif auto_split and split > lowest:
        if _fan_out(flat, names) < TWO_ROUND_MIN_FANOUT:
            # A small fan-out is cheaper to finish in one round than to
            # split into two rounds' worth of jobs.
            split = 0
    if (auto_split and requests is None and 0 < k < MAX_GROUP_LIMIT and names and m < TWO_ROUND_MIN_ATTRIBUTES
            and _fan_out(flat, names) > MAX_BROADCAST_ROWS):
        flat = materialize(flat, "batch-flat")
        classes = materialize(class_rows(flat, names, id_col), "batch-classes")
        if 2 * classes.count() <= flat.count() and not (unique_ids and _ids_repeat(flat, id_col)):
            # A group is made of classes, so its smallest ids are among theirs.
            order = Window.partitionBy(*[attr(n) for n in names]).orderBy(id_col)
            firsts = flat.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1).drop("_r")
            pairs = candidate_pairs(materialize(firsts, "batch-firsts"), k, classes.select(id_col), **common)
            return top_k_from_classes(pairs, classes, flat, names, k, id_col, include_empty)
    if k == 0 or split <= lowest or split > m:
        return _as_wanted(top_k_from_pairs(candidate_pairs(flat, k, requests, **common), k, m, id_col), wanted, id_col)
    if auto_split and not (unique_ids and _ids_repeat(flat, id_col)):
        asking = None if requests is None else with_num(wanted if wanted is not None else requests, k)
        items, fields, share = _packed_items(flat, names, asking, k, id_col)
        asked = items if requests is None or 2 * n_asked > items.count() else materialize(
            items.filter("num IS NOT NULL"), "batch-asked")
        done, unfinished, carried, reached = _by_blocks(items, asked, share, k, id_col, fields)
        if done:
            pairs = None if unfinished is None else candidate_pairs(
                flat, k, unfinished, max_level=reached - 1, **common)
            return _together(done, pairs, carried, k, m, id_col, wanted)

    round1 = materialize(
        top_k_from_pairs(candidate_pairs(flat, k, requests, min_level=split, **common),
                         k, m, id_col), "batch-round1")
    finished = round1.filter(F.col("rn") == k).select("request_sku")
    asked = (flat.select(F.col(id_col).alias("request_sku")) if requests is None else
             requests.select(F.col(id_col).alias("request_sku"))).distinct()
    unfinished = (asked.join(finished, "request_sku", "left_anti")
                  .select(F.col("request_sku").alias(id_col)))
    carried = (round1.join(finished, "request_sku", "left_anti")
               .select("request_sku", id_col, "score"))
    pairs2 = candidate_pairs(flat, k, unfinished, max_level=split - 1, **common)
    round2 = top_k_from_pairs(pairs2.unionByName(carried), k, m, id_col)
    return _as_wanted(round1.join(finished, "request_sku", "left_semi").unionByName(round2), wanted, id_col)


def batch_top_k_indexed(flat: DataFrame, k: int = 10, requests: DataFrame | None = None,
                        id_col: str = "sku", max_attributes: int = MAX_LATTICE_ATTRIBUTES,
                        unique_ids: bool = False) -> DataFrame:
    """``batch_top_k`` restricted to candidates sharing at least one attribute
    value with the request: the empty subset is not indexed, so a request
    with fewer than ``k`` matching items gets fewer than ``k`` rows."""
    return batch_top_k(flat, k, requests, id_col, include_empty=False,
                       max_attributes=max_attributes, unique_ids=unique_ids)


def missing_requests(flat: DataFrame, requests: DataFrame, id_col: str = "sku") -> DataFrame:
    """Distinct request ids that are not in the catalog (anti join on the id)."""
    ids = requests.select(F.col(id_col)).filter(F.col(id_col).isNotNull()).distinct()
    # Both sides are made distinct first (combined per task before the
    # shuffle), so an id repeated on many rows cannot overload one task.
    return ids.join(flat.select(id_col).distinct(), id_col, "left_anti")
