"""Top k for many requests over items of any width and any names, by posting lists.

An item is a set of keys, one per present attribute: a 64-bit hash of the attribute
and its value (among ``n`` distinct ones the chance that any two agree is about
``n**2 / 2**65``).  The posting list of a key holds the items that have it.

A request meets the items of its lists, the rarest list first.  Once it has met all
but ``r`` of its lists, an item not met yet matches it in at most ``r`` attributes.  So
with ``c`` as the count of its k-th best item so far, no unmet item can get into the
top k as soon as ``r < c``, and the remaining lists, which are the longest, are never
read for it.  That takes two rounds:

1. Each request meets the rarest third of its lists.  The k-th best item met gives
   ``c``, which the final k-th best can only exceed.
2. It meets its further lists up to number ``p - c + 1`` of ``p``, and only items that
   match in ``c`` attributes or more are passed on.

The result is exact and no pair of items without a common rare value is ever made.

A list and the requests that read it meet in one group of ``cogroup``.  Groups are
bounded: many short lists share one, a long list is cut into blocks of items and of
requests, and every pair of blocks is a group.  A group passes on at most ``k`` items of
a request, so pairs of items are never rows.

That sends an item's keys to each of its lists, the square of their number.  So a request
whose lists are all short takes another way (``top_k_by_short_lists``): its lists come to it,
as ids only, and how often and where an id comes is what it shares.  One round
is the whole result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..plans.session import materialize, ship_package
from ..plans.sizing import broadcast_if_small
from ..plans.skew import join_counted, partitions

# Keys of the items of one group, 8 bytes each.
GROUP_KEYS = 1 << 20
# Ids of the lists of one group, 8 bytes each.
GROUP_IDS = 1 << 21
# A list is short up to this many times the keys of an item on average: its ids, once
# for each of its items, are then no more than these items' keys, which are sent three times.
SHORT_FACTOR = 4
_BITS = 62


def posting_rows(items: DataFrame) -> DataFrame:
    """``(key, id, keys)``: every item once for each of its keys."""
    return items.select(F.explode("keys").alias("key"), "id", "keys")


def list_sizes(items: DataFrame) -> DataFrame:
    """``(key, n)`` of the lists with several items; a list of one holds nobody else."""
    return items.select(F.explode("keys").alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1")


def _segments(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a column's rows one after the other, and where each row's begin and end."""
    lengths = pc.list_value_length(column).to_numpy()
    return pc.list_flatten(column).to_numpy(), np.append(0, np.cumsum(lengths))


def _ranks(ids: list) -> np.ndarray:
    """The place of each id in their order."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    ranks = np.empty(len(ids), np.int64)
    ranks[order] = np.arange(len(ids))
    return ranks


def meet(items: pa.Table, requests: pa.Table, k: int) -> tuple[list, list, list[list[int]]]:
    """The best ``k`` items of each request from each of the lists in a group, as requests,
    items and the places of the request's keys that match."""
    out: tuple[list, list, list] = [], [], []
    if not items.num_rows or not requests.num_rows:
        return out
    items = items.sort_by("key")
    list_of = items.column("key").to_numpy()
    ids = items.column("id").to_pylist()
    ranks = _ranks(ids)
    flat, borders = _segments(items.column("keys"))
    known, local = np.unique(flat, return_inverse=True)
    asked, asked_borders = _segments(requests.column("asked"))
    lists = requests.column("list").to_numpy()
    least = requests.column("least").to_numpy()
    first, last = np.searchsorted(list_of, lists), np.searchsorted(list_of, lists, side="right")
    weight = np.zeros(len(known), np.uint64)
    for r, request in enumerate(requests.column("request").to_pylist()):
        a, b = int(first[r]), int(last[r])
        if a == b:
            continue
        own = asked[asked_borders[r]:asked_borders[r + 1]]
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        inside = known[at] == own
        part, starts = local[borders[a]:borders[b]], borders[a:b] - borders[a]
        masks, counts = [], np.zeros(b - a, np.int64)
        # The keys of an item differ, so adding their bits joins them.
        for low in range(0, len(own), _BITS):
            some = np.flatnonzero(inside[low:low + _BITS])
            weight[at[low + some]] = np.uint64(1) << (_BITS - 1 - some).astype(np.uint64)
            masks.append(np.add.reduceat(weight[part], starts))
            weight[at[low + some]] = 0
            counts += np.bitwise_count(masks[-1])
        can = np.flatnonzero(counts >= max(int(least[r]), 1))
        if len(can) > k + 1:
            # One more than k, as the request itself is among them.
            enough = np.partition(counts[can], len(can) - k - 1)[len(can) - k - 1]
            can = can[counts[can] >= enough]
        order = np.lexsort((ranks[a:b][can], *[~m[can] for m in masks[::-1]], -counts[can]))
        left = k
        for x in can[order][:k + 1].tolist():
            if ids[a + x] == request or not left:
                continue
            left -= 1
            out[0].append(request)
            out[1].append(ids[a + x])
            out[2].append([w * _BITS + j for w, m in enumerate(masks) for j in range(min(_BITS, len(own) - w * _BITS))
                           if int(m[x]) >> (_BITS - 1 - j) & 1])
    return out


def _round(items: DataFrame, requests: DataFrame, wanted: DataFrame, total: int, per_item: float,
           k: int) -> DataFrame:
    """``(request, id, places)``: what the requests meet in their ``wanted`` lists
    (``request, key, n, least``)."""
    spark = items.sparkSession
    block = max(int(GROUP_KEYS / max(per_item, 1.0)), 1)
    lists = wanted.groupBy("key").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("r"))
    lists = materialize(lists.select("key", "n", "r", F.ceil(F.col("n") / block).cast("int").alias("item_blocks"),
                                     F.ceil(F.col("r") / block).cast("int").alias("request_blocks")), "posting-lists")
    sums = lists.agg(F.sum("n"), F.sum("r")).first()
    bins = max(-(-(sums[0] or 0) // block), partitions(items))

    def one_of(column: str, blocks: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), column), F.col(blocks)).cast("int")

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    bin_of = F.pmod(F.xxhash64("key"), F.lit(bins)).alias("bin")
    left = join_counted(posting_rows(items), lists, "key", "n", total)
    left = left.select("key", "id", "keys", bin_of, one_of("id", "item_blocks").alias("i"), each("request_blocks").alias("j"))
    right = join_counted(wanted.select("request", "key", "least"), lists.drop("n"), "key", "r", sums[1] or 0)
    right = right.join(requests.select("request", "keys"), "request")
    right = right.select(F.col("key").alias("list"), "request", F.col("keys").alias("asked"), "least", bin_of, one_of("request", "request_blocks").alias("j"),
                         each("item_blocks").alias("i"))
    ship_package(spark)
    id_type = items.schema["id"].dataType
    schema = StructType([StructField("request", id_type), StructField("id", id_type),
                         StructField("places", ArrayType(IntegerType()))])

    def best_of_group(_key, own: pa.Table, asking: pa.Table) -> pa.Table:
        found, kind = meet(own, asking, k), own.schema.field("id").type
        return pa.table([pa.array(found[0], kind), pa.array(found[1], kind), pa.array(found[2], pa.list_(pa.int32()))],
                        ["request", "id", "places"])

    return left.groupBy("bin", "i", "j").cogroup(right.groupBy("bin", "i", "j")).applyInArrow(best_of_group, schema)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each request, numbered: more matches first, then matches at earlier
    places, then the smaller id."""
    # An item met in several lists is the same row each time.
    once = pairs.groupBy("request", "id").agg(F.max("places").alias("places"))
    order = Window.partitionBy("request").orderBy(F.desc(F.size("places")), "places", "id")
    return once.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def short_lists(items: DataFrame, most: int) -> DataFrame:
    """``(key, members)`` of the lists with several items: ``members`` are the ids, ascending, and the
    key's place among the item's keys; of a list of more than ``most`` the first ``most + 1``."""
    entries = items.select("id", F.posexplode("keys").alias("place", "key"))
    by_key = Window.partitionBy("key").orderBy("id")
    first = entries.withColumn("r", F.row_number().over(by_key)).filter(F.col("r") <= most + 1)
    lists = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "place"))).alias("members"))
    return lists.filter(F.size("members") > 1)


def best_of_lists(rows: pa.Table, k: int) -> tuple[pa.Array, np.ndarray, pa.Array, list[np.ndarray]]:
    """Requests, the numbers and the items of their best ``k`` and the places these match at, from
    the rows ``(request, place, ids)`` of whole requests."""
    flat = pc.list_flatten(rows.column("ids")).combine_chunks()
    lengths = pc.list_value_length(rows.column("ids")).to_numpy()
    asking = rows.column("request").combine_chunks()
    coded = pa.concat_arrays([asking, flat]).dictionary_encode()
    by_id = pc.array_sort_indices(coded.dictionary)
    known, ranks = coded.dictionary.take(by_id), np.empty(len(by_id), np.int64)
    ranks[by_id.to_numpy()] = np.arange(len(by_id))
    own = ranks[coded.indices.to_numpy()]
    requests, request = np.unique(own[:len(asking)], return_inverse=True)
    request, item = np.repeat(request, lengths), own[len(asking):]
    place = np.repeat(rows.column("place").to_numpy().astype(np.int64), lengths)
    other = requests[request] != item
    request, item, place = request[other], item[other], place[other]
    width, places = max(len(known), 1), int(place.max(initial=0)) + 1
    fits = len(requests) * width * places < 1 << 63
    # One row after the other for each place of a pair.
    if fits:
        pair, place = np.divmod(np.sort((request * width + item) * places + place), places)
    else:
        pair = request * width + item
        order = np.lexsort((place, pair))
        pair, place = pair[order], place[order]
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(pair)))
    request, item = np.divmod(pair[starts], width)
    left, out = np.full(len(requests), k, np.int64), []
    # More matches first, of equal counts matches at earlier places, then the smaller id.
    for count in np.unique(counts)[::-1].tolist():
        some = np.flatnonzero((counts == count) & (left[request] > 0))
        if count == 1 and fits:
            some = some[np.argsort((request[some] * places + place[starts[some]]) * width + item[some])]
        else:
            some = some[np.lexsort((item[some], *[place[starts[some] + d] for d in range(count - 1, -1, -1)],
                                    request[some]))]
        found = np.bincount(request[some], minlength=len(left))
        rank = np.arange(len(some)) - (np.cumsum(found) - found)[request[some]]
        can = rank < left[request[some]]
        some, rank = some[can], rank[can]
        out.append((some, k - left[request[some]] + rank + 1))
        left -= np.minimum(found, left)
    best = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
    rn = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
    matched = [place[a:a + n] for a, n in zip(starts[best].tolist(), counts[best].tolist())]
    return known.take(pa.array(requests[request[best]])), rn, known.take(pa.array(item[best])), matched


def top_k_by_short_lists(lists: DataFrame, ids: DataFrame | None, k: int) -> DataFrame:
    """``(request, rn, id, places)``: the best ``k`` items that the requests ``ids`` (column ``request``;
    all items where ``None``) meet in ``lists``, a stored table of ``short_lists``, in which are all of
    these requests' lists."""
    spark = lists.sparkSession
    n = F.size("members").cast("bigint")
    pairs = lists.agg(F.sum(n * n)).first()[0] or 0
    bins = max(-(-pairs // GROUP_IDS), partitions(lists))
    rows = lists.select(F.explode("members").alias("m"), F.col("members.id").alias("ids")).select(
        F.col("m.id").alias("request"), F.col("m.place").alias("place"), "ids")
    rows = rows if ids is None else rows.join(ids, "request", "left_semi")
    ship_package(spark)
    id_type = rows.schema["request"].dataType
    schema = StructType([StructField("request", id_type), StructField("rn", IntegerType()),
                         StructField("id", id_type), StructField("places", ArrayType(IntegerType()))])

    def best_of_group(table: pa.Table) -> pa.Table:
        request, rn, item, places = best_of_lists(table, k)
        flat = np.concatenate(places) if places else np.zeros(0, np.int32)
        borders = np.append(0, np.cumsum([len(p) for p in places])).astype(np.int32)
        return pa.table([request, pa.array(rn, pa.int32()), item, pa.ListArray.from_arrays(
            pa.array(borders, pa.int32()), pa.array(flat, pa.int32()))], ["request", "rn", "id", "places"])

    bin_of = F.pmod(F.xxhash64(F.lit(2), "request"), F.lit(bins))
    return rows.groupBy(bin_of.alias("bin")).applyInArrow(best_of_group, schema)


def wanted_lists(items: DataFrame, requests: DataFrame) -> tuple[DataFrame, int, float]:
    """``(request, key, n, rank, p)``: each request's lists from the rarest on, with its
    number of lists ``p``; the sum of all lists' sizes, and the keys of an item on average."""
    sizes = materialize(list_sizes(items), "posting-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    asked = requests.select("request", F.explode("keys").alias("key"))
    ranked = join_counted(asked, sizes, "key", "n", total)
    by_request = Window.partitionBy("request")
    ranked = ranked.withColumn("rank", F.row_number().over(by_request.orderBy("n", "key"))).withColumn(
        "p", F.count(F.lit(1)).over(by_request))
    per_item = items.agg(F.avg(F.size("keys"))).first()[0] or 0.0
    return materialize(ranked, "posting-ranked"), total, per_item


def _by_rounds(items: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """``(request, rn, id, places)``: the best ``k`` other items with a match, in two rounds."""
    ranked, total, per_item = wanted_lists(items, requests)
    first = F.ceil(F.col("p") / 3)
    one = ranked.filter(F.col("rank") <= first).select("request", "key", "n", F.lit(1).alias("least"))
    top = materialize(_ranked(_round(items, requests, one, total, per_item, k), k), "posting-round1")
    kth = top.filter(F.col("rn") == k).select("request", F.size("places").alias("least"))
    two = ranked.join(kth, "request", "left").withColumn("least", F.coalesce("least", F.lit(0)))
    two = two.filter((F.col("rank") > first) & (F.col("rank") <= F.col("p") - F.col("least") + 1))
    two = materialize(two.select("request", "key", "n", "least"), "posting-wanted2")
    pairs = top.drop("rn").unionByName(_round(items, requests, two, total, per_item, k))
    return _ranked(pairs, k)


def top_k_by_postings(items: DataFrame, requests: DataFrame, k: int, include_empty: bool = True) -> DataFrame:
    """``(request, rn, id, places)``: the best ``k`` other items of every request.

    ``items`` has ``id, keys`` and ``requests`` ``request, keys`` with the keys in order of
    their weight; both are stored tables, ids are unique and not null, and a request is an
    item's id.  ``places`` are the places of the request's keys that the item has.  With
    ``include_empty`` items without a match fill up what is left, the smallest ids first.
    """
    most = max(int(SHORT_FACTOR * (items.agg(F.avg(F.size("keys"))).first()[0] or 0.0)), 1)
    lists = materialize(short_lists(items, most), "posting-short")
    long = lists.filter(F.size("members") > most).select("key")
    every = requests.count() == items.count()
    if long.isEmpty():
        top = top_k_by_short_lists(lists, None if every else requests.select("request"), k)
    else:
        asked = requests.select("request", F.explode("keys").alias("key"))
        far = asked.join(broadcast_if_small(long), "key", "left_semi").select("request").distinct()
        far = materialize(far, "posting-far")
        near = materialize(requests.select("request").join(far, "request", "left_anti"), "posting-near")
        top = _by_rounds(items, materialize(requests.join(far, "request", "left_semi"), "posting-asked"), k)
        if not near.isEmpty():
            short = lists.filter(F.size("members") <= most)
            top = top.unionByName(top_k_by_short_lists(short, near, k))
    if include_empty:
        top = materialize(top, "posting-round2")
        # At most k - 1 of the smallest ids match and one is the request's own.
        smallest = items.select("id").orderBy("id").limit(2 * k).agg(F.collect_list("id").alias("ids"))
        some = top.groupBy("request").agg(F.count(F.lit(1)).alias("found"))
        short = requests.select("request").join(some, "request", "left").filter(
            F.coalesce("found", F.lit(0)) < k).select("request", F.lit(1).alias("one"))
        fill = (short.join(F.broadcast(smallest.withColumn("one", F.lit(1))), "one")
                .select("request", F.explode("ids").alias("id"), F.array().cast("array<int>").alias("places"))
                .filter("request != id"))
        filled = _ranked(top.join(short, "request", "left_semi").drop("rn").unionByName(fill), k)
        top = top.join(short, "request", "left_anti").unionByName(filled)
    return top.select("request", "rn", "id", "places")
