"""Top k for many requests by lists of items that share some values, for matches on many attributes.

Two ways give the lists for the matches on ``level`` attributes or more.

- *Blocks*, for few attributes.  An item that equals a request on ``level`` of ``m`` attributes
  differs on ``m - level`` at most.  So of any ``m - level + 1`` disjoint blocks of attributes it
  equals the request on one whole block.
- *Prefixes*, for wide items.  With the attributes in one order for all items, the first ``size``
  attributes two items agree on are among the first ``p - level + size`` of the ``p`` that each has,
  as ``level - size`` more follow.  So they meet in the list of these ``size`` values.

It is enough to compare a request with the items in its lists.  Items go to a task once per
list, not once per subset, and are compared there on all attributes at once.

A pair that shares several lists counts in the first of them only.  A list passes on at most
as many items of a request as it asks for, so pairs are never rows.  Many short lists share a group;
a long list is cut into parts, and every pair of parts is a group.

A value is told by a 64-bit hash (see ``operators.postings``), which for attributes with few
values is replaced by a number of a few bits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from itertools import combinations
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..functions.columns import attr, bit_of, score_from_mask
from ..plans.session import materialize, ship_package
from ..plans.skew import partitions

# Rows of one side of a group, pairs compared at once in it, pairs kept in it between two cuts, and items of
# a long list that are looked at first.
GROUP_ROWS = 1 << 14
PAIRS = 1 << 15
HELD = 1 << 21
FIRST_SEEN = 512
# Comparisons per item up to which a round takes a lower level at once, and that are worth less than the fan-out
# to all subsets.
CHEAP_COMPARED = 1 << 15
MAX_COMPARED = 1 << 18
# Levels below are left to the subsets, which are few there.
LOWEST_LEVEL = 3
# Repeated values of an attribute, and of all, up to which they get numbers.
MAX_VALUES = 1 << 16
MAX_ALL_VALUES = 1 << 18
# Values that make a list of a prefix at most, lists of an item on average at most, items that
# are sampled to choose among them, comparisons that cost as much as a row sent, and those that
# cost less than a further round.
MAX_SIZE = 3
MAX_LISTS = 32
SAMPLED = 1500
ROW_PAIRS = 600
CHEAP_ROUND = 1 << 33


def block_levels(m: int) -> list[int]:
    """The numbers of matching attributes that rounds ask for, one after the other."""
    return list(range(-(-7 * m // 10), LOWEST_LEVEL - 1, -2))


def coded(flat: DataFrame, names: Sequence[str], id_col: str) -> DataFrame:
    """``(id, codes)``: the hash of each attribute's value, 0 for none."""
    codes = [F.when(attr(n).isNotNull(), F.xxhash64(F.lit(i), attr(n).cast("string"))).otherwise(F.lit(0))
             for i, n in enumerate(names)]
    return flat.select(F.col(id_col).alias("id"), F.array(*codes).alias("codes"))


def shares(items: DataFrame, m: int) -> list[float]:
    """For each attribute the share of the pairs of items that agree on it."""
    at = items.select(F.posexplode("codes").alias("at", "code")).filter("code != 0")
    counts = at.groupBy("at", "code").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = {r[0]: r[1] for r in counts.groupBy("at").agg(F.sum(F.col("n") * F.col("n"))).collect()}
    n = max(items.count(), 1)
    return [sums.get(i, 0.0) / n / n for i in range(m)]


def blocks_of(share: Sequence[float], level: int) -> list[list[int]]:
    """The attributes in ``m - level + 1`` blocks of about equal selectivity."""
    blocks: list[list[int]] = [[] for _ in range(len(share) - level + 1)]
    weight = [1.0] * len(blocks)
    for i in sorted(range(len(share)), key=lambda i: share[i]):
        b = max(range(len(blocks)), key=lambda b: (not blocks[b], weight[b]))
        blocks[b].append(i)
        weight[b] *= share[i]
    return blocks


def compared_share(share: Sequence[float], level: int) -> float:
    """About the share of the items that a request is compared with."""
    return float(sum(np.prod([share[i] for i in block]) for block in blocks_of(share, level)))


def next_block_level(share: Sequence[float], left: int, reached: int, max_compared: int) -> int | None:
    """The level of the round after that of level ``reached`` (none yet: above ``len(share)``), with ``left`` requests:
    ``None`` if all meet too many items.

    The first round takes the lowest level from ``block_levels`` up that is cheap, as the more items there are the more
    of them match on many attributes; the others go two attributes down, or one if that is not cheap.
    """
    m, levels = len(share), block_levels(len(share))
    tries = list(range(levels[0], m + 1)) if reached > m else [x for x in (reached - 2, reached - 1) if x >= levels[-1]]
    compared = [left * compared_share(share, level) for level in tries]
    cheap = [level for level, n in zip(tries, compared) if n <= min(CHEAP_COMPARED, max_compared)]
    if cheap:
        return cheap[0]
    return tries[-1] if tries and compared[-1] <= max_compared else None


class Field(NamedTuple):
    """Where an attribute's value is in a row's ``codes``; 64 bits are a hash. 0 is no value."""
    word: int
    shift: int
    bits: int


def raw_fields(m: int) -> list[Field]:
    """Those of the rows of ``coded``."""
    return [Field(i, 0, 64) for i in range(m)]


def repeated_values(items: DataFrame, m: int) -> tuple[list[float], list[np.ndarray | None]]:
    """For each attribute the share of the pairs of items that agree on it, and the sorted hashes of
    the values that several items have; ``None`` where these are too many."""
    at = items.select(F.posexplode("codes").alias("at", "code")).filter("code != 0")
    counts = materialize(at.groupBy("at", "code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "batch-values")
    n = max(items.count(), 1)
    sums = {r[0]: (r[1], r[2]) for r in counts.groupBy("at").agg(
        F.sum(F.col("n").cast("double") * F.col("n")), F.count(F.lit(1))).collect()}
    share = [sums.get(i, (0.0, 0))[0] / n / n for i in range(m)]
    few, total = [], 0
    for i in sorted(range(m), key=lambda i: sums.get(i, (0.0, 0))[1]):
        total += sums.get(i, (0.0, 0))[1]
        if sums.get(i, (0.0, 0))[1] <= MAX_VALUES and total <= MAX_ALL_VALUES:
            few.append(i)
    values: list[np.ndarray | None] = [np.zeros(0, np.int64) if i in few else None for i in range(m)]
    found = counts.filter(F.col("at").isin(few)).select("at", "code").collect() if few else []
    own = np.array([(r[0], r[1]) for r in found], np.int64).reshape(-1, 2)
    for i in few:
        values[i] = np.sort(own[own[:, 0] == i, 1])
    return share, values


def packed(items: DataFrame, values: Sequence[np.ndarray | None]) -> tuple[DataFrame, list[Field]]:
    """``items`` with numbers for their values in as few words as they need, and where these are.  A value
    that no other item has becomes none, as it matches nothing."""
    fields, word, used = [], -1, 64
    for known in values:
        bits = 64 if known is None else max(len(known).bit_length(), 1)
        if used + bits > 64:
            word, used = word + 1, 0
        fields.append(Field(word, used, bits))
        used += bits
    ship_package(items.sparkSession)

    def numbers(batches):
        for batch in batches:
            codes = pc.list_flatten(batch.column("codes")).to_numpy().reshape(-1, len(values))
            out = np.zeros((len(codes), word + 1), np.uint64)
            for i, (known, field) in enumerate(zip(values, fields)):
                value = codes[:, i]
                if known is not None:
                    at = np.searchsorted(known, value)
                    at[at == len(known)] = 0
                    value = np.where(known[at] == value, at + 1, 0) if len(known) else np.zeros(len(codes), np.int64)
                out[:, field.word] |= value.astype(np.uint64) << np.uint64(field.shift)
            words = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * (word + 1),
                                             out.view(np.int64).ravel())
            yield batch.set_column(batch.schema.get_field_index("codes"), "codes", words)

    return items.mapInArrow(numbers, items.schema), fields


def value_of(field: Field) -> Column:
    word = F.get("codes", F.lit(field.word))
    return word if field.bits == 64 else F.shiftrightunsigned(word, field.shift).bitwiseAND(
        F.lit((1 << field.bits) - 1).cast("bigint"))


def _best(found: list[np.ndarray], ranks: np.ndarray, m: int, limit: np.ndarray) -> list[np.ndarray]:
    """Of ``found`` (requests, items, masks) the best of each request, as many as its ``limit``."""
    request, item, mask = found
    score = (np.bitwise_count(mask).astype(np.int64) << m) + mask
    order = np.lexsort((ranks[item], -score, request))
    request, item, mask = request[order], item[order], mask[order]
    starts = np.flatnonzero(np.append(True, request[1:] != request[:-1])) if len(request) else np.zeros(0, np.int64)
    place = np.arange(len(request)) - np.repeat(starts, np.diff(np.append(starts, len(request))))
    return [x[place < limit[request]] for x in (request, item, mask)]


def _columns(words: np.ndarray, fields: Sequence[Field]) -> tuple[list[np.ndarray], list[int]]:
    """Each attribute's values as numbers from 1, 0 for none, and the largest they can be."""
    columns, most = [], []
    for field in fields:
        word = words[:, field.word]
        if field.bits == 64:
            known, column = np.unique(word, return_inverse=True)
            columns.append(np.where(word == 0, 0, column + 1))
            most.append(len(known))
        else:
            top = (1 << field.bits) - 1
            columns.append(((word.view(np.uint64) >> np.uint64(field.shift)) & np.uint64(top)).astype(np.int64))
            most.append(top)
    return columns, most


def _side_by_side(columns: list[np.ndarray], most: list[int], n: int) -> list[tuple[np.ndarray, np.uint64, np.uint64]]:
    """Many attributes' values in each word, a free bit above each; with the words of the largest values and of the
    free bits.  What a request (the rows from ``n`` on) has no value for differs from everything."""
    words: list[list] = []
    used = 64
    for column, size in zip(columns, most):
        bits = (size + 1).bit_length()
        if used + bits + 1 > 64:
            words.append([np.zeros(len(column), np.uint64), 0, 0])
            used = 0
        top = (1 << bits) - 1
        value = np.append(column[:n], np.where(column[n:] == 0, top, column[n:])).astype(np.uint64)
        words[-1][0] |= value << np.uint64(used)
        words[-1][1] |= top << used
        words[-1][2] |= 1 << (used + bits)
        used += bits + 1
    return [(w, np.uint64(low), np.uint64(high)) for w, low, high in words]


def meet_lists(items: pa.Table, requests: pa.Table, fields: Sequence[Field], level: int,
               here: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """Row numbers of requests and items and the masks of what they share: for each request the best
    items of its lists in this group, as many as its ``num``.  ``here`` tells from the list's ``sig`` and the mask
    whether a pair counts in a list.

    Pairs are told apart by the number of attributes they differ on.  Where as many items of a list as a request
    wants differ on fewer, whatever list they count in, a pair can't be among its best and gets no mask."""
    none = [np.zeros(0, np.int64)] * 3
    if not items.num_rows or not requests.num_rows:
        return none
    n, m = items.num_rows, len(fields)
    ids = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
                            for x in (items.column("id"), requests.column("id"))])
    own = ids.dictionary_encode().indices.to_numpy()
    ranks = np.empty(n, np.int64)
    ranks[pc.array_sort_indices(ids.slice(0, n)).to_numpy()] = np.arange(n)
    width = fields[-1].word + 1
    columns, most = _columns(np.concatenate([pc.list_flatten(t.column("codes")).to_numpy().reshape(-1, width)
                                             for t in (items, requests)]), fields)
    words = _side_by_side(columns, most, n)
    keys = items.column("key").to_numpy()
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    # Rows of one list follow each other.
    lists, sig = requests.column("key").to_numpy(), requests.column("sig").to_numpy()
    limit = requests.column("num").to_numpy()
    asking = np.argsort(lists, kind="stable")
    lists = lists[asking]
    first, last = np.searchsorted(keys, lists), np.searchsorted(keys, lists, side="right")
    kept, held = [], 0

    def take(request: np.ndarray, item: np.ndarray) -> None:
        nonlocal kept, held
        mask = np.zeros(len(request), np.int64)
        for i, column in enumerate(columns):
            value = column[item]
            mask |= ((value == column[n + request]) & (value != 0)).astype(np.int64) << (m - 1 - i)
        can = here(sig[request], mask) & (own[item] != own[n + request])
        if not can.any():
            return
        kept.append([request[can], item[can], mask[can]])
        held += len(kept[-1][0])
        if held > HELD:
            kept = [_best([np.concatenate(x) for x in zip(*kept)], ranks, m, limit)]
            held = len(kept[0][0])

    def differing(asking_words: list[np.ndarray], listed_words: list[np.ndarray]) -> np.ndarray:
        """On how many attributes they differ: a value that differs carries into its free bit."""
        differ = None
        for (_, low, high), one, other in zip(words, asking_words, listed_words):
            x = one ^ other
            x += low
            x &= high
            differ = np.bitwise_count(x) if differ is None else differ + np.bitwise_count(x)
        return differ

    def nearest(row: np.ndarray, differ: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Which pairs can be among the best of their row: no more than ``wanted`` others, and the request
        itself, differ on less."""
        width = m - level + 1
        upto = np.cumsum(np.bincount(row * width + differ, minlength=len(wanted) * width).reshape(-1, width), axis=1)
        return differ <= np.count_nonzero(upto <= wanted[:, None], axis=1)[row]

    lengths = last - first
    borders = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
    ends = np.append(borders[1:], len(lists))
    large = (ends - borders) * lengths[borders] >= 1 << 12
    for start, end in zip(borders[large].tolist(), ends[large].tolist()):
        listed = by_key[first[start]:last[start]]
        listed_words = [word[listed][None, :] for word, _, _ in words]
        step = max(PAIRS // len(listed), 1)
        for at in range(start, end, step):
            some = asking[at:min(at + step, end)]
            wanted = limit[some]
            differ = differing([word[n + some][:, None] for word, _, _ in words], listed_words)
            bound, most_wanted = np.uint8(m - level), int(wanted.max())
            if len(listed) > 4 * FIRST_SEEN and most_wanted < FIRST_SEEN // 4:
                # Some of the list give a bound for all of it.
                seen = np.partition(differ[:, :FIRST_SEEN], most_wanted, axis=1)[:, most_wanted]
                bound = np.minimum(bound, seen)[:, None]
            hits = np.flatnonzero(differ <= bound)
            row = hits // len(listed)
            if len(hits) > 4 * int(wanted.sum()):
                can = nearest(row, differ.ravel()[hits].astype(np.int64), wanted)
                hits, row = hits[can], row[can]
            take(some[row], listed[hits - row * len(listed)])
    # The short lists' pairs all together; a list of one holds only the request or nobody else.
    small = np.flatnonzero(np.repeat(~large, ends - borders) & (lengths > 0))
    total = np.cumsum(lengths[small])
    at = 0
    while at < len(small):
        to = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")), at + 1)
        some = small[at:to]
        row = np.repeat(np.arange(len(some)), lengths[some])
        offset = np.arange(len(row)) - np.repeat(np.cumsum(lengths[some]) - lengths[some], lengths[some])
        item = by_key[first[some][row] + offset]
        request = asking[some][row]
        differ = differing([word[n + request] for word, _, _ in words], [word[item] for word, _, _ in words])
        can = np.flatnonzero(differ <= m - level)
        wanted = limit[asking[some]]
        if len(can) > 4 * int(wanted.sum()):
            can = can[nearest(row[can], differ[can].astype(np.int64), wanted)]
        take(request[can], item[can])
        at = to
    return _best([np.concatenate(x) for x in zip(*kept)], ranks, m, limit) if kept else none


def _best_in_lists(listed: DataFrame, asking: DataFrame | None, n_rows: int, fields: Sequence[Field], level: int, k: int,
                   here: Callable[[np.ndarray, np.ndarray], np.ndarray], group_rows: int) -> DataFrame:
    """``(request_sku, rn, id, score, mask, num, found)``: for every request its best ``num`` items in its lists, and
    how many were found.  ``listed`` has about ``n_rows`` rows ``sig, key, id, codes, num``, ``asking`` those of the
    requests; where it is ``None`` the listed rows with a ``num`` ask, and rows are sent once."""
    spark = listed.sparkSession

    def sizes(rows: DataFrame, name: str) -> DataFrame:
        # Of each side at most rows / group_rows lists are long.
        return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_rows).select(
            "key", F.ceil(F.col("n") / group_rows).cast("int").alias(name))

    def part(parts: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), "id"), parts).cast("int")

    def each(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), parts - 1))

    bin_of = F.pmod(F.xxhash64("key"), F.lit(max(-(-n_rows // group_rows), partitions(listed)))).alias("bin")
    ship_package(spark)
    m, id_type = len(fields), listed.schema["id"].dataType
    mask_type = IntegerType() if m < 32 else LongType()
    schema = StructType([StructField("request_sku", id_type), StructField("num", IntegerType()),
                         StructField("ids", ArrayType(id_type)), StructField("masks", ArrayType(mask_type))])

    def answers(have: pa.Table, asked: pa.Table) -> pa.Table:
        request, item, mask = meet_lists(have, asked, fields, level, here)
        starts = np.flatnonzero(np.append(True, request[1:] != request[:-1])) if len(request) else request
        ids = have.column("id").combine_chunks().take(pa.array(item))
        borders = pa.array(np.append(starts, len(request)), pa.int32())
        asking_rows = pa.array(request[starts])
        return pa.table([asked.column("id").take(asking_rows), asked.column("num").take(asking_rows),
                         pa.ListArray.from_arrays(borders, ids),
                         pa.ListArray.from_arrays(borders, pa.array(mask, pa.int32() if m < 32 else pa.int64()))],
                        ["request_sku", "num", "ids", "masks"])

    def asks(rows: pa.Table) -> pa.Table:
        return rows.filter(pc.is_valid(rows.column("num")))

    if asking is None:
        n, own = F.coalesce("n", F.lit(1)), ["sig", "key", "id", "codes", "num"]
        rows = listed.join(F.broadcast(sizes(listed, "n")), "key", "left").select(
            *own, bin_of, part(n).alias("part"), each(n).alias("other"))
        rows = rows.select(*own, "bin", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))

        def best_of_group(table: pa.Table) -> pa.Table:
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            if i == j:
                return answers(table, asks(table))
            one, two = (table.filter(pc.equal(table.column("part"), x)) for x in (i, j))
            return pa.concat_tables([answers(one, asks(two)), answers(two, asks(one))])

        met = rows.groupBy("bin", "i", "j").applyInArrow(best_of_group, schema)
    else:
        asking = asking.filter("num IS NOT NULL")
        long = F.broadcast(sizes(listed, "ni").join(sizes(asking, "nj"), "key", "full"))
        ni, nj = F.coalesce("ni", F.lit(1)), F.coalesce("nj", F.lit(1))
        left = listed.join(long, "key", "left").select("key", "id", "codes", bin_of, part(ni).alias("i"), each(nj).alias("j"))
        right = asking.join(long, "key", "left").select("sig", "key", "id", "codes", "num", bin_of, part(nj).alias("j"),
                                                        each(ni).alias("i"))

        def best_of_both(_key, have: pa.Table, asked: pa.Table) -> pa.Table:
            return answers(have, asked)

        met = left.groupBy("bin", "i", "j").cogroup(right.groupBy("bin", "i", "j")).applyInArrow(best_of_both, schema)
    # The lists go through the shuffle, and are rows behind it.
    pairs = met.repartition("request_sku").select("request_sku", "num", F.inline(F.arrays_zip("ids", "masks")))
    pairs = pairs.select("request_sku", "num", F.col("ids").alias("id"), F.col("masks").cast("bigint").alias("mask"))
    by_request = Window.partitionBy("request_sku")
    scored = pairs.withColumn("score", score_from_mask(F.col("mask"), m))
    top = scored.withColumn("rn", F.row_number().over(by_request.orderBy(F.desc("score"), F.asc("id"))))
    top = top.filter((F.col("rn") <= k) & (F.col("rn") <= F.col("num")))
    return top.withColumn("found", F.count(F.lit(1)).over(by_request))


def with_num(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` with how many items each asks for, ``k`` where nothing else is told."""
    return rows if "num" in rows.columns else rows.withColumn("num", F.lit(k).cast("int"))


def _listed(rows: DataFrame, blocks: Sequence[Sequence[int]], fields: Sequence[Field]) -> DataFrame:
    """Every row once for each block whose attributes it all has: ``sig`` (the block), ``key, id, codes, num``."""
    entries = []
    for b, block in enumerate(blocks):
        values = [value_of(fields[i]) for i in block]
        entries.append(F.when(F.forall(F.array(*values), lambda v: v != 0), F.struct(
            F.lit(b).cast("bigint").alias("sig"), F.xxhash64(F.lit(b), *values).alias("key"))))
    # Both sides may be one table, so its columns get names of their own.
    exploded = rows.select(F.col("id").alias("id"), F.col("codes").alias("codes"), F.col("num").alias("num"),
                           F.explode(F.array(*entries)).alias("e"))
    return exploded.filter("e IS NOT NULL").select("e.sig", "e.key", "id", "codes", "num")


def top_k_by_blocks(items: DataFrame, asked: DataFrame, share: Sequence[float], level: int, k: int,
                    group_rows: int = GROUP_ROWS, fields: Sequence[Field] | None = None) -> DataFrame:
    """The result of ``_best_in_lists``: for every row of ``asked`` the best other items among those that
    equal it on ``level`` attributes or more.

    ``items`` and ``asked`` are stored tables of ``(id, codes)`` with unique ids, and of ``num``, the
    items each row asks for (null: it asks for none); they may be one table."""
    m, blocks = len(share), blocks_of(share, level)
    fields = fields or raw_fields(m)
    members = [sum(bit_of(i, m) for i in block) for block in blocks]

    def here(sig: np.ndarray, mask: np.ndarray) -> np.ndarray:
        first = np.full(len(mask), len(members))
        for b in reversed(range(len(members))):
            first[(mask & members[b]) == members[b]] = b
        return first == sig

    asking = None if asked is items else _listed(with_num(asked, k), blocks, fields)
    return _best_in_lists(_listed(with_num(items, k), blocks, fields), asking, items.count() * len(blocks), fields, level,
                          k, here, group_rows)


def prefix_levels(most: int) -> list[int]:
    """The levels of the rounds for items with up to ``most`` values."""
    levels = [max(-(-3 * most // 5), 1)]
    while levels[-1] > 1:
        levels.append(levels[-1] - max(levels[-1] // 4, 1))
    return levels


def _in_prefixes(rows: DataFrame, fields: Sequence[Field], order: Sequence[int], level: int, size: int) -> DataFrame:
    """Every row with ``level`` values or more once for each ``size`` values of its prefix: ``sig`` (their mask),
    ``key, id, codes, num``."""
    m = len(fields)
    entries = F.array(*[F.struct(F.lit(bit_of(i, m)).cast("bigint").alias("bit"), value_of(fields[i]).cast("bigint").alias("value"))
                        for i in order])
    rows = rows.select(F.col("id").alias("id"), F.col("codes").alias("codes"), F.col("num").alias("num"),
                       F.filter(entries, lambda e: e["value"] != 0).alias("e"))
    rows = rows.filter(F.size("e") >= level).withColumn(
        "e", F.slice("e", F.lit(1), F.greatest(F.size("e") - (level - size), F.lit(0))))

    def subsets(chosen: list[Column], after: Column | None, left: int) -> Column:
        later = F.col("e") if after is None else F.slice("e", after + 2, F.size("e"))

        def one(e: Column, i: Column) -> Column:
            own, at = [*chosen, e], i if after is None else after + 1 + i
            if left > 1:
                return subsets(own, at, left - 1)
            sig = own[0]["bit"]
            for x in own[1:]:
                sig = sig.bitwiseOR(x["bit"])
            return F.struct(sig.alias("sig"), F.xxhash64(sig, *[x["value"] for x in own]).alias("key"))

        found = F.transform(later, one)
        return F.flatten(found) if left > 1 else found

    return rows.select("id", "codes", "num", F.inline(subsets([], None, size))).select("sig", "key", "id", "codes", "num")


def prefix_costs(items: DataFrame, fields: Sequence[Field], order: Sequence[int],
                 levels: Sequence[int]) -> dict[int, dict[int, tuple[float, float]]]:
    """For each level and size about the rows sent and the comparisons where all items ask, from a bounded sample
    of the items.  They choose how lists are made; what is found does not depend on them."""
    every = max(items.count() // SAMPLED, 1)
    some = items.filter(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(every)) == 0).select("codes").limit(2 * SAMPLED).collect()
    width = fields[-1].word + 1
    columns, _ = _columns(np.array([r[0] for r in some], np.int64).reshape(-1, width), fields)
    rows = [[(i, v) for i, v in zip(order, values) if v] for values in zip(*[columns[i].tolist() for i in order])]
    costs: dict[int, dict[int, tuple[float, float]]] = {}
    for level in levels:
        for size in range(1, min(level, MAX_SIZE) + 1):
            prefixes = [row[:len(row) - level + size] for row in rows if len(row) >= level]
            n = sum(comb(len(x), size) for x in prefixes)
            if size == 1 or n <= MAX_LISTS * len(rows):
                lists = Counter(x for prefix in prefixes for x in combinations(prefix, size))
                pairs = sum(c * (c - 1) for c in lists.values())
                costs.setdefault(level, {})[size] = float(n * every), float(pairs) * every * every
    return costs


def next_prefixes(costs: dict[int, dict[int, tuple[float, float]]], above: int, share: float) -> tuple[int, int]:
    """The level of the next round, below ``above``, and the size of its lists, where a ``share`` of the items ask:
    the lowest level whose cost is small, else the highest one.  Where few ask, each further round would send
    about as many rows, so only the comparisons count."""
    def cost(level: int, size: int) -> float:
        rows, pairs = costs[level][size]
        return ROW_PAIRS * rows + pairs * share

    best = {level: min(costs[level], key=lambda size: cost(level, size)) for level in costs if level < above}
    few = 2 * share <= 1
    cheap = [level for level in best if (costs[level][best[level]][1] * share if few
                                         else cost(level, best[level])) <= CHEAP_ROUND]
    level = min(cheap) if cheap else max(best)
    return level, best[level]


def top_k_by_prefixes(items: DataFrame, asked: DataFrame, fields: Sequence[Field], order: Sequence[int], level: int, size: int,
                      k: int, n_rows: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """As ``top_k_by_blocks`` by prefixes in the ``order`` of the attributes, with lists of ``size`` values;
    ``n_rows`` is about the number of the items' places in lists."""
    bits = [bit_of(i, len(fields)) for i in order]

    def here(sig: np.ndarray, mask: np.ndarray) -> np.ndarray:
        first, found = np.zeros(len(mask), np.int64), np.zeros(len(mask), np.int64)
        for bit in bits:
            has = (mask & bit) != 0
            first |= np.where(has & (found < size), bit, 0)
            found += has
        return first == sig

    asking = None if asked is items else _in_prefixes(with_num(asked, k), fields, order, level, size)
    return _best_in_lists(_in_prefixes(with_num(items, k), fields, order, level, size), asking, n_rows, fields, level, k, here,
                          group_rows)


def settle(top: DataFrame, items: DataFrame, asked: DataFrame, left: int, n: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """After a round with the stored result ``top``: the rows of finished requests, then ``items``, ``asked`` and their
    number for the next round.  A request that found all it asks for is finished, as every other item matches less."""
    done = top.filter("found >= num")
    ids = done.filter("rn = 1").select(F.col("request_sku").alias("id"))
    n_done = ids.count()
    left -= n_done
    if left and n_done:
        if asked is items and 2 * left > n:
            items = asked = materialize(items.join(ids.withColumn("done", F.lit(1)), "id", "left").select(
                "id", "codes", F.when(F.col("done").isNull(), F.col("num")).alias("num")), "batch-unfinished")
        else:
            asked = materialize(asked.filter("num IS NOT NULL").join(ids, "id", "left_anti").select("id", "codes", "num"),
                                "batch-unfinished")
    return done, items, asked, left
