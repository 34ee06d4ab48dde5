"""Rounds by blocks of attributes against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import flat_frame
from likewise import batch_top_k, build_subset_index, top_k_from_index
from likewise.operators import batch, blocks, value_join
from likewise.operators.blocks import block_levels, blocks_of, coded, shares, top_k_by_blocks
from likewise.plans.session import materialize
from test_batch import as_lists, brute_force

NAMES = list("abcdefgh")


def catalog(seed, n=120):
    """Some rows near copies of others, some alone, a constant attribute, nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            values = [v if rng.random() < 0.8 else rng.choice(["x", "y", None]) for v in rng.choice(rows)[1:]]
        else:
            values = [rng.choice(["x", "y", "z", f"{i}", None]) for _ in NAMES]
        rows.append((f"i{i:03d}", *values[:-1], "one"))
    rows.append(("none", *[None] * len(NAMES)))
    return rows


@pytest.fixture
def large(monkeypatch):
    """Every catalog's fan-out counts as large."""
    monkeypatch.setattr(batch, "TWO_ROUND_MIN_FANOUT", 1)
    monkeypatch.setattr(batch, "MAX_BROADCAST_ROWS", 1)


def test_blocks_hold_every_attribute_once():
    for m in range(8, 13):
        levels = block_levels(m)
        assert levels[-1] in (3, 4) and levels == sorted(levels, reverse=True)
        for level in levels:
            blocks = blocks_of([1 / (i + 2) for i in range(m)], level)
            assert len(blocks) == m - level + 1 and all(blocks)
            assert sorted(i for b in blocks for i in b) == list(range(m))


@pytest.mark.parametrize("level,group_rows", [(6, 1 << 14), (4, 7)])
def test_a_round_is_all_that_match_on_its_level(spark, level, group_rows):
    """Also with lists cut into parts of both sides."""
    rows = catalog(1)
    items = materialize(coded(flat_frame(spark, rows, NAMES), NAMES, "sku"), "test-codes")
    top = top_k_by_blocks(items, items, shares(items, 8), level, 5, group_rows)
    got = as_lists(top.withColumnRenamed("id", "sku"))
    want = {t: [x for x in v if x[1] >> 8 >= level] for t, v in brute_force(rows, NAMES, 5).items()}
    assert got == {t: v for t, v in want.items() if v}


@pytest.mark.parametrize("compared", [60, 0])
def test_rounds_equal_brute_force(spark, large, monkeypatch, compared):
    """With some rounds and none worth it."""
    monkeypatch.setattr(batch, "MAX_COMPARED", compared)
    rows = catalog(2)
    cat = flat_frame(spark, rows, NAMES)
    assert as_lists(batch_top_k(cat, 5)) == brute_force(rows, NAMES, 5)
    few = [r[0] for r in rows[::7]]
    asked = spark.createDataFrame([(i,) for i in [*few, "nobody"]], "sku string")
    matched = {t: v for t, v in brute_force(rows, NAMES, 5, few, matched_only=True).items() if v}
    assert as_lists(batch_top_k(cat, 5, asked, include_empty=False)) == matched


@pytest.mark.parametrize("compared", [batch.MAX_COMPARED, 12])
def test_index_keeps_only_small_subsets(spark, large, monkeypatch, compared):
    monkeypatch.setattr(batch, "MAX_COMPARED", compared)
    rows = catalog(3)
    path = build_subset_index(flat_frame(spark, rows, NAMES), 5)
    heads = spark.read.parquet(f"{path}/heads")
    assert heads.agg(F.max(F.bit_count("_s"))).first()[0] < block_levels(8)[-1]
    asked = [r[0] for r in rows[::3]]
    top = top_k_from_index(spark, path, spark.createDataFrame([(i,) for i in [*asked, "nobody"]], "sku string"), 4)
    assert as_lists(top) == brute_force(rows, NAMES, 4, asked)


def test_repeated_ids_stay_with_the_heads(spark, large):
    rows = catalog(4, 40)
    cat = flat_frame(spark, [*rows, *rows], NAMES)
    top = batch_top_k(cat, 3, unique_ids=True)
    assert top.groupBy("request_sku", "sku").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("include_empty", [True, False])
def test_equal_items_are_answered_together(spark, large, monkeypatch, include_empty):
    """Items of one class share a list; heads too many to be hashed are sorted."""
    monkeypatch.setattr(batch, "MAX_HASHED_HEADS", 1)
    rng = random.Random(5)
    rows = [(f"i{i:03d}", *[rng.choice(["x", None]) for _ in range(2)], rng.choice("uvw")) for i in range(60)]
    rows += [(f"n{i}", None, None, None) for i in range(9)] + [("alone", "q", "q", "q")]
    found, used = batch.top_k_from_classes, []
    monkeypatch.setattr(batch, "top_k_from_classes", lambda *a: used.append(1) or found(*a))
    cat = flat_frame(spark, rows, list("abc"))
    want = brute_force(rows, list("abc"), 5, matched_only=not include_empty)
    assert as_lists(batch_top_k(cat, 5, include_empty=include_empty)) == {t: v for t, v in want.items() if v}
    assert used


def test_value_join_sends_no_pairs_of_a_light_value(spark, monkeypatch):
    """A value of 60 items, just light, meets k + 1 heads for every set of values, not 60 items."""
    rows = [(f"i{i:03d}", "x" if i % 4 else "y", f"v{i % 20}", None if i % 5 else "z") for i in range(80)]
    met, light = [], value_join._light_heads
    monkeypatch.setattr(value_join, "_light_heads", lambda *a: met.append(light(*a)) or met[-1])
    cat = flat_frame(spark, rows, list("abc"))
    got = value_join.batch_top_k_joined(cat, 2, heavy_share=1)
    assert as_lists(got) == brute_force(rows, list("abc"), 2, matched_only=True)
    assert met[0].groupBy("request_sku").count().agg(F.max("count")).first()[0] <= 7 * 3


@pytest.mark.parametrize("group_rows", [1 << 14, 7])
def test_values_become_numbers_and_rows_are_sent_once(spark, group_rows):
    """Numbers of eight attributes fit one word; items that all ask are not sent as requests once more; a request
    gets as many items as it asks for."""
    rows = catalog(6)
    cat = flat_frame(spark, rows, NAMES)
    num = spark.createDataFrame([(r[0], i % 4) for i, r in enumerate(rows)], "sku string, num int")
    items, fields, share = batch._packed_items(cat, NAMES, num, 5, "sku")
    assert items.agg(F.max(F.size("codes"))).first()[0] == 1 and max(f.word for f in fields) == 0
    top = top_k_by_blocks(items, items, share, 4, 5, group_rows, fields)
    assert "CoGroup" not in top._jdf.queryExecution().optimizedPlan().toString()
    want = {t: [x for x in v if x[1] >> 8 >= 4][:n] for (t, v), n in zip(
        brute_force(rows, NAMES, 5).items(), [i % 4 for i in range(len(rows))])}
    assert as_lists(top.withColumnRenamed("id", "sku")) == {t: v for t, v in want.items() if v}


def test_requests_with_num_are_cut_in_the_rounds(spark, large, monkeypatch):
    """Most and some of the items asked for, each with its own number."""
    rows = catalog(7)
    cat = flat_frame(spark, rows, NAMES)
    rounds, tables = batch._by_blocks, []
    monkeypatch.setattr(batch, "_by_blocks", lambda *a: tables.append(a) or rounds(*a))
    for every in (1, 3):
        asked = [(r[0], (None, 1, 3, 9, 0)[i % 5]) for i, r in enumerate(rows) if i % every == 0]
        got = batch_top_k(cat, 5, spark.createDataFrame([*asked, ("nobody", 2), (None, 4)], "sku string, num int"))
        full = brute_force(rows, NAMES, 5)
        want = {t: full[t][:5 if n is None else n] for t, n in asked}
        assert as_lists(got) == {t: v for t, v in want.items() if v}
        items, asking = tables[-1][:2]
        assert (asking is items) == (every == 1)


def wide_catalog(seed, m, n=90):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(m)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            values = [v if rng.random() < 0.8 else rng.choice(["x", "y", None]) for v in rng.choice(rows)[1:]]
        else:
            values = [rng.choice(["x", "y", "z", f"{i}", None, None]) for _ in names]
        rows.append((f"i{i:03d}", *values))
    return [*rows, ("none", *[None] * m), ("one", "x", *[None] * (m - 1))], names


@pytest.mark.parametrize("m,include_empty,group_rows", [(16, True, 1 << 14), (24, False, 9)])
def test_wide_rounds_equal_brute_force(spark, monkeypatch, m, include_empty, group_rows):
    """Prefixes answer the requests that match enough items; posting lists get only the others."""
    monkeypatch.setattr(batch, "MIN_PREFIX_PAIRS", 0)
    monkeypatch.setattr(batch, "prefix_levels", lambda most: [9, 6, 3, 1])
    monkeypatch.setattr(blocks, "CHEAP_ROUND", -1)
    found, rest = batch.top_k_by_postings, []
    monkeypatch.setattr(batch, "top_k_by_postings", lambda items, asked, *a: rest.append(asked.count()) or found(
        items, asked, *a))
    by_prefixes = batch.top_k_by_prefixes
    monkeypatch.setattr(batch, "top_k_by_prefixes", lambda items, asked, fields, order, level, size, *a: by_prefixes(
        items, asked, fields, order, level, min(level, m // 8), *a, group_rows))
    rows, names = wide_catalog(m, m)
    cat = flat_frame(spark, rows, names)
    want = {t: v for t, v in brute_force(rows, names, 4, matched_only=not include_empty).items() if v}
    assert as_lists(batch_top_k(cat, 4, include_empty=include_empty)) == want
    assert rest and rest[0] <= 4
    if include_empty:
        return
    asked = [(r[0], i % 6) for i, r in enumerate(rows) if i % 5 < 1]
    got = batch_top_k(cat, 4, spark.createDataFrame(asked, "sku string, num int"), include_empty=include_empty)
    assert as_lists(got) == {t: want[t][:n] for t, n in asked if n and t in want}


@pytest.mark.parametrize("n,n_lists", [(3000, 1), (3000, 60)])
def test_only_pairs_that_can_be_among_the_best_get_masks(n, n_lists):
    """Most pairs of a list match on the low level asked for; those of a long and of many short lists."""
    rng, m, k = np.random.default_rng(8), 12, 3
    codes = np.where(rng.random((n, m)) < 0.2, 0, rng.integers(1, 4, (n, m)))
    key = rng.integers(0, n_lists, n)
    items = pa.table({"id": pa.array(rng.permutation(n)), "key": key, "sig": np.zeros(n, np.int64),
                      "codes": pa.array(list(codes)), "num": pa.array(rng.integers(1, k + 1, n), pa.int32())})
    some = sorted(rng.choice(n, 200, replace=False).tolist())
    asked, seen = items.take(some), []

    def here(sig, mask):
        seen.append(len(sig))
        return np.ones(len(sig), bool)

    request, item, mask = blocks.meet_lists(items, asked, blocks.raw_fields(m), 1, here)
    bits, ids, num = 1 << np.arange(m)[::-1], items["id"].to_numpy(), asked["num"].to_numpy()
    for r, at in enumerate(some):
        masks = ((codes == codes[at]) & (codes != 0)) @ bits
        met = [(-int(x).bit_count(), -int(x), int(i)) for x, i, here_too in zip(masks, ids, key == key[at])
               if x and i != ids[at] and here_too]
        got = [(-int(x).bit_count(), -int(x), int(ids[i])) for i, x in zip(item[request == r], mask[request == r])]
        assert sorted(got) == sorted(met)[:num[r]]
    assert sum(seen) < sum(int((key == key[at]).sum()) for at in some) / 3


def spied_levels(monkeypatch):
    """The levels of the rounds, and the highest level of the heads that are met."""
    rounds, heads, by_blocks, pairs = [], [], batch.top_k_by_blocks, batch.candidate_pairs
    monkeypatch.setattr(batch, "top_k_by_blocks", lambda items, asked, share, level, *a, **b: rounds.append(
        (level, asked is items, items)) or by_blocks(items, asked, share, level, *a, **b))
    monkeypatch.setattr(batch, "candidate_pairs", lambda *a, max_level=None, **b: heads.append(
        max_level) or pairs(*a, max_level=max_level, **b))
    return rounds, heads


def dense_catalog(seed, n=160):
    """Items that match many others on most attributes."""
    rng = random.Random(seed)
    return [(f"i{i:03d}", *[rng.choice("xy") if rng.random() < 0.15 else "x" for _ in NAMES[:-2]],
             rng.choice(["u", "v"]), None if rng.random() < 0.1 else f"{i % 8}") for i in range(n)]


def test_many_items_start_on_a_higher_level(spark, large, monkeypatch):
    """Where the lowest first round meets too many items a higher one comes first, not all subsets."""
    rows = dense_catalog(9)
    cat = flat_frame(spark, rows, NAMES)
    codes = materialize(coded(cat, NAMES, "sku"), "test-codes")
    first, share = block_levels(8)[0], shares(codes, 8)
    limit = len(rows) * blocks.compared_share(share, first) - 1
    monkeypatch.setattr(batch, "MAX_COMPARED", limit)
    rounds, heads = spied_levels(monkeypatch)
    assert as_lists(batch_top_k(cat, 5)) == brute_force(rows, NAMES, 5)
    assert rounds[0][0] > first and all(x is not None and x < rounds[-1][0] for x in heads)


def test_rounds_go_down_by_what_is_cheap():
    share = [1 / 10] * 10
    near = [10 ** 4 / blocks.compared_share(share, level) for level in range(11)]
    assert blocks.next_block_level(share, int(near[7]), 11, 1 << 18) == 7
    assert blocks.next_block_level(share, int(near[8]), 11, 1 << 18) == 8
    assert blocks.next_block_level(share, int(near[5]), 7, 1 << 18) == 5
    assert blocks.next_block_level(share, int(near[6]), 7, 1 << 18) == 6
    # Dear, but less than the fan-out; and more than it.
    assert blocks.next_block_level(share, int(10 * near[6]), 7, 1 << 18) == 6
    assert blocks.next_block_level(share, int(100 * near[6]), 7, 1 << 18) is None
    assert blocks.next_block_level(share, 1, 4, 1 << 18) == 3 and blocks.next_block_level(share, 1, 3, 1 << 18) is None


@pytest.mark.parametrize("every", [1, 3])
def test_index_answers_many_requests_on_a_higher_level(spark, large, monkeypatch, every):
    """The stored values are numbers; items that are mostly asked for are sent once."""
    rows = dense_catalog(10)
    cat = flat_frame(spark, rows, NAMES)
    path = build_subset_index(cat, 5)
    assert spark.read.parquet(f"{path}/codes").agg(F.max(F.size("codes"))).first()[0] == 1
    share, asked = spark.read.parquet(f"{path}/about").first()["share"], [r[0] for r in rows[::every]]
    first = block_levels(8)[0]
    monkeypatch.setattr(batch, "MAX_COMPARED", len(asked) * blocks.compared_share(share, first) - 1)
    rounds, heads = spied_levels(monkeypatch)
    top = top_k_from_index(spark, path, spark.createDataFrame([(i,) for i in [*asked, "nobody"]], "sku string"), 4)
    assert as_lists(top) == brute_force(rows, NAMES, 4, asked)
    assert rounds[0][0] > first and rounds[0][1] == (every == 1)
    assert all(x is not None and x < rounds[-1][0] for x in heads)
