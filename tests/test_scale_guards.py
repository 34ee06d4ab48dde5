"""The size checks that guard broadcasts and fan-outs."""

import random

import pytest

from conftest import flat_frame
from likewise import (batch_top_k, build_subset_index, flatten_attributes, similarity_score, top_k_from_index,
                      top_k_similar, top_k_weights)
from likewise.operators.batch import _hot_groups, subset_rows
from likewise.plans.session import is_local
from likewise.plans.sizing import broadcast_if_small


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_limit(spark):
    small = spark.range(10)
    big = spark.range(1000)
    joined_small = spark.range(100).join(broadcast_if_small(small, max_rows=50), "id")
    joined_big = spark.range(100).join(broadcast_if_small(big, max_rows=50), "id")
    assert joined_small.count() == 10 and joined_big.count() == 100
    # the hint is present only on the small side
    assert "broadcast" in joined_small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in joined_big._jdf.queryExecution().analyzed().toString().lower()


def test_no_hot_groups_below_threshold(spark):
    names = ["a", "b"]
    cat = flat_frame(spark, [(f"i{i}", "x", f"v{i % 3}") for i in range(30)], names)
    rows = subset_rows(cat, names)
    assert _hot_groups(cat, rows, names, None) is None          # 30 requests, tiny
    hot = _hot_groups(cat, rows, names, 5)                       # forced: groups > 5 rows
    got = sorted((r["_s"], r["_b"]) for r in hot.collect())
    # empty subset and a = 'x': 30 rows each -> 6 buckets; each value of b,
    # alone or with a: 10 rows -> 2 buckets
    assert got == [(0, 6), (1, 2), (1, 2), (1, 2), (2, 6), (3, 2), (3, 2), (3, 2)]


def brute(rows, names, k, include_empty=True):
    out = set()
    for t in rows:
        scored = []
        for x in rows:
            if x[0] != t[0]:
                same = [a is not None and a == b for a, b in zip(x[1:], t[1:])]
                if any(same) or include_empty:
                    scored.append((-sum(same), [not s for s in same], x[0]))
        out |= {(t[0], rn, sku, -n) for rn, (n, _, sku) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("width", [20, 70])
def test_wide_items_equal_brute_force(spark, width):
    rng = random.Random(width)
    names = [f"n{j:02d}" for j in range(width)]
    rows = [(f"i{i:02d}", *[rng.choice(["x", "y", "z", None]) for _ in names]) for i in range(40)]
    rows.append(("i99", *rows[0][1:]))  # a copy, a match on every attribute
    cat = flat_frame(spark, rows, names)
    got = {(r.request_sku, r.rn, r.sku, r.match_count) for r in batch_top_k(cat, 5).collect()}
    assert got == brute(rows, names, 5)
    top = top_k_similar(cat, "i00", 5).collect()
    assert [(rn, r.sku, r.match_count) for rn, r in enumerate(top, 1)] == sorted(
        x[1:] for x in got if x[0] == "i00")
    weights = top_k_weights(top_k_similar(cat, "i00", 1)).first()
    assert weights.sku == "i99" and weights.matched.split(",") == [
        n for n, v in zip(names, rows[0][1:]) if v is not None]


def test_lattice_and_scan_agree(spark):
    rng = random.Random(1)
    names = list("abcdef")
    rows = [(i, *[rng.choice(["x", "y", None]) for _ in names]) for i in range(60)]
    cat = flat_frame(spark, rows, names, "bigint")
    for empty in (True, False):
        lattice = batch_top_k(cat, 4, include_empty=empty)
        scan = batch_top_k(cat, 4, include_empty=empty, max_attributes=2)
        assert lattice.columns == scan.columns and set(lattice.collect()) == set(scan.collect())
        assert {(r[0], r[1], r[2], r[4]) for r in scan.collect()} == brute(rows, names, 4, empty)


def test_null_and_repeated_ids(spark):
    rows = [(None, "x", "y")] * 4 + [("a", "x", "z")] + [("a", "x", "y")] * 3 + [
        ("b", "x", "y"), ("c", "x", "q"), ("t", "x", "y")]
    cat = flat_frame(spark, rows, ["n", "m"])
    # Of the rows of a the smallest by its text counts: m = y.
    clean = [("a", "x", "y"), ("b", "x", "y"), ("c", "x", "q"), ("t", "x", "y")]
    want = {(r, rn, s, n) for r, rn, s, n in brute([(i, m, n) for i, n, m in clean], ["m", "n"], 2)}
    for options in ({}, {"max_attributes": 1}):
        got = {(r.request_sku, r.rn, r.sku, r.match_count) for r in batch_top_k(cat, 2, **options).collect()}
        assert got == want
    top = top_k_similar(cat, "t", 2).collect()
    assert [(r.sku, r.match_count) for r in top] == [(s, n) for _, _, s, n in sorted(x for x in want if x[0] == "t")]


def test_many_results_of_one_group(spark):
    rows = [(i, "x") for i in range(1300)]
    cat = flat_frame(spark, rows, ["a"], "bigint")
    asked = spark.createDataFrame([(7, 1100), (8, None), (9, 3), (9, 2), (5000, 1)], "sku bigint, num int")
    got = batch_top_k(cat, 1200, asked).groupBy("request_sku").count().collect()
    assert {tuple(r) for r in got} == {(7, 1100), (8, 1200), (9, 3)}


def test_index_checks_what_it_is_asked(spark):
    cat = flat_frame(spark, [("a", "x"), ("b", "x"), ("c", "y")], ["n"])
    path = build_subset_index(cat, 2)
    asked = spark.createDataFrame([("a",), ("nope",), (None,)], "sku string")
    top = top_k_from_index(spark, path, asked, 1, cat)
    assert [(r.request_sku, r.sku) for r in top.collect()] == [("a", "b")]
    heads = [line for line in plan_of(top).split("\n") if "Exchange hashpartitioning(_k1" in line]
    assert not heads
    with pytest.raises(ValueError):
        top_k_from_index(spark, path, asked, 3)
    with pytest.raises(ValueError):
        top_k_from_index(spark, path, asked, 2, include_empty=False)
    with pytest.raises(ValueError):
        top_k_from_index(spark, path, asked, 2, cat.limit(2))


def test_attribute_names_that_clash(spark):
    names = ["score", "mask", "match_count", "sku", "Color", "color", "rank"]
    catalog = spark.createDataFrame(
        [(i, {n: f"{n}{i % 2}" for n in names}) for i in range(6)], "sku bigint, attributes map<string,string>")
    flat = flatten_attributes(catalog)
    top = top_k_weights(top_k_similar(flat, 0, 2)).orderBy("rank").collect()
    assert [(r.sku, r.match_count, r.matched) for r in top] == [(s, 7, ",".join(sorted(names))) for s in (2, 4)]
    assert {(r.request_sku, r.sku) for r in batch_top_k(flat, 1, unique_ids=True).collect()} == {
        (0, 2), (1, 3), (2, 0), (3, 1), (4, 0), (5, 1)}
    assert similarity_score(flat_frame(spark, [("t", "a"), ("x", "a")], ["score"]), "t").first().match_count == 1


def test_cluster_needs_a_shared_folder():
    assert is_local("local") and is_local("local[8]") and is_local("local[*]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn") and not is_local("spark://h:7077")
