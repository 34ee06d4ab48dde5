"""Batch top-k against a brute-force reference on random catalogs.

The catalogs have few distinct values (many ties, many shared subsets), nulls,
and one value shared by a large share of items, so hot groups, ties on score
and the id tie-break are all exercised.
"""

import random

import pytest

from conftest import flat_frame
from likewise import (batch_top_k, batch_top_k_indexed, candidate_pairs, missing_requests,
                      top_k_similar)


def brute_force(rows, names, k, requests=None, matched_only=False):
    m = len(names)
    by_id = {r[0]: r[1:] for r in rows}
    out = {}
    for t in (requests if requests is not None else by_id):
        if t not in by_id:
            continue
        tv = by_id[t]
        scored = []
        for x, xv in by_id.items():
            if x == t:
                continue
            mask = sum(1 << (m - 1 - i) for i in range(m)
                       if tv[i] is not None and xv[i] is not None and tv[i] == xv[i])
            if matched_only and mask == 0:
                continue
            scored.append((-(bin(mask).count("1") << m | mask), x))
        scored.sort()
        out[t] = [(x, -s) for s, x in scored[:k]]
    return out


def random_catalog(seed, n, m, null_rate=0.15):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vals = []
        for j in range(m):
            if rng.random() < null_rate:
                vals.append(None)
            elif rng.random() < 0.35:
                vals.append("hot")          # a third of the rows share this value
            else:
                vals.append(f"v{rng.randrange(3 + j)}")
        rows.append((f"i{i:03d}", *vals))
    return rows


def as_lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["request_sku"], r["rn"])):
        got.setdefault(r["request_sku"], []).append((r["sku"], r["score"]))
    return got


@pytest.mark.parametrize("seed,n,m,k", [(1, 60, 4, 5), (2, 80, 6, 10), (3, 40, 3, 12)])
def test_batch_equals_brute_force(spark, seed, n, m, k):
    names = [f"n{j}" for j in range(m)]
    rows = random_catalog(seed, n, m)
    cat = flat_frame(spark, rows, names)
    assert as_lists(batch_top_k(cat, k)) == brute_force(rows, names, k)
    assert as_lists(batch_top_k_indexed(cat, k)) == {
        t: v for t, v in brute_force(rows, names, k, matched_only=True).items() if v}


def test_batch_with_requests_and_missing(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(7, 50, 4)
    cat = flat_frame(spark, rows, names)
    req_ids = ["i001", "i013", "i040", "nope-1", "nope-2"]
    requests = spark.createDataFrame([(r,) for r in req_ids], "sku string")
    assert as_lists(batch_top_k(cat, 6, requests=requests)) == \
        brute_force(rows, names, 6, requests=req_ids)
    assert sorted(r["sku"] for r in missing_requests(cat, requests).collect()) == \
        ["nope-1", "nope-2"]


def test_batch_row_equals_single_request(spark):
    names = ["a", "b", "c", "d", "e"]
    rows = random_catalog(11, 70, 5)
    cat = flat_frame(spark, rows, names)
    batch = as_lists(batch_top_k(cat, 8))
    for t in ["i000", "i033", "i069"]:
        single = [(r["sku"], r["score"]) for r in top_k_similar(cat, t, 8).collect()]
        assert batch[t] == single


def test_candidates_per_request_are_bounded(spark):
    """A request meets at most 2**p * (k + 1) heads, whatever the catalog size."""
    names = ["a", "b", "c"]
    rows = [(f"i{i:04d}", "hot", "hot", f"v{i % 2}") for i in range(400)]
    cat = flat_frame(spark, rows, names)
    k = 3
    per_request = candidate_pairs(cat, k).groupBy("request_sku").count()
    assert per_request.agg({"count": "max"}).first()[0] <= (2 ** 3) * (k + 1)


def test_open_catalog_many_names_few_per_item(spark):
    """40 attribute names, at most 4 present per item: the sparse fan-out path."""
    rng = random.Random(21)
    m = 40
    names = [f"n{j:02d}" for j in range(m)]
    rows = []
    for i in range(60):
        vals = [None] * m
        for j in rng.sample(range(m), rng.randrange(1, 5)):
            vals[j] = rng.choice(["x", "y", "hot"])
        rows.append((f"i{i:03d}", *vals))
    cat = flat_frame(spark, rows, names)
    assert as_lists(batch_top_k(cat, 4)) == brute_force(rows, names, 4)


def test_open_form_orders_like_fixed_score(spark):
    """O8b (map form, names) and O8 (bit score) give the same order."""
    from pyspark.sql import functions as F

    from likewise import similarity_open, to_map
    names = ["a", "b", "c", "d", "e"]
    rows = random_catalog(13, 50, 5)
    cat = flat_frame(spark, rows, names)
    for t in ["i000", "i021", "i044"]:
        fixed = [r["sku"] for r in top_k_similar(cat, t, 49).collect()]
        opened = similarity_open(to_map(cat), t).orderBy(
            F.desc("match_count"), F.asc("matched"), F.asc("sku"))
        assert [r["sku"] for r in opened.collect()] == fixed


def test_materialized_index_gives_same_result(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(17, 45, 4)
    cat = flat_frame(spark, rows, names)
    assert as_lists(batch_top_k(cat, 5, materialize_index=True)) == \
        brute_force(rows, names, 5)


@pytest.mark.parametrize("hot_rows", [5, 40])
def test_salted_hot_groups_give_same_result(spark, hot_rows):
    """Force the hot-group path: groups above ``hot_rows`` request rows are
    spread over salt buckets (the empty subset always is)."""
    names = ["a", "b", "c", "d"]
    rows = random_catalog(23, 70, 4)
    cat = flat_frame(spark, rows, names)
    assert as_lists(batch_top_k(cat, 6, hot_group_rows=hot_rows)) == \
        brute_force(rows, names, 6)
    req_ids = [f"i{i:03d}" for i in range(0, 70, 3)]
    requests = spark.createDataFrame([(r,) for r in req_ids], "sku string")
    assert as_lists(batch_top_k(cat, 6, requests=requests, hot_group_rows=hot_rows)) == \
        brute_force(rows, names, 6, requests=req_ids)


@pytest.mark.parametrize("split", [0, 1, 2, 3, 4, None])
def test_two_rounds_equal_brute_force(spark, split):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(31, 60, 4)
    cat = flat_frame(spark, rows, names)
    assert as_lists(batch_top_k(cat, 5, split_level=split)) == brute_force(rows, names, 5)
    assert as_lists(batch_top_k(cat, 5, include_empty=False, split_level=split)) == {
        t: v for t, v in brute_force(rows, names, 5, matched_only=True).items() if v}


def test_two_rounds_with_requests(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(37, 60, 4)
    cat = flat_frame(spark, rows, names)
    req_ids = [f"i{i:03d}" for i in range(0, 60, 4)] + ["absent"]
    requests = spark.createDataFrame([(r,) for r in req_ids], "sku string")
    for split in (2, 3):
        assert as_lists(batch_top_k(cat, 5, requests=requests, split_level=split)) == \
            brute_force(rows, names, 5, requests=req_ids)
