"""
and the physical plans the operators are meant to get."""

import pytest
from pyspark import StorageLevel

from conftest import SF_SMOKE, flat_frame
from likewise import (cached, exclude_item, lookup_item, rank_candidates, similarity_score,
                      top_k_similar, top_k_weights)
from likewise.sources import derived


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_ids_never_candidates(spark):
    cat = flat_frame(spark, [("t", "a"), (None, "a"), ("x", "a")], ["a"])
    assert [r["sku"] for r in exclude_item(cat, "t").collect()] == ["x"]
    assert [r["sku"] for r in similarity_score(cat, "t").collect()] == ["x"]


def test_more_than_twenty_results(spark):
    rows = [("t", "a", "b")] + [(f"x{i:02d}", "a" if i % 2 else "z", "b") for i in range(30)]
    cat = flat_frame(spark, rows, ["a", "b"])
    top = top_k_weights(top_k_similar(cat, "t", 25)).orderBy("rank").collect()
    assert len(top) == 25 and [r["rank"] for r in top] == list(range(1, 26))
    assert all(r["match_count"] == 2 for r in top[:15])


def test_cached_releases(spark):
    cat = flat_frame(spark, [("t", "a")], ["a"])
    with cached(cat) as c:
        assert c.storageLevel != StorageLevel.NONE
        assert c.count() == 1
    assert cat.storageLevel == StorageLevel.NONE


def test_lookup_pushes_filter_to_scan(spark):
    p = derived.part10(spark, SF_SMOKE)
    plan = lookup_item(p, 42)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_partkey), EqualTo(p_partkey,42)]" in plan


def test_single_request_plan_has_no_shuffle(spark):
    p = derived.part10(spark, SF_SMOKE)
    plan = plan_of(top_k_similar(p, 42, 10, unique_ids=True))
    assert "TakeOrderedAndProject" in plan
    assert "Exchange" not in plan
    # the scan reads only the six columns part10 needs
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string," \
           "p_type:string,p_size:int,p_retailprice:double>" in plan


def test_rank_never_sends_all_rows_to_one_task(spark):
    p = derived.part10(spark, SF_SMOKE)
    ranked = rank_candidates(similarity_score(p, 42), "fixed", m=10)
    ranked.collect()
    plan = plan_of(ranked)
    # the only single-partition step is the histogram of distinct scores,
    # which is broadcast back; the candidates are joined to it in place
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    main = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in main


def test_batch_plan_limits_groups_before_shuffle(spark):
    from likewise import batch_top_k
    p = derived.part10(spark, SF_SMOKE)
    plan = batch_top_k(p, 10)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ShuffledHashJoin" in plan


def test_top_k_rejects_negative_k(spark):
    cat = flat_frame(spark, [("t", "a")], ["a"])
    with pytest.raises(ValueError):
        top_k_similar(cat, "t", -1)
