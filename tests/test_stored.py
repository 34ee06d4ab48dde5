"""Stored look-ups, postings, batches appended once, and owned tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from likewise import (OwnedTables, append_once, append_once_and_count, build_term_index, committed_count, committed_rows,
                      lookup_item, read_stored, search_terms, store_catalog)
from likewise.operators.text import term_match
from likewise.plans.session import materialize, shared_path
from likewise.sources import derived
from likewise.sources.tables import commits
from conftest import SF_SMOKE


def scanned(df):
    """``(rows, files)`` that the plan's scans have read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    rows = files = 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            rows += node.metrics().apply("numOutputRows").value()
            files += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return rows, files


def test_a_stored_lookup_reads_one_row_group(spark):
    items = spark.range(0, 200_000, 1, 8).select(
        (F.col("id") * 7919 % 200_003).alias("sku"), F.concat(F.lit("value"), F.col("id")).alias("a"))
    path = store_catalog(items, shared_path(spark, "test-stored"), row_group_bytes=100_000, files=4)
    stored = read_stored(spark, path)
    assert stored.count() == 200_000 and stored.exceptAll(items).isEmpty()
    rows, _ = scanned(stored.filter("sku = 7919"))
    assert 0 < rows < 25_000
    # Within the range of a file but in no item: the filter of the row group says so.
    absent = next(i for i in range(200_003) if i == 200_003 * 0 + 7919 * 200_000 % 200_003)
    assert scanned(stored.filter(F.col("sku") == absent))[0] == 0
    assert lookup_item(stored, 7919).collect() == lookup_item(items, 7919).collect()


def test_stored_catalog_with_null_and_repeated_ids(spark):
    items = spark.createDataFrame([(None, "x"), (3, "b"), (3, "a"), (1, None)], "sku bigint, a string")
    stored = read_stored(spark, store_catalog(items, shared_path(spark, "test-stored")))
    assert sorted(map(str, stored.collect())) == sorted(map(str, items.collect()))
    assert [tuple(r) for r in lookup_item(stored, 3).collect()] == [tuple(r) for r in lookup_item(items, 3).collect()]
    empty = read_stored(spark, store_catalog(items.limit(0), shared_path(spark, "test-stored")))
    assert empty.count() == 0


def test_postings_equal_a_search_of_the_texts(spark):
    docs = derived.table(spark, SF_SMOKE, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "The the THE"), (5, None), (6, ""), (7, "élan-Élan,\nthe_the 42"), (7, "the"),
                                 (8, "word " * 50_000)], "doc_id bigint, text string")
    docs = docs.unionByName(odd)
    path = build_term_index(docs, "text", "doc_id", shared_path(spark, "test-terms"), files=8)
    for term in ("the", "Élan", "42", "word", "is"):
        found = sorted(map(str, search_terms(spark, path, term, "doc_id").collect()))
        assert found == sorted(map(str, term_match(docs, "text", term, id_col="doc_id").collect())) and found
    assert search_terms(spark, path, "absentterm", "doc_id").count() == 0
    with pytest.raises(ValueError):
        search_terms(spark, path, "two words", "doc_id")
    whole = spark.read.parquet(path).count()
    rows, _ = scanned(spark.read.parquet(path).filter("token = 'élan'"))
    assert 0 < rows < whole / 4
    assert build_term_index(docs.limit(0), "text", "doc_id", shared_path(spark, "test-terms"))


def test_a_batch_counts_once(spark):
    path = shared_path(spark, "test-batches")
    one = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a")], "id bigint, text string")
    assert committed_count(spark, path) == 0
    assert append_once_and_count(one, path, "a/b c=1") == 3
    assert append_once_and_count(one, path, "a/b c=1") == 3
    assert append_once(one.limit(1), path, "2") and not append_once(one, path, "2")
    assert append_once_and_count(one.limit(0), path, "nothing") == 4
    # A job that died before its commit: its rows are not there, and its replay counts.
    one.write.parquet(f"{path}/batches/batch=late")
    assert committed_rows(spark, path).count() == 4 == committed_count(spark, path)
    assert append_once_and_count(one, path, "late") == 7
    assert committed_rows(spark, path).drop("batch").distinct().count() == 2
    assert {r.batch: r["rows"] for r in commits(spark, path).collect()} == {"a/b c=1": 3, "2": 1, "nothing": 0, "late": 3}


def test_a_count_reads_no_data_page(spark):
    path = shared_path(spark, "test-count")
    spark.range(1000).select("id", F.col("id").cast("string").alias("t")).write.parquet(path)
    plan = spark.read.parquet(path).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def folders(spark):
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return set(glob.glob(f"{base}/likewise/owned-*"))


def test_owned_tables_go_with_their_block(spark):
    rows = spark.range(10)
    before = folders(spark)
    with OwnedTables(spark) as outer:
        materialize(rows, "owned-a")
        with OwnedTables(spark) as inner:
            materialize(rows, "owned-b")
            kept = inner.keep(rows, "owned-c")
            assert len(folders(spark) - before) == 3
        assert {os.path.basename(f)[:7] for f in folders(spark) - before} == {"owned-a", "owned-c"}
        assert kept.count() == 10
        last = outer.keep(rows, "owned-d")
    assert {os.path.basename(f)[:7] for f in folders(spark) - before} == {"owned-d"} and last.count() == 10
    with pytest.raises(RuntimeError):
        with OwnedTables(spark):
            materialize(rows, "owned-e")
            raise RuntimeError("stops")
    assert {os.path.basename(f)[:7] for f in folders(spark) - before} == {"owned-d"}
