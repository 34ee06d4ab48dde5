"""Requests served from a stream equal the batch answer."""

from conftest import flat_frame
from likewise import batch_top_k
from likewise.plans.session import shared_path
from likewise.streaming.requests import missing, results, serve_requests
from test_batch import as_lists, random_catalog


def test_stream_equals_batch(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(5, 40, 4)
    cat = flat_frame(spark, rows, names)
    req_dir = shared_path(spark, "req")
    ids = ["i000", "i005", "i017", "i031", "missing"]
    spark.createDataFrame([(i,) for i in ids], "sku string").repartition(2) \
        .write.parquet(req_dir)
    stream = spark.readStream.schema("sku string").option("maxFilesPerTrigger", 1) \
        .parquet(req_dir)
    out = shared_path(spark, "answers")
    serve_requests(spark, cat, stream, 5, out).awaitTermination()
    requests = spark.createDataFrame([(i,) for i in ids], "sku string")
    assert as_lists(results(spark, out)) == as_lists(batch_top_k(cat, 5, requests=requests))
    assert [r.sku for r in missing(spark, out).collect()] == ["missing"]
