"""Answering a stream of recommendation requests.

Requests (item ids) arrive as a streaming DataFrame, for example files landing
in a folder or a message topic.  The catalog's subset index is built once and
written as a table below the shared checkpoint folder, which cuts its lineage:
a lost executor re-reads the table instead of rebuilding the index.  Each
micro-batch fans out only its own requests and broadcasts them, while they are
few, into the scan of the stored heads (``top_k_from_index``); the index does not
move.

Results go to ``output_path/answers/epoch=<id>`` with ``overwrite``: a micro-batch
replayed after a failure rewrites the same folder, so the sink is
exactly-once together with the query's checkpoint.  A micro-batch's intermediate
tables are deleted when its answers are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.batch import build_subset_index, missing_requests, top_k_from_index
from ..plans.session import OwnedTables, shared_path


def serve_requests(spark: SparkSession, flat: DataFrame, requests: DataFrame, k: int,
                   output_path: str, checkpoint_location: str | None = None,
                   index_path: str | None = None, id_col: str = "sku",
                   available_now: bool = True, unique_ids: bool = False) -> StreamingQuery:
    """Start a streaming query that writes the top ``k`` for each request.

    ``requests`` is a streaming DataFrame with an ``id_col`` column.  An index
    given by ``index_path`` must be of this catalog and have at least this ``k``.
    Ids that are not in the catalog go to ``output_path/missing``.  With
    ``available_now`` the query processes what is there and stops (batch
    style); otherwise it keeps running with the default trigger.
    """
    if index_path is None:
        index_path = build_subset_index(flat, k, None, id_col, unique_ids=unique_ids)
    else:
        top_k_from_index(spark, index_path, flat.select(id_col).limit(0), k, flat)
    checkpoint_location = checkpoint_location or shared_path(spark, "serve-checkpoint")
    items = spark.read.parquet(f"{index_path}/items")

    def answer(batch: DataFrame, epoch_id: int) -> None:
        asked = batch.select(id_col)
        with OwnedTables(spark):
            top = top_k_from_index(spark, index_path, asked, k)
            top.write.mode("overwrite").parquet(f"{output_path}/answers/epoch={epoch_id}")
            missing = missing_requests(items, asked, id_col)
            missing.write.mode("overwrite").parquet(f"{output_path}/missing/epoch={epoch_id}")

    writer = (requests.writeStream.foreachBatch(answer)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def results(spark: SparkSession, output_path: str) -> DataFrame:
    """All answers written so far (the ``epoch`` folder becomes a column)."""
    return spark.read.parquet(f"{output_path}/answers").drop("epoch")


def missing(spark: SparkSession, output_path: str) -> DataFrame:
    """All requested ids so far that are not in the catalog, once per micro-batch."""
    return spark.read.parquet(f"{output_path}/missing").drop("epoch")
