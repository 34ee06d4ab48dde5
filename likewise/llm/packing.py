"""Packing documents into training sequences: concatenate and cut.

All token ids, document after document, make one long run that is cut every
``length`` ids, so only the last sequence is not full.  The run is never in one
place:

1. Every task encodes its texts and writes chunks: the ids of some documents one
   after the other, their ids and token counts.
2. The chunks' token totals, summed by partition first and then over the
   partitions, give where each chunk begins in the whole run.
3. Every chunk is cut where the whole run is.  Windows inside a chunk are whole
   sequences; what is left at its two ends are boundary records, at most two of a
   chunk, which are put together by sequence.

Nothing but the boundary records is shuffled.  The run follows the partitions in
which the documents are read, and the rows in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.session import shared_path
from ..plans.sizing import broadcast_if_small
from .common import col, map_arrow, row_blocks, run_starts, utf8_bytes
from .stretch_encoder import shared_encoder, lowercase_stretches

LENGTH = 2048
END_ID = 1
# Text of one chunk.
CHUNK_BYTES = 4 << 20

PIECE = "struct<doc_id:bigint,start:bigint,length:bigint,doc_tokens:bigint,offset:bigint>"
CHUNK = "part int, seq int, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, width int, payload binary"
WINDOW = f"sequence_id bigint, offset bigint, ids binary, pieces array<{PIECE}>"


def write_chunks(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> str:
    """Encode ``docs`` into chunks at ``path``.

    A null text is an empty one (its end id is still written), a null id stays null,
    repeated rows are documents of their own, and a text longer than a chunk is a
    chunk by itself.  An empty table writes no chunk.  Other columns are not read.
    """
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"),
                       F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seq = None, 0
        for batch in batches:
            encoder = encoder or shared_encoder(tokenizer_path, lowercase_stretches)
            data, offsets = utf8_bytes(batch.column(1))
            ids = batch.column(0)
            for low, high in row_blocks(offsets, chunk_bytes):
                tokens, counts = encoder.encode(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                tokens = np.insert(tokens, np.cumsum(counts), end_id)
                counts = counts + 1
                width = 2 if encoder.terminals <= 1 << 16 else 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(2)[0].as_py()], pa.int32()), pa.array([seq], pa.int32()),
                     pa.array([len(tokens)], pa.int64()), pa.array([ids.slice(low, high - low).to_pylist()],
                                                                   pa.list_(pa.int64())),
                     pa.array([counts], pa.list_(pa.int64())),
                     pa.array([width], pa.int32()), pa.array([tokens.astype(f"<u{width}").tobytes()], pa.binary())],
                    ["part", "seq", "n_tokens", "doc_ids", "counts", "width", "payload"])
                seq += 1

    map_arrow(rows, run, CHUNK).write.option("compression", "zstd").parquet(path)
    return path


def cut(base: int, doc_ids: list, counts: np.ndarray, length: int) -> list[tuple]:
    """The windows of a chunk that begins at ``base``: ``(sequence_id, offset, from, to,
    pieces)``, where ``from`` and ``to`` are places in the chunk and ``offset`` is where
    the part begins in its sequence."""
    ends = np.cumsum(counts)
    starts, total = ends - counts, int(ends[-1]) if len(ends) else 0
    # Pieces begin where a document or a window does.
    windows = np.arange(-(base % length), total, length)
    windows = windows[windows > 0]
    begins = np.union1d(starts, windows)
    stops = np.append(begins[1:], total)
    doc = np.searchsorted(starts, begins, side="right") - 1
    sequence = (base + begins) // length
    out = []
    for s in range(base // length, (base + total - 1) // length + 1) if total else ():
        a, b = np.searchsorted(sequence, [s, s + 1])
        pieces = [{"doc_id": doc_ids[d], "start": int(x - starts[d]), "length": int(y - x),
                   "doc_tokens": int(counts[d]), "offset": int((base + x) % length)}
                  for x, y, d in zip(begins[a:b], stops[a:b], doc[a:b])]
        out.append((s, pieces[0]["offset"], int(begins[a]), int(stops[b - 1]), pieces))
    return out


def read_windows(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """``(sequence_id, offset, ids, pieces)``: the parts of sequences in each chunk."""
    chunks = spark.read.parquet(path)
    # One small row per chunk, payloads not read.
    starts = broadcast_if_small(run_starts(chunks.select("part", "seq", "n_tokens")))
    rows = chunks.join(starts, ["part", "seq"]).select("base", "doc_ids", "counts", "width", "payload")
    kind = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                base = batch.column(0)[i].as_py()
                ids = np.frombuffer(batch.column(4)[i].as_buffer(), f"<u{batch.column(3)[i].as_py()}").astype("<u4")
                counts = batch.column(2)[i].values.to_numpy()
                found = cut(base, batch.column(1)[i].as_py(), counts, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([ids[f[2]:f[3]].tobytes() for f in found], pa.binary()),
                     pa.array([f[4] for f in found], pa.list_(kind))],
                    ["sequence_id", "offset", "ids", "pieces"])

    return map_arrow(rows, run, WINDOW)


def write_sequences(spark: SparkSession, chunks: str, path: str, length: int = LENGTH,
                    pad_id: int = 0) -> str:
    """Sequences from the chunks, below ``path``: ``windows/whole=true`` holds those inside
    one chunk, ``joined`` those put together from the boundary records in
    ``windows/whole=false``.  ``read_sequences`` reads them as one table.

    Sequences are padded with ``pad_id`` to ``length`` unless their own ids are a power of
    two in number, so only the last one can be.
    """
    windows = read_windows(spark, chunks, length)
    (windows.withColumn("whole", F.octet_length("ids") == 4 * length).write.option("compression", "zstd")
     .partitionBy("whole").parquet(f"{path}/windows"))
    windows = spark.read.schema(f"{WINDOW}, whole boolean").parquet(f"{path}/windows")
    parts = windows.filter("NOT whole").groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids", "pieces"))).alias("parts"))
    joined = parts.select(
        "sequence_id", F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))").alias("ids"),
        F.flatten("parts.pieces").alias("pieces"))
    n = (F.octet_length("ids") / 4).cast("bigint")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (length - n).cast("int")))
    padded = F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(F.concat("ids", pad))
    joined.select("sequence_id", padded.alias("ids"), "pieces").write.parquet(f"{path}/joined")
    return path


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``(sequence_id, n_tokens, ids, pieces)`` of every sequence at ``path``.

    ``ids`` are little-endian unsigned 32-bit, padding included; ``n_tokens`` counts the
    sequence's own ids.  ``pieces`` tells of each part of a document in the sequence: its
    id, the ids of the document before it, its length, the document's ids, and its place.
    """
    whole = spark.read.schema(f"{WINDOW}, whole boolean").parquet(f"{path}/windows").filter("whole")
    joined = spark.read.schema(f"sequence_id bigint, ids binary, pieces array<{PIECE}>").parquet(f"{path}/joined")
    rows = whole.select("sequence_id", "ids", "pieces").unionByName(joined)
    n = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda a, p: a + p["length"])
    return rows.select("sequence_id", n.alias("n_tokens"), "ids", "pieces")


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, path: str | None = None,
         **options) -> DataFrame:
    """Pack ``docs`` and read the sequences back (``write_chunks``, ``read_sequences``)."""
    spark = docs.sparkSession
    chunks = write_chunks(docs, shared_path(spark, "packing-chunks"), tokenizer_path, **options)
    path = write_sequences(spark, chunks, path or shared_path(spark, "packing-sequences"), length)
    return read_sequences(spark, path)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece, with the checksum of its ids as read from the sequence."""
    opened = sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.expr("substring(ids, CAST(4 * p.offset + 1 AS INT), CAST(4 * p.length AS INT))")
    return opened.select("p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens",
                         "sequence_id", "p.offset")
