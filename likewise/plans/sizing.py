"""Size checks that guard every broadcast.

A side is broadcast only when its row count is bounded by construction (a
constant such as ``k`` or ``2**m``) or its rows and bytes have been counted below a
limit.  Beyond the limit the caller keeps the shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# The most this package broadcasts when the bound is only known after counting.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20


def value_bytes(value: Column, kind) -> Column:
    """About the bytes of a value in memory: 16 for a number, and what it holds."""
    if isinstance(kind, (StringType, BinaryType)):
        return 16 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, StructType):
        return sum((value_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, ArrayType):
        return 16 + F.coalesce(F.aggregate(
            value, F.lit(0).cast("bigint"), lambda a, x: a + value_bytes(x, kind.elementType)), F.lit(0))
    if isinstance(kind, MapType):
        entries = StructType().add("key", kind.keyType).add("value", kind.valueType)
        return value_bytes(F.map_entries(value), ArrayType(entries))
    return F.lit(16)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row of ``df``."""
    def column(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")
    return sum((value_bytes(column(f.name), f.dataType) for f in df.schema.fields), F.lit(16).cast("bigint"))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       known_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast when its size is proven small, in rows and in bytes.

    ``known_rows`` is an upper bound of the rows the caller can prove without a job (for
    example ``2**m`` distinct scores), of rows that are a few numbers wide.  Otherwise one
    bounded job counts rows and bytes of ``limit(max_rows + 1)``, so the check itself never
    scans more than ``max_rows + 1`` rows.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return F.broadcast(df) if size[0] <= max_rows and (size[1] or 0) <= max_bytes else df
