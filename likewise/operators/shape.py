"""Changing the shape of a catalog: map or struct to flat, flat to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import MapType, StructType

from ..errors import TooManyAttributes
from ..functions.columns import attr, column_names

# More names than this are no schema.
MAX_NAMES = 10_000


def discover_names(catalog: DataFrame, max_names: int = MAX_NAMES) -> list[str]:
    """Distinct attribute names of a map-form catalog, alphabetical.

    One distributed ``distinct`` over the map keys (partial-aggregated before
    its shuffle).  The distinct names reach the driver, as they become the
    schema of the flat form.  More than ``max_names`` raise ``TooManyAttributes``,
    and no more than one beyond that ever reach the driver; such catalogs are
    handled in the open forms (``attributes_long``, ``similarity_open``,
    ``batch_top_k_open``).
    """
    keys = catalog.select(F.explode(F.map_keys("attributes")).alias("name")).distinct()
    names = [r["name"] for r in keys.limit(max_names + 1).collect()]
    if len(names) > max_names:
        raise TooManyAttributes(f"more than {max_names} attribute names; use an open form such as batch_top_k_open")
    return sorted(names)


def flatten_attributes(catalog: DataFrame, names: Sequence[str] | None = None,
                       id_col: str = "sku") -> DataFrame:
    """One string column per attribute, alphabetical; absent attributes are null.

    Accepts the map form or a struct ``attributes`` column.  Attributes are
    taken by name, never by position, so any number of attributes works and
    an extra one is not silently dropped.  An attribute named like the id or a
    result column, or like another one in other case, is found behind the
    prefix ``attribute:``.
    """
    dtype = catalog.schema["attributes"].dataType
    if isinstance(dtype, StructType):
        fields = [f.name for f in dtype.fields]
        names = sorted(names if names is not None else fields)
        column = column_names(names, id_col)
        cols = [(F.col("attributes").getField(n) if n in fields else F.lit(None))
                .cast("string").alias(column[n]) for n in names]
    elif isinstance(dtype, MapType):
        names = sorted(names if names is not None else discover_names(catalog))
        column = column_names(names, id_col)
        cols = [F.try_element_at("attributes", F.lit(n)).cast("string").alias(column[n])
                for n in names]
    else:
        raise TypeError(f"attributes must be a map or a struct, not {dtype}")
    return catalog.select(F.col(id_col).alias(id_col), *cols)


def attributes_long(catalog: DataFrame, id_col: str = "sku") -> DataFrame:
    """``(sku, name, value)``: one row per present, non-null attribute.

    Works on the map form (``explode``) and on the flat form (``unpivot``).
    """
    if "attributes" in catalog.columns and isinstance(
            catalog.schema["attributes"].dataType, MapType):
        out = catalog.select(id_col, F.explode("attributes").alias("name", "value"))
    else:
        names = sorted(c for c in catalog.columns if c != id_col)
        out = catalog.select(id_col, *[attr(n).cast("string").alias(n) for n in names]) \
            .unpivot([id_col], [attr(n) for n in names], "name", "value")
    return out.filter(F.col("value").isNotNull())
