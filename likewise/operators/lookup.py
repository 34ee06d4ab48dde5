"""Finding the requested item and leaving it out of the candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..errors import ItemNotFound
from ..functions.columns import attr


def lookup_item(flat: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """The catalog row with id ``sku`` as a one-row DataFrame (lazy).

    The id is compared as a value (``F.lit``), never pasted into SQL text, so
    quotes in ids are harmless.  The equality filter reaches the parquet scan
    as a pushed filter.  If several rows share the id, the one with the
    smallest JSON text of its attributes is taken, which does not depend on
    file order.  An unknown id gives an empty frame; ``require_item`` raises.
    """
    return flat.filter(F.col(id_col) == F.lit(sku)).orderBy(row_order(flat, id_col)).limit(1)


def row_order(flat: DataFrame, id_col: str = "sku"):
    """The text that decides between rows of one id: the JSON of their attributes
    in order of the names."""
    columns = sorted(c for c in flat.columns if c != id_col)
    return F.to_json(F.struct(*[attr(c) for c in columns])) if columns else F.lit("")


def one_row_per_id(flat: DataFrame, id_col: str = "sku") -> DataFrame:
    """The catalog without null ids and with one row per id, that with the smallest
    ``row_order``.  Each task keeps one row per id before the shuffle on the id."""
    order = Window.partitionBy(id_col).orderBy(row_order(flat, id_col))
    return (flat.filter(F.col(id_col).isNotNull()).withColumn("_first", F.row_number().over(order))
            .filter("_first = 1").drop("_first"))


def require_item(flat: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """``lookup_item`` that raises ``ItemNotFound`` for an unknown id."""
    found = lookup_item(flat, sku, id_col)
    if found.isEmpty():
        raise ItemNotFound(sku)
    return found


def exclude_item(flat: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """All rows except those with id ``sku``.

    Every row with that id goes, duplicates included; rows with a null id
    go too, because ``null != x`` is not true.
    """
    return flat.filter(F.col(id_col) != F.lit(sku))


def target_values(flat: DataFrame, sku, id_col: str = "sku") -> dict:
    """The looked-up item's attribute values, ``{name: value}``.

    One small job: the id filter is pushed to the scan and at most one row
    (the item's own attributes, bounded by the number of attributes) comes
    back to the driver.  The values then enter the scoring plan as literals,
    so every candidate is compared against constants in generated code and
    the whole catalog is scored in one projection, with no join and no
    shuffle.  Raises ``ItemNotFound`` for an unknown id.
    """
    rows = lookup_item(flat, sku, id_col).collect()
    if not rows:
        raise ItemNotFound(sku)
    row = rows[0].asDict()
    row.pop(id_col, None)
    return row
