"""Top k for many requests over a catalog with open attribute names.

The map form stays as it is: names never become columns, and never come to the
driver.  An attribute is a key hashed from its name and value, and the posting
lists of ``operators.postings`` count what two items share.  A request's keys are in
order of the names, so of equal counts the match on an earlier name wins without any
order of all names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.session import materialize
from ..sources.catalog import first_per_id
from .postings import top_k_by_postings


def open_items(catalog: DataFrame, id_col: str = "sku", unique_ids: bool = False) -> DataFrame:
    """``(id, names, keys)``: each item's present names, sorted, and their keys."""
    rows = catalog.select(F.col(id_col).alias("sku"), F.map_filter(
        F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda n, v: v.isNotNull()).alias("attributes"))
    rows = rows.filter("sku IS NOT NULL")
    rows = rows if unique_ids else first_per_id(rows)
    entries = F.sort_array(F.map_entries("attributes"))
    return rows.select(F.col("sku").alias("id"), F.transform(entries, lambda e: e["key"]).alias("names"),
                       F.transform(entries, lambda e: F.xxhash64(e["key"], e["value"])).alias("keys"))


def batch_top_k_open(catalog: DataFrame, k: int = 10, requests: DataFrame | None = None, id_col: str = "sku",
                     include_empty: bool = True, unique_ids: bool = False) -> DataFrame:
    """``request_sku, rn, sku, match_count, matched``: ``similarity_open`` for every request
    (all items by default), the best ``k``.

    ``catalog`` has ``attributes map<string,string>``; a null value or a null map is absent
    attributes.  ``matched`` are the matched names, sorted; the order is
    ``match_count desc, matched asc, sku asc``.  Null ids are neither items nor requests, of
    rows with one id the smallest by ``canonical_json`` counts (``unique_ids`` saves that
    check), and requests not in the catalog are left out (``missing_requests``).
    ``include_empty=False`` keeps candidates with a match.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    items = materialize(open_items(catalog, id_col, unique_ids), "open-items")
    asked = items.select(F.col("id").alias("request"), "names", "keys")
    if requests is not None:
        ids = requests.select(F.col(id_col).alias("request")).distinct()
        asked = materialize(asked.join(ids, "request", "left_semi"), "open-requests")
    top = top_k_by_postings(items.select("id", "keys"), asked, k, include_empty)
    named = top.join(asked.select("request", "names"), "request")
    matched = F.transform("places", lambda p: F.get("names", p))
    return named.select(F.col("request").alias("request_sku"), F.col("rn").cast("int").alias("rn"),
                        F.col("id").alias(id_col), F.size("places").alias("match_count"), matched.alias("matched"))
