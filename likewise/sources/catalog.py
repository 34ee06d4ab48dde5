"""Reading and holding catalogs.

Two forms are used throughout:

* **map form** ``(sku, attributes map<string,string>)``: the open form of a
  JSON catalog, any attribute names, only present values;
* **flat form** ``(sku, <one string column per attribute>)``: the fixed
  form the scoring operators work on (see ``operators.shape``).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"

CATALOG_SCHEMA = StructType([
    StructField("sku", StringType()),
    StructField("attributes", MapType(StringType(), StringType())),
    StructField(CORRUPT, StringType()),
])


def read_catalog(spark: SparkSession, path: str, infer: bool = False,
                 dedupe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read a JSON-lines catalog into ``(catalog, rejects)``.

    ``catalog`` has ``sku string, attributes map<string,string>``.  With the
    default explicit schema no inference pass runs; numbers are read as
    their text (``1`` becomes ``"1"``) and a JSON ``null`` value is dropped
    from the map, so a missing and a null attribute look the same.

    ``rejects`` has ``line, reason``: malformed lines (``reason = 'malformed'``)
    and rows without an id (``'no id'``).  They are split off instead of
    failing the job later.

    With ``dedupe`` one row is kept per id: the one with the smallest JSON text
    of its attributes in order of their names, a choice that depends neither
    on file nor on key order.  That costs one shuffle on ``sku``, before which
    each task keeps one row per id; pass ``dedupe=False`` for catalogs
    whose ids are known to be unique.

    ``infer=True`` runs Spark's schema inference (one extra pass) and reads
    ``attributes`` as a struct, which is then turned into the map form.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT)
    if infer:
        raw = reader.json(path)
        attrs = raw.schema["attributes"].dataType if "attributes" in raw.columns else None
        if isinstance(attrs, StructType):
            names = [f.name for f in attrs.fields]
            pairs = []
            for n in names:
                pairs += [F.lit(n), F.col("attributes").getField(n).cast("string")]
            amap = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
        else:
            amap = F.lit(None).cast("map<string,string>")
        if CORRUPT not in raw.columns:
            raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
        raw = raw.select(F.col("sku").cast("string").alias("sku"),
                         amap.alias("attributes"), CORRUPT)
    else:
        raw = reader.schema(CATALOG_SCHEMA).json(path)
        raw = raw.select("sku",
                         F.map_filter("attributes", lambda k, v: v.isNotNull())
                         .alias("attributes"), CORRUPT)
    # Both outputs read ``sku`` and ``attributes`` besides the corrupt-record
    # column, which Spark requires of a raw JSON scan.
    bad = F.col(CORRUPT).isNotNull()
    rejects = raw.filter(bad | F.col("sku").isNull()).select(
        F.coalesce(F.col(CORRUPT), F.to_json(F.struct("sku", "attributes"))).alias("line"),
        F.when(bad, F.lit("malformed")).otherwise(F.lit("no id")).alias("reason"))
    good = raw.filter(~bad & F.col("sku").isNotNull()).select(
        "sku", F.coalesce("attributes", F.create_map().cast("map<string,string>"))
        .alias("attributes"))
    if dedupe:
        good = first_per_id(good)
    return good, rejects


def canonical_json(attributes: str = "attributes"):
    """The JSON text of a map's entries in order of their keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(attributes))))


def first_per_id(catalog: DataFrame) -> DataFrame:
    """One row per ``sku`` of a map-form catalog, the smallest by ``canonical_json``."""
    order = Window.partitionBy("sku").orderBy("_json")
    return (catalog.withColumn("_json", canonical_json())
            .withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_json", "_n"))


def to_map(flat: DataFrame, id_col: str = "sku") -> DataFrame:
    """Flat catalog to map form; null attributes are left out of the map."""
    names = sorted(c for c in flat.columns if c != id_col)
    pairs = []
    for n in names:
        pairs += [F.lit(n), F.col("`" + n.replace("`", "``") + "`").cast("string")]
    amap = F.create_map(*pairs) if pairs else F.create_map()
    return flat.select(F.col(id_col).alias("sku"),
                       F.map_filter(amap, lambda k, v: v.isNotNull()).alias("attributes"))


def write_catalog_json(catalog: DataFrame, path: str) -> str:
    """Write a map-form catalog as JSON lines (one object per line)."""
    catalog.select(F.col("sku").cast("string").alias("sku"), "attributes") \
        .write.mode("errorifexists").json(path)
    return path


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist ``df`` for the body of the ``with`` block, then release it.

    The data stays cached across every action inside the block and is
    released in ``finally`` even when an action fails.  ``MEMORY_AND_DISK``
    spills instead of recomputing when executors run short of memory; a
    lost executor's blocks are recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
