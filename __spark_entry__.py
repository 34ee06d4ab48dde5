"""

``entry(spark)`` is the flagship query on sf0.001: the ten items most similar
to item 42 of the ``part10`` catalog, with their weights.  ``queries()`` maps
every operator to a query over the driver's tables, and ``oracle_sql()`` gives
the same result in plain SQL for DuckDB, column names aliased alike.

All catalogs are derived from the parquet tables (FIXTURES.md): ``part10``
(parts, ten attributes), ``cust5`` (customers with order aggregates),
``docs5`` (documents with labels, some attributes missing) and ``event2``
(events with an attribute inside a JSON text).  Every query runs over whole
tables; the only limits are the operators' own ``k``.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from likewise import (append_and_count, attributes_long, batch_top_k, batch_top_k_indexed,
                      append_once, append_once_and_count, batch_top_k_joined, batch_top_k_open,
                      build_term_index, build_upkept_index, cached, committed_rows, read_stored,
                      search_terms, store_catalog, top_k_from_upkept, update_index, digit_score_compat, exclude_item, flatten_attributes, lookup_item,
                      match_indicators, missing_requests, rank_candidates, read_catalog,
                      similarity_open, similarity_score, to_map, top_k_names, top_k_similar,
                      top_k_weights, write_catalog_json)
from likewise.functions.columns import COMPAT_SCORE_COLUMN, INDICATOR_COLUMN, NAMES_COLUMN
from likewise.operators.text import term_match, term_total
from likewise.plans.session import shared_path
from likewise.sources import derived
from likewise.sources.tables import append_rows, table_rows
from likewise.streaming.requests import (missing as stream_missing, results as stream_results,
                                         serve_requests)

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed request parameters of the registered queries.
TARGET = 42          # part10 item asked for, as in FIXTURES.md
OPEN_TARGET = 7      # docs5 document asked for
CLONE_ID = -42       # id given to the copy of the target (perfect match)
K = 10
TERM = "the"

WIDE = 64            # attributes of the widest single request
PART10 = list("abcdefghij")
RESERVED_NAMES = ["Color", "color", "mask", "match_count", "score", "sku"]
FIVE = list("abcde")


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _part10_with_clone(spark: SparkSession, sf: str) -> DataFrame:
    """part10 plus the target's attributes once more under ``CLONE_ID``."""
    p = derived.part10(spark, sf)
    clone = lookup_item(p, TARGET).withColumn("sku", F.lit(CLONE_ID).cast("bigint"))
    return p.unionByName(clone)


def q_read_catalog(spark: SparkSession, sf: str) -> DataFrame:
    path = write_catalog_json(to_map(derived.cust5(spark, sf)), shared_path(spark, "cust5-json"))
    catalog, _rejects = read_catalog(spark, path)
    return attributes_long(catalog)


def q_read_catalog_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as JSON lines, every tenth cut off, every seventh without an id."""
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    line = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit('{"sku":"'), key)).when(
        F.col("c_custkey") % 7 == 0, F.concat(F.lit('{"attributes":{"a":"'), segment, F.lit('"}}'))
    ).otherwise(F.concat(F.lit('{"sku":"'), key, F.lit('","attributes":{"a":"'), segment, F.lit('"}}')))
    path = shared_path(spark, "customer-lines")
    derived.table(spark, sf, "customer").select(line.alias("value")).write.text(path)
    return read_catalog(spark, path)[1]


def _nation_json(spark: SparkSession, sf: str) -> str:
    """Customers under the id of their nation, so that ids repeat."""
    flat = derived.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("sku"), F.col("c_mktsegment").alias("a"),
        F.col("c_custkey").cast("string").alias("b"))
    return write_catalog_json(to_map(flat), shared_path(spark, "nation-json"))


def q_read_catalog_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return attributes_long(read_catalog(spark, _nation_json(spark, sf))[0])


def q_read_catalog_infer(spark: SparkSession, sf: str) -> DataFrame:
    return attributes_long(read_catalog(spark, _nation_json(spark, sf), infer=True)[0])


def q_cached(spark: SparkSession, sf: str) -> DataFrame:
    """Two actions on one cached catalog: its items, and its attributes by name."""
    with cached(to_map(derived.docs5(spark, sf))) as catalog:
        n = catalog.count()
        counts = attributes_long(catalog).groupBy("name").agg(F.count(F.lit(1)).alias("n_present"))
        rows = [(r["name"], r["n_present"], n) for r in counts.collect()]
    return spark.createDataFrame(rows, "name string, n_present bigint, n_items bigint")


def q_flatten_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_attributes(to_map(derived.cust5(spark, sf)))


def q_attributes_long(spark: SparkSession, sf: str) -> DataFrame:
    return attributes_long(to_map(derived.docs5(spark, sf)))


def q_json_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return attributes_long(derived.event2(spark, sf))


def q_lookup_item(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_item(derived.part10(spark, sf), TARGET)


def q_exclude_item(spark: SparkSession, sf: str) -> DataFrame:
    return exclude_item(derived.part10(spark, sf), TARGET)


def q_match_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return match_indicators(derived.part10(spark, sf), TARGET)


def q_digit_score_compat(spark: SparkSession, sf: str) -> DataFrame:
    return digit_score_compat(_part10_with_clone(spark, sf), TARGET)


def q_similarity_score(spark: SparkSession, sf: str) -> DataFrame:
    return similarity_score(_part10_with_clone(spark, sf), TARGET)


def q_similarity_open(spark: SparkSession, sf: str) -> DataFrame:
    scored = similarity_open(to_map(derived.docs5(spark, sf)), OPEN_TARGET)
    return scored.select("sku", "match_count",
                         F.array_join("matched", ",").alias("matched"))


def q_rank_candidates(spark: SparkSession, sf: str) -> DataFrame:
    scored = digit_score_compat(_part10_with_clone(spark, sf), TARGET)
    return rank_candidates(scored, "compat", m=len(PART10)).select(
        "sku", COMPAT_SCORE_COLUMN, "rank")


def q_rank_candidates_fixed(spark: SparkSession, sf: str) -> DataFrame:
    scored = similarity_score(_part10_with_clone(spark, sf), TARGET)
    return rank_candidates(scored, "fixed", m=len(PART10)).select("sku", "score", "rank")


def q_top_k_similar(spark: SparkSession, sf: str) -> DataFrame:
    return top_k_similar(derived.part10(spark, sf), TARGET, K, unique_ids=True)


def q_top_k_wide(spark: SparkSession, sf: str) -> DataFrame:
    """64 attributes: more than a bigint score can hold."""
    wide = derived.orders_wide(spark, sf, WIDE)
    return top_k_weights(top_k_similar(wide, wide_target(spark, sf), K, unique_ids=True)).select(
        "sku", "rank", "match_count", "matched")


def wide_target(spark: SparkSession, sf: str) -> int:
    """The customer with the smallest id that has orders."""
    return derived.table(spark, sf, "orders").agg(F.min("o_custkey")).first()[0]


def q_reserved_names(spark: SparkSession, sf: str) -> DataFrame:
    """Six attributes named like result columns, the id, and each other."""
    flat = derived.part10(spark, sf)
    pairs = [x for n, c in zip(RESERVED_NAMES, PART10) for x in (F.lit(n), F.col(c))]
    catalog = flat.select("sku", F.create_map(*pairs).alias("attributes"))
    top = top_k_similar(flatten_attributes(catalog, RESERVED_NAMES), TARGET, K)
    return top_k_weights(top).select("sku", "rank", "score", "match_count", "mask", "matched")


def q_top_k_names(spark: SparkSession, sf: str) -> DataFrame:
    return top_k_names(q_top_k_similar(spark, sf))


def q_top_k_weights(spark: SparkSession, sf: str) -> DataFrame:
    return top_k_weights(q_top_k_similar(spark, sf))


def q_batch_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k(derived.part10(spark, sf), K, unique_ids=True)


def q_batch_top_k_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every part on an order line, each with its own number of results."""
    li = derived.table(spark, sf, "lineitem")
    asked = li.select(F.col("l_partkey").alias("sku")).distinct().withColumn("num", 1 + F.col("sku") % K)
    return batch_top_k(derived.part10(spark, sf), K, requests=asked, unique_ids=True)


def q_batch_top_k_k2000(spark: SparkSession, sf: str) -> DataFrame:
    """2,000 results for the parts whose key is that of a nation."""
    asked = derived.table(spark, sf, "nation").select(F.col("n_nationkey").alias("sku"))
    return batch_top_k(derived.part10(spark, sf), 2000, requests=asked, unique_ids=True)


def q_batch_top_k_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k(derived.part10_dirty(spark, sf), K)


def q_batch_top_k_wide(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k(derived.orders_wide(spark, sf, 24), K, unique_ids=True)


def q_batch_top_k_open(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by the parts they ordered: a name per part, a few of them per customer."""
    top = batch_top_k_open(derived.parts_of_customers(spark, sf), K, unique_ids=True)
    return top.withColumn("matched", F.array_join("matched", ","))


def q_batch_top_k_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k(derived.docs5(spark, sf), K)


def q_batch_top_k_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k_indexed(derived.cust5(spark, sf), K, unique_ids=True)


def q_batch_top_k_joined(spark: SparkSession, sf: str) -> DataFrame:
    return batch_top_k_joined(derived.cust5(spark, sf), K, unique_ids=True)


def q_batch_top_k_upkept(spark: SparkSession, sf: str) -> DataFrame:
    """An index of three quarters of the customers, to which the others are added, of which
    every seventh is removed and every fifth gets another segment; no rebuild."""
    cust = derived.cust5(spark, sf)
    key = F.col("sku")
    path = build_upkept_index(cust.filter(key % 4 != 0), K, unique_ids=True)
    update_index(spark, path, added=cust.filter(key % 4 == 0))
    update_index(spark, path, removed=cust.filter(key % 7 == 0).select("sku"))
    changed = cust.filter((key % 5 == 0) & (key % 7 != 0)).withColumn("b", F.lit("NONE"))
    update_index(spark, path, added=changed)
    return top_k_from_upkept(spark, path)


def q_lookup_stored(spark: SparkSession, sf: str) -> DataFrame:
    path = store_catalog(derived.part10(spark, sf), shared_path(spark, "part10-stored"))
    return lookup_item(read_stored(spark, path), TARGET)


def q_missing_requests(spark: SparkSession, sf: str) -> DataFrame:
    catalog = derived.docs5(spark, sf, labelled_only=True)
    requests = derived.table(spark, sf, "documents").select(F.col("doc_id").alias("sku"))
    return missing_requests(catalog, requests)


def q_append_and_count(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "nation-appends")
    nation = derived.table(spark, sf, "nation")
    append_rows(nation, path)
    append_and_count(nation, path)
    return table_rows(spark, path).agg(F.count(F.lit(1)).alias("n"))


def q_append_once(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by segment, a batch each, every batch twice."""
    path = shared_path(spark, "customer-batches")
    cust = derived.table(spark, sf, "customer")
    for segment in [r[0] for r in cust.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]:
        rows = cust.filter(F.col("c_mktsegment") == segment)
        append_once(rows, path, segment)
        append_once_and_count(rows, path, segment)
    return committed_rows(spark, path).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


def _served(spark: SparkSession, sf: str, key: str) -> str:
    """Serve a stream of all values of a lineitem key from the stored index of part10."""
    req_dir = shared_path(spark, "stream-requests")
    (derived.table(spark, sf, "lineitem").select(F.col(key).alias("sku")).distinct()
     .write.parquet(req_dir))
    stream = spark.readStream.schema("sku bigint").parquet(req_dir)
    out = shared_path(spark, "stream-answers")
    serve_requests(spark, derived.part10(spark, sf), stream, K, out, unique_ids=True).awaitTermination()
    return out


def q_stream_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return stream_results(spark, _served(spark, sf, "l_partkey"))


def q_stream_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys as requests: those that are no part key."""
    return stream_missing(spark, _served(spark, sf, "l_orderkey"))


def q_term_total(spark: SparkSession, sf: str) -> DataFrame:
    return term_total(derived.table(spark, sf, "documents"), "text", TERM)


def q_term_match(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived.table(spark, sf, "documents").select("doc_id", "text")
    return term_match(docs, "text", TERM, id_col="doc_id")


def q_term_index(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived.table(spark, sf, "documents").select("doc_id", "text")
    path = build_term_index(docs, "text", "doc_id", shared_path(spark, "term-index"))
    return search_terms(spark, path, TERM, "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_catalog": q_read_catalog,
    "read_catalog_rejects": q_read_catalog_rejects,
    "read_catalog_duplicates": q_read_catalog_duplicates,
    "read_catalog_infer": q_read_catalog_infer,
    "cached": q_cached,
    "flatten_attributes": q_flatten_attributes,
    "attributes_long": q_attributes_long,
    "json_attributes": q_json_attributes,
    "lookup_item": q_lookup_item,
    "exclude_item": q_exclude_item,
    "match_indicators": q_match_indicators,
    "digit_score_compat": q_digit_score_compat,
    "similarity_score": q_similarity_score,
    "similarity_open": q_similarity_open,
    "rank_candidates": q_rank_candidates,
    "rank_candidates_fixed": q_rank_candidates_fixed,
    "top_k_similar": q_top_k_similar,
    "top_k_wide": q_top_k_wide,
    "reserved_names": q_reserved_names,
    "top_k_names": q_top_k_names,
    "top_k_weights": q_top_k_weights,
    "batch_top_k": q_batch_top_k,
    "batch_top_k_requests": q_batch_top_k_requests,
    "batch_top_k_k2000": q_batch_top_k_k2000,
    "batch_top_k_dirty": q_batch_top_k_dirty,
    "batch_top_k_wide": q_batch_top_k_wide,
    "batch_top_k_open": q_batch_top_k_open,
    "batch_top_k_sparse": q_batch_top_k_sparse,
    "batch_top_k_indexed": q_batch_top_k_indexed,
    "batch_top_k_joined": q_batch_top_k_joined,
    "batch_top_k_upkept": q_batch_top_k_upkept,
    "lookup_stored": q_lookup_stored,
    "append_once": q_append_once,
    "term_index": q_term_index,
    "missing_requests": q_missing_requests,
    "append_and_count": q_append_and_count,
    "term_match": q_term_match,
    "term_total": q_term_total,
    "stream_top_k": q_stream_top_k,
    "stream_missing": q_stream_missing,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ten items most similar to item 42, with their weights."""
    return q_top_k_weights(spark, SMOKE_DIR)


def _present(module: str) -> bool:
    """Whether a module is there; errors inside it are not hidden."""
    package = module.rpartition(".")[0]
    return (not package or _present(package)) and importlib.util.find_spec(module) is not None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if _present("likewise.llm.queries"):
        from likewise.llm.queries import QUERIES as llm_queries
        found |= llm_queries
        if _present("corpus_pipeline"):
            import corpus_pipeline
            found["pipeline"] = corpus_pipeline.run
    return found


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

CTE_PART10 = """part10 AS (
  SELECT p_partkey AS sku, p_brand AS a, p_type AS b,
         split_part(p_name, ' ', 1) AS c, split_part(p_name, ' ', 2) AS d,
         CAST(p_size AS VARCHAR) AS e,
         CAST(CAST(floor(p_size / 10.0) AS BIGINT) AS VARCHAR) AS f,
         CAST(CAST(floor(p_retailprice / 100.0) AS BIGINT) AS VARCHAR) AS g,
         CAST((p_partkey * 7) % 15 AS VARCHAR) AS h,
         CAST(CAST(floor(p_partkey / 3.0) AS BIGINT) % 15 AS VARCHAR) AS i,
         CAST(CAST(floor(p_partkey / 11.0) AS BIGINT) % 15 AS VARCHAR) AS j
  FROM part)"""

CTE_CUST5 = """cust5 AS (
  SELECT c_custkey AS sku, CAST(c_nationkey AS VARCHAR) AS a, c_mktsegment AS b,
         CAST(CAST(floor(c_acctbal / 1000.0) AS BIGINT) AS VARCHAR) AS c,
         CAST(o.n AS VARCHAR) AS d, o.p AS e
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, max_by(o_orderpriority, o_orderkey) AS p
    FROM orders GROUP BY o_custkey) o ON c_custkey = o.o_custkey)"""

CTE_DOCS5 = """docs5 AS (
  SELECT d.doc_id AS sku, lang AS a, source AS b,
         CAST(CAST(floor(n_chars / 1000.0) AS BIGINT) AS VARCHAR) AS c,
         CAST(quality AS VARCHAR) AS d, CAST(toxic AS VARCHAR) AS e
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

CTE_PART10_CLONE = CTE_PART10 + f""",
part10c AS (
  SELECT * FROM part10
  UNION ALL
  SELECT CAST({CLONE_ID} AS BIGINT) AS sku, a, b, c, d, e, f, g, h, i, j
  FROM part10 WHERE sku = {TARGET})"""


def _mask_sql(names: list[str], x: str = "x", t: str = "t") -> str:
    m = len(names)
    return " + ".join(f"(CASE WHEN {x}.{n} = {t}.{n} THEN {1 << (m - 1 - i)} ELSE 0 END)"
                      for i, n in enumerate(names))


def _count_sql(names: list[str], x: str = "x", t: str = "t") -> str:
    return " + ".join(f"(CASE WHEN {x}.{n} = {t}.{n} THEN 1 ELSE 0 END)" for n in names)


def _scored_sql(cat: str, names: list[str], target: int) -> str:
    """Candidates of ``cat`` against ``target`` with score, match_count, mask."""
    m = len(names)
    cols = ", ".join(f"x.{n}" for n in names)
    return f"""SELECT x.sku, {cols},
         CAST(({_count_sql(names)}) * {1 << m} + ({_mask_sql(names)}) AS BIGINT) AS score,
         CAST({_count_sql(names)} AS INTEGER) AS match_count,
         CAST({_mask_sql(names)} AS BIGINT) AS mask
  FROM {cat} x, (SELECT * FROM {cat} WHERE sku = {target}) t
  WHERE x.sku <> {target}"""


def _indicators_sql(cat: str, names: list[str], target: int) -> str:
    m = len(names)
    cols = ", ".join(f"x.{n}" for n in names)
    ind = ", ".join(f"CAST(CASE WHEN x.{n} = t.{n} THEN {m - 1 - i} ELSE -1 END AS INTEGER) "
                    f"AS {INDICATOR_COLUMN.format(n)}" for i, n in enumerate(names))
    return f"""SELECT x.sku, {cols}, {ind}
  FROM {cat} x, (SELECT * FROM {cat} WHERE sku = {target}) t
  WHERE x.sku <> {target}"""


def _compat_sql(cat: str, names: list[str], target: int) -> str:
    cols = ", ".join(["sku", *names, *[INDICATOR_COLUMN.format(n) for n in names]])
    concat = ", ".join(INDICATOR_COLUMN.format(n) for n in names)
    return f"""SELECT {cols},
         TRY_CAST(regexp_replace(concat({concat}), '-1', '', 'g') AS INTEGER) AS {COMPAT_SCORE_COLUMN}
  FROM ({_indicators_sql(cat, names, target)})"""


def _batch_sql(cat: str, names: list[str], k: int, matched_only: bool = False,
               requests: str | None = None) -> str:
    m = len(names)
    where = "WHERE match_count > 0" if matched_only else ""
    req = f"WHERE t.sku IN ({requests})" if requests else ""
    return f"""pairs AS (
  SELECT t.sku AS request_sku, x.sku AS sku,
         CAST({_count_sql(names)} AS INTEGER) AS match_count,
         CAST({_mask_sql(names)} AS BIGINT) AS mask
  FROM {cat} t JOIN {cat} x ON t.sku <> x.sku {req}),
ranked AS (
  SELECT request_sku, sku, match_count, mask,
         CAST(match_count * {1 << m} + mask AS BIGINT) AS score,
         CAST(row_number() OVER (PARTITION BY request_sku
              ORDER BY match_count * {1 << m} + mask DESC, sku ASC) AS INTEGER) AS rn
  FROM pairs {where})
SELECT request_sku, rn, sku, score, match_count, mask FROM ranked WHERE rn <= {k}"""


def _wide_sql(m: int) -> str:
    cols = ", ".join(f"max(CASE WHEN o_orderkey % {m} = {i} THEN o_orderpriority END) AS o{i:02d}"
                     for i in range(m))
    return f"wide AS (SELECT o_custkey AS sku, {cols} FROM orders GROUP BY o_custkey)"


def _long_sql(cat: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT sku, '{n}' AS name, {n} AS value FROM {cat} WHERE {n} IS NOT NULL"
        for n in names)


def _digits_sql(names: list[str], mask: str = "mask") -> str:
    m = len(names)
    parts = ", ".join(f"CASE WHEN ({mask} & {1 << (m - 1 - i)}) <> 0 THEN '{m - 1 - i}' END"
                      for i in range(m))
    return f"concat_ws('', {parts})"


def _matched_sql(names: list[str], mask: str = "mask") -> str:
    m = len(names)
    parts = ", ".join(f"CASE WHEN ({mask} & {1 << (m - 1 - i)}) <> 0 THEN '{n}' END"
                      for i, n in enumerate(names))
    return f"concat_ws(',', {parts})"


def oracle_sql() -> dict[str, str]:
    p10 = PART10
    top = f"""SELECT * FROM ({_scored_sql('part10', p10, TARGET)})
  ORDER BY score DESC, sku ASC LIMIT {K}"""
    six = PART10[:6]
    six_top = f"""SELECT * FROM ({_scored_sql('part10', six, TARGET)})
  ORDER BY score DESC, sku ASC LIMIT {K}"""
    wide = [f"o{i:02d}" for i in range(WIDE)]
    wide_same = {n: f"CASE WHEN x.{n} = t.{n} THEN {{}} END" for n in wide}
    nation_first = """WITH first AS (
  SELECT c_nationkey AS sku, min('{"a":"' || c_mktsegment || '","b":"' || c_custkey || '"}') AS j
  FROM customer GROUP BY c_nationkey)
SELECT CAST(sku AS VARCHAR) AS sku, 'a' AS name, json_extract_string(j, '$.a') AS value FROM first
UNION ALL SELECT CAST(sku AS VARCHAR), 'b', json_extract_string(j, '$.b') FROM first"""
    hits = f"""SELECT doc_id, CAST(len(list_filter(
    string_split_regex(lower(text), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda tok: tok = '{TERM}')) AS INTEGER) AS hits
  FROM documents"""
    open_matched = ", ".join(f"CASE WHEN x.{n} = t.{n} THEN '{n}' END" for n in FIVE)
    llm_sql = {}
    if _present("likewise.llm.queries"):
        from likewise.llm.queries import ORACLE_SQL as llm_sql
    return llm_sql | {
        "read_catalog": f"""WITH {CTE_CUST5}, long AS ({_long_sql('cust5', FIVE)})
SELECT CAST(sku AS VARCHAR) AS sku, name, value FROM long""",
        "read_catalog_rejects": """SELECT CASE WHEN c_custkey % 10 = 0 THEN '{"sku":"' || c_custkey
            ELSE '{"attributes":{"a":"' || c_mktsegment || '"}}' END AS line,
       CASE WHEN c_custkey % 10 = 0 THEN 'malformed' ELSE 'no id' END AS reason
FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0""",
        "read_catalog_duplicates": nation_first,
        "read_catalog_infer": nation_first,
        "cached": f"""WITH {CTE_DOCS5}, long AS ({_long_sql('docs5', FIVE)})
SELECT name, count(*) AS n_present, (SELECT count(*) FROM docs5) AS n_items FROM long GROUP BY name""",
        "flatten_attributes": f"WITH {CTE_CUST5} SELECT * FROM cust5",
        "attributes_long": f"WITH {CTE_DOCS5} {_long_sql('docs5', FIVE)}",
        "json_attributes": """WITH event2 AS (
  SELECT event_id AS sku, event_type, json_extract_string(props, '$.k') AS k FROM events)
SELECT sku, 'event_type' AS name, event_type AS value FROM event2 WHERE event_type IS NOT NULL
UNION ALL
SELECT sku, 'k' AS name, k AS value FROM event2 WHERE k IS NOT NULL""",
        "lookup_item": f"WITH {CTE_PART10} SELECT * FROM part10 WHERE sku = {TARGET}",
        "exclude_item": f"WITH {CTE_PART10} SELECT * FROM part10 WHERE sku <> {TARGET}",
        "match_indicators": f"WITH {CTE_PART10} {_indicators_sql('part10', p10, TARGET)}",
        "digit_score_compat": f"WITH {CTE_PART10_CLONE} {_compat_sql('part10c', p10, TARGET)}",
        "similarity_score": f"WITH {CTE_PART10_CLONE} {_scored_sql('part10c', p10, TARGET)}",
        "similarity_open": f"""WITH {CTE_DOCS5}
SELECT x.sku, CAST({_count_sql(FIVE)} AS INTEGER) AS match_count,
       concat_ws(',', {open_matched}) AS matched
FROM docs5 x, (SELECT * FROM docs5 WHERE sku = {OPEN_TARGET}) t
WHERE x.sku <> {OPEN_TARGET}""",
        "rank_candidates": f"""WITH {CTE_PART10_CLONE}
SELECT sku, {COMPAT_SCORE_COLUMN},
       CAST(rank() OVER (ORDER BY {COMPAT_SCORE_COLUMN} ASC NULLS FIRST) AS INTEGER) AS rank
FROM ({_compat_sql('part10c', p10, TARGET)})""",
        "rank_candidates_fixed": f"""WITH {CTE_PART10_CLONE}
SELECT sku, score, rank() OVER (ORDER BY score DESC) AS rank
FROM ({_scored_sql('part10c', p10, TARGET)})""",
        "top_k_similar": f"WITH {CTE_PART10} {top}",
        "top_k_wide": f"""WITH {_wide_sql(WIDE)}, scored AS (
  SELECT x.sku, {_count_sql(wide)} AS n,
         concat({", ".join(f"CASE WHEN x.{c} = t.{c} THEN '1' ELSE '0' END" for c in wide)}) AS bits,
         concat_ws(',', {", ".join(v.format(f"'{c}'") for c, v in wide_same.items())}) AS matched
  FROM wide x, (SELECT * FROM wide ORDER BY sku LIMIT 1) t WHERE x.sku <> t.sku)
SELECT sku, CAST(row_number() OVER (ORDER BY n DESC, bits DESC, sku) AS INTEGER) AS rank,
       CAST(n AS INTEGER) AS match_count, matched
FROM (SELECT * FROM scored ORDER BY n DESC, bits DESC, sku LIMIT {K})""",
        "reserved_names": f"""WITH {CTE_PART10}
SELECT sku, CAST(row_number() OVER (ORDER BY score DESC, sku ASC) AS INTEGER) AS rank,
       score, match_count, mask, concat_ws(',', {", ".join(
           f"CASE WHEN (mask & {1 << (5 - i)}) <> 0 THEN '{n}' END" for i, n in enumerate(RESERVED_NAMES))}) AS matched
FROM ({six_top})""",
        "top_k_names": f"""WITH {CTE_PART10}
SELECT sku AS "{NAMES_COLUMN}" FROM ({top})""",
        "top_k_weights": f"""WITH {CTE_PART10}
SELECT sku, CAST(row_number() OVER (ORDER BY score DESC, sku ASC) AS INTEGER) AS rank,
       score, match_count, mask, {_digits_sql(p10)} AS digits, {_matched_sql(p10)} AS matched
FROM ({top})""",
        "batch_top_k": f"WITH {CTE_PART10}, {_batch_sql('part10', p10, K)}",
        "batch_top_k_requests": f"WITH {CTE_PART10}, " + _batch_sql(
            "part10", p10, K, requests="SELECT l_partkey FROM lineitem")
            + " AND rn <= 1 + request_sku % 10",
        "batch_top_k_k2000": f"WITH {CTE_PART10}, " + _batch_sql(
            "part10", p10, 2000, requests="SELECT n_nationkey FROM nation"),
        "batch_top_k_dirty": f"""WITH {CTE_PART10}, dirty AS (
  SELECT sku, CASE WHEN sku % 3 = 0 THEN 'A0' ELSE a END AS a, b, c, d, e, f, g, h, i, j FROM part10),
{_batch_sql('dirty', p10, K)}""",
        "batch_top_k_wide": f"WITH {_wide_sql(24)}, {_batch_sql('wide', [f'o{i:02d}' for i in range(24)], K)}",
        "batch_top_k_open": f"""WITH long AS (
  SELECT o_custkey AS sku, 'part' || l_partkey AS name, max(l_returnflag) AS value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey),
ids AS (SELECT DISTINCT sku FROM long),
pairs AS (
  SELECT t.sku AS request_sku, x.sku, count(*) AS n, string_agg(t.name, ',' ORDER BY t.name) AS matched
  FROM long t JOIN long x ON x.name = t.name AND x.value = t.value AND x.sku <> t.sku GROUP BY t.sku, x.sku),
every AS (
  SELECT t.sku AS request_sku, x.sku, coalesce(n, 0) AS n, coalesce(matched, '') AS matched
  FROM ids t JOIN ids x ON x.sku <> t.sku LEFT JOIN pairs p ON p.request_sku = t.sku AND p.sku = x.sku),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_sku ORDER BY n DESC, string_split(matched, ','), sku) AS rn FROM every)
SELECT request_sku, CAST(rn AS INTEGER) AS rn, sku, CAST(n AS INTEGER) AS match_count, matched FROM ranked WHERE rn <= {K}""",
        "batch_top_k_sparse": f"WITH {CTE_DOCS5}, {_batch_sql('docs5', FIVE, K)}",
        "batch_top_k_indexed": f"WITH {CTE_CUST5}, "
                               f"{_batch_sql('cust5', FIVE, K, matched_only=True)}",
        "batch_top_k_joined": f"WITH {CTE_CUST5}, "
                              f"{_batch_sql('cust5', FIVE, K, matched_only=True)}",
        "batch_top_k_upkept": f"""WITH {CTE_CUST5}, kept AS (
  SELECT sku, a, CASE WHEN sku % 5 = 0 THEN 'NONE' ELSE b END AS b, c, d, e FROM cust5 WHERE sku % 7 <> 0),
{_batch_sql('kept', FIVE, K)}""",
        "lookup_stored": f"WITH {CTE_PART10} SELECT * FROM part10 WHERE sku = {TARGET}",
        "append_once": "SELECT c_mktsegment AS batch, count(*) AS n FROM customer GROUP BY c_mktsegment",
        "term_index": f"SELECT doc_id, hits FROM ({hits}) WHERE hits > 0",
        "missing_requests": """SELECT DISTINCT d.doc_id AS sku FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "append_and_count": "SELECT CAST(2 * count(*) AS BIGINT) AS n FROM nation",
        "stream_top_k": f"WITH {CTE_PART10}, "
                        f"{_batch_sql('part10', p10, K, requests='SELECT l_partkey FROM lineitem')}",
        "stream_missing": """SELECT DISTINCT l_orderkey AS sku FROM lineitem
WHERE l_orderkey NOT IN (SELECT p_partkey FROM part)""",
        "term_match": f"SELECT doc_id, hits FROM ({hits}) WHERE hits > 0",
        "term_total": f"""SELECT count(*) FILTER (WHERE hits > 0) AS matching_rows,
       CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits FROM ({hits})""",
    }
