"""Line dedup with a log-template tree.

A line is parsed to a fixed depth: first by its number of tokens, then by its
leading tokens, where a token with a digit counts as variable.  Below such a leaf
come up to ``LEVELS`` branches: the lines of a node that no template took go on by the
token they share with the most lines of the node, at a position not yet used.  So
a leaf holds several templates, the smaller families as well as the largest.

In each branch a position behind the leading tokens is constant if one token fills
it in at least half of the branch's distinct lines.  With two constant positions,
and in half of these positions, the branch has a template; the lines that have
three quarters of its constants share it.  Leading tokens don't count, as they are
equal in a leaf anyway.

Lines go when they recur: a line of ``LONG_WORDS`` words or more from the second
document on, any other line, and every generalised template, from ``MIN_DOCS``
documents on.

Only DataFrame functions are used.  Every line is masked once and stored; keys
are hashes, and token rows are made only for leaves that can reach the bar.
Counts are combined per task before they move; lines so common that their rows
would fill a task are broadcast, at most a few per partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import col, materialize

DEPTH = 3
LEVELS = 3
MIN_DOCS = 10
LONG_WORDS = 50
LONG_DOCS = 2
MIN_CONSTANT = 2
VARIABLE = "<*>"
# A line is hot with more rows than a quarter of a partition's even share.
HOT_PARTS = 4


def masked(line: Column) -> Column:
    """The line's tokens, those with a digit replaced, single blanks between them."""
    # Most lines have nothing to squeeze; a search is cheaper than a replacement.
    odd = line.contains("  ") | line.rlike(r"[\t\x0B\f\r]")
    squeezed = F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line))
    return F.when(squeezed.rlike("[0-9]"), F.regexp_replace(squeezed, r"[^ ]*[0-9][^ ]*", VARIABLE)
                  ).otherwise(squeezed)


def line_rows(docs: DataFrame, id_col: str, text_col: str, depth: int = DEPTH) -> DataFrame:
    """``(id, doc, at, n_tokens, leaf, line, text)`` for every line with a token; ``doc`` is
    a hash of the document's text, ``at`` the line's place and ``text`` its masked text."""
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("doc"),
                       F.posexplode(F.transform(F.split(col(text_col), "\n"), masked)).alias("at", "text"))
    tokens = F.split("text", " ")
    return rows.filter("text != ''").select(
        "id", "doc", "at", F.size(tokens).alias("n_tokens"),
        F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth)).alias("leaf"), F.xxhash64("text").alias("line"), "text")


def _token_rows(lines: DataFrame) -> DataFrame:
    return lines.select("grp", "line", "used", F.posexplode("tail").alias("pos", "token"))


def _branch(active: DataFrame, min_docs: int) -> DataFrame:
    """The lines of ``active`` (``grp, line, n, tail, used``) in their next node: by the
    unused token that most lines of the node share (the first place in a tie).  Lines
    that share none, and nodes that cannot reach the bar, are left out."""
    tokens = _token_rows(active).filter(~F.array_contains("used", F.col("pos"))).drop("used")
    shared = tokens.groupBy("grp", "pos", "token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    pivot = (tokens.join(shared, ["grp", "pos", "token"]).groupBy("grp", "line")
             .agg(F.max(F.struct("c", (-F.col("pos")).alias("before"), "token")).alias("p")))
    return active.join(pivot, ["grp", "line"]).select(
        F.xxhash64("grp", "p.before", "p.token").alias("grp"), "line", "n", "tail",
        F.concat("used", F.array(-F.col("p.before"))).alias("used"))


def _constants(nodes: DataFrame, min_docs: int) -> DataFrame:
    """``(grp, constants)``: the constant places and tokens of every node with several
    lines and ``min_docs`` documents in all."""
    sizes = nodes.groupBy("grp").agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("lines"))
    sizes = sizes.filter((F.col("docs") >= min_docs) & (F.col("lines") > 1)).select("grp", "lines")
    counts = _token_rows(nodes).groupBy("grp", "pos", "token").agg(F.count(F.lit(1)).alias("c"))
    best = counts.groupBy("grp", "pos").agg(F.max(F.struct("c", "token")).alias("best"))
    constant = best.join(sizes, "grp").withColumn("constant", 2 * F.col("best.c") >= F.col("lines"))
    return constant.groupBy("grp").agg(F.sort_array(F.collect_list(
        F.when(F.col("constant"), F.struct("pos", F.col("best.token").alias("token"))))).alias("constants"))


def assign_templates(lines: DataFrame, min_docs: int = MIN_DOCS, levels: int = LEVELS) -> DataFrame:
    """``(line, template)`` for the lines that share a generalised template.  ``lines`` has
    ``leaf, line, n, tail``: distinct lines, their documents and the tokens behind the
    leading ones."""
    active = lines.select(F.col("leaf").alias("grp"), "line", "n", "tail", F.array().cast("array<int>").alias("used"))
    found = []
    for level in range(levels):
        nodes = materialize(_branch(active, min_docs), f"template-nodes{level}")
        fitted = nodes.join(_constants(nodes, min_docs), "grp")
        held = F.size(F.filter("constants", lambda c: F.get("tail", c["pos"]) == c["token"]))
        all_of = F.size("constants")
        fits = (all_of >= MIN_CONSTANT) & (2 * all_of >= F.size("tail")) & (4 * held >= 3 * all_of)
        fitted = materialize(fitted.select("grp", "line", "n", "tail", "used", fits.alias("fits")),
                             f"template-fits{level}")
        found.append(fitted.filter("fits").select("line", F.col("grp").alias("template")))
        active = fitted.filter("NOT fits").drop("fits")
    return reduce(DataFrame.unionByName, found)


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_docs: int = MIN_DOCS, long_words: int = LONG_WORDS, long_docs: int = LONG_DOCS,
                    depth: int = DEPTH, levels: int = LEVELS) -> DataFrame:
    """``(id, doc, gone)``: for each document with recurring lines, their places."""
    spark = docs.sparkSession
    rows = materialize(line_rows(docs, id_col, text_col, depth), "template-lines")
    # The tokens are read again only for leaves that can reach the bar.
    counted = (rows.select("leaf", "line", "n_tokens", "id", "doc").distinct().groupBy("leaf", "line", "n_tokens")
               .agg(F.count(F.lit(1)).alias("n")))
    counted = materialize(counted, "template-counts")
    open_leaves = (counted.filter(F.col("n_tokens") >= depth + MIN_CONSTANT).groupBy("leaf")
                   .agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("lines"))
                   .filter((F.col("docs") >= min_docs) & (F.col("lines") > 1)).select("leaf"))
    texts = rows.select("leaf", "line", "text").join(open_leaves, "leaf", "left_semi").groupBy("leaf", "line").agg(
        F.min("text").alias("text"))
    lines = texts.join(counted, ["leaf", "line"]).select(
        "leaf", "line", "n", F.slice(F.split("text", " "), F.lit(depth + 1), F.col("n_tokens")).alias("tail"))
    templates = materialize(assign_templates(materialize(lines, "template-texts"), min_docs, levels), "templates")
    often = (rows.select("line", "id", "doc").join(templates, "line").select("template", "id", "doc").distinct()
             .groupBy("template").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= min_docs))
    bar = F.when(F.col("n_tokens") >= long_words, F.lit(long_docs)).otherwise(F.lit(min_docs))
    by_template = templates.join(often.select("template"), "template", "left_semi").select("line")
    bad = counted.filter(F.col("n") >= bar).select("line").unionByName(by_template).distinct()
    bad = materialize(bad.join(counted.groupBy("line").agg(F.sum("n").alias("n")), "line"), "template-bad")
    # Of lines with more than 1 / (HOT_PARTS * partitions) of all rows there are at most
    # HOT_PARTS * partitions, so they can be broadcast.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(bad.filter(F.col("n") * (HOT_PARTS * parts) > total).select("line"))
    cold = bad.filter(F.col("n") * (HOT_PARTS * parts) <= total).select("line")
    places = rows.select("id", "doc", "line", "at")
    gone = places.join(hot, "line", "left_semi").unionByName(
        places.join(hot, "line", "left_anti").join(cold, "line", "left_semi"))
    return gone.groupBy("id", "doc").agg(F.collect_set("at").alias("gone"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """``(row, text, n_lines, n_dropped)`` for every row of ``docs``: ``row`` holds its
    columns but the text, ``text`` is without the recurring lines, and the counts are of
    lines with a token.

    A null text stays null with no lines; blank lines stay; long texts are read whole.
    Rows equal in id and text are one document for the counts and treated alike.  Null
    ids are ids.  An empty table gives no rows.
    """
    found = recurring_lines(docs, id_col, text_col, **options)
    found = found.select(F.col("id").alias("found_id"), F.col("doc").alias("found_doc"), "gone")
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[col(c) for c in others]).alias("row"), col(text_col).alias("text"),
                       col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("doc"))
    joined = rows.join(found, rows["id"].eqNullSafe(found["found_id"])
                       & (rows["doc"] == found["found_doc"]), "left")
    every = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("gone"))
    text = F.array_join(F.transform(kept, lambda i: F.get(every, i)), "\n")
    full = F.size(F.filter(every, lambda line: line.rlike(r"\S")))
    return joined.select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.coalesce(full, F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


def templates_sql(min_docs: int = MIN_DOCS, long_words: int = LONG_WORDS, long_docs: int = LONG_DOCS,
                  depth: int = DEPTH, levels: int = LEVELS) -> str:
    """DuckDB SQL for ``doc_id, text, n_lines, n_dropped`` of ``documents``."""
    parts = [f"""a0 AS (
  SELECT leaf AS grp, m, n, list_slice(string_split(m, ' '), {depth + 1}, n_tokens) AS tail, CAST([] AS BIGINT[]) AS used
  FROM every WHERE n_tokens >= {depth + MIN_CONSTANT})"""]
    for k in range(levels):
        parts.append(f"""t{k} AS (
  SELECT grp, m, unnest(tail) AS token, unnest(range(len(tail))) AS pos, used FROM a{k}),
u{k} AS (SELECT grp, m, token, pos, count(*) OVER (PARTITION BY grp, pos, token) AS c
         FROM t{k} WHERE NOT list_contains(used, pos)),
v{k} AS (SELECT grp, m, token, pos FROM u{k} WHERE c > 1
         QUALIFY row_number() OVER (PARTITION BY grp, m ORDER BY c DESC, pos) = 1),
w{k} AS (SELECT v.grp || ' / ' || v.pos || ' ' || v.token AS grp, a.m, a.n, a.tail, list_append(a.used, v.pos) AS used
         FROM a{k} a JOIN v{k} v ON v.grp = a.grp AND v.m = a.m),
s{k} AS (SELECT grp, count(*) AS lines FROM w{k} GROUP BY grp HAVING sum(n) >= {min_docs} AND count(*) > 1),
c{k} AS (
  SELECT grp, pos, token FROM (
    SELECT grp, pos, token, count(*) AS c FROM (
      SELECT grp, unnest(tail) AS token, unnest(range(len(tail))) AS pos FROM w{k}) GROUP BY grp, pos, token
    QUALIFY row_number() OVER (PARTITION BY grp, pos ORDER BY c DESC, token DESC) = 1)
  JOIN s{k} USING (grp) WHERE 2 * c >= lines),
f{k} AS (
  SELECT w.grp, w.m, w.n, w.tail, w.used, count(c.pos) AS consts, count(*) FILTER (w.tail[c.pos + 1] = c.token) AS held
  FROM w{k} w JOIN s{k} USING (grp) LEFT JOIN c{k} c ON c.grp = w.grp GROUP BY w.grp, w.m, w.n, w.tail, w.used),
g{k} AS (SELECT *, consts >= {MIN_CONSTANT} AND 2 * consts >= len(tail) AND 4 * held >= 3 * consts AS fits FROM f{k}),
a{k + 1} AS (SELECT grp, m, n, tail, used FROM g{k} WHERE NOT fits)""")
    named = " UNION ALL ".join(f"SELECT m, grp AS template FROM g{k} WHERE fits" for k in range(levels))
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY doc_id, text) AS doc, doc_id, text FROM documents),
lines AS (
  SELECT r, doc, line, i, regexp_replace(trim(regexp_replace(line, '\\s+', ' ', 'g')),
                                         '[^ ]*[0-9][^ ]*', '{VARIABLE}', 'g') AS m
  FROM (SELECT r, doc, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
every AS (
  SELECT m, len(string_split(m, ' ')) AS n_tokens, count(DISTINCT doc) AS n,
         len(string_split(m, ' ')) || ' ' || array_to_string(list_slice(string_split(m, ' '), 1, {depth}), ' ') AS leaf
  FROM lines WHERE m <> '' GROUP BY m),
{", ".join(parts)},
named AS ({named}),
often AS (SELECT template FROM named JOIN lines USING (m) GROUP BY template HAVING count(DISTINCT doc) >= {min_docs}),
bad AS (
  SELECT m FROM every WHERE n >= CASE WHEN n_tokens >= {long_words} THEN {long_docs} ELSE {min_docs} END
  UNION SELECT m FROM named WHERE template IN (SELECT template FROM often)),
judged AS (SELECT r, line, i, m <> '' AS is_full, m IN (SELECT m FROM bad) AS gone FROM lines),
joined AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept,
         count(*) FILTER (WHERE is_full) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
  FROM judged GROUP BY r)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN kept END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM d LEFT JOIN joined USING (r)"""
