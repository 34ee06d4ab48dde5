"""Chat formatting by quotation linking.

The lines of a message that start with ``>`` are quotes; the number of signs is
the nesting level.  Runs of one level are passages.  Normalised passages (and
their lines) are hashed and joined to the normalised texts, paragraphs and lines
of earlier messages of the conversation: of all messages with an equal hash the
latest earlier one counts, found by sorting the turns of a hash in ranges and not by
pairing them.
The message that covers most characters of a message's first-level quotes is
the one it replies to.  Replies follow their thread's first message, and quotes
and their introductions are left out of the formatted text.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.numbering import numbered
from .common import col, materialize

_PREFIX = r"^(?:[ \t]*>)+"
# Turns of one window, so that a long conversation is not one.
TURNS = 1024
_INTRODUCTION = r"(?i)\b(wrote|writes|said|schrieb|écrit|a écrit|escribió)\s*:\s*$"
CHUNK = 64
PREFIX = 64


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _level(line: Column) -> Column:
    return F.regexp_count(F.regexp_extract(line, _PREFIX, 0), F.lit(">"))


def parse_quotes(messages: DataFrame) -> DataFrame:
    """Adds ``own`` (the text without quotes and without lines that introduce one)
    and ``passages``, an array of ``level, text``, to rows with a ``text``."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.struct(
        _level(line).alias("level"),
        F.regexp_replace(line, _PREFIX + r"[ \t]?", "").alias("body")))
    rows = messages.withColumn("_lines", lines)
    at = lambda i: F.get("_lines", i)
    rows = rows.withColumn("_cuts", F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1),
        lambda i: (i == 0) | (at(i)["level"] != at(i - 1)["level"])))
    passages = F.transform("_cuts", lambda i, k: F.struct(
        at(i)["level"].alias("level"),
        F.array_join(F.transform(
            F.slice("_lines", i + 1, F.coalesce(F.get("_cuts", k + 1), F.size("_lines")) - i),
            lambda x: x["body"]), "\n").alias("text")))
    own = F.filter(
        "_lines", lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(_INTRODUCTION)
                                                     & (F.coalesce(at(i + 1)["level"], F.lit(0)) > 0)))
    # A message without quotes keeps its text as it is.
    quoting = F.exists("_lines", lambda x: x["level"] > 0)
    return rows.withColumn("own", F.when(quoting, F.trim(F.array_join(
        F.transform(own, lambda x: x["body"]), "\n"), F.lit(" \n\t"))).otherwise(F.col("text"))).withColumn(
        "passages", F.filter(passages, lambda p: (p["level"] > 0) & (_normal(p["text"]) != ""))).drop(
        "_lines", "_cuts")


def _keys(text: Column) -> Column:
    """Distinct ``hash, size`` of the normalised whole, paragraphs and lines of a text."""
    parts = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, "\n"))
    normal = F.array_distinct(F.filter(F.transform(parts, _normal), lambda p: p != ""))
    return F.transform(normal, lambda p: F.struct(F.md5(p).alias("hash"), F.length(p).alias("size")))


def _group(name: str) -> Column:
    """A text without nulls for a value or a null."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """``(conv, turn, h, passage, level, found, size)``: for each quoted passage and each
    earlier message found for it, the matched characters.  ``messages`` is parsed
    and has ``conv, turn, h`` (a hash that tells rows of one turn apart)."""
    quoted = messages.filter(F.size("passages") > 0).select(
        "conv", "turn", "h", F.posexplode("passages").alias("passage", "p"))
    quoted = quoted.select("conv", "turn", "h", "passage", F.col("p.level").alias("level"),
                           F.explode(_keys(F.col("p.text"))).alias("key"))
    quoted = quoted.filter("turn IS NOT NULL").select("conv", "turn", "h", "passage", "level", "key.hash", "key.size")
    quoted = quoted.withColumn("grp", _group("conv"))
    asked = quoted.select("grp", "hash", "turn").distinct()
    own = messages.filter("turn IS NOT NULL").select(
        _group("conv").alias("grp"), "turn", F.explode(_keys(F.coalesce("own", F.lit("")))).alias("key"))
    own = own.select("grp", F.col("key.hash").alias("hash"), "turn").distinct()
    own = own.join(asked.select("grp", "hash").distinct(), ["grp", "hash"], "left_semi")
    # Each turn once, in ranges of turns; the last turn of earlier ranges is carried on.
    both = own.withColumn("source", F.col("turn")).unionByName(asked.withColumn("source", F.lit(None).cast("bigint")))
    both = materialize(both.withColumn("range", F.floor(F.col("turn") / TURNS)), "quote-turns")
    tops = both.groupBy("grp", "hash", "range").agg(F.max("source").alias("top"))
    before = Window.partitionBy("grp", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("grp", "hash", "range", F.max("top").over(before).alias("carried"))
    # Quotes of a turn come before the turn's own texts, so only earlier turns count.
    inside = (Window.partitionBy("grp", "hash", "range").orderBy("turn", F.col("source").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("last", F.last("source", ignorenulls=True).over(inside)).filter("source IS NULL")
    found = found.join(tops, ["grp", "hash", "range"]).select(
        "grp", "hash", "turn", F.coalesce("last", "carried").alias("found")).filter("found IS NOT NULL")
    return (quoted.join(found, ["grp", "hash", "turn"])
            .groupBy("conv", "turn", "h", "passage", "level", "found").agg(F.sum("size").alias("size")))


def _threads(parents: DataFrame) -> DataFrame:
    """``(conv, turn, root, depth)`` of turns with a parent, by doubling steps."""
    state = materialize(parents.groupBy("conv", "turn").agg(F.min("parent").alias("root"))
                        .withColumn("depth", F.lit(1)), "quote-threads")
    while True:
        up = state.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("root").alias("r"),
                          F.col("depth").alias("d"))
        step = state.join(up, state["conv"].eqNullSafe(up["c"]) & (state["root"] == up["t"]), "left")
        if step.filter("r IS NOT NULL").isEmpty():
            return state
        state = materialize(step.select("conv", "turn", F.coalesce("r", "root").alias("root"),
                                        (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth")),
                            "quote-threads")


def reply_ordered(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, n_quotes, reply_to, thread, depth, position)`` for
    every message: its own text, the number of quoted passages, the turn it replies to
    (null without a linked quote), the first turn of its thread, its distance from
    it, and its place in the conversation's reply order from 1: threads by first
    turn, in a thread by turn.

    A null text has no quotes and stays null.  Null conversations are one
    conversation; a message with a null turn links to nothing and comes last.
    Rows of one turn are ordered by role and text; repeated rows are kept.  An
    empty table gives no rows.  Other columns are not read.
    """
    rows = messages.select(col(conv_col).alias("conv"), col(turn_col).cast("bigint").alias("turn"),
                           col(role_col).alias("role"), col(text_col).alias("text"))
    # Parsed once, as the rows are read for quotes, for own texts and for the result.
    rows = materialize(parse_quotes(rows.withColumn("h", F.xxhash64("role", "text"))), "quote-messages")
    links = materialize(link_quotes(rows), "quote-links")
    best = Window.partitionBy("conv", "turn", "h").orderBy(F.desc("size"), F.desc("found"))
    replies = (links.filter("level = 1").groupBy("conv", "turn", "h", "found").agg(F.sum("size").alias("size"))
               .withColumn("n", F.row_number().over(best)).filter("n = 1")
               .select("conv", "turn", "h", F.col("found").alias("parent")))
    replies = materialize(replies, "quote-replies")
    threads = _threads(replies)
    up = replies.join(threads.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "root", "depth"),
                      replies["conv"].eqNullSafe(F.col("c")) & (replies["parent"] == F.col("t")), "left")
    up = up.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("h").alias("x"), "parent",
                   F.coalesce("root", "parent").alias("root"),
                   (F.coalesce("depth", F.lit(0)) + 1).alias("depth"))
    placed = rows.join(up, rows["conv"].eqNullSafe(up["c"]) & (rows["turn"] == up["t"])
                       & (rows["h"] == up["x"]), "left")
    placed = placed.select(
        "conv", "turn", "role", F.col("own").alias("text"), F.size("passages").cast("bigint").alias("n_quotes"),
        F.col("parent").alias("reply_to"), F.coalesce("root", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"))
    # Ranges by the start of the text, so that texts are no range bounds; a short one is
    # told from its likes by its row.
    placed = materialize(placed.withColumn("grp", _group("conv")).withColumn("row", F.monotonically_increasing_id()),
                         "quote-places")
    start = F.substring("text", 1, PREFIX)
    whole = F.col("text").isNull() | (F.length("text") <= PREFIX)
    first = [F.asc_nulls_last("thread"), F.asc_nulls_last("turn"), F.asc_nulls_first("role")]
    keys = [*first, F.asc_nulls_first(start), F.when(whole, F.col("row")).otherwise(F.lit((1 << 63) - 1))]
    placed = numbered(placed, "grp", keys, [*first, F.asc_nulls_first("text"), "row"])
    return placed.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                         F.col("text").alias(text_col), "n_quotes", "reply_to", "thread", "depth",
                         (F.col("idx") + 1).alias("position"))


def format_chat(ordered: DataFrame, conv_col: str = "conv_id", role_col: str = "role",
                text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``(conv_id, part, chat)``: the formatted conversations, ``chunk`` messages of
    ``reply_ordered`` to a row.  Messages without text are left out of the chat."""
    part = F.floor((F.col("position") - 1) / chunk)
    line = F.concat(F.lit("<|"), F.coalesce(col(role_col), F.lit("")), F.lit("|>\n"), col(text_col), F.lit("\n"))
    told = ordered.select(col(conv_col).alias(conv_col), part.alias("part"), "position", line.alias("line"))
    return told.groupBy(conv_col, "part").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("position", F.coalesce("line", F.lit("")).alias("line")))),
        lambda x: x["line"]), "").alias("chat"))


def reply_ordered_sql(source: str = "conversations") -> str:
    """DuckDB SQL for ``reply_ordered`` of ``source``."""
    normal = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
    keys = ("list_distinct(list_filter(list_transform(list_concat([{0}], string_split_regex({0}, '\\n\\s*\\n'), "
            "string_split({0}, chr(10))), lambda p: " + normal.format("p") + "), lambda p: p <> ''))")
    return f"""WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id AS conv, turn, role, text FROM {source}),
split AS (
  SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM m),
lines AS (
  SELECT r, i, len(regexp_extract_all(regexp_extract(line, '{_PREFIX}'), '>')) AS level,
         regexp_replace(line, '{_PREFIX}[ \t]?', '') AS body FROM split),
near AS (
  SELECT *, coalesce(lag(level) OVER (PARTITION BY r ORDER BY i), -1) <> level AS cut,
         coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) AS next_level FROM lines),
runs AS (SELECT *, sum(CAST(cut AS INT)) OVER (PARTITION BY r ORDER BY i) AS passage FROM near),
passages AS (
  SELECT r, passage, any_value(level) AS level, string_agg(body, chr(10) ORDER BY i) AS text
  FROM runs WHERE level > 0 GROUP BY r, passage),
full_passages AS (SELECT * FROM passages WHERE {normal.format("text")} <> ''),
owned AS (
  SELECT r, trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (
           WHERE level = 0 AND NOT (next_level > 0 AND regexp_matches(body, '{_INTRODUCTION}'))), ''),
         ' ' || chr(10) || chr(9)) AS own, max(level) AS top FROM runs GROUP BY r),
said AS (SELECT m.*, CASE WHEN top > 0 THEN own ELSE text END AS own FROM m JOIN owned USING (r)),
sources AS (
  SELECT DISTINCT conv, turn, unnest({keys.format("coalesce(own, '')")}) AS k FROM said WHERE turn IS NOT NULL),
quoted AS (
  SELECT r, conv, turn, passage, level, unnest({keys.format("p.text")}) AS k
  FROM full_passages p JOIN m USING (r) WHERE turn IS NOT NULL),
found AS (
  SELECT q.r, q.conv, q.turn, level, length(q.k) AS size, max(s.turn) AS found
  FROM quoted q JOIN sources s ON s.conv IS NOT DISTINCT FROM q.conv AND s.k = q.k AND s.turn < q.turn
  GROUP BY q.r, q.conv, q.turn, passage, level, q.k),
weighed AS (SELECT r, conv, turn, found, sum(size) AS size FROM found WHERE level = 1 GROUP BY r, conv, turn, found),
replies AS (
  SELECT r, conv, turn, found AS parent FROM weighed
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY size DESC, found DESC) = 1),
nodes AS (SELECT conv, turn, min(parent) AS parent FROM replies GROUP BY conv, turn),
chains(conv, turn, root, depth) AS (
  SELECT conv, turn, parent, 1 FROM nodes
  UNION ALL
  SELECT c.conv, c.turn, n.parent, depth + 1 FROM chains c JOIN nodes n
  ON n.conv IS NOT DISTINCT FROM c.conv AND n.turn = c.root),
threads AS (SELECT conv, turn, min(root) AS root, max(depth) AS depth FROM chains GROUP BY conv, turn),
placed AS (
  SELECT s.conv AS conv_id, s.turn, s.role, s.own AS text,
         (SELECT count(*) FROM full_passages p WHERE p.r = s.r) AS n_quotes, y.parent AS reply_to,
         coalesce(t.root, y.parent, s.turn) AS thread,
         CASE WHEN y.parent IS NULL THEN 0 ELSE coalesce(t.depth, 0) + 1 END AS depth
  FROM said s LEFT JOIN replies y ON y.r = s.r
  LEFT JOIN threads t ON t.conv IS NOT DISTINCT FROM y.conv AND t.turn = y.parent)
SELECT conv_id, turn, role, text, n_quotes, reply_to, thread, depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS LAST, turn NULLS LAST,
                          role NULLS FIRST, text NULLS FIRST) AS position
FROM placed"""
