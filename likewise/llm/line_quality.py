"""Quality rules, line first.

Every line is judged by punctuation, navigation, symbol, shouting, repetition
and boilerplate rules; failing lines are removed, and a document that loses
too much of its text is rejected as a whole.  Base statistics of the whole
text reject documents outright.  Only DataFrame functions are used; a
document's arrays never leave its row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import col

# Fixed values of the base rules.
BLANKS = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MAX_LOST_PERCENT = 40
ENDINGS = ".!?:;,…)]}\"'”’»。！？"
LONG_LINE = 12          # words from which a line needs punctuation
SHORT_LINE = 30         # words up to which a line can be boilerplate
# Fixed phrases of English, German, French and Spanish pages, in lower case.
BOILERPLATE = (
    "all rights reserved|licen[cs]ed under|released under the|terms of (use|service)|"
    "privacy policy|cookie policy|accept (all )?cookies|sign (in|up)|log ?in to|subscribe (to|now)|"
    "click here|read more|share this|skip to (main )?content|javascript is (disabled|required)|"
    "copyright (©|\\(c\\)|[0-9]{4})|"
    "alle rechte vorbehalten|lizenziert unter|datenschutzerklärung|nutzungsbedingungen|impressum|"
    "cookies? akzeptieren|hier (klicken|anmelden)|weiterlesen|zum (haupt)?inhalt springen|"
    "tous droits réservés|sous licence|politique de confidentialité|mentions légales|conditions d.utilisation|"
    "accepter les cookies|cliquez ici|lire la suite|se connecter|aller au contenu|"
    "todos los derechos reservados|bajo (la )?licencia|política de privacidad|aviso legal|términos de uso|"
    "aceptar (las )?cookies|haga clic aquí|leer más|iniciar sesión|(ir|saltar) al contenido")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def line_rules() -> dict[str, Callable[[Column, Column], Column]]:
    """Rules by name: whether a line, given with its array of words, fails."""
    last = lambda line: F.substring(F.rtrim(line), -1, 1)
    return {
        "punctuation": lambda line, ws: (F.size(ws) >= LONG_LINE) & ~last(line).isin(*ENDINGS),
        "navigation": lambda line, ws: F.regexp_count(line, F.lit("[|»›•·]")) * 6 > F.size(ws) + 6,
        "symbols": lambda line, ws: F.regexp_count(line, F.lit(SYMBOLS)) * 10 > F.length(line),
        "shouting": lambda line, ws: (F.size(ws) >= 3) & (line == F.upper(line)) & (line != F.lower(line)),
        "repetition": lambda line, ws: (F.size(ws) >= 10) & (F.size(F.array_distinct(ws)) * 4 < F.size(ws)),
        "boilerplate": lambda line, ws: (F.size(ws) <= SHORT_LINE) & F.lower(line).rlike(BOILERPLATE),
    }


def judge(docs: DataFrame, text_col: str = "text", columns: list[str] | None = None,
          max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """``(row, quality)``: ``row`` holds the ``columns`` of ``docs`` (all by default),
    ``quality`` the struct ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lost_chars, text`` with the cleaned text.

    A null text is an empty one: no words, so it fails.  A line of blanks is
    no line to judge and stays.  Every row is judged by itself, so repeated rows
    agree; an empty table gives no rows.
    """
    rows = docs.select(F.struct(*[col(c) for c in columns or docs.columns]).alias("row"),
                       F.coalesce(col(text_col), F.lit("")).alias("text"))
    rows = rows.select("row", "text", _words(F.col("text")).alias("words"),
                       F.split("text", "\n").alias("lines"))
    hashes = F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    rules = line_rules()

    def fails(line: Column) -> Column:
        # The words are bound once, as the one element of an array.
        def any_rule(ws: Column) -> Column:
            out = F.lit(False)
            for rule in rules.values():
                out = out | rule(line, ws)
            return out
        return F.exists(F.array(_words(line)), any_rule)

    full = F.filter("lines", lambda line: line.rlike(f"[^{BLANKS}]"))
    rows = rows.select(
        "row", F.size("words").cast("bigint").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.length(w)).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        full.alias("full"), hashes.alias("hashes"),
        F.filter("lines", lambda line: ~fails(line)).alias("good"))
    # Most documents repeat no window; only the others' windows are sorted.
    placed = F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.array_sort(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(
        "row", "n_words", "word_chars", "n_symbols", "good",
        (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint").alias("n_dup_lines"),
        placed.alias("placed"))
    again = F.filter("placed", lambda x, i: (x["h"] == F.get("placed", i - 1)["h"])
                     | (x["h"] == F.get("placed", i + 1)["h"]))
    covered = F.array_distinct(F.flatten(F.transform(
        again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    rows = rows.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.array_join("good", "\n").alias("clean"),
        F.coalesce(F.when(F.col("placed").isNotNull(), F.size(covered)), F.lit(0))
        .cast("bigint").alias("n_repeat_words"))
    lost = F.col("word_chars") - F.length(F.regexp_replace("clean", f"[{BLANKS}]+", ""))
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    rows = rows.withColumn("lost_chars", lost.cast("bigint"))
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("word_chars"))
    # Made as a generator's row, so that a filter on it is not pushed into the
    # expressions above, which would be computed again for each use.
    return rows.select("row", F.explode(F.array(F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "lost_chars", F.col("clean").alias("text")))).alias("quality"))


def clean(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents kept, with failing lines removed from ``text_col``; all other
    columns as they are."""
    found = judge(docs, text_col, None, **options).filter("quality.kept")
    return found.select(*[F.col("quality.text").alias(c) if c == text_col
                          else F.col("row")[c].alias(c) for c in docs.columns])


def quality_sql() -> str:
    """DuckDB SQL for ``doc_id`` and the base columns, ``base_failed`` and ``kept``."""
    blanks = "[ \\t\\n\\x0B\\f\\r]"
    ends = ", ".join("'" + c.replace("'", "''") + "'" for c in ENDINGS)
    ws = f"list_filter(string_split_regex(line, '{blanks}+'), lambda w: w <> '')"
    return f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, list_filter(string_split_regex(text, '{blanks}+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')) AS full_lines
  FROM d),
windows AS (
  SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
keyed AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k FROM windows),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM keyed) WHERE n > 1),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w),
judged AS (
  SELECT r, line, {ws} AS ws FROM lines),
good AS (
  SELECT r, sum(length(regexp_replace(line, '{blanks}+', '', 'g'))) AS chars FROM judged
  WHERE NOT ((len(ws) >= {LONG_LINE} AND right(rtrim(line), 1) NOT IN ({ends}))
    OR len(regexp_extract_all(line, '[|»›•·]')) * 6 > len(ws) + 6
    OR len(regexp_extract_all(line, '{SYMBOLS}')) * 10 > length(line)
    OR (len(ws) >= 3 AND line = upper(line) AND line <> lower(line))
    OR (len(ws) >= 10 AND len(list_distinct(ws)) * 4 < len(ws))
    OR (len(ws) <= {SHORT_LINE} AND regexp_matches(lower(line), '{BOILERPLATE}')))
  GROUP BY r),
base AS (
  SELECT w.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{blanks}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
         CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, coalesce(chars, 0) AS chars
  FROM w LEFT JOIN repeats USING (r) LEFT JOIN good USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND 100 * (word_chars - chars) <= {MAX_LOST_PERCENT} * word_chars AS kept
FROM base"""
