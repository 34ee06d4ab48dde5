"""Whole-word search in a text column."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, functions as F

# Tokens are maximal runs of letters, marks and digits of any script, after lower-casing.
TOKEN_CHARS = r"[\p{L}\p{M}\p{N}]"
NO_TOKEN = r"[^\p{L}\p{M}\p{N}]+"


def check_term(term: str) -> str:
    """The term in lower case; a ValueError unless it is one token."""
    term = term.lower()
    if not term or not all(unicodedata.category(c)[0] in "LMN" for c in term):
        raise ValueError("term must be a non-empty run of letters and digits")
    return term


def _pattern(term: str) -> str:
    return f"(?<!{TOKEN_CHARS}){check_term(term)}(?!{TOKEN_CHARS})"


def term_hits(text_col: str, term: str) -> F.Column:
    """How often ``term`` occurs as a whole token in the lower-cased text.

    A whole token is a match not preceded or followed by a letter, mark or
    digit, which is the same as splitting at everything else and counting equal
    tokens, but runs as one compiled regular expression per row instead of
    building an array of every token of the text.
    """
    return F.regexp_count(F.lower(F.col(text_col)), F.lit(_pattern(term)))


def term_match(df: DataFrame, column: str, term: str, id_col: str | None = None) -> DataFrame:
    """Rows whose ``column`` contains ``term`` as a whole token, with ``hits``.

    The whole text of every row is read once in one stage, with no shuffle.
    ``term_total`` gives the totals.
    """
    cols = [id_col] if id_col else [c for c in df.columns if c != column]
    # A generator's row, so that the filter does not count a second time.
    hits = df.select(*cols, F.explode(F.array(term_hits(column, term))).alias("hits"))
    return hits.filter(F.col("hits") > 0)


def term_total(df: DataFrame, column: str, term: str) -> DataFrame:
    """One row ``(matching_rows, hits)``: the totals of a term search, 0 without a hit."""
    hits = df.agg(F.count_if(term_hits(column, term) > 0).alias("matching_rows"),
                  F.coalesce(F.sum(term_hits(column, term)), F.lit(0)).cast("bigint").alias("hits"))
    return hits
