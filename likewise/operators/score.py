"""Scoring every candidate against one requested item.

Each operator is one projection over the catalog: the requested item is
looked up once (``lookup.target_values``, one row), its values enter the plan
as literals, every candidate row is compared column by column inside
whole-stage code generation, and no shuffle is planned.  Work grows linearly with the catalog and splits across as many
tasks as the scan has splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..errors import ItemNotFound, TooManyAttributes
from ..functions.columns import (COMPAT_SCORE_COLUMN, INDICATOR_COLUMN, MAX_DIGIT_ATTRIBUTES,
                                 MISS_WEIGHT, attr, attribute_names, compat_weights,
                                 count_from_score, escaped, indicator_expr, mask_expr, matches,
                                 score_from_mask)
from .lookup import exclude_item, lookup_item, target_values


def match_indicators(flat: DataFrame, sku, weights: Sequence[int] | None = None,
                     id_col: str = "sku") -> DataFrame:
    """Candidates (the target left out) plus ``col_<x>_diff`` per attribute:
    the attribute's weight on a match, ``-1`` otherwise.

    Default weights are ``m-1 .. 0`` in alphabetical order, so ten attributes
    get ``9 .. 0``.  Null never matches, on either side.
    """
    names = attribute_names(flat, id_col)
    weights = list(weights) if weights is not None else compat_weights(len(names))
    if len(weights) != len(names):
        raise ValueError(f"{len(names)} attributes but {len(weights)} weights")
    target = target_values(flat, sku, id_col)
    return exclude_item(flat, sku, id_col).select(
        "*", *[indicator_expr(attr(n), F.lit(target.get(n)), w).alias(INDICATOR_COLUMN.format(n))
               for n, w in zip(names, weights)])


def digit_score_compat(flat: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """The digit score exactly as the original job computes it.

    The indicators are concatenated as text, every ``-1`` is removed and the
    rest is read as an ``int`` in column ``concatealldiffcols``.  This keeps
    two known edges: a match on all ten attributes (``9876543210``) does not
    fit an int and gives NULL, and no match at all (``''``) gives NULL too;
    ``rank_candidates(order='compat')`` then puts both last.  Use
    ``similarity_score`` for the correct order.  At most ten attributes, since
    every weight must be one digit.
    """
    names = attribute_names(flat, id_col)
    if len(names) > MAX_DIGIT_ATTRIBUTES:
        raise TooManyAttributes(f"the digit score needs at most {MAX_DIGIT_ATTRIBUTES} "
                                f"attributes, got {len(names)}")
    ind = match_indicators(flat, sku, id_col=id_col)
    text = F.concat(*[attr(INDICATOR_COLUMN.format(n)).cast("string") for n in names])
    digits = F.regexp_replace(text, F.lit(str(MISS_WEIGHT)), F.lit(""))
    return ind.withColumn(COMPAT_SCORE_COLUMN, digits.try_cast("int"))


def similarity_score(flat: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """Candidates plus ``score bigint``, ``match_count int`` and ``mask bigint``.

    ``score = match_count * 2**m + mask`` where the mask has the alphabetically
    first attribute as its highest bit: more matches always win, and at equal
    count the match on the earlier name wins.  A perfect match scores highest
    and no match scores 0.  Beyond 57 attributes ``mask`` and ``score`` are text
    that orders the same way.  Attributes named like these columns are found
    behind the prefix ``attribute:``.
    """
    flat = escaped(flat, id_col)
    names = attribute_names(flat, id_col)
    m = len(names)
    mask = mask_expr(names, target_values(flat, sku, id_col))
    score = score_from_mask(mask, m)
    return exclude_item(flat, sku, id_col).select(
        "*", mask.alias("mask"), score.alias("score"),
        count_from_score(score, m).alias("match_count"))


def similarity_open(catalog: DataFrame, sku, id_col: str = "sku") -> DataFrame:
    """Map-form catalog, any attribute names: candidates plus ``match_count``
    and ``matched`` (the matched names, sorted).

    Order candidates by ``match_count desc, matched asc, sku asc``: arrays of
    equal length compare by their first differing name, and the smaller name
    is the better match.  No global attribute index is needed: the requested
    item's present attributes, looked up once, become one literal comparison
    each, so the names come out already sorted.
    """
    rows = lookup_item(catalog.select(id_col, "attributes"), sku, id_col).collect()
    if not rows:
        raise ItemNotFound(sku)
    target = {k: v for k, v in (rows[0]["attributes"] or {}).items() if v is not None}
    hits = [F.when(matches(F.try_element_at(F.col("attributes"), F.lit(k)), F.lit(v)), F.lit(k))
            for k, v in sorted(target.items())]
    matched = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return exclude_item(catalog, sku, id_col).select(
        "*", matched.alias("matched"), F.size(matched).alias("match_count"))
