"""Column expressions for attribute matching and scoring.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage code generation; nothing here runs Python per row.

Conventions.  A catalog has an id column and ``m`` attribute columns whose
names, sorted alphabetically, are indexed ``0..m-1``.  Attribute ``i`` owns
the bit ``2**(m-1-i)`` of a match mask, so the alphabetically first attribute
is the highest bit.  The similarity score of a candidate is

    score = match_count * 2**m + mask

Because ``mask < 2**m`` the count decides first and, at equal count, the
larger mask wins, which is the match on the earlier attribute name.

A bigint holds this for up to 57 attributes.  With more, mask and score are
text that orders the same way: the mask has a ``1`` or ``0`` per attribute in
order of the names, and the score is the count in ten digits and the mask.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Output names and the miss marker of the original job, kept
# so that its results can be reproduced column for column.
COMPAT_SCORE_COLUMN = "concatealldiffcols"
NAMES_COLUMN = "Most Similar SKU's"
INDICATOR_COLUMN = "col_{}_diff"
MISS_WEIGHT = -1

# A bigint holds (m + 1) * 2**m for m up to 57; beyond, scores are text.
MAX_BIGINT_ATTRIBUTES = 57
COUNT_DIGITS = 10
# Result columns; an attribute of such a name, or one that only differs in case
# from another, gets a column of its own behind this prefix.
RESERVED = ("score", "match_count", "mask", "rank", "rn", "request_sku", "digits", "matched",
            COMPAT_SCORE_COLUMN)
ESCAPE = "attribute:"
# The digit form writes one decimal digit per attribute, weights m-1 .. 0.
MAX_DIGIT_ATTRIBUTES = 10


def attr(name: str) -> Column:
    """The column of an attribute, quoted so that names with dots or
    spaces (common in JSON catalogs) are taken literally."""
    return F.col("`" + name.replace("`", "``") + "`")


def attribute_names(flat: DataFrame, id_col: str = "sku") -> list[str]:
    """Attribute columns of a flat catalog, in alphabetical order of the attributes."""
    return sorted((c for c in flat.columns if c != id_col), key=lambda c: (original_name(c), c))


def bit_of(index: int, m: int) -> int:
    """Mask bit of the attribute at alphabetical position ``index``."""
    return 1 << (m - 1 - index)


def in_mask(mask: Column, index: int, m: int) -> Column:
    """Whether the attribute at alphabetical position ``index`` is in the mask."""
    if m > MAX_BIGINT_ATTRIBUTES:
        return F.substring(mask, index + 1, 1) == "1"
    return mask.bitwiseAND(F.lit(bit_of(index, m))) != 0


def column_names(names: Sequence[str], id_col: str = "sku") -> dict[str, str]:
    """``{attribute: column}``: an attribute keeps its name unless the id, a result
    column or an earlier attribute has it, upper and lower case aside."""
    taken = {id_col.lower(), *RESERVED, *(INDICATOR_COLUMN.format(n).lower() for n in names)}
    out = {}
    for n in sorted(names):
        column, again = n, 1
        while column.lower() in taken:
            column, again = f"{ESCAPE}{n}" + (f"#{again}" if again > 1 else ""), again + 1
        taken.add(column.lower())
        out[n] = column
    return out


def original_name(column: str) -> str:
    """The attribute name behind a column of ``column_names``."""
    if not column.startswith(ESCAPE):
        return column
    name, _, again = column[len(ESCAPE):].rpartition("#")
    return name if name and again.isdigit() else column[len(ESCAPE):]


def escaped(flat: DataFrame, id_col: str = "sku") -> DataFrame:
    """``flat`` with attributes named like result columns behind the prefix."""
    clashing = {c: ESCAPE + c for c in flat.columns if c != id_col and c.lower() in RESERVED}
    return flat.withColumnsRenamed(clashing) if clashing else flat


def matches(candidate: Column, target: Column) -> Column:
    """True when both values are present and equal; null never matches."""
    return F.coalesce(candidate == target, F.lit(False))


def mask_expr(names: Sequence[str], target: dict) -> Column:
    """Bit mask of the attributes on which each row equals ``target``.

    ``target`` maps attribute names to the requested item's values; they
    become literals, and a missing or null value matches nothing.
    """
    m = len(names)
    if m > MAX_BIGINT_ATTRIBUTES:
        return F.concat(*[F.when(matches(attr(n), F.lit(target.get(n))), F.lit("1")).otherwise("0")
                          for n in names])
    terms = [F.when(matches(attr(n), F.lit(target.get(n))), F.lit(bit_of(i, m)))
             .otherwise(F.lit(0)).cast("bigint") for i, n in enumerate(names)]
    return sum(terms[1:], terms[0]) if terms else F.lit(0).cast("bigint")


def score_from_mask(mask: Column, m: int) -> Column:
    """``bit_count(mask) * 2**m + mask`` as bigint, or its text form."""
    if m > MAX_BIGINT_ATTRIBUTES:
        count = F.length(F.translate(mask, "0", "")).cast("string")
        return F.concat(F.lpad(count, COUNT_DIGITS, "0"), mask)
    return F.shiftleft(F.bit_count(mask).cast("bigint"), m) + mask.cast("bigint")


def count_from_score(score: Column, m: int) -> Column:
    if m > MAX_BIGINT_ATTRIBUTES:
        return F.substring(score, 1, COUNT_DIGITS).cast("int")
    return F.shiftright(score, m).cast("int")


def mask_from_score(score: Column, m: int) -> Column:
    if m > MAX_BIGINT_ATTRIBUTES:
        return F.substring(score, COUNT_DIGITS + 1, m)
    return score.bitwiseAND(F.lit((1 << m) - 1)).cast("bigint")


def compat_weights(m: int) -> list[int]:
    """Default per-attribute weights of the digit form: ``m-1 .. 0``."""
    return list(range(m - 1, -1, -1))


def indicator_expr(candidate: Column, target: Column, weight: int) -> Column:
    """``weight`` on a match, ``MISS_WEIGHT`` (-1) otherwise."""
    return F.when(matches(candidate, target), F.lit(weight)).otherwise(F.lit(MISS_WEIGHT))


def digits_from_mask(mask: Column, names: Sequence[str]) -> Column:
    """Digit string of the matched weights, best attribute first.

    For ``m <= 10`` attributes this is the concatenation of the weights
    ``m-1 .. 0`` of the matched attributes, e.g. ``'9643210'``; with more, where
    weights have several digits, they are joined by dots.  No match gives
    ``''``.
    """
    m = len(names)
    parts = [F.when(in_mask(mask, i, m), F.lit(str(w)))
             for i, w in enumerate(compat_weights(m))]
    return F.concat_ws("" if m <= MAX_DIGIT_ATTRIBUTES else ".", *parts)


def matched_names_from_mask(mask: Column, names: Sequence[str], sep: str = ",") -> Column:
    """Names of the matched attributes, alphabetical, joined by ``sep``."""
    m = len(names)
    parts = [F.when(in_mask(mask, i, m), F.lit(original_name(n)))
             for i, n in enumerate(names)]
    return F.concat_ws(sep, *parts)
