"""Small tables for the operators' tests."""

import random

# Columns whose names the operators use inside, to clash with theirs.
CLASHES = "row string, id string, fp string, h string, match string, line string, position string, `a.b` string"
CLASH_VALUES = ("r", "i", "f", "h", "m", "l", "p", "ab")


def documents(spark, rows):
    """``(doc_id, text, lang, source)`` rows with clashing extra columns."""
    return spark.createDataFrame([(*r, *CLASH_VALUES) for r in rows],
                                 f"doc_id bigint, text string, lang string, source string, {CLASHES}")


def awkward(spark):
    """Null and repeated ids, null, empty, blank and long texts, repeated rows."""
    rng = random.Random(5)
    long = " ".join(rng.choice("alpha beta gamma delta épsilon zeta 42 eta".split()) for _ in range(60_000))
    return documents(spark, [
        (1, None, None, None), (2, "", "en", "s"), (3, "  \n\t ", "en", "s"), (4, long, "en", "s"),
        (5, "one two three", "en", "t"), (5, "one two three", "en", "t"), (5, "another text", "fr", None),
        (None, "one two three", None, "t"), (None, None, "en", "t")])


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]
