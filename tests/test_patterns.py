"""All 1,024 match patterns of ten attributes: the score orders them by
(match count, mask) and the digit form agrees except on its two edges."""

from conftest import flat_frame
from likewise import digit_score_compat, similarity_score

NAMES = list("abcdefghij")


def test_all_patterns(spark):
    target = ("t", *[f"v{n}" for n in NAMES])
    rows = [target]
    for p in range(1024):
        vals = [f"v{n}" if p >> (9 - i) & 1 else f"w{n}" for i, n in enumerate(NAMES)]
        rows.append((f"p{p:04d}", *vals))
    cat = flat_frame(spark, rows, NAMES)
    fixed = {r["sku"]: (r["score"], r["match_count"], r["mask"])
             for r in similarity_score(cat, "t").collect()}
    compat = {r["sku"]: r["concatealldiffcols"]
              for r in digit_score_compat(cat, "t").collect()}
    for p in range(1024):
        score, count, mask = fixed[f"p{p:04d}"]
        assert mask == p and count == bin(p).count("1") and score == (count << 10) + p
        digits = "".join(str(9 - i) for i in range(10) if p >> (9 - i) & 1)
        expected = None if p in (0, 1023) else int(digits)
        assert compat[f"p{p:04d}"] == expected
    by_score = sorted(range(1024), key=lambda p: fixed[f"p{p:04d}"][0])
    assert by_score == sorted(range(1024), key=lambda p: (bin(p).count("1"), p))
    # the digit integer sorts the same way wherever it is defined
    defined = [p for p in by_score if p not in (0, 1023)]
    assert defined == sorted(defined, key=lambda p: compat[f"p{p:04d}"])


def test_scoring_is_one_projection(spark):
    """No shuffle is planned for single-request scoring."""
    cat = flat_frame(spark, [("t", "a", "b"), ("x", "a", "c")], ["a", "b"])
    plan = similarity_score(cat, "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0]
