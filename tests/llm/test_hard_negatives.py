"""Hard negatives against brute force, intervals against products, awkward rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from likewise.llm import hard_negatives as H

SCHEMA = "id bigint, label bigint, vector array<double>, code string, a string, r string, wanted string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "a", "r", "w") for r in rows], SCHEMA)


def brute(rows, is_anchor, n_positives=5, n_negatives=3):
    valid = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if sum(x * x for x in v) >= H.MAX_SQUARED_NORM:
            continue
        key = (label, [int(x) for x in v])
        valid[i] = min(valid.get(i, key), key)
    out = set()
    for a in filter(is_anchor, valid):
        label, v = valid[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in valid.items()
                        if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:n_positives]:
            inside = [s for s in scored if s[2] != label and -50 * ps <= -100 * s[0] <= -95 * ps]
            for rank, (ns, n, _) in enumerate(inside[:n_negatives], 1):
                out.add((a, p, rank, n, -ps, -ns))
    return out


def mined(df, anchor, **options):
    rows = [tuple(r) for r in H.mine(df, anchor, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed, dim, spread", [(1, 8, 0.3), (2, 20, 1.0), (3, 64, 0.1)])
def test_matches_brute_force(spark, monkeypatch, seed, dim, spread):
    monkeypatch.setattr(H, "ROW_BLOCK", 40)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", 7)
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((3, dim)) * 40
    rows = []
    for i in range(250):
        label = 0 if i % 3 == 0 else int(rng.integers(0, 4))
        v = np.floor(middle[i % 3] + spread * 100 * rng.standard_normal(dim))
        rows.append((i * 3, label, [float(x) for x in v]))
    rows += [(1000 + i, i % 4, rows[5][2]) for i in range(12)]  # ties
    assert mined(frame(spark, rows), F.col("id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_awkward_rows(spark):
    """Nulls, non-finite and huge components, repeated ids, other lengths, empty vectors."""
    rng = random.Random(4)
    rows = [(i, i % 3, [float(rng.randint(-9, 9)) for _ in range(5)]) for i in range(60)]
    rows += [(None, 1, [1.0] * 5), (100, None, [1.0] * 5), (110, 1, None), (120, 1, [1.0, None, 1.0, 1.0, 1.0]),
             (130, 1, [float("nan")] * 5), (140, 1, [float("inf")] * 5), (150, 1, [1e300] * 5),
             (10, 2, [9.0] * 5), (10, 2, [9.0] * 5), (20, 0, [9.0] * 5),
             (200, 1, [2.0, 3.0]), (210, 1, [2.0, 3.0]), (220, 2, [1.0, 2.0]),
             (300, 1, []), (310, 1, []), (320, 2, []), (400, 1, [0.0] * 5), (410, 2, [0.0] * 5)]
    expected = brute(rows, lambda i: i % 10 == 0)
    assert any(r[0] == 300 for r in expected) and any(r[0] == 200 for r in expected)
    assert mined(frame(spark, rows), F.col("id") % 10 == 0) == expected


def test_empty(spark):
    assert mined(frame(spark, []), F.col("id") == 0) == set()
    assert mined(frame(spark, [(1, 1, [1.0]), (2, 1, [1.0])]), F.col("id") == 0) == set()
    assert mined(frame(spark, [(0, 1, [1.0])]), F.col("id") == 0) == set()


@pytest.mark.parametrize("dim", [1, 3, 64, 70])
def test_intervals_hold_every_product(dim):
    rng = np.random.default_rng(dim)
    vectors = np.floor(rng.standard_normal((400, dim)) * 100)
    vectors[:20] = 0
    vectors[20:40] = vectors[40:60]
    codes, norm, code_norm, align = H.encode(vectors)
    rows = {"codes": codes, "norm": norm, "code_norm": code_norm, "align": align}
    low, high = H.intervals(vectors, rows)
    exact = vectors @ vectors.T
    assert (low <= exact).all() and (exact <= high).all()


def test_intervals_narrow_the_search():
    """Of unlike rows most are ruled out by their intervals alone."""
    rng = np.random.default_rng(9)
    vectors = np.floor(rng.standard_normal((2000, 64)) * 32)
    codes, norm, code_norm, align = H.encode(vectors)
    low, high = H.intervals(vectors[:20], {"codes": codes, "norm": norm, "code_norm": code_norm, "align": align})
    assert (high < 0.5 * norm[:20, None] ** 2).mean() > 0.9
