"""The worked examples of the specification and the edge cases (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from conftest import flat_frame
from likewise import (ItemNotFound, batch_top_k, digit_score_compat, flatten_attributes,
                      lookup_item, rank_candidates, read_catalog, similarity_open,
                      similarity_score, to_map, top_k_names, top_k_similar, top_k_weights)
from likewise.plans.session import shared_path

NAMES = list("abcdefghij")
# six own items with ten attributes.
F1 = {
    "chair": "oak brown matt low wide four plain north small light".split(),
    "bench": "oak grey matt low long four plain south large heavy".split(),
    "stool": "pine brown gloss high round three plain north small light".split(),
    "table": "pine white gloss mid long four carved west large heavy".split(),
    "shelf": "steel white dull tall slim none drawn east mid modest".split(),
    "couch": "cloth green soft deep broad six quilted home huge bulky".split(),
}


def by_hand(target):
    """``(item, digits, count, mask)`` of the items with a match, best first."""
    out = []
    for sku, values in F1.items():
        same = [a == b for a, b in zip(values, F1[target])]
        if sku != target and any(same):
            out.append((sku, "".join(str(9 - i) for i, x in enumerate(same) if x), sum(same),
                        sum(1 << (9 - i) for i, x in enumerate(same) if x)))
    return sorted(out, key=lambda x: (-x[2], -x[3], x[0]))


F1_EXPECTED = {sku: by_hand(sku) for sku in F1}

@pytest.fixture(scope="module")
def f1(spark):
    rows = [(sku, *vals) for sku, vals in F1.items()]
    return flat_frame(spark, rows, NAMES)

def expected_order(target):
    matched = [x for x, *_ in F1_EXPECTED[target]]
    rest = sorted(s for s in F1 if s != target and s not in matched)
    return matched + rest

@pytest.mark.parametrize("target", sorted(F1))
def test_f1_top_k_order_and_weights(spark, f1, target):
    top = top_k_weights(top_k_similar(f1, target, 5)).orderBy("rank").collect()
    assert [r["sku"] for r in top] == expected_order(target)
    for r, (sku, digits, count, mask) in zip(top, F1_EXPECTED[target]):
        assert (r["sku"], r["digits"], r["match_count"], r["mask"]) == (sku, digits, count, mask)
    for r in top[len(F1_EXPECTED[target]):]:
        assert r["score"] == 0 and r["digits"] == "" and r["matched"] == ""

def test_f1_batch_equals_single(spark, f1):
    rows = batch_top_k(f1, 5).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rn"]):
        got.setdefault(r["request_sku"], []).append(r["sku"])
    assert got == {t: expected_order(t) for t in F1}

def test_f1_names_column(spark, f1):
    out = top_k_names(top_k_similar(f1, "chair", 2))
    assert out.columns == ["Most Similar SKU's"]
    assert [r[0] for r in out.collect()] == expected_order("chair")[:2]

# Fixed values of the specification's two short examples (F2, F3).

def test_f2_count_decides(spark):
    cat = flat_frame(spark, [("t", "a1", "b1", "c1"), ("x", "a2", "b1", "c1"),
                             ("y", "a1", "b3", "c3")], list("abc"))
    assert [r["sku"] for r in top_k_similar(cat, "t", 2).collect()] == ["x", "y"]

def test_f3_name_breaks_tie(spark):
    cat = flat_frame(spark, [("t", "a1", "b1"), ("x", "a2", "b1"), ("y", "a1", "b2")],
                     list("ab"))
    assert [r["sku"] for r in top_k_similar(cat, "t", 2).collect()] == ["y", "x"]

def test_f2_f3_open_form(spark):
    cat = to_map(flat_frame(spark, [("t", "a1", "b1", "c1"), ("x", "a2", "b1", "c1"),
                                    ("y", "a1", "b3", "c3")], list("abc")))
    rows = similarity_open(cat, "t").orderBy(F.desc("match_count"), "matched", "sku").collect()
    assert [(r["sku"], r["matched"]) for r in rows] == [("x", ["b", "c"]), ("y", ["a"])]

@pytest.fixture(scope="module")
def f4(spark):
    t = [f"v{n}" for n in NAMES]
    rows = [
        ("target", *t),
        ("clone", *t),                                           # all ten match
        ("none", *[f"w{n}" for n in NAMES]),                     # no match
        ("only-j", *[f"w{n}" for n in NAMES[:-1]], "vj"),         # only j
        ("all-but-j", *t[:-1], "wj"),                            # nine match
        ("null-a", None, *[f"w{n}" for n in NAMES[1:]]),          # null never matches
        ("tie-2", "va", *[f"w{n}" for n in NAMES[1:]]),
        ("tie-1", "va", *[f"w{n}" for n in NAMES[1:]]),
        ("sku-o'brien", *[f"w{n}" for n in NAMES]),
    ]
    return flat_frame(spark, rows, NAMES)

def test_f4_compat_digit_score(spark, f4):
    got = {r["sku"]: r["concatealldiffcols"]
           for r in digit_score_compat(f4, "target").collect()}
    assert got["clone"] is None          # 9876543210 does not fit an int
    assert got["none"] is None           # '' is not a number
    assert got["only-j"] == 0
    assert got["all-but-j"] == 987654321
    assert got["null-a"] is None
    assert got["tie-1"] == got["tie-2"] == 9

def test_f4_fixed_score(spark, f4):
    got = {r["sku"]: (r["match_count"], r["mask"])
           for r in similarity_score(f4, "target").collect()}
    assert got["clone"] == (10, 1023)
    assert got["none"] == (0, 0)
    assert got["only-j"] == (1, 1)
    assert got["all-but-j"] == (9, 1022)
    top = [r["sku"] for r in top_k_similar(f4, "target", 4).collect()]
    assert top == ["clone", "all-but-j", "tie-1", "tie-2"]

def test_f4_compat_rank_puts_edges_last(spark, f4):
    ranked = rank_candidates(digit_score_compat(f4, "target"), "compat", m=10)
    rows = {r["sku"]: r["rank"] for r in ranked.collect()}
    assert rows["clone"] == rows["none"] == 1            # NULLs first, i.e. worst
    assert rows["all-but-j"] == max(rows.values())
    fixed = {r["sku"]: r["rank"] for r in
             rank_candidates(similarity_score(f4, "target"), "fixed", m=10).collect()}
    assert fixed["clone"] == 1 and fixed["tie-1"] == fixed["tie-2"]

def test_f4_null_target_attribute_never_matches(spark):
    cat = flat_frame(spark, [("t", None, "b1"), ("x", None, "b2"), ("y", "a1", "b1")],
                     list("ab"))
    got = {r["sku"]: r["match_count"] for r in similarity_score(cat, "t").collect()}
    assert got == {"x": 0, "y": 1}

def test_f4_quote_in_id_and_unknown_id(spark, f4):
    assert lookup_item(f4, "sku-o'brien").count() == 1
    assert top_k_similar(f4, "sku-o'brien", 1).count() == 1
    with pytest.raises(ItemNotFound):
        top_k_similar(f4, "no-such-item", 3)

def test_k_bounds(spark, f4):
    assert top_k_similar(f4, "target", 0).count() == 0
    with pytest.raises(ValueError):
        top_k_similar(f4, "target", -1)

def test_f5_json_reading(spark):
    lines = [
        '{"sku":"s1","attributes":{"att-b":"b1","att-a":"a1"}}',
        '{"sku":"s2","attributes":{"att-c":"c1","att-a":"a1"}}',
        '{"sku":"s3","attributes":',
        '{"sku":"s4","attributes":{"att-a":1,"att-c":null}}',
    ]
    path = shared_path(spark, "f5")
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1) \
        .write.text(path)
    catalog, rejects = read_catalog(spark, path)
    flat = flatten_attributes(catalog)
    assert flat.columns == ["sku", "att-a", "att-b", "att-c"]
    got = {r["sku"]: tuple(r)[1:] for r in flat.collect()}
    assert got == {"s1": ("a1", "b1", None), "s2": ("a1", None, "c1"),
                   "s4": ("1", None, None)}
    bad = rejects.collect()
    assert len(bad) == 1 and bad[0]["reason"] == "malformed"
    inferred, _ = read_catalog(spark, path, infer=True)
    assert sorted(flatten_attributes(inferred).collect()) == sorted(flat.collect())

def test_duplicate_ids_pick_smallest_attributes(spark):
    path = shared_path(spark, "dups")
    lines = ['{"sku":"d","attributes":{"a":"z"}}', '{"sku":"d","attributes":{"a":"b"}}',
             '{"sku":"e","attributes":{"a":"b"}}']
    spark.createDataFrame([(ln,) for ln in lines], "value string").write.text(path)
    catalog, _ = read_catalog(spark, path)
    rows = {r["sku"]: r["attributes"] for r in catalog.collect()}
    assert rows == {"d": {"a": "b"}, "e": {"a": "b"}}


def test_attribute_names_with_dots(spark):
    cat = spark.createDataFrame(
        [("t", "r", "x"), ("y", "r", "z"), ("w", "q", "x")],
        "sku string, `color.main` string, `size x` string")
    assert [r["sku"] for r in top_k_similar(cat, "t", 2).collect()] == ["y", "w"]
    best = {r["request_sku"]: r["sku"] for r in batch_top_k(cat, 1).collect()}
    assert best == {"t": "y", "y": "t", "w": "t"}
