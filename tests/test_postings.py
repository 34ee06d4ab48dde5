"""Posting lists, open names and the value join against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import flat_frame
from likewise import (TooManyAttributes, batch_top_k, batch_top_k_indexed, batch_top_k_joined, batch_top_k_open,
                      discover_names, flatten_attributes, similarity_open, to_map)
from likewise.operators import postings, value_join
from test_batch import as_lists, brute_force, random_catalog


def open_brute(items, k, asked=None, include_empty=True):
    """``{request: [(id, matched)]}`` from ``{id: {name: value}}``."""
    out = {}
    for t in (items if asked is None else asked):
        if t not in items:
            continue
        found = []
        for x, values in items.items():
            same = sorted(n for n, v in items[t].items() if v is not None and values.get(n) == v)
            if x != t and (same or include_empty):
                found.append((-len(same), same, x))
        out[t] = [(x, same) for _, same, x in sorted(found)[:k]]
    return out


def open_lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.request_sku, r.rn)):
        assert r.match_count == len(r.matched) and r.rn == len(got.get(r.request_sku, [])) + 1
        got.setdefault(r.request_sku, []).append((r.sku, r.matched))
    return got


def open_frame(spark, rows):
    return spark.createDataFrame(rows, "sku string, attributes map<string,string>")


def random_items(rng, n, names, most, values=("x", "y", "z")):
    return {f"i{i:04d}": {name: rng.choice(values) for name in rng.sample(names, rng.randint(0, most))} for i in range(n)}


@pytest.mark.parametrize("group_keys", [1 << 20, 40])
@pytest.mark.parametrize("include_empty", [True, False])
def test_open_batch_equals_brute_force(spark, monkeypatch, group_keys, include_empty):
    monkeypatch.setattr(postings, "GROUP_KEYS", group_keys)
    rng = random.Random(3)
    items = random_items(rng, 120, [f"n{i}" for i in range(15)], 9)
    for i in range(0, 120, 3):
        items[f"i{i:04d}"]["n0"] = "hot"
    got = open_lists(batch_top_k_open(open_frame(spark, list(items.items())), 6, include_empty=include_empty))
    want = open_brute(items, 6, include_empty=include_empty)
    assert got == {t: v for t, v in want.items() if v}


def test_open_batch_of_requests_and_single_request_agree(spark):
    rng = random.Random(4)
    items = random_items(rng, 80, [f"n.{i} é" for i in range(10)], 8)
    catalog = open_frame(spark, list(items.items()))
    asked = ["i0003", "i0050", "absent", None, "i0003"]
    got = open_lists(batch_top_k_open(catalog, 7, spark.createDataFrame([(a,) for a in asked], "sku string")))
    assert got == open_brute(items, 7, ["i0003", "i0050"])
    for t in got:
        one = similarity_open(catalog, t).orderBy(F.desc("match_count"), "matched", "sku").limit(7)
        assert [(r.sku, r.matched) for r in one.collect()] == got[t]


def test_open_batch_of_a_hundred_thousand_names(spark):
    """Names are far too many for a schema, few per item, one shared by a third."""
    rng = random.Random(5)
    items = {f"i{i:05d}": {f"name{rng.randrange(3)}-{i * 40 + j}": "v" for j in range(40)} for i in range(2500)}
    ids = list(items)
    for i in range(0, 2500, 3):
        items[ids[i]]["common"] = "c"
    for i in range(0, 2500, 50):  # a few items share what others have
        for name in rng.sample(sorted(items[ids[i]]), 5):
            items[ids[(i * 7 + 1) % 2500]][name] = "v"
    catalog = open_frame(spark, list(items.items()))
    assert len({n for a in items.values() for n in a}) > 100_000
    with pytest.raises(TooManyAttributes):
        discover_names(catalog)
    with pytest.raises(TooManyAttributes):
        flatten_attributes(catalog)
    asked = [ids[i] for i in range(0, 2500, 25)]
    got = open_lists(batch_top_k_open(catalog, 4, spark.createDataFrame([(a,) for a in asked], "sku string")))
    assert got == open_brute(items, 4, asked)


def test_open_batch_of_awkward_rows(spark):
    rows = [("a", {"x": "1", "y": None}), ("a", {"x": "2"}), ("b", {"x": "1"}), ("b", {"x": "1"}), ("c", None),
            ("d", {}), (None, {"x": "1"}), ("e", {"": "", "x": "1"}), ("f", {"": "", "x": "1", "q": "long " * 50_000})]
    got = open_lists(batch_top_k_open(open_frame(spark, rows), 3))
    items = {"a": {"x": "1"}, "b": {"x": "1"}, "c": {}, "d": {}, "e": {"": "", "x": "1"},
             "f": {"": "", "x": "1", "q": "long " * 50_000}}
    assert got == open_brute(items, 3)
    assert batch_top_k_open(open_frame(spark, []), 3).count() == 0
    assert batch_top_k_open(open_frame(spark, rows), 0).count() == 0
    assert open_lists(batch_top_k_open(open_frame(spark, rows), 50)) == open_brute(items, 50)
    with pytest.raises(ValueError):
        batch_top_k_open(open_frame(spark, rows), -1)


@pytest.mark.parametrize("m", [20, 57, 58, 130])
def test_wide_items_equal_brute_force(spark, monkeypatch, m):
    monkeypatch.setattr(postings, "GROUP_KEYS", 2000)
    names = [f"n{j:03d}" for j in range(m)]
    rows = random_catalog(m, 50, m)
    cat = flat_frame(spark, rows, names)
    for k, empty in ((5, True), (70, True), (5, False)):
        got = batch_top_k(cat, k, include_empty=empty)
        lists = {}
        for r in sorted(got.collect(), key=lambda r: (r.request_sku, r.rn)):
            score = r.score if m <= 57 else (int(r.score[:10]) << m) + int(r.score[10:], 2)
            lists.setdefault(r.request_sku, []).append((r.sku, score))
        assert lists == {t: v for t, v in brute_force(rows, names, k, matched_only=not empty).items() if v}


def test_rare_lists_come_first_and_most_pairs_are_never_made(spark):
    """Items of one family share rare values; a frequent value is in all of them."""
    rows = [(f"i{i:04d}", {"all": "same", "half": str(i % 2), **{f"f{j}": f"{i // 5}-{j}" for j in range(8)}})
            for i in range(400)]
    catalog = open_frame(spark, rows)
    from likewise.operators.open_batch import open_items
    from likewise.plans.session import materialize
    items = materialize(open_items(catalog).select("id", "keys"), "test-items")
    asked = items.withColumnRenamed("id", "request")
    ranked, _, _ = postings.wanted_lists(items, asked)
    rank_of = {r["n"]: r["rank"] for r in ranked.groupBy("n").agg(F.min("rank").alias("rank")).collect()}
    assert rank_of[400] == 10 and rank_of[200] == 9
    # With four others of its family met in 8 attributes or more, a request reads no list but rare ones.
    met = ranked.filter(F.col("rank") <= F.greatest(F.ceil(F.col("p") / 3), F.col("p") - 8 + 1))
    pairs = met.agg(F.sum("n")).first()[0]
    assert pairs <= 0.05 * 400 * 400
    got = open_lists(batch_top_k_open(catalog, 4))
    assert all(sorted(x for x, _ in v) == sorted(f"i{i:04d}" for i in range(int(t[1:]) // 5 * 5, int(t[1:]) // 5 * 5 + 5)
                                                 if f"i{i:04d}" != t) for t, v in got.items())


@pytest.mark.parametrize("seed,m,share,heavy", [(1, 4, 8, 10), (2, 6, 8, 2), (3, 5, 3, 10), (4, 4, 1, 10)])
def test_value_join_equals_brute_force(spark, monkeypatch, seed, m, share, heavy):
    """A third of the rows have one value in every attribute."""
    monkeypatch.setattr(value_join, "BLOCK", 7)
    names = [f"n{j}" for j in range(m)]
    rows = random_catalog(seed, 70, m)
    cat = flat_frame(spark, rows, names)
    options = dict(heavy_share=share, max_heavy=heavy)
    assert as_lists(batch_top_k_joined(cat, 6, **options)) == {
        t: v for t, v in brute_force(rows, names, 6, matched_only=True).items() if v}
    asked = [f"i{i:03d}" for i in range(0, 70, 9)] + ["absent"]
    requests = spark.createDataFrame([(a,) for a in asked], "sku string")
    assert as_lists(batch_top_k_joined(cat, 6, requests, **options)) == {
        t: v for t, v in brute_force(rows, names, 6, asked, matched_only=True).items() if v}


def test_value_join_and_subset_index_agree(spark):
    names = ["a", "b", "c", "d", "e"]
    rows = random_catalog(9, 90, 5) + [("i000", "v9", None, None, None, None), (None, "hot", None, None, None, None)]
    cat = flat_frame(spark, rows, names)
    joined, indexed = batch_top_k_joined(cat, 8), batch_top_k_indexed(cat, 8)
    assert joined.columns == indexed.columns and set(joined.collect()) == set(indexed.collect())
    assert batch_top_k_joined(flat_frame(spark, [], names), 8).count() == 0
    with pytest.raises(TooManyAttributes):
        batch_top_k_joined(flat_frame(spark, [], [f"n{i}" for i in range(58)]), 8)


def test_most_items_asked_for(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(41, 40, 4)
    cat = flat_frame(spark, rows, names)
    asked = [r[0] for r in rows[:30]] + ["absent"]
    got = batch_top_k(cat, 5, spark.createDataFrame([(a,) for a in asked], "sku string"))
    assert as_lists(got) == brute_force(rows, names, 5, asked)


def test_map_form_and_flat_form_agree(spark):
    names = ["a", "b", "c", "d"]
    rows = random_catalog(42, 50, 4)
    cat = flat_frame(spark, rows, names)
    opened = {(r.request_sku, r.rn): r.sku for r in batch_top_k_open(to_map(cat), 5).collect()}
    assert opened == {(r.request_sku, r.rn): r.sku for r in batch_top_k(cat, 5).collect()}


def test_short_lists_come_to_the_request_without_keys(spark, monkeypatch):
    """Where no list is long no item's keys are sent to its lists; one long list leaves only its
    own requests to the rounds."""
    rng = random.Random(8)
    items = random_items(rng, 150, [f"n{i}" for i in range(60)], 12, values=range(4))
    items = {t: {n: str(v) for n, v in a.items()} for t, a in items.items()}
    rounds, asked = postings._by_rounds, []

    def counted(items, requests, k):
        asked.append({r.request for r in requests.select("request").collect()})
        return rounds(items, requests, k)

    monkeypatch.setattr(postings, "_by_rounds", counted)
    monkeypatch.setattr(postings, "GROUP_IDS", 500)
    assert open_lists(batch_top_k_open(open_frame(spark, list(items.items())), 5)) == open_brute(items, 5)
    assert not asked
    some = list(items)[::2]
    for t in some:
        items[t]["all"] = "long"
    assert open_lists(batch_top_k_open(open_frame(spark, list(items.items())), 5)) == open_brute(items, 5)
    assert asked == [set(some)]


@pytest.mark.parametrize("far", [0, 1 << 58])
def test_best_of_lists_orders_by_count_places_and_id(far):
    """Also with places too large for one number a row."""
    import pyarrow as pa
    rng = random.Random(9)
    keys = {i: sorted(rng.sample(range(12), 6)) for i in range(40)}
    rows = [(t, far + p, [x for x in keys if q in keys[x]]) for t in keys for p, q in enumerate(keys[t])]
    rng.shuffle(rows)
    table = pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
        (pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["request", "place", "ids"])
    request, rn, item, places = postings.best_of_lists(table, 4)
    got = sorted(zip(request.to_pylist(), rn.tolist(), item.to_pylist(), [p.tolist() for p in places]))
    want = []
    for t in keys:
        met = [(x, [far + p for p, q in enumerate(keys[t]) if q in keys[x]]) for x in keys if x != t]
        met = sorted((-len(p), p, x) for x, p in met if p)[:4]
        want += [(t, i, x, p) for i, (_, p, x) in enumerate(met, 1)]
    assert got == sorted(want)
