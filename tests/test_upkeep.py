"""The upkept index against brute force after additions, removals and changes."""

import random

import pytest

from conftest import flat_frame
from likewise import build_upkept_index, live_items, top_k_from_upkept, update_index
from likewise.operators import upkeep
from test_batch import as_lists, brute_force, random_catalog

NAMES = ["a", "b", "c"]


def ids(spark, some):
    return spark.createDataFrame([(i,) for i in some], "sku string")


@pytest.mark.parametrize("seed,slack", [(1, 0), (2, None)])
def test_updates_equal_a_rebuilt_index(spark, seed, slack):
    """With no slack the removal of a hot group's heads makes it short at once."""
    rng = random.Random(seed)
    rows = random_catalog(seed, 90, 3)
    live = {r[0]: r for r in rows[:60]}
    path = build_upkept_index(flat_frame(spark, rows[:60], NAMES), 4, slack=slack)
    steps = [(rows[60:75], []), ([], sorted(live)[:20]), ([(r[0], "hot", None, r[3]) for r in rows[30:40]] + rows[75:], ["nobody"])]
    steps.append(([rows[3]], [r[0] for r in rows[40:50]]))
    whole = 0
    for n, (added, removed) in enumerate(steps):
        assert update_index(spark, path, flat_frame(spark, added, NAMES), ids(spark, removed)) == n + 1
        for i in removed:
            live.pop(i, None)
        live.update({r[0]: r for r in added})
        whole += upkeep.live_heads(spark, path).filter(f"whole AND gen = {n + 1}").count()
        assert {tuple(r) for r in live_items(spark, path).select("sku", *NAMES).collect()} == set(live.values())
        want = brute_force(list(live.values()), NAMES, 4)
        assert as_lists(top_k_from_upkept(spark, path)) == want
    assert whole > 0 or slack is None
    asked = [rng.choice(sorted(live)) for _ in range(5)] + ["nobody", rows[40][0]]
    assert as_lists(top_k_from_upkept(spark, path, ids(spark, asked), 3)) == brute_force(
        list(live.values()), NAMES, 3, sorted(set(asked)))


def test_a_batch_is_taken_in_once_and_a_failed_update_is_none(spark):
    rows = random_catalog(5, 30, 3)
    path = build_upkept_index(flat_frame(spark, rows[:20], NAMES), 3)
    for _ in range(2):
        assert update_index(spark, path, flat_frame(spark, rows[20:], NAMES), batch="monday") == 1
    # What an update that did not come to its log entry has written.
    flat_frame(spark, [("zz", "hot", "hot", "hot")], NAMES).write.parquet(f"{path}/items/gen=2")
    assert as_lists(top_k_from_upkept(spark, path)) == brute_force(rows, NAMES, 3)
    assert update_index(spark, path, removed=ids(spark, [rows[0][0]])) == 2
    assert as_lists(top_k_from_upkept(spark, path)) == brute_force(rows[1:], NAMES, 3)


def test_awkward_updates(spark):
    rows = random_catalog(6, 15, 3)
    path = build_upkept_index(flat_frame(spark, [*rows, (None, "hot", None, None)], NAMES), 3)
    added = flat_frame(spark, [(None, "x"), ("new", "b"), ("new", "a"), ("none", None)], ["a"])
    update_index(spark, path, added, ids(spark, [None, "absent"]))
    update_index(spark, path)
    live = [*rows, ("new", "a", None, None), ("none", None, None, None)]
    assert as_lists(top_k_from_upkept(spark, path)) == brute_force(live, NAMES, 3)
    with pytest.raises(ValueError):
        update_index(spark, path, flat_frame(spark, [("q", "1")], ["unknown"]))
    with pytest.raises(ValueError):
        top_k_from_upkept(spark, path, k=4)
    update_index(spark, path, removed=ids(spark, [r[0] for r in live]))
    assert top_k_from_upkept(spark, path).count() == 0 and live_items(spark, path).count() == 0


def test_an_empty_catalog_can_grow(spark):
    path = build_upkept_index(flat_frame(spark, [], NAMES), 3)
    assert top_k_from_upkept(spark, path).count() == 0
    rows = random_catalog(8, 12, 3)
    update_index(spark, path, flat_frame(spark, rows, NAMES))
    assert as_lists(top_k_from_upkept(spark, path)) == brute_force(rows, NAMES, 3)


def test_equal_items_are_answered_together(spark, monkeypatch):
    monkeypatch.setattr(upkeep, "MAX_BROADCAST_ROWS", 1)
    found, used = upkeep.top_k_from_classes, []
    monkeypatch.setattr(upkeep, "top_k_from_classes", lambda *a: used.append(1) or found(*a))
    rows = [(f"i{i:02d}", "x" if i % 2 else None, "hot", "u" if i % 3 else "v") for i in range(40)]
    path = build_upkept_index(flat_frame(spark, rows, NAMES), 3)
    update_index(spark, path, flat_frame(spark, [(rows[8][0], "x", None, "v")], NAMES), ids(spark, [rows[0][0]]))
    live = [*rows[1:8], (rows[8][0], "x", None, "v"), *rows[9:]]
    assert as_lists(top_k_from_upkept(spark, path)) == brute_force(live, NAMES, 3)
    assert used
