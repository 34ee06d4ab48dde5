import random
import re

import numpy as np
import pytest

from likewise.llm import decontaminate as D

from .helpers import awkward, documents, vocabulary

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    doc, hit, found, longest = words(text), set(), set(), 0
    for item, item_text in items:
        w = words(item_text)
        for i in range(max(len(w) - window + 1, 1 if w else 0)):
            part = w[i:i + window]
            for p in range(len(doc) - len(part) + 1):
                if doc[p:p + len(part)] == part:
                    hit |= set(range(p, p + len(part)))
                    found.add(item)
                    n = len(part)
                    while i + n < len(w) and p + n < len(doc) and w[i + n] == doc[p + n]:
                        n += 1
                    longest = max(longest, n)
    return len(doc), len(hit), sorted(found), longest, bool(hit) and 20 * len(hit) >= len(doc)


def sample(rng):
    vocab = vocabulary(rng, 60) + ["Élan", "x9", "9"]
    join = lambda ws: "".join(w + rng.choice([" ", ", ", "\n", " - "]) for w in ws)
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(str(i), join(some(rng.choice([1, 3, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [("25", items[3][1]), ("26", ""), ("27", None), ("28", "!!")]
    docs = []
    for i in range(60):
        parts = some(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(parts))
            parts[at:at] = words(rng.choice(items)[1])[rng.randint(0, 3):]
        docs.append((i, join(parts).upper() if i % 7 == 0 else join(parts)))
    return docs, items


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 700, "block_bytes": 900}])
def test_equals_brute_force(spark, options):
    docs, items = sample(random.Random(4))
    bench = spark.createDataFrame([(int(i), t) for i, t in items], "item_id bigint, text string")
    rows = documents(spark, [(*d, None, None) for d in docs])
    found = D.find_contamination(rows, bench, columns=["doc_id"], **options)
    got = {r.doc_id: r for r in found.select("row.doc_id", "match.*").collect()}
    texts = dict(docs)
    assert set(got) == set(texts)
    for i, text in texts.items():
        r = got[i]
        n, hit, found_items, longest, bad = brute(text, items)
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (n, hit, found_items, bad)
        assert r.longest >= longest  # a chain may pass from one item to another


def test_suffix_array_sorts_to_its_depth():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        ranks = rng.integers(0, 3, n)
        order = D.suffix_array(ranks, 13)
        keys = [tuple(ranks[p:p + 13]) for p in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)


def test_awkward_rows(spark):
    docs = awkward(spark)
    bench = spark.createDataFrame([(1, "One, TWO three"), (None, None)], "item_id bigint, text string")
    rows = D.find_contamination(docs, bench).select("row.*", "match.*").collect()
    assert len(rows) == docs.count()
    assert all(r.contaminated == (r.text == "one two three") for r in rows)
    assert max(r.n_words for r in rows) == 60_000
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert D.decontaminate(awkward(spark), bench).count() == 9
    assert D.decontaminate(documents(spark, []), bench).count() == 0


def test_null_item_ids_and_repeats(spark):
    bench = spark.createDataFrame([(None, "one two three"), (7, "one two three"), (7, "One, two three")],
                                  "item_id bigint, text string")
    rows = D.find_contamination(documents(spark, [(1, "ONE two  three", None, None)]), bench).select("match.*").collect()
    assert [(r.n_hit, r["items"]) for r in rows] == [(3, ["", "7"])]


def test_words_are_told_apart_by_their_bytes(spark):
    """Words whose power sums agree modulo any power of two."""
    morse = lambda a, b: "".join((a, b)[i.bit_count() % 2] for i in range(2048))
    bench = spark.createDataFrame([(1, morse("a", "b"))], "item_id bigint, text string")
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate([morse("a", "b"), morse("b", "a")])])
    found = D.find_contamination(docs, bench, columns=["doc_id"]).select("row.doc_id", "match.n_hit").collect()
    assert {(r.doc_id, r.n_hit) for r in found} == {(0, 1), (1, 0)}


def test_windows_take_few_bytes():
    rng = random.Random(3)
    vocab = vocabulary(rng, 5000)
    items = [(str(i), " ".join(rng.choice(vocab) for _ in range(500))) for i in range(200)]
    items += [(f"x{i}", items[i][1]) for i in range(50)]
    tests = D.TestWindows(items, 13)
    arrays = (tests.words, tests.at, tests.lengths, tests.of, tests.borders, tests.follows)
    assert sum(a.nbytes for a in arrays) < 30 * sum(len(t.split()) for _, t in items)
    assert len(tests.at) == len({tuple(t.split()[i:i + 13]) for _, t in items for i in range(488)})
