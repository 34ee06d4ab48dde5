"""The manifest against a plain recursive tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from likewise.llm import merkle_manifest as M
from .helpers import awkward, documents

FIELDS = ["doc_id", "source", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout):
    """The root and each leaf's siblings as ``(left, right)``, level by level."""
    paths, at, own = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for i, k in enumerate(own):
            run = k // fanout * fanout
            paths[i].append(("".join(at[run:k]), "".join(at[k + 1:run + fanout])))
        at = [sha(*at[i:i + fanout]) for i in range(0, len(at), fanout)]
        own = [k // fanout for k in own]
    return at[0], paths


def brute(rows, changed, fanout=16):
    """Multiset of the result rows for ``(doc_id, text, lang, source)`` rows."""
    groups = {}
    for doc_id, text, _, source in rows:
        own = leaf(doc_id, source, text)
        other = own if text is None or not changed(doc_id) else leaf(doc_id, source, text.lower())
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, own, other, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in order}
    root, upper = tree([built[g][0] for g in order], fanout) if order else (None, [])
    out = []
    for g, above in zip(order, upper):
        for (_, _, own, other, doc_id), below in zip(sorted(groups[g]), built[g][1]):
            path = below + above
            folded = other
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((doc_id, own, built[g][0], root, sha(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=str)


def run(docs, fanout=16):
    values = [F.col(c) for c in FIELDS]
    candidate = F.when(F.col("doc_id") % 3 == 0, M.leaf_digest(*values[:2], F.lower("text")))
    found = M.manifest(docs, values, candidate=candidate, fanout=fanout)
    return sorted((tuple(r) for r in found.select(
        "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def changed(doc_id):
    return doc_id is not None and doc_id % 3 == 0


@pytest.mark.parametrize("sizes, fanout", [
    ([1], 16), ([2, 1], 16), ([16, 17, 1], 16), ([257, 30, 5], 16), ([40, 9, 1, 1, 1, 3], 3), ([5] * 20, 2)])
def test_matches_a_plain_tree(spark, sizes, fanout):
    rng = random.Random(str(sizes))
    rows = [(rng.randint(0, 10_000), rng.choice(["Text ONE", "two", "Drei É"]), "en", f"s{s}")
            for s, n in enumerate(sizes) for _ in range(n)]
    docs = documents(spark, rows).repartition(5)
    assert run(docs, fanout) == brute(rows, changed, fanout)


def test_awkward_documents(spark):
    docs = awkward(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    rows += [(None, None, None, None), (9, "É Ü", "de", ""), (9, "É Ü", "de", "")]
    assert run(documents(spark, rows), 2) == brute(rows, changed, 2)


def test_many_groups_and_one_hot(spark):
    rows = [(i, "Hot", "en", "hot" if i % 3 else f"g{i}") for i in range(300)]
    assert run(documents(spark, rows).repartition(3)) == brute(rows, changed)


def test_empty(spark):
    assert run(documents(spark, [])) == []


def test_paths_fold_to_the_root(spark):
    docs = documents(spark, [(i, f"t{i}", "en", f"s{i % 2}") for i in range(70)])
    for r in M.manifest(docs, [F.col("doc_id"), F.col("text")]).collect():
        at = r.leaf
        for step in r.path:
            at = sha(step.left, at, step.right)
        assert at == r.root and r.verified
