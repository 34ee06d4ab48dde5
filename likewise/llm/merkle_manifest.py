"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf: the sha256 of its fields.  The leaves of a group, in order
of their ids, are hashed in runs of ``fanout`` until one node, the group's
subroot, is left; the subroots, in order of the groups, likewise give the root.

A level is one aggregation: conditional aggregates spread the children of each
parent into ``fanout`` slot columns (``d0, d1, ...``).  The columns joined in
order are what the parent's digest is taken of, and the columns without the own
slot are a child's siblings.  Levels are stored tables; going down them again,
each run learns the way from its parent to the root, so a row's proof is its own
run's siblings and that way, and no row is joined to every level.

Ids number the leaves of a group, but no group is numbered in one task: rows are
range-partitioned by group and id, and the sizes of the ranges (one row per
group and range) give where each starts.  Texts are read once and never move.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.numbering import numbered
from ..plans.sizing import broadcast_if_small
from .common import col, materialize

FANOUT = 16
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' texts one after the other; null parts
    are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, ``:`` and the value's text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def group_key(group: Column) -> Column:
    """A text without nulls that sorts as the group does, nulls first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _slots(fanout: int) -> list[str]:
    return [f"d{s}" for s in range(fanout)]


def _pivot(nodes: DataFrame, fanout: int, carried: str | None = None) -> DataFrame:
    """One row per run of ``fanout`` nodes of a group: its children's digests in the
    slot columns, ``carried`` of each child in ``c0, c1, ...``, and its own digest."""
    slot = F.col("idx") % fanout

    def spread(column: str, prefix: str) -> list[Column]:
        return [F.max(F.when(slot == s, F.col(column))).alias(f"{prefix}{s}") for s in range(fanout)]

    columns = spread("digest", "d") + (spread(carried, "c") if carried else [])
    runs = nodes.groupBy("grp", "n", F.floor(F.col("idx") / fanout).cast("bigint").alias("parent")).agg(*columns)
    return runs.withColumn("digest", digest(*[F.col(d) for d in _slots(fanout)]))


@dataclass
class Tree:
    """The stored levels of the trees of all groups, and each group's last node."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int


def build(nodes: DataFrame, fanout: int = FANOUT, carried: str | None = None) -> Tree:
    """Trees over ``nodes`` (``grp, n, idx, digest``), one per group.

    ``tops`` has ``grp, top, height`` of every group; ``height`` counts the
    levels above its leaves, 0 for a lone leaf."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops = nodes.filter("n = 1").select("grp", F.col("digest").alias("top"), F.lit(0).alias("height"))
    levels, at = [], nodes
    while most > 1:
        runs = materialize(_pivot(at.filter("n > 1"), fanout, carried if not levels else None),
                           f"merkle-level{len(levels)}")
        levels.append(runs)
        most = -(-most // fanout)
        at = runs.select("grp", F.ceil(F.col("n") / fanout).cast("bigint").alias("n"),
                         F.col("parent").alias("idx"), "digest")
        tops = tops.unionByName(at.filter("n = 1").select(
            "grp", F.col("digest").alias("top"), F.lit(len(levels)).alias("height")))
    return Tree(levels, tops, fanout)


def _children(runs: DataFrame, fanout: int, carried: bool = False) -> DataFrame:
    """The children of stored runs with ``path``, each with its own way to the root:
    the siblings to its left and right, then the parent's ``path``."""
    digests = F.array(*[F.col(d) for d in _slots(fanout)])
    others = [F.struct(
        F.lit(s).alias("slot"), F.col(f"d{s}").alias("digest"),
        *([F.col(f"c{s}").alias("carried")] if carried else [])) for s in range(fanout)]
    opened = runs.select("grp", "parent", "path", digests.alias("digests"),
                         F.explode(F.array(*others)).alias("child")).filter("child.digest IS NOT NULL")
    slot = F.col("child.slot")
    step = F.struct(
        F.concat_ws("", F.slice("digests", F.lit(1), slot)).alias("left"),
        F.concat_ws("", F.slice("digests", slot + 2, F.lit(fanout))).alias("right"))
    return opened.select(
        "grp", (F.col("parent") * fanout + slot).alias("idx"), F.col("child.digest").alias("digest"),
        *([F.col("child.carried").alias("carried")] if carried else []),
        F.concat(F.array(step), F.col("path")).alias("path"))


def with_paths(tree: Tree, tops: DataFrame, carried: bool = False) -> DataFrame | None:
    """The leaves below at least one level with their ``path`` to the root; ``tops``
    has ``grp, height, path`` of every group's last node.  None without levels."""
    below = None
    for height in range(len(tree.levels), 0, -1):
        ends = tops.filter(F.col("height") == height).select("grp", F.lit(0).cast("bigint").alias("parent"), "path")
        if below is not None:
            ends = ends.unionByName(below.select("grp", F.col("idx").alias("parent"), "path"))
        runs = tree.levels[height - 1].join(ends, ["grp", "parent"])
        last = height == 1
        below = _children(runs, tree.fanout, carried and last)
        if not last:
            below = materialize(below.select("grp", "idx", "path"), f"merkle-paths{height}")
    return below


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def manifest(docs: DataFrame, values: list[Column], id_col: str = "doc_id", group_col: str = "source",
             candidate: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """``(id, grp, leaf, subroot, root, path, proof_sha256, folded_root, verified)`` of
    every row of ``docs``.

    ``values`` are a leaf's fields.  ``candidate`` is the leaf digest to be verified in
    place of the row's own (null: its own): ``folded_root`` is recomputed from it and the
    stored siblings, ``verified`` tells whether that is the root.

    A group is a value of ``group_col``; null is a group, the first.  Within a group null
    ids come first and rows of one id follow their leaf digests; repeated rows are leaves
    of their own.  Null fields are hashed as ``-``, empty texts as ``0:``; long texts are
    hashed whole.  An empty table gives no row.  Other columns are not read.
    """
    leaf = leaf_digest(*values)
    own = F.lit(None).cast("string") if candidate is None else candidate
    leaves = docs.select(col(id_col).alias("id"), group_key(col(group_col)).alias("grp"), leaf.alias("digest"),
                         F.when(own != leaf, own).alias("changed"),
                         F.monotonically_increasing_id().alias("row"))
    # Stored once: the texts are hashed here and not read again.
    leaves = materialize(leaves, "merkle-leaves")
    leaves = numbered(leaves, "grp", ["id", "digest", "row"], ["id", "digest", "row"]).select(
        "grp", "n", "idx", "digest", F.struct("id", "changed").alias("carried"))
    leaves = materialize(leaves, "merkle-numbered")
    groups = build(leaves, fanout, "carried")
    tops = materialize(groups.tops, "merkle-tops")

    subroots = tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("top").alias("digest"),
                           F.struct("grp", "top", "height").alias("carried"))
    subroots = materialize(numbered(subroots, "grp", ["key"], ["key"]).drop("key"), "merkle-subroots")
    whole = build(subroots, fanout, "carried")
    start = whole.tops.select("grp", "height", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    lone = subroots.filter("n = 1").join(start.filter("height = 0"), "grp").select(
        "grp", "idx", "digest", "carried", "path")
    ways = with_paths(whole, start, carried=True)
    ways = lone if ways is None else ways.unionByName(lone)
    ways = materialize(ways.join(F.broadcast(start.select("grp", "root")), "grp").select(
        "carried.grp", "carried.top", "carried.height", "path", "root"), "merkle-ways")

    single = leaves.filter("n = 1").join(ways.filter("height = 0").select("grp", "path"), "grp").select(
        "grp", "idx", "digest", "carried", "path")
    rows = with_paths(groups, ways.select("grp", "height", "path"), carried=True)
    rows = single if rows is None else rows.unionByName(single)
    rows = rows.join(broadcast_if_small(ways.select("grp", "top", "root")), "grp")
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    folded = fold(F.coalesce("carried.changed", "digest"), F.col("path"))
    return rows.select(
        F.col("carried.id").alias("id"), F.when(F.col("grp") != "-", F.substr("grp", F.lit(2))).alias("grp"),
        F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root", "path",
        F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text."""
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), "
            "lambda ch: CAST(ascii(ch) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), "
            "range(8)), lambda c, i: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)))), CAST(4294967295 AS BIGINT))")


def manifest_sql(height: int = 6, fanout: int = FANOUT) -> str:
    """DuckDB SQL for the manifest of ``documents``, its levels written out up to
    ``height`` for a source and for the sources."""
    def part(value: str) -> str:
        return (f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')")

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(part(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = crc32_sql("CAST(doc_id AS VARCHAR)")

    def levels(prefix: str) -> list[str]:
        out = []
        for h in range(height):
            out.append(f"""{prefix}{h + 1} AS (
  SELECT grp, (n + {fanout - 1}) // {fanout} AS n, idx // {fanout} AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d
  FROM {prefix}{h} WHERE n > 1 GROUP BY grp, n, idx // {fanout})""")
        return out

    def paths(prefix: str, first: str) -> list[str]:
        """Each leaf's siblings, level by level, and what its candidate folds to."""
        out, at = [], first
        for h in range(height):
            out.append(f"""{prefix}p{h + 1} AS (
  SELECT p.r, p.grp, p.idx // {fanout} AS idx, p.proof || coalesce(s.l, '') || coalesce(s.r, '') AS proof,
         CASE WHEN s.k IS NULL THEN p.f ELSE sha256(coalesce(s.l, '') || p.f || coalesce(s.r, '')) END AS f
  FROM {at} p LEFT JOIN (
    SELECT p.r AS k, string_agg(t.d, '' ORDER BY t.idx) FILTER (t.idx < p.idx) AS l,
           string_agg(t.d, '' ORDER BY t.idx) FILTER (t.idx > p.idx) AS r
    FROM {at} p JOIN {prefix}{h} t ON t.grp = p.grp AND t.n > 1 AND t.idx // {fanout} = p.idx // {fanout}
    GROUP BY p.r) s ON s.k = p.r)""")
            at = f"{prefix}p{h + 1}"
        return out

    def tops(prefix: str) -> str:
        return " UNION ALL ".join(f"SELECT grp, d FROM {prefix}{h} WHERE n = 1" for h in range(height + 1))

    parts = [f"""leaves AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS grp, {leaf('text')} AS d,
         CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f FROM documents)""",
             """placed AS (
  SELECT *, count(*) OVER (PARTITION BY grp) AS n,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d) - 1 AS idx FROM leaves)""",
             "a0 AS (SELECT grp, n, idx, d FROM placed)", *levels("a"),
             f"atops AS ({tops('a')})",
             """b0 AS (SELECT '' AS grp, count(*) OVER () AS n, row_number() OVER (ORDER BY grp) - 1 AS idx, d, grp AS src
  FROM atops)""", *levels("b"), f"btops AS ({tops('b')})",
             "ap0 AS (SELECT r, grp, idx, '' AS proof, f FROM placed)", *paths("a", "ap0"),
             f"bp0 AS (SELECT p.r, '' AS grp, b0.idx, p.proof, p.f FROM ap{height} p JOIN b0 ON b0.src = p.grp)",
             *paths("b", "bp0")]
    return f"""WITH {", ".join(parts)}
SELECT l.doc_id, l.d AS leaf, s.d AS subroot, t.d AS root, sha256(p.proof) AS proof_sha256,
       p.f AS folded_root, p.f = t.d AS verified
FROM placed l JOIN bp{height} p ON p.r = l.r JOIN atops s ON s.grp = l.grp CROSS JOIN btops t"""
