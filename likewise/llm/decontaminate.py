"""Benchmark decontamination with training suffix arrays.

Every task cuts its documents into shards of bounded size and builds a suffix
array over each shard's words, sorted to the depth of a test window.  All test
suffixes (13 words from every position of every benchmark item; a shorter
item as a whole) are binary-searched in it together, which gives the range
of training positions that start with the same words: the verbatim matches
and their locations.  Successive matches are chained to the longest ones.

Words are told apart by their bytes: a word is its place among the benchmark's
distinct words, and a word that no item has can be in no match.

Documents are never shuffled.  The test side reaches the tasks in blocks of
at most ``block_bytes`` of text, as arrays of about 25 bytes a word: one block is one
pass; more blocks are further passes that carry the marks found so far along with
each row, with a written table between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .common import col, map_arrow, materialize, row_blocks, utf8_bytes

WINDOW = 13
# Contaminated: one hit word or more, and at least one word in MIN_SHARE hit.
MIN_SHARE = 20
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 16 << 20
# Windows searched at once.
QUERY_WINDOWS = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_FIELDS = {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>",
           "longest": "bigint", "longest_at": "bigint", "hits": "binary"}
_STATE = "struct<" + ",".join(f"{k}:{v}" for k, v in _FIELDS.items()) + ">"
_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.binary()]


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Word starts, ends and rows of lower-cased texts.  Bytes from 0x80 on
    only occur in characters from U+0080 on, so bytes decide like characters."""
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as an Arrow array."""
    lengths = ends - starts
    borders = np.append(0, np.cumsum(lengths))
    pick = np.arange(borders[-1]) + np.repeat(starts - borders[:-1], lengths)
    return pa.Array.from_buffers(pa.large_binary(), len(starts),
                                 [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(data[pick])])


class TestWindows:
    """The distinct windows of a block of benchmark items, as arrays: the items' words one
    after the other (``words``, places in ``vocabulary``), and of each distinct window where it
    begins (``at``), its ``lengths`` and the items that have it (``of``, in rows of ``borders``)."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.names = sorted({item for item, _ in items})
        texts = pa.array([text or "" for _, text in items], pa.large_string())
        data, offsets = utf8_bytes(texts)
        data = _LOWER[data]
        starts, ends, rows = words_of(data, offsets)
        coded = word_array(data, starts, ends).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.words = coded.indices.to_numpy().astype(np.int32)
        place = {name: i for i, name in enumerate(self.names)}
        item = np.array([place[i] for i, _ in items], np.int64)[rows] if len(items) else rows
        n_words = np.bincount(rows, minlength=len(items))
        left = (np.cumsum(n_words)[rows] if len(items) else rows) - np.arange(len(rows))
        whole = n_words[rows] < window if len(items) else np.zeros(0, bool)
        first = np.ones(len(rows), bool)
        first[1:] = rows[1:] != rows[:-1]
        # Windows of all items, equal ones side by side: full ones, then whole short items.
        begins = np.flatnonzero((left >= window) | (first & whole))
        lengths = np.minimum(left[begins], window)
        padded = np.append(self.words, np.full(window, -1, np.int32))
        order = self._sorted(begins, lengths, padded)
        begins, lengths = begins[order], lengths[order]
        new = np.ones(len(begins), bool)
        for low in range(1, len(begins), QUERY_WINDOWS):
            part = np.arange(low, min(low + QUERY_WINDOWS, len(begins)))
            new[part] = (self._row(begins[part], lengths[part], padded)
                         != self._row(begins[part - 1], lengths[part - 1], padded)).any(axis=1)
        group = np.cumsum(new) - 1
        self.at, self.lengths = begins[new].astype(np.int32), lengths[new].astype(np.int8)
        pairs = np.unique(group * np.int64(max(len(self.names), 1)) + item[begins])
        self.of = (pairs % max(len(self.names), 1)).astype(np.int32)
        self.borders = np.searchsorted(pairs // max(len(self.names), 1), np.arange(len(self.at) + 1)).astype(np.int32)
        # Which full window an item has one word after which.
        group_at = np.full(len(self.words) + 1, -1, np.int64)
        group_at[begins] = np.where(lengths == window, group, -1)
        after = np.flatnonzero((group_at[:-1] >= 0) & (group_at[1:] >= 0) & (left > window))
        self.follows = np.unique(group_at[after] * max(len(self.at), 1) + group_at[after + 1])

    def _row(self, begins: np.ndarray, lengths: np.ndarray, padded: np.ndarray) -> np.ndarray:
        """The words of windows, -1 behind the shorter ones."""
        steps = np.arange(self.window)
        return np.where(steps < lengths[:, None], padded[begins[:, None] + steps], -1)

    def _sorted(self, begins: np.ndarray, lengths: np.ndarray, padded: np.ndarray) -> np.ndarray:
        """An order that brings equal windows together."""
        full = np.flatnonzero(lengths == self.window)
        short = np.flatnonzero(lengths < self.window)
        rank = np.empty(len(self.words), np.int64)
        rank[suffix_array(self.words.astype(np.int64), self.window)] = np.arange(len(self.words))
        full = full[np.argsort(rank[begins[full]])]
        rows = self._row(begins[short], lengths[short], padded)
        return np.concatenate([full, short[np.lexsort(rows.T[::-1])] if len(short) else short])

    def rows(self, which: np.ndarray) -> np.ndarray:
        """The words of some distinct windows."""
        padded = np.append(self.words, np.full(self.window, -1, np.int32))
        return self._row(self.at[which].astype(np.int64), self.lengths[which], padded)

    def items_of(self, windows: np.ndarray) -> list[str]:
        """The items that have any of these distinct windows."""
        if not len(windows):
            return []
        found = np.concatenate([self.of[self.borders[w]:self.borders[w + 1]] for w in windows])
        return [self.names[i] for i in np.unique(found)]


def suffix_array(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ranks`` (non-negative integers) sorted by the ``depth``
    ranks from there on.  The sorted prefix doubles each round, and only
    positions still tied are sorted again."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    place = np.empty(n, np.int64)
    head = np.ones(n, bool)
    head[1:] = ranks[order][1:] != ranks[order][:-1]
    place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    reach = 1
    while reach < depth:
        alone = head.copy()
        alone[:-1] &= head[1:]
        tied = np.flatnonzero(~alone)
        if not len(tied):
            break
        at = order[tied]
        after = np.where(at + reach < n, place[np.minimum(at + reach, n - 1)] + 1, 0)
        key = place[at] * np.int64(n + 1) + after
        sub = np.argsort(key, kind="stable")
        order[tied], key = at[sub], key[sub]
        # Tied slots of one group are adjacent, so group and key changes mark heads.
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        head[tied] = new
        place[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        reach *= 2
    return order


def find_windows(words: pa.Array, tests: TestWindows) -> tuple[np.ndarray, np.ndarray]:
    """``(window, position)`` of every occurrence of a test window in ``words``, by binary
    search of all windows in the suffix array."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(words) or not len(tests.at):
        return none
    codes = pc.index_in(words, value_set=tests.vocabulary).fill_null(-1).to_numpy().astype(np.int64)
    known = np.zeros(len(tests.vocabulary), bool)
    known[codes[codes >= 0]] = True
    unknown = np.append(0, np.cumsum(~known[tests.words]))
    asked = np.flatnonzero(unknown[tests.at + tests.lengths.astype(np.int64)] == unknown[tests.at])
    if not len(asked):
        return none
    # A word that no item has is like no other, so it ties with none.
    ranks = np.where(codes < 0, len(known) + np.arange(len(codes)), codes)
    order = suffix_array(ranks, tests.window)
    padded = np.append(ranks, np.full(tests.window, -1))
    found = [_search(asked[i:i + QUERY_WINDOWS], tests, order, padded) for i in range(0, len(asked), QUERY_WINDOWS)]
    return np.concatenate([w for w, _ in found]), np.concatenate([p for _, p in found])


def _search(asked: np.ndarray, tests: TestWindows, order: np.ndarray,
            padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the windows ``asked``."""
    query, n = tests.rows(asked), len(order)
    used, steps = query >= 0, np.arange(tests.window)

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(query), np.int64), np.full(len(query), n, np.int64)
        while (low < high).any():
            middle = (low + high) // 2
            found = padded[order[np.minimum(middle, n - 1)][:, None] + steps]
            differs = (found != query) & used
            where = differs.argmax(axis=1)
            row = np.arange(len(query))
            before = np.where(differs[row, where], found[row, where] < query[row, where], upper)
            go = low < high
            low = np.where(go & before, middle + 1, low)
            high = np.where(go & ~before, middle, high)
        return low

    low, high = bound(False), bound(True)
    counts = high - low
    total = int(counts.sum())
    slot = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return np.repeat(asked, counts), order[slot]


def _mark(data: np.ndarray, offsets: np.ndarray, tests: TestWindows, old: list[dict]) -> list[list]:
    """The match fields of a block of rows, the marks of earlier blocks (``old``)
    joined in."""
    n_rows = len(offsets) - 1
    data = _LOWER[data]
    starts, ends, rows = words_of(data, offsets)
    window, at = find_windows(word_array(data, starts, ends), tests)
    if len(at):
        end = at + tests.lengths[window]
        whole = end <= len(rows)
        whole &= rows[at] == rows[np.minimum(end, len(rows)) - 1]
        window, at, end = window[whole], at[whole], end[whole]
    n_words = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(n_words) - n_words
    items, longest, longest_at = [[] for _ in range(n_rows)], [0] * n_rows, [0] * n_rows
    hits = [None] * n_rows
    if len(at):
        marks = np.zeros(len(starts) + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, end, -1)
        hit = np.cumsum(marks)[:-1] > 0
        by = np.argsort(at, kind="stable")
        window, at = window[by], at[by]
        row = rows[at]
        # A chain goes on where the next word starts a window that follows in an
        # item.  Only full windows chain, and no two of them start at one word.
        head = np.arange(len(at))
        full = np.flatnonzero(tests.lengths[window] == tests.window)
        if len(full):
            w, a, r = window[full], at[full], row[full]
            alone = np.ones(len(full), bool)
            alone[1:] = ((a[1:] != a[:-1] + 1) | (r[1:] != r[:-1])
                         | ~np.isin(w[:-1] * len(tests.at) + w[1:], tests.follows))
            head[full] = full[np.maximum.accumulate(np.where(alone, np.arange(len(full)), 0))]
        length = at - at[head] + tests.lengths[window]
        bounds = np.flatnonzero(np.append(np.append(True, row[1:] != row[:-1]), True))
        for low, high in zip(bounds, bounds[1:]):
            r = int(row[low])
            hits[r] = np.packbits(hit[first[r]:first[r] + n_words[r]])
            items[r] = tests.items_of(np.unique(window[low:high]))
            best = low + int(length[low:high].argmax())
            longest[r], longest_at[r] = int(length[best]), int(at[head[best]] - first[r])
    for r, before in enumerate(old):
        if before["hits"] is not None:
            marked = np.frombuffer(before["hits"], np.uint8)
            hits[r] = marked if hits[r] is None else hits[r] | marked
            items[r] = sorted({*before["items"], *items[r]})
            if before["longest"] >= longest[r]:
                longest[r], longest_at[r] = before["longest"], before["longest_at"]
    n_hit = [0 if x is None else int(np.bitwise_count(x).sum()) for x in hits]
    return [n_words.tolist(), n_hit, items, longest, longest_at,
            [None if x is None else x.tobytes() for x in hits]]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes`` of text, repeats left out."""
    items = benchmark.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("item"),
                             col(text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [tuple(r) for r in part.collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       columns: list[str] | None = None, window: int = WINDOW,
                       min_share: int = MIN_SHARE, shard_bytes: int = SHARD_BYTES,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(row, match)`` for every row of ``docs``: ``row`` holds its ``columns``
    (all by default) and ``match`` the fields ``n_words, n_hit, items`` (ids as
    strings, sorted), ``longest`` (words of the longest chain of matches),
    ``longest_at`` (its first word) and ``contaminated``.

    Null and empty texts have no words and are never contaminated.  Every row
    is judged by itself, so repeated rows agree.  An empty benchmark or an item
    without words matches nothing.  Items with a null id count as id ''.  An
    empty table gives no rows.
    """
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"),
                       F.lit(None).cast(_STATE).alias("match"))
    first = True
    for block in _blocks(benchmark, item_id_col, item_text_col, block_bytes):
        if not first:
            rows = materialize(rows, "decontaminate-marks")
        rows = _pass(rows, text_col, TestWindows(block, window), shard_bytes)
        first = False
    if first:
        rows = _pass(rows, text_col, TestWindows([], window), shard_bytes)
    kept = F.struct(*[F.col("row")[c].alias(c) for c in columns]) if columns else F.col("row")
    m = F.col("match")
    return rows.select(kept.alias("row"), F.struct(
        m["n_words"].alias("n_words"), m["n_hit"].alias("n_hit"), m["items"].alias("items"),
        m["longest"].alias("longest"), m["longest_at"].alias("longest_at"),
        ((m["n_hit"] > 0) & (min_share * m["n_hit"] >= m["n_words"])).alias("contaminated"),
    ).alias("match"))


def _pass(rows: DataFrame, text_col: str, tests: TestWindows, shard_bytes: int) -> DataFrame:
    """One block's marks on every row, with those of earlier blocks."""
    names = rows.schema["row"].dataType.names
    text_at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_bytes(batch.column(0).flatten()[text_at])
            for low, high in row_blocks(offsets, shard_bytes):
                part = batch.slice(low, high - low)
                old = [] if part.column(1).null_count else part.column(1).to_pylist()
                marks = _mark(data[offsets[low]:offsets[high]],
                              offsets[low:high + 1] - offsets[low], tests, old)
                match = pa.StructArray.from_arrays(
                    [pa.array(x, t) for x, t in zip(marks, _ARROW)], list(_FIELDS))
                yield pa.RecordBatch.from_arrays([part.column(0), match], ["row", "match"])

    return map_arrow(rows, run, StructType([rows.schema["row"], rows.schema["match"]]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    found = find_contamination(docs, benchmark, **options)
    return found.filter(~F.col("match.contaminated")).select("row.*")


def contamination_sql(window: int = WINDOW, min_share: int = MIN_SHARE) -> str:
    """DuckDB SQL for ``doc_id`` and the match of every row of ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), {window}) AS n, array_to_string(list_slice(w, i, i + {window - 1}), ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window - 1}, least(len(w), 1)) + 1)) AS i FROM b)),
placed AS (
  SELECT r, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, p, n, item FROM placed JOIN windows USING (n, k)),
covered AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS x FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
          FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {min_share} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""
