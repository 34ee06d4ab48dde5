"""Secret scans with one combined deterministic automaton.

All rules' regular expressions become one automaton: position sets over byte
classes (subset construction), minimised, as transition arrays.  It runs over
the bytes of a text once and tells after each byte which rules have a match
ending there.  Matches are rare; only there a rule's reversed automaton finds
the leftmost start back from that end, and its own automaton the longest end
from that start.  Spans of a rule are leftmost and do not overlap.  This is
right for rules no match of which holds another complete match before its own
first end, as is the case for those here (tests compare with a regular
expression library).

Matches that fail a rule's length are dropped after matching, as they still
use up their text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as rc, _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import col, map_arrow


@dataclass(frozen=True)
class Rule:
    """A match needs ``least`` characters: of the value after its separator if
    ``of_value``, else of the whole."""

    kind: str
    pattern: str
    least: int = 0
    of_value: bool = False


# The first three rules and their lengths are given; hexadecimal
# runs are counted in the pattern, as every short word has some.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16}[0-9a-f]*"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    """States with byte-set moves and empty moves, from a parsed expression."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, tree, at: int, fold: bool, back: bool) -> int:
        """Append ``tree`` after state ``at`` (mirrored if ``back``); the end state."""
        for op, arg in (reversed(list(tree)) if back else tree):
            if op in (rc.LITERAL, rc.IN):
                end = self.state()
                self.moves[at].append((_byte_set(op, arg, fold), end))
                at = end
            elif op is rc.SUBPATTERN:
                at = self.add(arg[3], at, fold or bool(arg[1] & rc.SRE_FLAG_IGNORECASE), back)
            elif op is rc.BRANCH:
                end = self.state()
                for way in arg[1]:
                    self.empty[self.add(way, at, fold, back)].append(end)
                at = end
            elif op is rc.MAX_REPEAT:
                low, high, inner = arg
                for _ in range(low):
                    at = self.add(inner, at, fold, back)
                if high is rc.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.empty[at].append(loop)
                    self.empty[self.add(inner, loop, fold, back)].append(loop)
                    self.empty[loop].append(end)
                    at = end
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.empty[at].append(end)
                        at = self.add(inner, at, fold, back)
                    self.empty[at].append(end)
                    at = end
            else:
                raise ValueError(f"not supported in a rule: {op}")
        return at

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _byte_set(op, arg, fold: bool) -> frozenset:
    chosen: set[int] = set()
    for kind, value in ([(op, arg)] if op is rc.LITERAL else arg):
        if kind is rc.LITERAL:
            chosen.add(value)
        elif kind is rc.RANGE:
            chosen.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a class: {kind}")
    if max(chosen) > 127:
        raise ValueError("rules are ASCII")
    if fold:
        chosen |= {ord(f(chr(c))) for c in chosen for f in (str.upper, str.lower)}
    return frozenset(chosen)


@dataclass
class Automaton:
    """``moves[state, byte]`` is the next state and ``accepts[state]`` a bit set of
    rules; state 0 starts; ``dead`` is the state without a way out, or -1."""

    moves: np.ndarray
    accepts: np.ndarray
    dead: int = -1


def build(patterns: list[str], anywhere: bool, back: bool = False) -> Automaton:
    """The minimal automaton of all ``patterns``.  With ``anywhere`` a match may
    start at every byte and is told at its first end only, which keeps the
    automaton small; ``back`` reads the patterns from their ends."""
    nfa = _Nfa()
    start = nfa.state()
    ends: dict[int, int] = {}
    for i, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        ends[nfa.add(rp.parse(pattern), first, False, back)] = 1 << i
    if anywhere:
        for s in range(len(nfa.moves)):
            if not ends.keys().isdisjoint(nfa.closure([s])):
                nfa.moves[s] = []
    # Bytes that no set tells apart are one class.
    sets = {s for moves in nfa.moves for s, _ in moves}
    signs = [tuple(b in s for s in sets) for b in range(256)]
    classes = {sign: k for k, sign in enumerate(dict.fromkeys(signs))}
    of_byte = np.array([classes[s] for s in signs])
    sample = {classes[s]: b for b, s in reversed(list(enumerate(signs)))}
    origin = nfa.closure([start])
    known, todo, table = {origin: 0}, [origin], []
    while todo:
        row, states = [], todo.pop(0)
        by_class = []
        for k in range(len(classes)):
            byte = sample[k]
            reached = nfa.closure([t for s in states for chars, t in nfa.moves[s] if byte in chars])
            by_class.append(reached | origin if anywhere else reached)
        for reached in by_class:
            if reached not in known:
                known[reached] = len(known)
                todo.append(reached)
            row.append(known[reached])
        table.append(row)
    table = np.array(table)
    accepts = np.zeros(len(table), np.int64)
    for states, k in known.items():
        for s in states:
            accepts[k] |= ends.get(s, 0)
    # Minimisation: split groups of states until members move alike.
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            break
        group = finer
    _, first = np.unique(group, return_index=True)
    order = np.argsort(np.where(group[first] == group[0], -1, first))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    moves = rank[group[table[first[order]]]][:, of_byte]
    accepts = accepts[first[order]]
    dead = np.flatnonzero((moves == np.arange(len(moves))[:, None]).all(axis=1) & (accepts == 0))
    return Automaton(moves.astype(np.int32), accepts, int(dead[0]) if len(dead) and not anywhere else -1)


class Scanner:
    """All spans of all rules in a text."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = build([r.pattern for r in rules], anywhere=True)
        self.forward = [build([r.pattern], anywhere=False) for r in rules]
        self.backward = [build([r.pattern], anywhere=False, back=True) for r in rules]
        self._rows = None

    def __getstate__(self):
        return self.__dict__ | {"_rows": None}

    def _linked(self) -> list:
        """The transition arrays as lists of each other: one look-up moves on a
        byte.  Entry 256 has the rules that match there."""
        if self._rows is None:
            rows = [[None] * 257 for _ in self.all.moves]
            for row, moves, accept in zip(rows, self.all.moves.tolist(), self.all.accepts.tolist()):
                row[:256] = [rows[k] for k in moves]
                row[256] = accept
            self._rows = rows
        return self._rows

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """``(end, rules)`` wherever some rule has a match ending, in one pass."""
        found, row = [], self._linked()[0]
        for at, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                found.append((at + 1, row[256]))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, end, rule number)`` in bytes, by start and then rule."""
        out = []
        done = [0] * len(self.rules)
        for end, matched in self.ends(data):
            for k, rule in enumerate(self.rules):
                if matched >> k & 1 and end > done[k]:
                    start = _furthest(self.backward[k], data, end, done[k], -1)
                    if start is None:
                        continue
                    stop = _furthest(self.forward[k], data, start, len(data), 1)
                    done[k] = stop
                    if rule.least:
                        value = data[start:stop]
                        value = _value(value) if rule.of_value else value
                        if len(value) < rule.least:
                            continue
                    out.append((start, stop, k))
        return sorted(out)


def _value(match: bytes) -> bytes:
    """What follows the separator (the first colon or equals sign) and its quote."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1
    rest = match[at:].lstrip(b" ")
    return rest[1:] if rest[:1] in (b'"', b"'") else rest


def _furthest(auto: Automaton, data: bytes, at: int, limit: int, step: int) -> int | None:
    """The last place an anchored automaton accepts, from ``at`` to ``limit``."""
    state, best = 0, None
    while at != limit:
        state = auto.moves[state, data[at if step > 0 else at - 1]]
        if state == auto.dead:
            break
        at += step
        if auto.accepts[state]:
            best = at
    return best


def scan(docs: DataFrame, text_col: str = "text", columns: list[str] | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(row, spans)``: ``row`` holds the ``columns`` of ``docs`` (all by default),
    ``spans`` an array of ``kind, start, end`` in code points (end exclusive) by
    start and then order of the rules.

    A null text is an empty one and has no spans.  Whole texts are scanned,
    however long; repeated rows agree; an empty table gives no rows.
    """
    scanner = Scanner(rules)
    rows = docs.select(F.struct(*[col(c) for c in columns or docs.columns]).alias("row"),
                       col(text_col).alias("text"))
    kind_of = [r.kind for r in rules]
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                data = (text.as_py() or "").encode()
                points = _Points(data)
                found.append([{"kind": kind_of[k], "start": points(s), "end": points(e)}
                              for s, e, k in scanner.spans(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, span_type)], ["row", "spans"])

    schema = StructType([rows.schema["row"]]).add("spans", ArrayType(
        StructType().add("kind", "string").add("start", "long").add("end", "long")))
    return map_arrow(rows, run, schema)


class _Points:
    """Code points before a byte, counted once per text and only if asked."""

    def __init__(self, data: bytes):
        self.data, self.before = data, None

    def __call__(self, at: int) -> int:
        if self.before is None:
            self.before = np.append(0, np.cumsum(
                np.frombuffer(self.data, np.uint8) & 0xC0 != 0x80))
        return int(self.before[at])


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span's text replaced by ``[kind]``; of overlapping spans
    the first one names the joined stretch.  A null text stays null."""
    found = scan(docs, text_col, None, rules)
    # Spans are in order of their starts: keep the text between them.
    pieces = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(
                s["out"], F.substring(F.col("row")[text_col], s["at"].cast("int") + 1,
                                      (x["start"] - s["at"]).cast("int")),
                F.lit("["), x["kind"], F.lit("]"))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at")))
    clean = F.concat(F.col("p.out"), F.substring(F.col("row")[text_col], F.col("p.at").cast("int") + 1,
                                                 F.length(F.col("row")[text_col])))
    columns = [clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return found.withColumn("p", pieces).select(*columns)
