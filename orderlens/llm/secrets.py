"""Secret scan: one automaton of all rules reads each byte once, rules then place their spans.

The rules' patterns become one deterministic, minimised automaton that looks for all of them at
once. Bytes that send every state back to the start cut a text into stretches that no match crosses;
the stretches of many texts are read in step, longest first, one table lookup a byte. A stretch in
which a pattern was recognised is then read by each rule's own automata: one reads it backwards and marks
where matches begin, the other gives from there the leftmost, longest, non-overlapping matches; those that
fail the rule's length are dropped. Both read a byte a bounded number of times, however long the text is, and
a long text is read in pieces of a megabyte that end at such a byte.

Spans count code points, end exclusive, ordered by start and then by the rules' order. A null text
is an empty one and has no spans. Repeated rows stay; extra columns are carried, input columns named
like an output column are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.automaton import Automaton, compile_backwards, compile_patterns
from orderlens.llm.common import append_columns, long_pieces, text_offsets, texts_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` says where matches lie, ``shortest`` how long they must be.

    ``signal`` is what the common automaton looks for: the pattern, or a part of its language that
    holds all matches of sufficient length. For ``value_only`` the length is that of the assigned value.
    """

    kind: str
    pattern: bytes
    shortest: int
    signal: bytes = b""
    value_only: bool = False


# The base rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6,
         value_only=True),
    Rule("access", rb"AKIA[A-Z0-9]+", 20),
    Rule("hex", rb"[0-9a-f]+", 24, rb"[0-9a-f]{24}"),
)
MORE_RULES = (
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)
RULES = BASE_RULES + MORE_RULES
#: Stretches read in step; the last few are read one by one.
FEW = 48


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    all_rules: Automaton
    each: tuple[Automaton, ...]
    backwards: tuple[Automaton, ...]
    shortest: int
    cutting: np.ndarray


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    joined = compile_patterns([r.signal or r.pattern for r in rules], anywhere=True)
    # Steps from the start to the nearest final state.
    reached, steps = {0}, 0
    while not any(s >= joined.first_final for s in reached):
        reached = set(joined.table[list(reached)].ravel().tolist())
        steps += 1
    cutting = (joined.table == 0).all(axis=0)[joined.classes]
    return Scanner(rules, joined, tuple(compile_patterns([r.pattern], anywhere=False) for r in rules),
                   tuple(compile_backwards(r.pattern) for r in rules), steps, cutting)


def flagged_stretches(data: np.ndarray, offsets: np.ndarray, scan: Scanner) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches in which some pattern was recognised."""
    inside = np.concatenate([[False], ~scan.cutting[data], [False]])
    edge = np.zeros(len(inside), bool)
    edge[offsets + 1] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[1:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[2:])) + 1
    long_enough = ends - starts >= scan.shortest
    starts, ends = starts[long_enough], ends[long_enough]
    order = np.argsort(starts - ends, kind="stable")
    starts, ends = starts[order], ends[order]

    auto = scan.all_rules
    width = auto.table.shape[1]
    classes = auto.classes[data]
    jump = (auto.table * width).astype(np.int32).ravel()
    final = auto.first_final * width
    state = np.zeros(len(starts), np.int32)
    highest = np.zeros(len(starts), np.int32)
    lengths = ends - starts
    at = starts.copy()
    # How many stretches are longer than each step.
    most = int(lengths[0]) if len(lengths) else 0
    longer = len(lengths) - np.cumsum(np.bincount(lengths, minlength=most + 1))
    step = 0
    while step < most and (n := int(longer[step])) > FEW:
        now = state[:n]
        np.add(now, classes[at[:n]], out=now)
        np.take(jump, now, out=now)
        np.maximum(highest[:n], now, out=highest[:n])
        at[:n] += 1
        step += 1
    if step < most:
        table = auto.table.tolist()
        for i in range(int(longer[step])):
            s = int(state[i]) // width
            for c in classes[at[i]: ends[i]].tolist():
                s = table[s][c]
                if s >= auto.first_final:
                    highest[i] = final
                    break
    hit = highest >= final
    return starts[hit], ends[hit]


def match_starts(codes: list[int], auto: Automaton) -> list[int]:
    """Where matches begin, in order, by reading backwards."""
    rows, first_final = auto.table.tolist(), auto.first_final
    state, found = 0, []
    for i in range(len(codes) - 1, -1, -1):
        state = rows[state][codes[i]]
        if state >= first_final:
            found.append(i)
    return found[::-1]


def leftmost_matches(raw: bytes, auto: Automaton, backwards: Automaton) -> list[tuple[int, int]]:
    """Leftmost, longest, non-overlapping matches of one rule.

    A first pass, backwards, marks where matches begin, so that no run starts in vain.
    """
    data = np.frombuffer(raw, np.uint8)
    codes = auto.classes[data]
    if not (auto.table[0][codes] != auto.dead).any():
        return []
    rows, dead, first_final = auto.table.tolist(), auto.dead, auto.first_final
    codes = codes.tolist()
    found, free = [], 0
    for start in match_starts(backwards.classes[data].tolist(), backwards):
        if start < free:
            continue
        state, end = 0, -1
        for i in range(start, len(codes)):
            state = rows[state][codes[i]]
            if state == dead:
                break
            if state >= first_final:
                end = i + 1
        found.append((start, end))
        free = end
    return found


def _assigned_length(match: bytes) -> int:
    """Length of what is assigned: after the sign, spaces and one quote."""
    sign = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[sign + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'"))


def spans_of(column: pa.Array, scan: Scanner) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of every secret of each row, in code points; a long text is read piece by piece."""
    def after_cut(window: np.ndarray) -> np.ndarray:
        return np.flatnonzero(scan.cutting[window[:-1]]) + 1

    found, chars = None, 0
    for piece in long_pieces(column, after_cut):
        spans = _spans(piece, scan)
        if found is None:
            found = spans
        else:
            found[0] += [(kind, a + chars, b + chars) for kind, a, b in spans[0]]
        if piece is not column:
            chars += int(np.count_nonzero((text_offsets(piece)[1] & 0xC0) != 0x80))
    return found


def _spans(column: pa.Array, scan: Scanner) -> list[list[tuple[str, int, int]]]:
    offsets, data = text_offsets(column)
    starts, ends = flagged_stretches(data, offsets, scan)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for start, end in zip(starts.tolist(), ends.tolist()):
        row = int(np.searchsorted(offsets, start, "right")) - 1
        raw = data[start:end].tobytes()
        for kind, (rule, auto, backwards) in enumerate(zip(scan.rules, scan.each, scan.backwards)):
            for a, b in leftmost_matches(raw, auto, backwards):
                if (_assigned_length(raw[a:b]) if rule.value_only else b - a) >= rule.shortest:
                    found.setdefault(row, []).append((start + a, kind, start + b))
    out: list[list[tuple[str, int, int]]] = [[] for _ in range(len(column))]
    for row, spans in found.items():
        begin = int(offsets[row])
        points = np.concatenate([[0], np.cumsum((data[begin: offsets[row + 1]] & 0xC0) != 0x80)])
        out[row] = [(scan.rules[k].kind, int(points[a - begin]), int(points[b - begin])) for a, k, b in sorted(spans)]
    return out


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _as_structs(spans: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in spans], _ARROW_SPANS)


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``secrets``, the spans of each text."""
    def work():
        scan = scanner(rules)
        return lambda part: [_as_structs(spans_of(texts_of(part), scan))]

    return append_columns(docs, text, [T.StructField("secrets", SPANS)], work, keep)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def hide(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each secret, or run of overlapping ones, replaced by the first one's kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with secrets hidden in the text and its length counted anew; null texts stay null."""
    def work():
        scan = scanner(rules)

        def made(part: pa.RecordBatch) -> list[pa.Array]:
            column = texts_of(part)
            texts = [t if not s else hide(t, s) for t, s in zip(column.to_pylist(), spans_of(column, scan))]
            return [pa.array(texts, pa.string())]

        return made

    hidden = append_columns(docs, text, [T.StructField(text, T.StringType())], work)
    if n_chars in docs.columns:
        hidden = hidden.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return hidden.select(*docs.columns)
