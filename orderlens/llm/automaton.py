"""One deterministic automaton for many regular expressions.

Patterns are taken apart by Python's own regex parser, built into a nondeterministic automaton,
determinised by subset construction over classes of equal bytes, and minimised by refining
partitions. Supported: literals, classes, groups, alternatives, greedy repeats, letters in either case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_parse = re._parser.parse
_ops = re._constants


class _Nfa:
    """States with byte moves (a 256-bit mask and a target each) and free moves."""

    def __init__(self):
        self.moves: list[list[tuple[int, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree, at: int, fold: bool) -> int:
        """Append a parsed pattern after state ``at``; the state where it ends."""
        for kind, value in tree:
            at = self._item(kind, value, at, fold)
        return at

    def _item(self, kind, value, at: int, fold: bool) -> int:
        if kind is _ops.SUBPATTERN:
            _, on, off, inner = value
            return self.add(inner, at, (fold or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
        if kind is _ops.BRANCH:
            end = self.state()
            for inner in value[1]:
                self.free[self.add(inner, at, fold)].append(end)
            return end
        if kind is _ops.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                at = self.add(inner, at, fold)
            if most is _ops.MAXREPEAT:
                again = self.state()
                self.free[at].append(again)
                self.free[self.add(inner, again, fold)].append(again)
                return again
            end = self.state()
            for _ in range(most - least):
                self.free[at].append(end)
                at = self.add(inner, at, fold)
            self.free[at].append(end)
            return end
        end = self.state()
        self.moves[at].append((_bytes_of(kind, value, fold), end))
        return end

    def closed(self, states) -> int:
        """Bit mask of ``states`` and what free moves reach from them."""
        seen, todo = 0, list(states)
        while todo:
            s = todo.pop()
            if not seen >> s & 1:
                seen |= 1 << s
                todo.extend(self.free[s])
        return seen


def _bytes_of(kind, value, fold: bool) -> int:
    if kind is _ops.LITERAL:
        mask = 1 << value
    elif kind is _ops.RANGE:
        mask = sum(1 << b for b in range(value[0], value[1] + 1))
    elif kind is _ops.IN:
        negate = value[0][0] is _ops.NEGATE
        mask = 0
        for k, v in value[negate:]:
            mask |= _bytes_of(k, v, fold)
        return ((1 << 256) - 1) ^ mask if negate else mask
    else:
        raise ValueError(f"pattern item {kind} is not supported")
    if fold:
        for b in range(256):
            if mask >> b & 1 and chr(b).isascii() and chr(b).isalpha():
                mask |= 1 << (b ^ 32)
    return mask


@dataclass(frozen=True)
class Automaton:
    """``table[state, classes[byte]]`` is the next state; state 0 starts.

    States from ``first_final`` on have recognised a pattern; ``finals`` gives each state's patterns
    as bits. ``dead`` is the state without a way on, -1 if there is none.
    """

    table: np.ndarray
    classes: np.ndarray
    finals: np.ndarray
    first_final: int
    dead: int


def compile_patterns(patterns: list[bytes], anywhere: bool) -> Automaton:
    """Automaton that recognises the patterns at its start, or ``anywhere`` in what it reads."""
    nfa = _Nfa()
    start = nfa.state()
    if anywhere:
        nfa.moves[start].append(((1 << 256) - 1, start))
    ends = [nfa.add(_parse(p), _after(nfa, start), False) for p in patterns]
    return _determined(nfa, start, ends)


def compile_backwards(pattern: bytes) -> Automaton:
    """Automaton for a text read from its end: it is final at every place where a match begins."""
    forwards = _Nfa()
    first = forwards.state()
    last = forwards.add(_parse(pattern), first, False)
    nfa = _Nfa()
    for _ in forwards.moves:
        nfa.state()
    for s, (moves, free) in enumerate(zip(forwards.moves, forwards.free)):
        for mask, target in moves:
            nfa.moves[target].append((mask, s))
        for target in free:
            nfa.free[target].append(s)
    start = nfa.state()
    nfa.moves[start].append(((1 << 256) - 1, start))
    nfa.free[start].append(last)
    return _determined(nfa, start, [first])


def _determined(nfa: _Nfa, start: int, ends: list[int]) -> Automaton:
    masks = {mask for moves in nfa.moves for mask, _ in moves}
    signatures = [tuple(mask >> b & 1 for mask in masks) for b in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signatures))}
    classes = np.array([kinds[s] for s in signatures], np.uint8)
    sample = [signatures.index(s) for s in kinds]

    reach = [[0] * len(kinds) for _ in nfa.moves]
    for s, moves in enumerate(nfa.moves):
        for mask, target in moves:
            closed = nfa.closed([target])
            for c, b in enumerate(sample):
                if mask >> b & 1:
                    reach[s][c] |= closed

    first = nfa.closed([start])
    number, rows, todo = {first: 0}, [], [first]
    for states in todo:
        row = [0] * len(kinds)
        rest = states
        while rest:
            low = rest & -rest
            rest ^= low
            for c, target in enumerate(reach[low.bit_length() - 1]):
                row[c] |= target
        for c, target in enumerate(row):
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row[c] = number[target]
        rows.append(row)
    finals = np.array([sum(1 << i for i, e in enumerate(ends) if states >> e & 1) for states in todo], np.int64)
    return _numbered(*_minimised(np.array(rows), finals), classes)


def _after(nfa: _Nfa, start: int) -> int:
    begin = nfa.state()
    nfa.free[start].append(begin)
    return begin


def _minimised(table: np.ndarray, finals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart; state 0 stays the start."""
    part = np.unique(finals, return_inverse=True)[1]
    while True:
        seen = np.column_stack([part, part[table]])
        finer = np.unique(seen, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    first = np.unique(part, return_index=True)[1]
    return part[table[first]], finals[first], part[0]


def _numbered(table: np.ndarray, finals: np.ndarray, start: int, classes: np.ndarray) -> Automaton:
    """Start first, then the other states, those that recognise something last."""
    others = [s for s in np.argsort(finals > 0, kind="stable") if s != start]
    order = np.array([start, *others])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table, finals = place[table[order]], finals[order]
    stuck = [s for s in range(len(table)) if not finals[s] and (table[s] == s).all()]
    plain = int(np.argmax(finals > 0)) if finals.any() else len(finals)
    return Automaton(np.ascontiguousarray(table), classes, finals, plain, stuck[0] if stuck else -1)
