"""Regular expressions over bytes compiled to one minimal deterministic automaton.

The subset of patterns: literals, classes, alternatives, groups and repeats, without
anchors, look-around or back-references. Patterns are ASCII.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_parse = re._parser.parse


class _Nfa:
    """Thompson construction; a state has byte edges (a set) or empty edges."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def add(self, items: Sequence, start: int, backwards: bool) -> int:
        """Append the parsed ``items`` after ``start``; the end state is returned."""
        for op, arg in reversed(list(items)) if backwards else items:
            start = self._one(str(op), arg, start, backwards)
        return start

    def _one(self, op: str, arg, start: int, backwards: bool) -> int:
        if op in ("LITERAL", "IN", "NOT_LITERAL", "ANY"):
            end = self.state()
            self.edges[start].append((_bytes(op, arg), end))
            return end
        if op == "SUBPATTERN":
            return self.add(arg[-1], start, backwards)
        if op == "BRANCH":
            end = self.state()
            for branch in arg[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(branch, first, backwards)].append(end)
            return end
        if op == "MAX_REPEAT":
            least, most, items = arg
            for _ in range(least):
                start = self.add(items, start, backwards)
            if str(most) == "MAXREPEAT":
                first, end = self.state(), self.state()
                self.empty[start] += [first, end]
                self.empty[self.add(items, first, backwards)] += [first, end]
                return end
            end = self.state()
            for _ in range(most - least):
                self.empty[start].append(end)
                start = self.add(items, start, backwards)
            self.empty[start].append(end)
            return end
        raise ValueError(f"pattern part not supported: {op}")


def _bytes(op: str, arg) -> frozenset[int]:
    if op == "LITERAL":
        return frozenset((arg,))
    if op == "NOT_LITERAL":
        return frozenset(range(128)) - {arg}
    if op == "ANY":
        return frozenset(range(128)) - {10}
    chosen: set[int] = set()
    negated = False
    for kind, value in arg:
        if str(kind) == "NEGATE":
            negated = True
        elif str(kind) == "LITERAL":
            chosen.add(value)
        elif str(kind) == "RANGE":
            chosen.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"class part not supported: {kind}")
    return frozenset(range(128)) - chosen if negated else frozenset(chosen)


@dataclass
class Dfa:
    """``table[state * classes + class_of[byte]]`` is the next state.

    States from ``first_accepting`` on accept; ``accepts[state]`` has one bit a rule.
    """

    class_of: np.ndarray
    classes: int
    table: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    start: int
    dead: int

    def resets(self) -> np.ndarray:
        """Bytes after which every state is the start state."""
        rows = self.table.reshape(-1, self.classes)
        return (rows == self.start).all(axis=0)[self.class_of]


def compile_rules(patterns: Sequence[str], *, search: bool, backwards: bool = False) -> Dfa:
    """One automaton for all ``patterns``.

    ``search``: a match may begin at any byte. ``backwards``: it reads matches from
    their last byte to their first.
    """
    nfa = _Nfa()
    root = nfa.state()
    finals: dict[int, int] = {}
    for k, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[root].append(first)
        finals[nfa.add(_parse(pattern), first, backwards)] = 1 << k
    class_of, samples = _byte_classes(nfa)

    def closure(states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in nfa.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(s for s in seen if nfa.edges[s] or s in finals)

    begin = closure(frozenset((root,)))
    number = {begin: 0}
    order = [begin]
    rows: list[list[int]] = []
    for current in order:
        edges = [e for s in current for e in nfa.edges[s]]
        row = []
        for byte in samples:
            reached = frozenset(t for chosen, t in edges if byte in chosen)
            following = closure(reached) | begin if search else closure(reached)
            if following not in number:
                number[following] = len(order)
                order.append(following)
            row.append(number[following])
        rows.append(row)
    accepts = np.array([sum(finals.get(s, 0) for s in states) for states in order])
    return _minimal(np.array(rows), accepts, class_of, number.get(frozenset(), -1))


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no edge tells apart share a class; one sample of each."""
    sets = list({chosen for edges in nfa.edges for chosen, _ in edges})
    seen: dict[tuple[bool, ...], int] = {}
    class_of = np.zeros(256, np.int64)
    samples: list[int] = []
    for byte in range(256):
        kind = tuple(byte in chosen for chosen in sets)
        if kind not in seen:
            seen[kind] = len(samples)
            samples.append(byte)
        class_of[byte] = seen[kind]
    return class_of, samples


def _minimal(rows: np.ndarray, accepts: np.ndarray, class_of: np.ndarray, dead: int) -> Dfa:
    """Merge states by refining the partition until successors agree."""
    _, block = np.unique(accepts, return_inverse=True)
    count = block.max() + 1
    while True:
        keys = np.column_stack((block, block[rows]))
        _, block = np.unique(keys, axis=0, return_inverse=True)
        block = block.reshape(-1)
        if block.max() + 1 == count:
            break
        count = block.max() + 1
    _, sample = np.unique(block, return_index=True)
    order = np.argsort(accepts[sample] != 0, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    sample = sample[order]
    accepted = accepts[sample]
    return Dfa(
        class_of=class_of,
        classes=rows.shape[1],
        table=place[block[rows[sample]]].astype(np.int32).reshape(-1),
        accepts=accepted,
        first_accepting=int((accepted == 0).sum()),
        start=int(place[block[0]]),
        dead=int(place[block[dead]]) if dead >= 0 else -1,
    )


def scan(dfa: Dfa, data: np.ndarray, lanes: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(position of a match's last byte, accepted rules) over ``data``, in order.

    Lanes begin after bytes that put every state back to the start, so that cutting
    changes nothing; all lanes advance one byte a step.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kinds = dfa.class_of.astype(np.int32)[data]
    safe = np.flatnonzero(dfa.resets()[data]) + 1
    wanted = np.linspace(0, n, lanes, endpoint=False).astype(np.int64)[1:]
    at = np.searchsorted(safe, wanted)
    starts = np.unique(np.concatenate(([0], safe[at[at < len(safe)]])))
    starts = starts[starts < n]
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    live = len(starts) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    state = np.full(len(starts), dfa.start, np.int32)
    places, rules = [], []
    for step, alive in enumerate(live.tolist()):
        state = state[:alive]
        position = starts[:alive] + step
        state = dfa.table[state * dfa.classes + kinds[position]]
        hit = state >= dfa.first_accepting
        if hit.any():
            places.append(position[hit])
            rules.append(dfa.accepts[state[hit]])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, rule = np.concatenate(places), np.concatenate(rules)
    by = np.argsort(place, kind="stable")
    return place[by], rule[by]


def farthest_start(dfa: Dfa, data: bytes, last: int, floor: int) -> int:
    """First byte of the longest match of a backwards automaton that ends at ``last``.

    Bytes before ``floor`` are not read; -1 where nothing matches.
    """
    state, found = dfa.start, -1
    table, classes, kind = dfa.table, dfa.classes, dfa.class_of
    for at in range(last, floor - 1, -1):
        state = int(table[state * classes + kind[data[at]]])
        if state == dfa.dead:
            break
        if state >= dfa.first_accepting:
            found = at
    return found
