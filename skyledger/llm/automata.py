"""Finite automata over bytes: rule expressions to minimal deterministic transition arrays.

An expression has literals, classes, groups, `|`, `?`, `*`, `+`, `{n}` and `{n,}`. Several
expressions become one automaton whose states carry the set of rules that accept there.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np

ALL_BYTES = frozenset(range(256))


class _Reader:
    """Reads one expression into nested tuples: set, cat, alt, rep."""

    def __init__(self, text: str, any_case: bool):
        self.text, self.at, self.any_case = text, 0, any_case

    def more(self, stop: str = "") -> bool:
        return self.at < len(self.text) and self.text[self.at] not in stop

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def symbol(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def cased(self, symbols: set[int]) -> tuple:
        if self.any_case:
            symbols = symbols | {ord(f) for s in symbols if chr(s).isalpha() for f in (chr(s).lower(), chr(s).upper())}
        return ("set", frozenset(symbols))

    def one_of(self) -> tuple:
        symbols: set[int] = set()
        inverse = self.text[self.at] == "^"
        self.at += inverse
        while self.more("]"):
            low = high = self.symbol()
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self.symbol()
            symbols |= set(range(low, high + 1))
        self.at += 1
        return ("set", ALL_BYTES - symbols) if inverse else self.cased(symbols)

    def alternatives(self) -> tuple:
        ways = [self.sequence()]
        while self.more() and self.text[self.at] == "|":
            self.at += 1
            ways.append(self.sequence())
        return ways[0] if len(ways) == 1 else ("alt", ways)

    def sequence(self) -> tuple:
        parts = []
        while self.more("|)"):
            if self.text[self.at] == "(":
                self.at += 1
                part = self.alternatives()
                self.at += 1
            elif self.text[self.at] == "[":
                self.at += 1
                part = self.one_of()
            else:
                part = self.cased({self.symbol()})
            while self.more() and self.text[self.at] in "?*+{":
                part = self.repeated(part)
            parts.append(part)
        return ("cat", parts)

    def repeated(self, part: tuple) -> tuple:
        mark = self.take()
        if mark != "{":
            return ("rep", part, int(mark == "+"), 1 if mark == "?" else None)
        body = self.text[self.at : self.text.index("}", self.at)]
        self.at += len(body) + 1
        low, comma, high = body.partition(",")
        return ("rep", part, int(low), int(high or low) if high or not comma else None)


def parse(expression: str, any_case: bool = False) -> tuple:
    return _Reader(expression, any_case).alternatives()


def backwards(node: tuple) -> tuple:
    """The expression of the mirrored words."""
    if node[0] == "set":
        return node
    if node[0] == "rep":
        return ("rep", backwards(node[1]), *node[2:])
    parts = [backwards(x) for x in node[1]]
    return ("cat", parts[::-1]) if node[0] == "cat" else ("alt", parts)


class _Graph:
    """A nondeterministic automaton: edges on byte sets and free moves."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def node(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def build(self, tree: tuple, start: int) -> int:
        """Adds the tree behind `start`; its end."""
        kind = tree[0]
        if kind == "set":
            end = self.node()
            self.edges[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.node()
            for way in tree[1]:
                self.free[self.build(way, start)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.build(part, start)
        if high is None:
            loop = self.node()
            self.free[start].append(loop)
            self.free[self.build(part, loop)].append(loop)
            return loop
        for _ in range(high - low):
            end = self.build(part, start)
            self.free[start].append(end)
            start = end
        return start

    def closure(self, nodes: set[int]) -> frozenset[int]:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


@dataclass
class Automaton:
    """State 0 is the start. `moves[state * n_classes + class_of[byte]]`; `rules[state]` is a bit set.

    States that accept have the highest numbers, from `accepting` on. `dead` is -1 or the
    state that nothing leaves.
    """

    class_of: np.ndarray
    moves: np.ndarray
    rules: np.ndarray
    n_classes: int
    accepting: int
    dead: int

    def longest(self, data: bytes, start: int, stop: int) -> int:
        """End of the longest match that begins at `start`; -1 if there is none."""
        state, end = 0, -1
        moves, classes, n = self._lists()
        for i in range(start, stop):
            state = moves[state * n + classes[data[i]]]
            if state == self.dead:
                break
            if state >= self.accepting:
                end = i + 1
        return end

    def _lists(self) -> tuple[list[int], list[int], int]:
        if not hasattr(self, "_plain"):
            self._plain = self.moves.tolist(), self.class_of.tolist(), self.n_classes
        return self._plain


def compile_rules(trees: list[tuple], anywhere: bool) -> Automaton:
    """Subset construction over all rules at once, then minimisation.

    anywhere: a match may begin at each byte, not only at the first.
    """
    graph = _Graph()
    root = graph.node()
    if anywhere:
        graph.edges[root].append((ALL_BYTES, root))
    ends = [graph.build(tree, root) for tree in trees]
    # Bytes that no edge tells apart are one class.
    sets = list({s for edges in graph.edges for s, _ in edges})
    kinds: dict[tuple, int] = {}
    class_of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)
    sample = [int(np.flatnonzero(class_of == c)[0]) for c in range(len(kinds))]
    names: dict[frozenset, int] = {}
    todo = [graph.closure({root})]
    names[todo[0]] = 0
    table: list[list[int]] = []
    for nodes in todo:
        row = []
        for byte in sample:
            after = graph.closure({to for x in nodes for s, to in graph.edges[x] if byte in s})
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            row.append(names[after])
        table.append(row)
    moves = np.array(table)
    rules = np.array([sum(1 << k for k, end in enumerate(ends) if end in nodes) for nodes in todo])
    return _minimal(class_of, moves, rules)


def _minimal(class_of: np.ndarray, moves: np.ndarray, rules: np.ndarray) -> Automaton:
    """Merges states that no input tells apart, by refining the partition until it stands."""
    block = np.unique(rules, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    members: dict[int, int] = {}
    for state, b in enumerate(block.tolist()):
        members.setdefault(b, state)
    # The start first, accepting states last.
    order = sorted(members, key=lambda b: (rules[members[b]] > 0, members[b]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    chosen = [members[b] for b in order]
    small = place[block[moves[chosen]]]
    accepts = rules[chosen]
    loops = np.flatnonzero((small == np.arange(len(small))[:, None]).all(axis=1) & (accepts == 0))
    return Automaton(
        class_of,
        small.ravel().astype(np.int32),
        accepts.astype(np.int64),
        small.shape[1],
        int((accepts == 0).sum()),
        int(loops[0]) if len(loops) and loops[0] else -1,
    )


def scan_back(machine: Automaton, data: np.ndarray, piece: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """One pass over all bytes from right to left: places whose state accepts, and the rules there.

    Many pieces of the array advance in step. They are cut in front of bytes that lead every
    state back to the start, so a piece needs nothing of its neighbours; without such a byte a
    piece just gets longer.
    """
    n = machine.n_classes
    table = machine.moves.reshape(-1, n)
    resets = (table == 0).all(axis=0)
    classes = machine.class_of[data]
    free = np.flatnonzero(resets[classes])
    wanted = np.searchsorted(free, np.arange(piece, len(data), piece))
    cuts = np.unique(free[wanted[wanted < len(free)]])
    starts = np.concatenate([[0], cuts]).astype(np.int64)
    ends = np.concatenate([cuts, [len(data)]]).astype(np.int64)
    order = np.argsort(starts - ends, kind="stable")
    lengths, at = (ends - starts)[order], ends[order] - 1
    longest = int(lengths[0]) if len(data) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    state = np.zeros(len(lengths), np.int32)
    moves = machine.moves
    places, found = [], []
    for step in range(longest):
        k = active[step]
        here = at[:k] - step
        now = moves[state[:k] * n + classes[here]]
        state[:k] = now
        if now.max(initial=0) >= machine.accepting:
            hit = np.flatnonzero(now >= machine.accepting)
            places.append(here[hit])
            found.append(machine.rules[now[hit]])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, rule = np.concatenate(places), np.concatenate(found)
    order = np.argsort(place)
    return place[order], rule[order]


def by_rule(places: np.ndarray, rules: np.ndarray, count: int) -> dict[int, list[int]]:
    """Places of each rule, ascending."""
    out: dict[int, list[int]] = defaultdict(list)
    for k in range(count):
        out[k] = places[(rules >> k) & 1 == 1].tolist()
    return out
