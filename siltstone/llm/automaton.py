"""Regular expressions over bytes to minimal deterministic automata, as transition arrays.

The expressions know literals, ``\\xHH`` and ``\\.`` escapes, classes, groups, ``|`` and the repeats
``? * + {m} {m,n}``. Thompson's construction makes the nondeterministic automaton, the subset
construction the deterministic one over classes of bytes that no rule tells apart, and refinement
of partitions the minimal one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Net:
    """Nondeterministic automaton: per state, free steps and steps on sets of bytes."""

    free: list[list[int]] = field(default_factory=list)
    steps: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1


class _Parser:
    """Recursive descent to a tree of ``("set", bytes)``, ``("cat", ..)``, ``("or", ..)``, ``("rep", node, m, n)``."""

    def __init__(self, text: str, any_case: bool) -> None:
        self.text, self.at, self.any_case = text, 0, any_case

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def union(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            node = self.atom()
            while self.peek() and self.peek() in "?*+{":
                sign = self.take()
                if sign == "{":
                    end = self.text.index("}", self.at)
                    low, _, high = self.text[self.at : end].partition(",")
                    self.at = end + 1
                    node = ("rep", node, int(low), int(high or low))
                else:
                    node = ("rep", node, int(sign == "+"), 1 if sign == "?" else None)
            parts.append(node)
        return ("cat", parts)

    def atom(self):
        if self.peek() == "(":
            self.take()
            node = self.union()
            self.take()
            return node
        if self.peek() == "[":
            self.take()
            members: set[int] = set()
            while self.peek() != "]":
                low = self.byte()
                if self.peek() == "-" and self.text[self.at + 1] != "]":
                    self.take()
                    members.update(range(low, self.byte() + 1))
                else:
                    members.add(low)
            self.take()
        else:
            members = {self.byte()}
        if self.any_case:
            members |= {ord(chr(b).swapcase()) for b in members if chr(b).isalpha()}
        return ("set", frozenset(members))

    def byte(self) -> int:
        char = self.take()
        if char != "\\":
            return ord(char)
        char = self.take()
        if char == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(char)


def parse(text: str, any_case: bool = False):
    return _Parser(text, any_case).union()


def reverse(node):
    """The tree of the same texts read from their end."""
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", reverse(node[1]), *node[2:])
    return (kind, [reverse(part) for part in (node[1][::-1] if kind == "cat" else node[1])])


def _build(net: _Net, node, start: int) -> int:
    kind = node[0]
    if kind == "set":
        end = net.state()
        net.steps[start].append((node[1], end))
        return end
    if kind == "cat":
        for part in node[1]:
            start = _build(net, part, start)
        return start
    if kind == "or":
        end = net.state()
        for part in node[1]:
            begin = net.state()
            net.free[start].append(begin)
            net.free[_build(net, part, begin)].append(end)
        return end
    _, part, low, high = node
    for _ in range(low):
        start = _build(net, part, start)
    if high is None:
        loop = net.state()
        net.free[start].append(loop)
        net.free[_build(net, part, loop)].append(loop)
        return loop
    end = net.state()
    net.free[start].append(end)
    for _ in range(high - low):
        start = _build(net, part, start)
        net.free[start].append(end)
    return end


@dataclass(frozen=True)
class Automaton:
    """``table[state * classes + byte_class]``; states from ``accepting`` on accept, 0 starts."""

    table: np.ndarray
    byte_class: np.ndarray
    classes: int
    accepting: int
    dead: int  #: the state nothing leads out of, or -1
    rules: tuple[tuple[int, ...], ...]  #: of each accepting state, the numbers of the rules it ends
    steps: list[int] = field(repr=False)  #: the table once more, for single steps

    def longest(self, data: bytes, start: int) -> int:
        """Where the longest match from ``start`` ends, or -1."""
        steps, classes, dead, accepting = self.steps, self.classes, self.dead, self.accepting
        of_byte = self.byte_class.tobytes()
        state, end = 0, -1
        for at in range(start, len(data)):
            state = steps[state * classes + of_byte[data[at]]]
            if state == dead:
                break
            if state >= accepting:
                end = at + 1
        return end

    def resetting(self) -> np.ndarray:
        """Which bytes lead from every state to the start."""
        back = (self.table.reshape(-1, self.classes) == 0).all(0)
        return back[self.byte_class]


def compile_rules(trees: list, anywhere: bool) -> Automaton:
    """One minimal automaton for all ``trees``; ``anywhere`` lets a match start at every byte.

    Accepting states that end different rules stay apart.
    """
    net = _Net()
    first = net.state()
    ends: dict[int, int] = {}
    for rule, tree in enumerate(trees):
        begin = net.state()
        net.free[first].append(begin)
        ends[_build(net, tree, begin)] = rule
    sets = list({s for steps in net.steps for s, _ in steps})
    of_byte = np.array([[b in s for s in sets] for b in range(256)])
    kinds, byte_class = np.unique(of_byte, axis=0, return_inverse=True)
    byte_class = byte_class.ravel().astype(np.uint8)
    member = {s: np.flatnonzero(kinds[:, i]) for i, s in enumerate(sets)}

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in net.free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(s for s in seen if net.steps[s] or s in ends)

    start = closure({first})
    number, rows, todo = {start: 0}, [], [start]
    while todo:
        grown = []
        for subset in todo:
            moves: list[set[int]] = [set(start) if anywhere else set() for _ in range(len(kinds))]
            for s in subset:
                for byte_set, target in net.steps[s]:
                    for c in member[byte_set]:
                        moves[c].add(target)
            row = []
            for move in moves:
                to = closure(move)
                if to not in number:
                    number[to] = len(number)
                    grown.append(to)
                row.append(number[to])
            rows.append(row)
        todo = grown
    table = np.array(rows)
    told = [tuple(sorted(ends[s] for s in subset & ends.keys())) for subset in number]
    accepts = np.array([bool(rules) for rules in told])
    labels = {rules: i for i, rules in enumerate(sorted(set(told) | {()}))}
    part = np.array([labels[rules] for rules in told])
    while True:
        finer = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].ravel()
        if len(np.unique(finer)) == len(np.unique(part)):
            part = finer
            break
        part = finer
    head = np.unique(part, return_index=True)[1]  # one state of every part
    order = np.lexsort((part[head] != part[0], accepts[head]))  # the start first, accepting ones last
    place = np.empty(len(head), int)
    place[order] = np.arange(len(head))
    small = place[part[table[head[order]]]].astype(np.int32)
    accepting = int((~accepts[head]).sum())
    stuck = np.flatnonzero((small == np.arange(len(small))[:, None]).all(1) & (np.arange(len(small)) < accepting))
    rules = tuple(told[head[at]] for at in order[accepting:])
    return Automaton(small.ravel(), byte_class, len(kinds), accepting, int(stuck[0]) if len(stuck) else -1, rules, small.ravel().tolist())
