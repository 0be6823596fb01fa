"""Deterministic automata over bytes for sets of rules.

Rules are regular expressions of literals, escapes, byte sets, groups,
``(?i:...)`` (ASCII letters in either case), ``|``, ``?``, ``*``, ``+`` and
``{m,n}``. All rules become one automaton by subset construction, which is then
minimised and kept as one transition array over byte classes.

A long run of bytes is scanned in lanes side by side: each lane is begun in the
start state, and lanes whose predecessor ends in another state are gone through
again until they meet the states already known. The result is that of one pass
from left to right.
"""

from __future__ import annotations

import numpy as np

#: A byte that is in no UTF-8 text and in no set: it brings every automaton back to its start.
SEPARATOR = 0xFF
#: Lanes of a scan, and the least bytes of one.
LANES, LANE_BYTES = 4096, 128
#: States of an automaton before minimisation; a set of rules that needs more is refused.
MOST_STATES = 60_000

_ALL = (1 << SEPARATOR) - 1  # all bytes but the separator, as a bit set


class _Parser:
    """Turns a rule into a tree of ("set", bits), ("cat", parts), ("alt", parts) and ("rep", part, least, most)."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def _next(self) -> str:
        return self.text[self.at : self.at + 1]

    def _take(self, expected: str | None = None) -> str:
        c = self._next()
        if not c or (expected is not None and c != expected):
            raise ValueError(f"rule {self.text!r}: {expected or 'a character'} expected at {self.at}")
        self.at += 1
        return c

    def parse(self) -> tuple:
        tree = self._alternatives(False)
        if self.at != len(self.text):
            raise ValueError(f"rule {self.text!r}: unexpected {self._next()!r} at {self.at}")
        return tree

    def _alternatives(self, fold: bool) -> tuple:
        parts = [self._sequence(fold)]
        while self._next() == "|":
            self._take()
            parts.append(self._sequence(fold))
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self, fold: bool) -> tuple:
        parts = []
        while self._next() not in ("", "|", ")"):
            parts.append(self._repeated(fold))
        return ("cat", parts)

    def _repeated(self, fold: bool) -> tuple:
        tree = self._atom(fold)
        while self._next() and self._next() in "?*+{":
            sign = self._take()
            if sign == "{":
                low = self._number()
                high = low
                if self._next() == ",":
                    self._take()
                    high = self._number() if self._next() != "}" else None
                self._take("}")
                if high is not None and high < low:
                    raise ValueError(f"rule {self.text!r}: counts out of order")
            else:
                low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            tree = ("rep", tree, low, high)
        return tree

    def _number(self) -> int:
        digits = ""
        while self._next().isdigit():
            digits += self._take()
        return int(digits or self._take("0"))

    def _atom(self, fold: bool) -> tuple:
        c = self._take()
        if c == "(":
            if self.text.startswith("?i:", self.at):
                self.at, fold = self.at + 3, True
            tree = self._alternatives(fold)
            self._take(")")
            return tree
        if c == "[":
            return ("set", self._set(fold))
        if c in "?*+{}])":
            raise ValueError(f"rule {self.text!r}: unexpected {c!r} at {self.at - 1}")
        if c == ".":
            return ("set", _ALL)
        return ("set", self._fold(1 << (self._escape() if c == "\\" else self._code(c)), fold))

    def _code(self, c: str) -> int:
        if ord(c) >= 0x80:
            raise ValueError(f"rule {self.text!r}: {c!r} is not ASCII")
        return ord(c)

    def _escape(self) -> int:
        c = self._take()
        if c == "x":
            code = int(self._take() + self._take(), 16)
            if code == SEPARATOR:
                raise ValueError(f"rule {self.text!r}: byte {code} separates texts")
            return code
        if c.isalnum():
            raise ValueError(f"rule {self.text!r}: unknown escape \\{c}")
        return self._code(c)

    def _set(self, fold: bool) -> int:
        negated = self._next() == "^"
        if negated:
            self._take()
        bits, first = 0, True
        while first or self._next() != "]":
            first = False
            low = high = self._element()
            if self._next() == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", ""):
                self._take()
                high = self._element()
            for code in range(low, high + 1):
                bits |= 1 << code
        self._take("]")
        bits = self._fold(bits, fold)
        return _ALL & ~bits if negated else bits

    def _element(self) -> int:
        c = self._take()
        return self._escape() if c == "\\" else self._code(c)

    @staticmethod
    def _fold(bits: int, fold: bool) -> int:
        if fold:
            for code in range(65, 91):
                if bits >> code & 1 or bits >> (code + 32) & 1:
                    bits |= 1 << code | 1 << (code + 32)
        return bits


def _reversed(tree: tuple) -> tuple:
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reversed(t) for t in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reversed(t) for t in tree[1]])
    if kind == "rep":
        return ("rep", _reversed(tree[1]), *tree[2:])
    return tree


class _Nfa:
    """States with empty moves and moves by a set of bytes."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.move: list[tuple[int, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.move.append(None)
        return len(self.empty) - 1

    def add(self, tree: tuple, begin: int) -> int:
        """Adds what ``tree`` matches after ``begin``; its last state."""
        kind = tree[0]
        if kind == "set":
            source, end = self.state(), self.state()
            self.empty[begin].append(source)
            self.move[source] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                begin = self.add(part, begin)
            return begin
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                self.empty[self.add(part, begin)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            begin = self.add(part, begin)
        end = self.state()
        if high is None:
            again = self.state()
            self.empty[begin].append(again)
            self.empty[self.add(part, again)].append(again)
            self.empty[again].append(end)
        else:
            for _ in range(high - low):
                self.empty[begin].append(end)
                begin = self.add(part, begin)
            self.empty[begin].append(end)
        return end

    def closures(self) -> list[int]:
        """Per state the states reached by empty moves, as a bit set."""
        out = []
        for s in range(len(self.empty)):
            seen, stack = {s}, [s]
            while stack:
                for t in self.empty[stack.pop()]:
                    if t not in seen:
                        seen.add(t)
                        stack.append(t)
            out.append(sum(1 << t for t in seen))
        return out


def _bits(x: int) -> list[int]:
    out = []
    while x:
        low = x & -x
        out.append(low.bit_length() - 1)
        x ^= low
    return out


class Automaton:
    """The minimal automaton of some rules.

    ``anywhere``: a match may begin at any byte; else at the first one only.
    ``backwards``: for bytes in reverse order. A state is given as its row's
    place in ``table``; ``accepts[state]`` has bit r if a match of rule r ends
    there, and in ``dead`` (None if there is none) no match can end any more.
    """

    def __init__(self, patterns: list[str], anywhere: bool, backwards: bool = False):
        if len(patterns) > 62:
            raise ValueError("at most 62 rules")
        nfa = _Nfa()
        begin, ends = nfa.state(), []
        for pattern in patterns:
            tree = _Parser(pattern).parse()
            ends.append(nfa.add(_reversed(tree) if backwards else tree, begin))
        closures = nfa.closures()
        sets = sorted({m[0] for m in nfa.move if m})
        signs = [tuple(s >> byte & 1 for s in sets) for byte in range(256)]
        kinds = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
        self.classes = np.array([kinds[s] for s in signs], np.uint8)
        self.width = len(kinds)
        members = {s: [kinds[sign] for sign in kinds if sign[i]] for i, s in enumerate(sets)}
        moves = {s: (members[m[0]], closures[m[1]]) for s, m in enumerate(nfa.move) if m}
        moving, first = sum(1 << s for s in moves), closures[begin]
        known, todo, rows = {first: 0}, [first], []
        while len(rows) < len(todo):
            row = [first if anywhere else 0] * self.width
            for s in _bits(todo[len(rows)] & moving):
                where, after = moves[s]
                for c in where:
                    row[c] |= after
            for after in row:
                if after not in known:
                    known[after] = len(todo)
                    todo.append(after)
            if len(todo) > MOST_STATES:
                raise ValueError(f"these rules need more than {MOST_STATES} states")
            rows.append([known[after] for after in row])
        accepts = np.array([sum(1 << r for r, e in enumerate(ends) if s >> e & 1) for s in todo], np.int64)
        if accepts[0]:
            raise ValueError("a rule matches the empty text")
        self._minimise(np.array(rows, np.int64), accepts)
        self._lists = None

    def _minimise(self, rows: np.ndarray, accepts: np.ndarray) -> None:
        """Splits states by what they accept, then by the groups of their successors, until nothing splits."""
        _, group = np.unique(accepts, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([group, group[rows]]), axis=0, return_inverse=True)
            if finer.max() == group.max():
                break
            group = finer
        _, one = np.unique(group, return_index=True)
        order = np.argsort(one, kind="stable")  # states in the order they were found, so the start is the first
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        table = number[group[rows[one[order]]]]
        self.states = len(table)
        self.table = (table * self.width).ravel()
        self.accepts = np.zeros(self.states * self.width, np.int64)
        self.accepts[:: self.width] = accepts[one[order]]
        stuck = np.flatnonzero((table == np.arange(self.states)[:, None]).all(axis=1) & (accepts[one[order]] == 0))
        self.dead = int(stuck[0]) * self.width if len(stuck) else None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lists": None}

    def lists(self) -> tuple[list[int], list[int], list[int]]:
        """Byte classes, transitions and accepted rules as lists, for going byte by byte."""
        if self._lists is None:
            self._lists = self.classes.tolist(), self.table.tolist(), self.accepts.tolist()
        return self._lists

    def scan(self, data: np.ndarray) -> np.ndarray:
        """The rules of which a match ends with each byte, as bits; the scan begins in the start state."""
        n = len(data)
        lanes = max(1, min(LANES, n // LANE_BYTES))
        steps = -(-n // lanes)
        code = np.full(lanes * steps, self.classes[SEPARATOR], np.uint8)
        code[:n] = self.classes[data]
        code = np.ascontiguousarray(code.reshape(lanes, steps).T)
        after = np.empty((steps, lanes), np.int32)
        state = np.zeros(lanes, np.int64)
        for j in range(steps):
            state = self.table.take(state + code[j])
            after[j] = state
        if steps:
            self._join_lanes(code, after)
        found = self.accepts.take(after)
        return found.T.ravel()[:n]

    def _join_lanes(self, code: np.ndarray, after: np.ndarray) -> None:
        """Goes through lanes again that do not begin in the state the lane before them ends in."""
        steps, lanes = after.shape
        assumed = np.zeros(lanes, np.int64)
        while True:
            true = np.zeros(lanes, np.int64)
            true[1:] = after[-1, :-1]
            lane = np.flatnonzero(true != assumed)
            if not len(lane):
                return
            if len(lane) < 16:
                break
            assumed[lane] = true[lane]
            state = true[lane]
            for j in range(steps):
                state = self.table.take(state + code[j, lane])
                differs = state != after[j, lane]
                lane, state = lane[differs], state[differs]
                if not len(lane):
                    break
                after[j, lane] = state
        _, table, _ = self.lists()
        for i in range(int(lane[0]), lanes):  # few are left: one after the other
            state = int(after[-1, i - 1])
            if state == assumed[i]:
                continue
            for j, (c, was) in enumerate(zip(code[:, i].tolist(), after[:, i].tolist())):
                state = table[state + c]
                if state == was:
                    break
                after[j, i] = state

    def longest(self, data: bytes, begin: int, rule: int) -> tuple[int, int]:
        """End of the longest match of ``rule`` that begins at ``begin`` (-1 if none), and all rules with a match of that end, as bits."""
        classes, table, accepts = self.lists()
        state, end, held, bit = 0, -1, 0, 1 << rule
        for at in range(begin, len(data)):
            state = table[state + classes[data[at]]]
            if state == self.dead:
                break
            if accepts[state] & bit:
                end, held = at + 1, accepts[state]
        return end, held
