"""Regular expressions compiled into one deterministic automaton over bytes.

Subset of the usual syntax: literals, escapes, classes, groups, ``|``, ``?``,
``*``, ``+``, ``{n}``, ``{n,}``, ``{n,m}``.  Matches must not be empty.

A rule begins with a prefix of fixed length (or a few of them), so that a state knows
where a match began when the prefix is complete.  Rules are made deterministic by
subset construction, combined by their reachable products, and minimised.  One pass
over the bytes then gives every rule's leftmost longest matches that don't overlap:
while a rule accepts, its prefixes don't begin anew.
"""

from __future__ import annotations

from functools import reduce
from operator import getitem

import numpy as np

_ALL = frozenset(range(256))


class _Parser:
    def __init__(self, pattern: str, any_case: bool) -> None:
        self.p, self.i, self.any_case = pattern, 0, any_case

    def parse(self) -> tuple:
        node = self.either()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} in {self.p!r}")
        return node

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def either(self) -> tuple:
        options = [self.row()]
        while self.peek() == "|":
            self.i += 1
            options.append(self.row())
        return ("alt", options) if len(options) > 1 else options[0]

    def row(self) -> tuple:
        items = []
        while self.peek() and self.peek() not in "|)":
            items.append(self.repeated())
        return ("cat", items)

    def repeated(self) -> tuple:
        node = self.single()
        while (c := self.peek()) and c in "?*+{":
            self.i += 1
            if c == "{":
                end = self.p.index("}", self.i)
                lo, _, hi = self.p[self.i : end].partition(",")
                top = int(hi) if hi else None if "," in self.p[self.i : end] else int(lo)
                node, self.i = ("rep", node, int(lo), top), end + 1
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def single(self) -> tuple:
        c = self.p[self.i]
        if c == "(":
            self.i += 3 if self.p.startswith("(?:", self.i) else 1
            node = self.either()
            if self.peek() != ")":
                raise ValueError(f"open group in {self.p!r}")
            self.i += 1
            return node
        if c == "[":
            return ("set", self.klass())
        return ("set", self.cased({self.char()}))

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c != "\\":
            if ord(c) > 127:
                raise ValueError("patterns are ASCII")
            return ord(c)
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        if c.isalnum():
            raise ValueError(f"escape {c!r} isn't supported")
        return ord(c)

    def klass(self) -> frozenset:
        self.i += 1
        negated = self.peek() == "^"
        self.i += negated
        out: set[int] = set()
        while self.peek() != "]" or not out:
            lo = self.char()
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                out |= set(range(lo, self.char() + 1))
            else:
                out.add(lo)
        self.i += 1
        found = self.cased(out)
        return _ALL - found if negated else found

    def cased(self, chars: set[int]) -> frozenset:
        if self.any_case:
            chars = chars | {c ^ 32 for c in chars if chr(c).isascii() and chr(c).isalpha()}
        return frozenset(chars)


#: Prefixes of one rule, and states of the combined automaton, at most.
MOST_PREFIXES, MOST_STATES = 64, 200_000


def _expand(node: tuple) -> list[list[frozenset]] | None:
    """All sequences of sets that a node stands for, or None if they are too many."""
    if node[0] == "set":
        return [[node[1]]]
    if node[0] == "alt":
        parts = [_expand(x) for x in node[1]]
        out = None if None in parts else [x for p in parts for x in p]
    elif node[0] == "cat":
        out = [[]]
        for x in node[1]:
            more = _expand(x)
            if more is None or len(out) * len(more) > MOST_PREFIXES:
                return None
            out = [o + m for o in out for m in more]
    else:
        _, inner, lo, hi = node
        more = _expand(inner)
        if hi is None or more is None or len(more) ** hi > MOST_PREFIXES:
            return None
        out, now = [], [[]]
        for n in range(hi + 1):
            out += now if n >= lo else []
            now = [o + m for o in now for m in more]
    return out if out and len(out) <= MOST_PREFIXES else None


def split(node: tuple, least: int) -> tuple[list[list[frozenset]], list[tuple]]:
    """(prefixes, rest) of a rule: leading parts of fixed length, at least one byte, and what follows them.

    A rule that is one run of a class takes ``least`` bytes of it as its prefix.
    """
    items = list(node[1]) if node[0] == "cat" else [node]
    if len(items) == 1 and items[0][0] == "rep" and items[0][1][0] == "set" and items[0][3] is None:
        n = max(1, items[0][2], least)
        return [[items[0][1][1]] * n], [("rep", items[0][1], 0, None)]
    prefixes: list[list[frozenset]] = [[]]
    while items and not (items[0][0] == "rep" and items[0][2] != items[0][3]):
        more = _expand(items[0])
        if more is None or [] in more or len(prefixes) * len(more) > MOST_PREFIXES:
            break
        prefixes = [p + m for p in prefixes for m in more]
        items.pop(0)
    if prefixes == [[]]:
        raise ValueError("a rule must begin with a prefix of fixed length")
    return prefixes, items


class _Rule:
    """Deterministic automaton of one rule that may begin at every byte: transitions, and for each state whether the rule
    accepts, whether it is beyond its prefix, and the length of the prefix with which a match has just begun (or 0)."""

    def __init__(self, prefixes: list[list[frozenset]], rest: list[tuple]) -> None:
        self.eps: list[list[int]] = []
        self.steps: list[tuple[frozenset, int] | None] = []
        end = self.new()
        entry = self.add(("cat", rest), end)
        self.inside = set(range(len(self.eps)))  # beyond the prefix
        after = self.after(end)
        marks: dict[int, int] = {}
        first = set()
        for p in prefixes:
            state = self.new()
            self.eps[state] = [entry]
            self.inside.add(state)
            marks[state] = len(p)
            for chars in reversed(p):
                before = self.new()
                self.steps[before] = (chars, state)
                state = before
            first.add(state)
        sets = sorted({s[0] for s in self.steps if s}, key=sorted)
        member = np.array([[b in s for b in range(256)] for s in sets])
        _, reps, klass = np.unique(member, axis=1, return_index=True, return_inverse=True)
        alone = [frozenset(first)]  # of a match by itself
        for state in alone:
            for b in reps.tolist():
                to = frozenset(self.move(state & after if end in state else state, b))
                if (end in to and not to <= after | marks.keys()) or (end in state and to and end not in to):
                    raise ValueError("a rule may go on beyond a match without matching")
                if to not in alone:
                    alone.append(to)
        # with each set of states: whether nothing that began before is left, so that a complete prefix is where a match begins
        states: dict[tuple[frozenset, bool], int] = {(frozenset(), True): 0}
        todo, table = [(frozenset(), True)], []
        for state, _ in todo:
            row = []
            for b in reps.tolist():
                older = self.move(state & (after if end in state else self.inside), b)
                to = older if end in state and older else self.move(first if end in state else state | first, b)
                if end in to:  # what began later is part of this match
                    to &= after | marks.keys()
                key = (frozenset(to), not older)
                if key not in states:
                    states[key] = len(states)
                    todo.append(key)
                row.append(states[key])
            table.append(row)
        self.trans = np.array(table, np.int32)[:, klass.ravel()]
        self.accepts = np.array([end in s for s, _ in states])
        self.begun = np.array([bool(s & self.inside) for s, _ in states])
        self.mark = np.array([max((marks[x] for x in s if x in marks and new), default=0) for s, new in states], np.int32)

    def new(self) -> int:
        self.eps.append([])
        self.steps.append(None)
        return len(self.eps) - 1

    def add(self, node: tuple, end: int) -> int:
        """Entry state of ``node`` when it goes on to ``end`` (Thompson construction)."""
        if node[0] == "set":
            s = self.new()
            self.steps[s] = (node[1], end)
            return s
        if node[0] == "cat":
            for x in reversed(node[1]):
                end = self.add(x, end)
            return end
        if node[0] == "alt":
            s = self.new()
            self.eps[s] = [self.add(x, end) for x in node[1]]
            return s
        _, inner, lo, hi = node
        if hi is None:
            loop = self.new()
            self.eps[loop] = [self.add(inner, loop), end]
            end = loop
        else:
            for _ in range(hi - lo):
                s = self.new()
                self.eps[s] = [self.add(inner, end), end]
                end = s
        for _ in range(lo):
            end = self.add(inner, end)
        return end

    def after(self, end: int) -> set[int]:
        """States in which a match may go on after it has been accepted."""
        seen = {end}
        size = 0
        while len(seen) != size:  # states from which the end is reached without a byte
            size = len(seen)
            seen |= {k for k, to in enumerate(self.eps) if seen & set(to)}
        todo = list(seen)
        while todo:
            s = todo.pop()
            for t in (*self.eps[s], *([self.steps[s][1]] if self.steps[s] else [])):
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def move(self, states: set[int] | frozenset, byte: int) -> set[int]:
        """States after one more byte, with all that are reached without a byte."""
        todo = [s[1] for x in states if (s := self.steps[x]) and byte in s[0]]
        seen = set(todo)
        while todo:
            for t in self.eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen


def combine(rules: list[_Rule]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal automaton of all rules at once: class of each byte, transitions (states x classes), and for each state a
    row of every rule's mark, accepts and begun.  State 0 is the start."""
    _, reps, klass = np.unique(np.concatenate([r.trans for r in rules]), axis=1, return_index=True, return_inverse=True)
    tables = [r.trans[:, reps] for r in rules]
    radix = np.concatenate([[1], np.cumprod([len(t) for t in tables], dtype=np.float64)])
    if radix[-1] > 2**62:
        raise ValueError("too many rules for one automaton")
    radix = radix[:-1].astype(np.int64)
    parts = lambda codes: [codes // n % len(t) for n, t in zip(radix, tables, strict=True)]
    known = np.zeros(1, np.int64)
    fresh = known
    while len(fresh):  # breadth first over products of states that occur together
        to = sum(t[p] * n for t, p, n in zip(tables, parts(fresh), radix, strict=True))
        fresh = np.setdiff1d(np.unique(to), known)
        known = np.union1d(known, fresh)
        if len(known) > MOST_STATES:
            raise ValueError(f"more than {MOST_STATES} states")
    each = parts(known)
    trans = np.searchsorted(known, sum(t[p] * n for t, p, n in zip(tables, each, radix, strict=True)))
    says = np.stack([x[p] for r, p in zip(rules, each, strict=True) for x in (r.mark, r.accepts, r.begun)], 1).astype(np.int32)
    _, group = np.unique(says, axis=0, return_inverse=True)
    n = 0
    while int(group.max()) + 1 != n:
        n = int(group.max()) + 1
        _, group = np.unique(np.column_stack([group.ravel(), group.ravel()[trans]]), axis=0, return_inverse=True)
    group = group.ravel()
    order = np.full(n, -1)  # the start is state 0
    order[group[0]] = 0
    order[[g for g in range(n) if g != group[0]]] = np.arange(1, n)
    member = np.zeros(n, np.int64)
    member[order[group]] = np.arange(len(group))
    return klass.ravel().astype(np.uint8), order[group[trans[member]]].astype(np.int32), says[member].reshape(n, len(rules), 3)


class _Stop(Exception):
    def __init__(self, state: int) -> None:
        self.state = state


class _Hit:
    """Stands for a state in which a rule is beyond its prefix, and ends the fast loop at the byte after it."""

    __slots__ = ("state",)

    def __init__(self, state: int) -> None:
        self.state = state

    def __getitem__(self, _: int) -> None:
        raise _Stop(self.state)


class Automaton:
    """All rules (pattern, either case, least bytes of a rule that is one run) in one automaton.

    A rule must go on to accept once it has begun to, until its match ends, and a
    match that began earlier must not end before one that began later could go on;
    both hold for rules that end in a run or in fixed characters.
    """

    def __init__(self, rules: list[tuple[str, bool, int]]) -> None:
        made = [_Rule(*split(_Parser(p, c).parse(), least)) for p, c, least in rules]
        self.rules = len(rules)
        self.klass, self.trans, self.says = combine(made)
        self._rows = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_rows": None}

    def _build(self) -> tuple:
        """Rows for the fast loop, all transitions, and what each state says: (accepting, begun, marks), masks of rules; one object for equal ones."""
        same: dict[tuple, tuple] = {}
        says = []
        for state in self.says.tolist():
            mask = lambda k: sum(1 << r for r, x in enumerate(state) if x[k])  # noqa: B023, E731
            key = (mask(1), mask(2), tuple((r, x[0]) for r, x in enumerate(state) if x[0]))
            says.append(same.setdefault(key, key))
        rows: list = [_Hit(k) if x[1] else [] for k, x in enumerate(says)]
        trans = self.trans.tolist()
        for row, to in zip(rows, trans, strict=True):
            if type(row) is list:
                row.extend(map(rows.__getitem__, to))
        self._rows = (rows, trans, says, self.klass.tobytes())
        return self._rows

    def spans(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(start, end, rule, where it first matched) in bytes, by start and rule."""
        rows, trans, says, klass = self._rows or self._build()
        data = text.translate(klass)
        out: list[tuple[int, int, int, int]] = []
        start, first = [0] * self.rules, [0] * self.rules
        it, n, row = iter(data), len(data), rows[0]
        while True:
            try:
                row = reduce(getitem, it, row)
                if type(row) is not _Hit:
                    return sorted(out)
                state, at, taken = row.state, n, False
            except _Stop as stop:
                state, at, taken = stop.state, n - it.__length_hint__() - 1, True
            # the state is that after ``at`` bytes; one more may be taken from the iterator already
            accepting = 0
            last = None
            while True:
                if (now := says[state]) is not last or now[2]:
                    last = now
                    accepts, begins, marks = now
                    ended = accepting & ~accepts
                    for r, size in marks:
                        if accepting >> r & 1:
                            ended |= 1 << r
                    for r in range(self.rules) if ended else ():
                        if ended >> r & 1:
                            out.append((start[r], at - 1, r, first[r]))
                    for r, size in marks:
                        start[r] = at - size
                    fresh = accepts & (ended | ~accepting)
                    for r in range(self.rules) if fresh else ():
                        if fresh >> r & 1:
                            first[r] = at - 1
                    accepting = accepts
                    if not begins:
                        break
                if at == n:
                    return sorted(out + [(start[r], n, r, first[r]) for r in range(self.rules) if accepting >> r & 1])
                state = trans[state][data[at]]
                at += 1
                if not taken:
                    next(it)
                taken = False
            row = rows[state]
