"""Regular expressions of several rules as one deterministic automaton over bytes.

The expressions know literals, escapes (\\n, \\t, \\xHH and escaped signs), classes, groups, alternatives and the repeats ? * + {m}
{m,} {m,n}, all over ASCII. Each becomes a nondeterministic automaton; subset construction over classes of bytes that no
rule tells apart makes one deterministic automaton of all, and partition refinement merges states that accept
the same rules after every string.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SIGNS = {"n": 10, "t": 9, "r": 13}


@dataclass(frozen=True)
class Automaton:
    """table[state, byte] is the next state, accepts[state] the bits of the rules met; state 0 is the start.

    dead: the state that nothing leaves, or -1 if there is none.
    """

    table: np.ndarray
    accepts: np.ndarray
    dead: int


class _Parts:
    """Nondeterministic automaton: steps by bytes and free steps between numbered states."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def build(self, tree, start: int) -> int:
        """Add a tree from `start` on; the state where it ends."""
        kind, *rest = tree
        if kind == "bytes":
            end = self.state()
            self.steps[start].append((rest[0], end))
            return end
        if kind == "all":
            for part in rest[0]:
                start = self.build(part, start)
            return start
        if kind == "any":
            end = self.state()
            for part in rest[0]:
                self.free[self.build(part, start)].append(end)
            return end
        part, least, most = rest
        for _ in range(least):
            start = self.build(part, start)
        if most is None:
            start, again = self._apart(start), self.state()
            self.free[start].append(again)
            self.free[self.build(part, again)].append(start)
            return start
        ends = [start]
        for _ in range(most - least):
            start = self.build(part, self._apart(start))
            ends.append(start)
        end = self.state()
        for e in ends:
            self.free[e].append(end)
        return end

    def _apart(self, state: int) -> int:
        """A fresh state after `state`, so that loops do not reach back into what comes before."""
        new = self.state()
        self.free[state].append(new)
        return new

    def closed(self, states) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def parse(pattern: str, either_case: bool = False):
    """The tree of an expression. Anything beyond the forms named above is an error."""
    at = 0

    def cased(values) -> frozenset:
        values = set(values)
        if either_case:
            values |= {ord(chr(v).swapcase()) for v in values if chr(v).isalpha()}
        if not values or max(values) > 127:
            raise ValueError(f"only ASCII bytes can be matched: {pattern}")
        return frozenset(values)

    def escaped() -> int:
        nonlocal at
        sign = pattern[at + 1]
        if sign == "x":
            value = int(pattern[at + 2 : at + 4], 16)
            at += 4
            return value
        if sign.isalnum() and sign not in _SIGNS:
            raise ValueError(f"\\{sign} is not known: {pattern}")
        at += 2
        return _SIGNS.get(sign, ord(sign))

    def sign() -> int:
        nonlocal at
        if pattern[at] == "\\":
            return escaped()
        at += 1
        return ord(pattern[at - 1])

    def klass():
        nonlocal at
        at += 1
        turned = pattern[at] == "^"
        at += turned
        values: set[int] = set()
        while pattern[at] != "]":
            low = high = sign()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = sign()
            values.update(range(low, high + 1))
        at += 1
        return "bytes", cased(set(range(128)) - values if turned else values)

    def one():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            if pattern.startswith("?:", at):
                at += 2
            inner = choice()
            at += 1
            return inner
        if pattern[at] == "[":
            return klass()
        if pattern[at] in ".^$|?*+{)":
            raise ValueError(f"'{pattern[at]}' at {at} is not known here: {pattern}")
        return "bytes", cased({sign()})

    def repeated():
        nonlocal at
        inner = one()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                least, comma, most = pattern[at + 1 : end].partition(",")
                low, high = int(least), int(most) if most else None if comma else int(least)
                at = end + 1
            else:
                low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                at += 1
            inner = ("repeat", inner, low, high)
        return inner

    def choice():
        nonlocal at
        options = [[]]
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                options.append([])
            else:
                options[-1].append(repeated())
        return ("any", [("all", o) for o in options]) if len(options) > 1 else ("all", options[0])

    tree = choice()
    if at < len(pattern):
        raise ValueError(f"')' at {at} closes nothing: {pattern}")
    return tree


def compiled(rules: list[tuple[str, bool]], anywhere: bool) -> Automaton:
    """The least automaton of rules (pattern, either case), whose bits stand in their order.

    anywhere: a match may start at any byte, so that the state after a byte tells which rules end there; else matches start
    at the first byte only.
    """
    parts = _Parts()
    start, ends = parts.state(), []
    for pattern, either_case in rules:
        ends.append(parts.build(parse(pattern, either_case), parts._apart(start)))
    kinds = _byte_kinds(parts)
    samples = [int(np.flatnonzero(kinds == k)[0]) for k in range(kinds.max() + 1)]
    first = parts.closed([start])
    number, todo, rows = {first: 0}, [first], []
    while todo:
        states = todo.pop(0)
        row = []
        for byte in samples:
            reached = {end for s in states for values, end in parts.steps[s] if byte in values}
            if anywhere:
                reached.add(start)
            after = parts.closed(reached)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    accepts = np.array([sum(1 << i for i, e in enumerate(ends) if e in states) for states in number], np.uint32)
    return _least(np.array(rows), accepts, kinds)


def _byte_kinds(parts: _Parts) -> np.ndarray:
    """Number of the class of each byte; bytes of a class are in the same steps."""
    kinds = np.zeros(256, np.int64)
    for values in {values for steps in parts.steps for values, _ in steps}:
        inside = np.zeros(256, np.int64)
        inside[list(values)] = 1
        kinds = np.unique(2 * kinds + inside, return_inverse=True)[1]
    return kinds


def _least(rows: np.ndarray, accepts: np.ndarray, kinds: np.ndarray) -> Automaton:
    """Split states by what they accept and then by where they lead, until nothing splits."""
    group = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[rows]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    order = np.full(group.max() + 1, -1)
    order[group[0]], n = 0, 1
    for g in group:
        if order[g] < 0:
            order[g], n = n, n + 1
    group = order[group]
    some = np.zeros(n, np.int64)
    some[group] = np.arange(len(group))
    table = group[rows[some]][:, kinds]
    accepts = accepts[some]
    stuck = np.flatnonzero((table == np.arange(n)[:, None]).all(1) & (accepts == 0))
    return Automaton(table.astype(np.uint16), accepts, int(stuck[0]) if len(stuck) else -1)
