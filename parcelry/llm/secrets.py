"""Secrets in texts, found by one automaton of all rules.

The rules' expressions are compiled to one deterministic automaton in which a match may start anywhere (see automaton). It
reads each byte of a text once, for all rules together; a byte that leads every state back to the start
separates segments that cannot share a match, and the segments of a batch are read side by side. Where a segment meets a rule, the
rule's own anchored automaton finds its matches there: from the left, the longest at each place, none overlapping.
A match then has to be long enough, and for some rules its value, the part from the first byte on which the rule is met.

Besides the three kinds asked for, further rules find tokens of known forms and heads of private keys; they add spans and
take none away.

Defined cases: a null or empty text has no secrets; a text of any length is read whole; equal rows have equal results; all other
columns are kept, whatever their names, but one with the name of the result, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelry.llm.automaton import compiled
from parcelry.llm.common import pieces, utf8

#: Longest segment that is read side by side with others.
SIDE_BY_SIDE = 1 << 12
_BATCH = 1 << 20


@dataclass(frozen=True)
class Rule:
    """kind, expression, whether letters count in either case, least length of a match and of its value."""

    kind: str
    pattern: str
    either_case: bool = False
    least: int = 0
    least_value: int = 0


#: The kinds asked for, in their order, and known forms of other secrets.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 0, 6),
    Rule("access", r"AKIA[A-Z0-9]+", False, 20),
    Rule("hex", r"[0-9a-f]+", False, 24),
]
FURTHER = [
    Rule("private_key", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_.-]+", False, 40),
    Rule("prefixed_token", r"(ghp_|glpat-|npm_|sk_live_)[A-Za-z0-9_-]+", False, 24),
]
RULES = BASE + FURTHER


def _run_of(rule: Rule) -> int:
    """How many bytes in a row must end a match of a rule that is a run of one class; 1 for other rules.

    Matches of such a rule that are long enough end at that many bytes in a row. Written into the expression, the length would multiply the states.
    """
    return max(rule.least, 1) if rule.pattern.startswith("[") and rule.pattern.index("]") == len(rule.pattern) - 2 and rule.pattern.endswith("+") else 1


class Scanner:
    """The automata of some rules: one of all for the pass, and one of each for its matches."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.all = compiled([(r.pattern, r.either_case) for r in rules], anywhere=True)
        self.own = [compiled([(r.pattern, r.either_case)], anywhere=False) for r in rules]
        #: bytes after which nothing that came before counts
        self.parts = (self.all.table == 0).all(0)
        self.steps = self.all.table.reshape(-1).astype(np.int32) << 8
        #: rules that are met only after so many accepting bytes in a row
        self.counted = [(k, _run_of(r)) for k, r in enumerate(rules) if _run_of(r) > 1]
        self.once = self.all.accepts & ~np.uint32(sum(1 << k for k, _ in self.counted))
        self.again = [(self.all.accepts >> np.uint32(k) & 1).astype(np.int32) for k, _ in self.counted]
        self.lists = [(a.table.tolist(), a.accepts.tolist(), a.dead) for a in self.own]

    def met(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, bits of the rules) of the segments that meet a rule; texts end segments too."""
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        apart = self.parts[data]
        edge[:-1] |= apart
        edge[1:] |= apart
        starts = np.flatnonzero(edge[:-1])
        sizes = np.diff(np.append(starts, len(data)))
        keep = ~apart[starts] if len(starts) else np.zeros(0, bool)
        starts, sizes = starts[keep], sizes[keep]
        bits = np.zeros(len(starts), np.uint32)
        order = np.argsort(-sizes, kind="stable")
        long = int(np.searchsorted(-sizes[order], -SIDE_BY_SIDE, "left"))
        for i in order[:long]:
            bits[i] = self._alone(data[starts[i] : starts[i] + sizes[i]])
        order = order[long:]
        at, state, seen = starts[order], np.zeros(len(order), np.int32), np.zeros(len(order), np.uint32)
        runs, longest = np.zeros((2, len(self.counted), len(order)), np.int32)
        left = np.searchsorted(-sizes[order], -np.arange(int(sizes[order[0]]) if len(order) else 0), "left")
        for step, n in enumerate(left.tolist()):
            state[:n] = now = self.steps[state[:n] | data[at[:n] + step]]
            now = now >> 8
            seen[:n] |= self.once[now]
            for again, run, most in zip(self.again, runs, longest):
                run[:n] += 1
                run[:n] *= again[now]
                np.maximum(most[:n], run[:n], out=most[:n])
        for (k, least), most in zip(self.counted, longest):
            seen[most >= least] |= np.uint32(1 << k)
        bits[order] = seen
        found = np.flatnonzero(bits)
        return starts[found], starts[found] + sizes[found], bits[found]

    def _alone(self, segment: np.ndarray) -> int:
        """The bits of one long segment, read byte by byte."""
        table, accepts, counted = self.all.table.tolist(), self.all.accepts.tolist(), dict(self.counted)
        state, seen, runs = 0, 0, dict.fromkeys(counted, 0)
        once = self.once.tolist()
        for byte in segment.tobytes():
            state = table[state][byte]
            seen |= once[state]
            for k, least in counted.items():
                runs[k] = runs[k] + 1 if accepts[state] >> k & 1 else 0
                if runs[k] >= least:
                    seen |= 1 << k
        return seen

    def matches(self, segment: bytes, rule: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, start of the value) of a rule's matches in a segment: leftmost, longest, none overlapping."""
        table, accepts, dead = self.lists[rule]
        at, size = 0, len(segment)
        while at < size:
            state, end, value, i = 0, -1, -1, at
            while i < size:
                state = table[state][segment[i]]
                if state == dead:
                    break
                i += 1
                if accepts[state]:
                    end = i
                    value = i - 1 if value < 0 else value
            if end < 0:
                at += 1
                continue
            yield at, end, value
            at = end

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule, end) of its secrets in order, in code points."""
        data, bounds = utf8(texts)
        found: list[list] = [[] for _ in range(len(texts))]
        starts, ends, bits = self.met(data, bounds)
        if not len(starts):
            return found
        points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        owner = np.searchsorted(bounds, starts, "right") - 1
        for a, b, met, text in zip(starts.tolist(), ends.tolist(), bits.tolist(), owner.tolist()):
            segment = data[a:b].tobytes()
            base = int(points[bounds[text]])
            for k, rule in enumerate(self.rules):
                if met >> k & 1:
                    for start, end, value in self.matches(segment, k):
                        if end - start >= rule.least and end - value >= rule.least_value:
                            found[text].append((int(points[a + start]) - base, k, int(points[a + end]) - base))
        return [sorted(f) for f in found]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find(docs: DataFrame, rules: list[Rule] = RULES, column: str = "secrets") -> DataFrame:
    """docs with a column: the secrets of `text` as (kind, start, end), by start, then in the order of the rules.

    Places are code points, ends exclusive. The automata, about a thousand states, are sent to the tasks.
    """
    docs = docs.drop(column)
    sent = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    columns = docs.columns
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = sent.value
        names = [r.kind for r in scanner.rules]
        for batch in batches:
            texts = batch.column(columns.index("text"))
            for a, b in pieces(texts, _BATCH):
                found = [[{"kind": names[k], "start": s, "end": e} for s, k, e in spans] for spans in scanner.spans(texts[a:b])]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(found, kind)], names=[*columns, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(column, SPANS)]))
