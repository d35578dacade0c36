"""Secret scans (operator 10): probabilistic automata inferred from labelled credentials.

A first scan takes a bounded sample of the plainly written credentials (base
spans) and of the other candidate tokens, as character classes only: no
credential leaves its text.  The credentials are the labelled strings: per
kind, a prefix tree of their classes is folded into a probabilistic automaton
by merging states whose outgoing and stopping frequencies do not differ
significantly (Hoeffding bound).  The other tokens, most of them long words,
give one more automaton in the same way.  A second scan scores every
candidate, whatever characters of the value class it has, by its likelihood
per character under each automaton; one that fits a kind as well as that
kind's own credentials do, and better than it fits the other tokens, is added
as a span of that kind.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import re
import string
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import id_text, slices, texts_of

KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class Params:
    """Production parameters; ``train_values`` and ``train_others`` bound the distinct credentials of a kind and other tokens learned from."""

    train_values: int = 600
    train_others: int = 2000
    alpha: float = 0.05
    shortest: int = 12
    quantile: float = 0.02
    margin: float = 0.2  # by which the other tokens' automaton must fit better, per character; unnamed credentials are among them
    seed: int = 29


# ---------------------------------------------------------------- base spans

# The names that announce a credential.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SEPARATOR = re.compile("[:=]")
_VALUE = re.compile(r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")


def assignments(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, start of the value) of every named value, found from its ``:`` or ``=``."""
    done = 0
    for m in _SEPARATOR.finditer(text):
        at = m.start()
        if at < done:
            continue
        j = at
        while j > done and text[j - 1] == " ":
            j -= 1
        if j > done and text[j - 1] in "\"'":
            j -= 1
        before = text[max(done, j - 8) : j]
        # only ASCII letters count in either case
        name = next((n for n in NAMES if before[-len(n) :].lower() == n and before[-len(n) :].isascii()), None)
        value = _VALUE.match(text, at + 1) if name else None
        if value:
            done = value.end()
            yield j - len(name), done, value.start(1)


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of every plainly written credential, kind by kind."""
    out = [("assign", s, e, text[v:e]) for s, e, v in assignments(text) if e - v >= 12]
    out += [("access", m.start(), m.end(), m.group()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return out + [("hex", m.start(), m.end(), m.group()) for m in _HEX.finditer(text)]


@functools.lru_cache(maxsize=4)
def _run(shortest: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9+/_.=-]{{{shortest},}}")


def candidates(text: str, shortest: int) -> list[tuple[int, int]]:
    """Runs of the value class, without the dots and dashes that end or begin them."""
    out = []
    for m in _run(shortest).finditer(text):
        run = m.group()
        start = m.start() + len(run) - len(run.lstrip(".-_"))
        end = m.end() - len(run) + len(run.rstrip(".-_"))
        if end - start >= shortest:
            out.append((start, end))
    return out


# ------------------------------------------------------------ grammar inference


_CLASSES = {c: "0" if chr(c) in string.digits else "a" if chr(c) in "abcdef" else "g" if chr(c) in string.ascii_lowercase else "A" for c in map(ord, string.digits + string.ascii_letters)}


def classes(value: str) -> str:
    """Character classes: digit, hex letter, other small letter, capital; other characters are themselves."""
    return value.translate(_CLASSES)


@dataclass
class State:
    """A state: arrivals, stops, and per symbol the target and how often it was taken."""

    arrivals: int = 0
    stops: int = 0
    go: dict[str, int] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=dict)


class Automaton:
    """Probabilistic deterministic automaton of strings; grows as a prefix tree, shrinks by merges."""

    def __init__(self, strings: list[str], alpha: float):
        self.states = [State()]
        for s in strings:
            self._add(s)
        self.margin = math.sqrt(0.5 * math.log(2 / alpha))
        self._fold()

    def _add(self, shape: str) -> None:
        at = self.states[0]
        at.arrivals += 1
        for c in shape:
            if c not in at.go:
                at.go[c] = len(self.states)
                self.states.append(State())
            at.taken[c] = at.taken.get(c, 0) + 1
            at = self.states[at.go[c]]
            at.arrivals += 1
        at.stops += 1

    def _differ(self, k: int, n: int, k2: int, n2: int) -> bool:
        return abs(k / n - k2 / n2) > self.margin * (1 / math.sqrt(n) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        """No significant difference between two states, nor between those that equal symbols lead to."""
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            if pair in seen:
                continue
            seen.add(pair)
            x, y = self.states[pair[0]], self.states[pair[1]]
            if self._differ(x.stops, x.arrivals, y.stops, y.arrivals):
                return False
            for c in x.taken.keys() | y.taken.keys():
                if self._differ(x.taken.get(c, 0), x.arrivals, y.taken.get(c, 0), y.arrivals):
                    return False
                if c in x.go and c in y.go:
                    todo.append((x.go[c], y.go[c]))
        return True

    def _absorb(self, a: int, b: int) -> None:
        """Fold the subtree of state b into state a."""
        todo = [(a, b)]
        while todo:
            i, j = todo.pop()
            x, y = self.states[i], self.states[j]
            x.arrivals += y.arrivals
            x.stops += y.stops
            for c, n in y.taken.items():
                x.taken[c] = x.taken.get(c, 0) + n
                if c in x.go:
                    todo.append((x.go[c], y.go[c]))
                else:
                    x.go[c] = y.go[c]

    def _fold(self) -> None:
        """Visit states breadth first; merge each into the first kept state it is compatible with, or keep it."""
        kept, held = [0], {0}
        frontier = deque((0, c) for c in sorted(self.states[0].go))
        while frontier:
            source, c = frontier.popleft()
            target = self.states[source].go[c]
            if target in held:
                continue
            match = next((k for k in kept if self._compatible(k, target)), None)
            if match is None:
                kept.append(target)
                held.add(target)
                frontier.extend((target, x) for x in sorted(self.states[target].go))
            else:
                self.states[source].go[c] = match
                self._absorb(match, target)
                # the merge may have hung new states onto kept ones
                frontier.extend((k, x) for k in kept for x in sorted(self.states[k].go) if self.states[k].go[x] not in held and (k, x) not in frontier)
        number = {s: i for i, s in enumerate(kept)}
        self.states = [self.states[k] for k in kept]
        for s in self.states:
            s.go = {c: number[t] for c, t in s.go.items()}

    def likelihood(self, shape: str) -> float:
        """Log probability per symbol (the stop included); symbols never taken cost a fixed penalty."""
        total, at = 0.0, self.states[0]
        for c in shape:
            n = at.taken.get(c, 0)
            total += math.log((n + 0.01) / (at.arrivals + 1))
            if n:
                at = self.states[at.go[c]]
        return (total + math.log((at.stops + 0.01) / (at.arrivals + 1))) / (len(shape) + 1)


@dataclass
class Grammar:
    """One automaton and acceptance level per kind that had credentials, and the automaton of the other tokens."""

    automata: dict[str, tuple[Automaton, float]]
    other: Automaton | None = None
    margin: float = 0.0
    memo: dict[str, str | None] = field(default_factory=dict)

    def kind_of(self, value: str) -> str | None:
        """The kind whose format the value fits best, relative to its level; None if it fits none, or the other tokens better."""
        shape = classes(value)
        if shape in self.memo:
            return self.memo[shape]
        fits = [(likely - level, likely, kind) for kind, (a, level) in self.automata.items() for likely in [a.likelihood(shape)]]
        over, likely, kind = max(fits, default=(-1.0, 0.0, ""), key=lambda f: f[0])
        if over < 0 or self.other is not None and self.other.likelihood(shape) > likely + self.margin:
            kind = None
        if len(self.memo) < 100_000:
            self.memo[shape] = kind
        return kind


def infer(values: dict[str, list[str]], p: Params = Params(), others: list[str] | None = None) -> Grammar:
    """An automaton per kind, from credentials or their classes; its level is a low quantile of the likelihoods of its own credentials."""
    automata = {}
    for kind in KINDS:
        shapes = sorted(classes(v) for v in values.get(kind, []))
        if shapes:
            a = Automaton(shapes, p.alpha)
            own = sorted(a.likelihood(s) for s in shapes)
            automata[kind] = (a, own[int(p.quantile * (len(own) - 1))])
    return Grammar(automata, Automaton(sorted(map(classes, others)), p.alpha) if others else None, p.margin)


# ------------------------------------------------------------------------ Spark

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
SPANS_DDL = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
OTHER = "other"


def free_candidates(text: str, base: list[tuple[str, int, int, str]], shortest: int) -> Iterator[tuple[int, int]]:
    """Candidates that meet no base span, by start."""
    taken = sorted((s, e) for _, s, e, _ in base)
    i, reach = 0, -1
    for start, end in candidates(text, shortest):
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            yield start, end


def labelled(rows: DataFrame, p: Params) -> dict[str, list[str]]:
    """Shapes of at most ``train_values`` distinct credentials of each kind and ``train_others`` other tokens: those with the smallest seeded hash.

    Every task keeps that many of each kind, so a task sends no more whatever it reads.
    """
    limits = dict.fromkeys(KINDS, p.train_values) | {OTHER: p.train_others}
    key = p.seed.to_bytes(8, "little")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, str]] = {kind: {} for kind in limits}

        def cut(kind: str) -> None:
            held[kind] = dict(heapq.nsmallest(limits[kind], held[kind].items()))

        for batch in slices(batches):
            for text in texts_of(batch):
                base = base_spans(text)
                found = [(kind, value) for kind, _, _, value in base]
                found += [(OTHER, text[s:e]) for s, e in free_candidates(text, base, p.shortest)]
                for kind, value in found:
                    held[kind][hashlib.blake2b(value.encode(), digest_size=16, key=key).digest()] = classes(value)
            for kind, limit in limits.items():
                if len(held[kind]) > 4 * limit:
                    cut(kind)
        for kind in limits:
            cut(kind)
        found = [(kind, mark, shape) for kind, some in held.items() for mark, shape in some.items()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.string(), pa.binary(), pa.string()))], ["kind", "mark", "shape"])

    marks = rows.mapInArrow(sample, "kind string, mark binary, shape string").distinct()
    first = Window.partitionBy("kind").orderBy("mark")
    kept = marks.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= max(limits.values()))
    out: dict[str, list[str]] = {kind: [] for kind in limits}
    for r in kept.filter(functools.reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("n") <= n) for k, n in limits.items()])).collect():
        out[r["kind"]].append(r["shape"])
    return out


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """Credentials of every whole text: ``doc_id`` and its spans (kind, start, end, base).

    Candidates that meet a base span are not scored.  Null or empty text: no
    spans.  Without any base span in the table nothing is learned and nothing
    is added.  Repeated rows give repeated rows; a null id stays null.
    """
    rows = id_text(df, id_col, text_col)
    learned = labelled(rows, params)
    grammar = infer(learned, params, learned[OTHER])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in texts_of(batch):
                base = base_spans(text)
                spans = [{"kind": kind, "start": s, "end": e, "base": True} for kind, s, e, _ in base]
                for s, e in free_candidates(text, base, params.shortest):
                    if kind := grammar.kind_of(text[s:e]):
                        spans.append({"kind": kind, "start": s, "end": e, "base": False})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, _SPANS)], ["doc_id", "spans"])

    return rows.mapInArrow(judge, SPANS_DDL)
