"""Secrets: three fixed kinds, and more by probabilistic automata of their formats.

Base spans come from three expressions (assign, access, hex). What they match are the
labelled credentials: the assigned value, the access key, the hexadecimal string. For
each kind a grammar is inferred from them: the distinct values, written in character
classes, make a prefix tree with counts; states of the tree whose ending and going on
are statistically compatible (Hoeffding bounds, down the whole subtree) are merged, in
order of the shortest prefix, into a deterministic probabilistic automaton.

All other runs of credential characters in all texts are candidates. Spark counts
which character class follows which in them; this makes the background automaton. A
candidate is scored by its likelihood under every kind's automaton against that of the
background, with the number of labelled values and of candidates as prior odds; where
the odds say ``CONFIDENCE`` or more it becomes a span of kind ``format``. Candidates
are scored whole, of any length, all automata stepping over all candidates of a chunk
together.

The automata are fitted on a bounded sample: per kind the ``TRAIN_VALUES`` distinct
values of the smallest hashes, of at most ``TRAIN_CHARS`` characters each; a kind with
fewer than ``MIN_VALUES`` gets none. Counts for background and odds cover everything.

Defined cases: a null text counts as empty; places are code points, the end is
exclusive; kinds may overlap each other, one kind never itself; a candidate that
touches a base span is left out; repeated rows are each answered; without any
automaton no span is added; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import in_chunks, materialise

KINDS = ("assign", "access", "hex", "format")
FORMAT = KINDS.index("format")

# Fixed expressions of the three kinds. They run over UTF-8 bytes, where ignoring case means A-Z only.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")  # what [0-9a-f]+ matches with 32 characters or more
ASSIGN_VALUE = 8
ACCESS_CHARS = 16

TRAIN_VALUES = 2000
TRAIN_CHARS = 256
MIN_VALUES = 20
ALPHA = 0.05  # of the Hoeffding bounds
CONFIDENCE = 0.9
CANDIDATE = 8  # characters of a candidate, at least
STEPPED = 1024  # longer candidates are walked one by one
FLUSH = 100_000  # distinct values a task holds before it hands their counts on

# Symbols of the automata: character classes, and the end.
CLASSES = (b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ", b"+", b"/", b"_", b".", b"=", b"-")
END = len(CLASSES)
SYMBOL = np.full(256, -1, np.int8)
for _i, _c in enumerate(CLASSES):
    SYMBOL[list(_c)] = _i
_ALNUM = (SYMBOL >= 0) & (SYMBOL <= 4)
_BODY = (SYMBOL >= 0) & (SYMBOL != CLASSES.index(b"="))


# --- spans and candidates of texts ------------------------------------------


class Scan:
    """Base spans and candidates of some texts, as byte ranges of their joined data.

    The texts are joined by line feeds, which no expression and no candidate holds.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts) + b"\n"
        self.buf = np.frombuffer(self.data, np.uint8)
        self.begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
        base = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(self.data) if m.end() - m.start(2) >= ASSIGN_VALUE]
        base += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(self.data) if m.end() - m.start() >= ACCESS_CHARS]
        base += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(self.data)]
        self.base = sorted(base)

    def values(self) -> Iterator[tuple[int, bytes]]:
        """(kind, credential) of the base spans."""
        for _, kind, end, value in self.base:
            yield kind, self.data[value:end]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of the candidates: runs of credential characters from the first to the last letter or
        digit, with up to two equal signs after it, that touch no base span."""
        body = _BODY[self.buf].view(np.int8)
        edge = np.diff(body, prepend=np.int8(0))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        solid = np.flatnonzero(_ALNUM[self.buf])
        if not len(solid) or not len(start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first = np.searchsorted(solid, start)
        some = first < len(solid)
        start, end, first = start[some], end[some], first[some]
        last = solid[np.searchsorted(solid, end) - 1] + 1
        start = solid[first]
        fit = start < last
        start, end, last = start[fit], end[fit], last[fit]
        padded = np.append(self.buf, [0, 0])
        one = (last == end) & (padded[end] == ord("="))
        end = last + one + (one & (padded[end + 1] == ord("=")))
        fit = end - start >= CANDIDATE
        start, end = start[fit], end[fit]
        if self.base:
            reach = np.concatenate([[-1], np.maximum.accumulate([b[2] for b in self.base])])
            free = reach[np.searchsorted([b[0] for b in self.base], end)] <= start
            start, end = start[free], end[free]
        return start, end

    def by_text(self, starts: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> list[list[dict]]:
        """Ranges in code points, per text."""
        out: list[list[dict]] = [[] for _ in self.begin[1:]]
        if not len(starts):
            return out
        points = np.concatenate([[0], np.cumsum((self.buf & 0xC0) != 0x80)])
        text = np.searchsorted(self.begin, starts, side="right") - 1
        lead = points[self.begin[text]]
        for t, a, k, b in zip(text.tolist(), (points[starts] - lead).tolist(), kinds.tolist(), (points[ends] - lead).tolist()):
            out[t].append({"start": a, "kind": k, "end": b})
        return out


# --- automata -----------------------------------------------------------------


class Automaton:
    """A deterministic probabilistic automaton: next states and log probabilities per state and symbol; the start is state 0."""

    def __init__(self, step: np.ndarray, logp: np.ndarray):
        self.step, self.logp = np.asarray(step, np.int32), np.asarray(logp, np.float64)

    def score(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log likelihood of each range of ``symbols``; ranges come by falling length."""
        out, state, size = np.zeros(len(starts)), np.zeros(len(starts), np.int32), ends - starts
        # How many ranges are longer than 0, 1, 2... symbols.
        longer = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for at, n in enumerate(longer.tolist()):
            s = symbols[starts[:n] + at]
            out[:n] += self.logp[state[:n], s]
            state[:n] = self.step[state[:n], s]
        return out + self.logp[state, END]

    def score_one(self, symbols: list[int]) -> float:
        step, logp, state, total = self.step.tolist(), self.logp.tolist(), 0, 0.0
        for s in symbols:
            total += logp[state][s]
            state = step[state][s]
        return total + logp[state][END]


class PrefixTree:
    """Prefix tree of symbol strings with counts, whose states merge into an automaton."""

    def __init__(self, strings: Iterable[Iterable[int]]):
        self.visits, self.ends, self.arcs = [0], [0], [{}]  # arcs: symbol -> [count, state]
        for string in strings:
            state = 0
            self.visits[0] += 1
            for s in string:
                if s not in self.arcs[state]:
                    self.arcs[state][s] = [0, len(self.visits)]
                    self.visits.append(0)
                    self.ends.append(0)
                    self.arcs.append({})
                arc = self.arcs[state][s]
                arc[0] += 1
                state = arc[1]
                self.visits[state] += 1
            self.ends[state] += 1

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """Whether both states end and go on alike, and so do the states that follow."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            reach = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > reach:
                return False
            left, right = self.arcs[a], self.arcs[b]
            for s in left.keys() | right.keys():
                x, y = left.get(s), right.get(s)
                if abs((x[0] if x else 0) / n - (y[0] if y else 0) / m) > reach:
                    return False
                if x and y:
                    todo.append((x[1], y[1]))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for s, (n, state) in self.arcs[b].items():
                if s in self.arcs[a]:
                    self.arcs[a][s][0] += n
                    todo.append((self.arcs[a][s][1], state))
                else:
                    self.arcs[a][s] = [n, state]

    def merged(self, alpha: float) -> Automaton:
        """The automaton after all compatible states are merged, in order of the shortest prefix."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        kept, place = [0], {0: 0}
        fringe = [(0, s) for s in sorted(self.arcs[0])]
        while fringe:
            later = []
            for state, s in fringe:
                new = self.arcs[state][s][1]
                if new in place:
                    continue
                same = next((k for k in kept if self.compatible(k, new, bound)), None)
                if same is None:
                    place[new] = len(kept)
                    kept.append(new)
                    later += [(new, x) for x in sorted(self.arcs[new])]
                else:
                    self.arcs[state][s][1] = same
                    before = set(self.arcs[same])
                    self.fold(same, new)
                    later += [(same, x) for x in sorted(set(self.arcs[same]) - before)]
            # Folding may have hung new states below kept ones.
            fringe = [(k, s) for k, s in dict.fromkeys(later + [(k, s) for k in kept for s in sorted(self.arcs[k])]) if self.arcs[k][s][1] not in place]
        # Symbols never seen lead to a last state in which everything is equally likely.
        step = np.full((len(kept) + 1, END), len(kept), np.int32)
        logp = np.full((len(kept) + 1, END + 1), -math.log(END + 1))
        for i, state in enumerate(kept):
            seen = np.zeros(END + 1)
            seen[END] = self.ends[state]
            for s, (n, target) in self.arcs[state].items():
                step[i, s], seen[s] = place[target], n
            logp[i] = np.log((seen + 0.5) / (self.visits[state] + 0.5 * (END + 1)))
        return Automaton(step, logp)


def background(pairs: np.ndarray) -> Automaton:
    """Automaton of which symbol follows which: ``pairs[0]`` counts first symbols, ``pairs[1 + s]`` what comes after ``s``."""
    step = np.tile(np.arange(1, END + 1), (END + 1, 1))
    return Automaton(step, np.log((pairs + 0.5) / (pairs.sum(1, keepdims=True) + 0.5 * (END + 1))))


# --- fitting ------------------------------------------------------------------


class Model:
    """Automata with their log odds against the background."""

    def __init__(self, normal: Automaton, formats: list[tuple[Automaton, float]]):
        self.normal, self.formats = normal, formats

    def odds(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log odds that the ranges are credentials rather than background."""
        out = np.full(len(starts), -np.inf)
        if not self.formats or not len(starts):
            return out
        order = np.argsort(starts - ends, kind="stable")
        long = int(np.searchsorted(starts[order] - ends[order], -STEPPED, side="left"))
        for i in order[:long]:
            one = symbols[starts[i] : ends[i]].tolist()
            normal = self.normal.score_one(one)
            out[i] = max(a.score_one(one) + prior for a, prior in self.formats) - normal
        order = order[long:]
        a, b = starts[order], ends[order]
        best = np.max([f.score(symbols, a, b) + prior for f, prior in self.formats], axis=0)
        out[order] = best - self.normal.score(symbols, a, b)
        return out


def _count(texts: list[bytes], values: Counter, pairs: np.ndarray) -> None:
    """Add what some texts hold to the counts of short credentials and of symbol pairs in candidates."""
    scan = Scan(texts)
    values.update((k, v) for k, v in scan.values() if len(v) <= TRAIN_CHARS)
    start, end = scan.candidates()
    if not len(start):
        return
    symbols = SYMBOL[scan.buf].astype(np.int64)
    inside = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    follows = np.cumsum(inside[:-1]).astype(bool)
    follows[start] = False  # a candidate's symbols but its first
    at = np.flatnonzero(follows)
    pairs += np.bincount((symbols[at - 1] + 1) * (END + 1) + symbols[at], minlength=pairs.size).reshape(pairs.shape)
    pairs[0] += np.bincount(symbols[start], minlength=END + 1)
    pairs[:, END] += np.bincount(symbols[end - 1] + 1, minlength=END + 1)


def _counts(texts: DataFrame) -> DataFrame:
    """``kind, value, n``: credentials of the kinds, and symbol pairs as kind -1."""

    def rows(counted: Counter) -> pa.RecordBatch:
        kinds, values = zip(*counted) if counted else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array([v.decode() for v in values], pa.string()), pa.array(list(counted.values()), pa.int64())],
            names=["kind", "value", "n"],
        )

    def count(batches):
        values: Counter = Counter()
        pairs = np.zeros((END + 1, END + 1), np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column(0).to_pylist()]
            for lo, hi in in_chunks(texts):
                _count(texts[lo:hi], values, pairs)
                if len(values) >= FLUSH:
                    yield rows(values)
                    values = Counter()
        some = {(-1, b"%d" % i): int(n) for i, n in enumerate(pairs.ravel()) if n}
        yield rows(values + Counter(some))

    return texts.mapInArrow(count, "kind int, value string, n bigint")


def _infer(group: pd.DataFrame) -> pd.DataFrame:
    """The automaton of one kind's sampled values, a row a state."""
    kind = int(group["kind"].iloc[0])
    strings = sorted(group["value"], key=lambda v: (len(v), v))
    a = PrefixTree(SYMBOL[np.frombuffer(v.encode(), np.uint8)].tolist() for v in strings).merged(ALPHA)
    return pd.DataFrame({"kind": kind, "state": range(len(a.step)), "step": list(a.step), "logp": list(a.logp)})


def fit(texts: DataFrame) -> Model:
    """Model of ``texts(text)``, a binary column.

    What the driver gets is bounded: the table of symbol pairs, one count a kind, and
    the states of three automata of at most TRAIN_VALUES * TRAIN_CHARS characters.
    """
    counts = materialise(_counts(texts).groupBy("kind", "value").agg(F.sum("n").alias("n")), "secret-values")
    pairs = np.zeros((END + 1) * (END + 1), np.int64)
    for r in counts.where("kind = -1").collect():
        pairs[int(r["value"])] = r["n"]
    pairs = pairs.reshape(END + 1, END + 1)
    found = {r["kind"]: r for r in counts.where("kind >= 0").groupBy("kind").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).collect()}
    sample = [
        counts.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(TRAIN_VALUES).select("kind", "value")
        for kind, r in sorted(found.items())
        if r["values"] >= MIN_VALUES
    ]
    normal = background(pairs)
    if not sample:
        return Model(normal, [])
    rows = sample[0]
    for s in sample[1:]:
        rows = rows.unionByName(s)
    states = rows.groupBy("kind").applyInPandas(_infer, "kind int, state int, step array<int>, logp array<double>").orderBy("kind", "state").collect()
    formats, n_normal = [], max(int(pairs[0].sum()), 1)
    for kind in sorted({r["kind"] for r in states}):
        own = [r for r in states if r["kind"] == kind]
        formats.append((Automaton([r["step"] for r in own], [r["logp"] for r in own]), math.log(found[kind]["n"] / n_normal)))
    return Model(normal, formats)


# --- the operator ---------------------------------------------------------------

SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans_of(texts: list[bytes], model: Model) -> tuple[list, list]:
    """Base and added spans of some texts."""
    scan = Scan(texts)
    base = np.array(scan.base, np.int64).reshape(-1, 4)
    start, end = scan.candidates()
    good = model.odds(SYMBOL[scan.buf], start, end) >= math.log(CONFIDENCE / (1 - CONFIDENCE))
    start, end = start[good], end[good]
    return scan.by_text(base[:, 0], base[:, 1], base[:, 2]), scan.by_text(start, np.full(len(start), FORMAT), end)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of (start, kind, end), ``kind`` being its place in KINDS."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows.select("text")))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for lo, hi in in_chunks(texts):
                base, added = _spans_of(texts[lo:hi], model.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(base, spans), pa.array(added, spans)], names=["doc_id", "base", "added"])

    kind = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "kind", "end")]))
    return rows.mapInArrow(scan, T.StructType([rows.schema["doc_id"], T.StructField("base", kind), T.StructField("added", kind)]))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
