"""Removal of long word sequences that occur more than once anywhere.

A window is ``WINDOW`` consecutive words of one text. Words covered by a window
whose sequence also starts somewhere else are removed.

Method: a compacted de Bruijn graph over sampled k-mers. Of every run of
``RUN`` consecutive k-mers (``RUN + K - 1 = WINDOW``) the least hash is selected,
so equal windows select the same k-mer at the same place. Selected k-mers are the
nodes; the words from one to the next, both ends included, are the edges. One
aggregation gives each node's count and whether all its occurrences have the same
edge in, and the same edge out. Where they do, the path does not branch there and
compacts: wherever the node occurs, the whole path around it does. A window on
such a path around its own node occurs as often as that node. Only the other
windows whose own node is repeated, at the ends of paths, are compared by hash,
with their source coordinates, through a second aggregation and join.

All joins are on node or window hashes with plain shuffled sides, so a sequence
that a third of all texts share is split over tasks. Node positions of a text
return as one list, no longer than the text.

Defined cases: words are maximal runs outside space and 0x09-0x0D, unchanged; a
null text counts as empty; texts with fewer than ``WINDOW`` words keep all words;
a sequence that repeats within one text counts, also where its copies overlap;
repeated rows are copies of each other. Texts of any length are read whole. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import cut_words, in_chunks, materialise, mix, packed, powers, rolling, unpack

WINDOW = 35
K = 10


class Nodes:
    """Selected k-mers of a run of texts, in order: ``at`` first word, ``text``, ``key``; and per window its own node."""

    def __init__(self, texts: list[str | None], window: int, k: int):
        self.cut = cut_words(texts)
        h, starts, counts = self.cut.hashes, self.cut.starts, self.cut.counts
        self.window, self.k = window, k
        run = window - k + 1
        grams = rolling(h, k)
        per_text = np.maximum(counts - window + 1, 0)
        self.first_window = np.concatenate([[0], np.cumsum(per_text)])
        self.window_text = np.repeat(np.arange(len(counts)), per_text)
        # Word index of each window of each text.
        self.window_at = np.arange(self.first_window[-1]) - np.repeat(self.first_window[:-1] - starts[:-1], per_text)
        if not len(self.window_at):
            self.at = self.text = self.own = np.empty(0, np.int64)
            self.key = np.empty(0, np.uint64)
            return
        # Least hash of each run of k-mers, leftmost of equals: hash above, place below.
        low = np.uint64((1 << 28) - 1)
        rank = (mix(grams) & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, least = 1, rank
        while width * 2 <= run:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < run:
            least = np.minimum(least[: len(rank) - run + 1], least[run - width :])
        chosen = (least[self.window_at] & low).astype(np.int64)
        self.at, self.own = np.unique(chosen, return_inverse=True)
        self.text = np.searchsorted(starts, self.at, side="right") - 1
        self.key = grams[self.at]

    def edges(self, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """48-bit hash of each node's edge in and edge out; the ends of a text are edges that only its copies share."""
        n = len(self.at)
        if not n:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        h = self.cut.hashes
        base = np.uint64(0xC2B2AE3D27D4EB4F)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ base) * powers(_STEP, len(h))[:-1])])
        lo, hi = self.at[:-1], self.at[1:] + self.k
        span = mix((total[hi] - total[lo]) * powers(_STEP_INVERSE, len(h))[lo] + (hi - lo).astype(np.uint64))
        same = self.text[1:] == self.text[:-1]
        lone = mix(salt[self.text] + mix(self.at - self.cut.starts[self.text]))
        before = np.append(lone[:1], np.where(same, span, lone[1:]))
        after = np.append(np.where(same, span, mix(lone[:-1])), mix(lone[-1:]))
        return before >> np.uint64(16), after >> np.uint64(16)


_STEP = np.uint64(0xE7037ED1A0B428DB | 5)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _occurrences(window: int, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, tx = b["text"].tolist(), b["tx"].to_numpy()
            for lo, hi in in_chunks(texts):
                nodes = Nodes(texts[lo:hi], window, k)
                if len(nodes.at):
                    before, after = nodes.edges(tx[lo:hi].view(np.uint64))
                    yield pd.DataFrame(
                        {
                            "node": _signed(nodes.key),
                            "before": _signed(before),
                            "after": _signed(after),
                            **{c: b[c].to_numpy()[lo:hi][nodes.text] for c in _OWN},
                            "at": (nodes.at - nodes.cut.starts[nodes.text]).astype(np.int32),
                        }
                    )

    return run


def _covered(starts: np.ndarray, n: int, window: int) -> np.ndarray:
    """Mask of the words that windows starting at ``starts`` cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:n]) > 0


def _outcome(text: str, mask: np.ndarray) -> tuple[int, int, str]:
    words = text.encode("utf-8", "surrogatepass").split()
    gone = int(mask.sum())
    if gone:
        words = [words[i] for i in np.flatnonzero(~mask)]
    return len(mask), gone, hashlib.sha256(b" ".join(words)).hexdigest()


# What names a text: its id (0 for none) and whether it has one, neither ever null so that pandas keeps them
# exact, and the text's digest, which tells texts of one id apart.
_OWN = ["doc_id", "named", "tx"]
_OWN_DDL = "doc_id bigint, named boolean, tx bigint"
_JUDGED = f"{_OWN_DDL}, n_words bigint, n_removed bigint, kept_sha256 string, packed binary, sure array<int>, at array<int>"


def _mark(at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place and node in one number, with two bits left for flags: tells texts of one id apart."""
    return (at.astype(np.int64) << 34) | ((key & np.uint64(0xFFFFFFFF)).astype(np.int64) << 2)


def _judge(window: int, k: int):
    """Windows inside paths are decided; the rest with a repeated node are handed on with their hashes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bodies, marks = b["packed"].tolist(), b["marks"].tolist()
            texts = [unpack(z) for z in bodies]
            for lo, hi in in_chunks(texts):
                nodes = Nodes(texts[lo:hi], window, k)
                starts = nodes.cut.starts
                flags = np.full(len(nodes.at), -1, np.int64)  # of repeated nodes: 1 one edge in, 2 one edge out
                first = np.searchsorted(nodes.text, np.arange(hi - lo + 1))
                for i in range(lo, hi):
                    if marks[i] is not None and len(marks[i]):
                        m = np.sort(np.asarray(marks[i], np.int64))
                        own = slice(first[i - lo], first[i - lo + 1])
                        here = _mark(nodes.at[own] - starts[i - lo], nodes.key[own])
                        j = np.minimum(np.searchsorted(m, here), len(m) - 1)
                        flags[own] = np.where(m[j] >> 2 == here >> 2, m[j] & 3, -1)
                cand = np.flatnonzero(flags[nodes.own] >= 0) if len(nodes.at) else np.empty(0, np.int64)
                at, own = nodes.window_at[cand], nodes.own[cand]
                # Nodes wholly inside the window. From its own node the path must not
                # branch on the way to either end, unless a node stands just there.
                begin = np.searchsorted(nodes.at, at)
                end = np.searchsorted(nodes.at, at + window - k, side="right")
                many_in = np.concatenate([[0], np.cumsum((flags < 0) | (flags & 1 == 0))])
                many_out = np.concatenate([[0], np.cumsum((flags < 0) | (flags & 2 == 0))])
                left = begin + (nodes.at[begin] == at) if len(cand) else begin
                right = end - (nodes.at[end - 1] == at + window - k) if len(cand) else end
                sure = (many_in[own + 1] <= many_in[np.minimum(left, own + 1)]) & (many_out[np.maximum(right, own)] <= many_out[own])
                cut = np.searchsorted(nodes.window_text[cand], np.arange(hi - lo + 1))
                rows = []
                for i in range(hi - lo):
                    mine = slice(cut[i], cut[i + 1])
                    place = (at[mine] - starts[i]).astype(np.int32)
                    s, n = place[sure[mine]], int(starts[i + 1] - starts[i])
                    if len(s) < len(place):
                        rows.append((n, None, None, bodies[lo + i], s, place[~sure[mine]]))
                    else:
                        rows.append((*_outcome(texts[lo + i], _covered(s, n, window)), None, None, None))
                out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "packed", "sure", "at"])
                out["n_removed"] = out["n_removed"].astype("Int64")
                yield pd.concat([b[_OWN].iloc[lo:hi].reset_index(drop=True), out], axis=1)

    return run


def _hashes(texts: list[str], places: list, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and 128-bit hash of the windows that start at ``places`` of each text."""
    cut = cut_words(texts)
    text = np.repeat(np.arange(len(texts)), [len(p) for p in places])
    at = np.concatenate([np.asarray(p, np.int64) for p in places])
    w = at + cut.starts[text]
    h2 = rolling(mix(cut.hashes ^ np.uint64(0x94D049BB133111EB)), window)
    return text, at, rolling(cut.hashes, window)[w], h2[w]


def _window_hashes(window: int):
    """The windows left to compare."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, places = [unpack(z) for z in b["packed"]], b["at"].tolist()
            for lo, hi in in_chunks(texts):
                text, at, h1, h2 = _hashes(texts[lo:hi], places[lo:hi], window)
                yield pd.DataFrame({**{c: b[c].to_numpy()[text + lo] for c in _OWN}, "at": at.astype(np.int32), "h1": _signed(h1), "h2": _signed(h2)})

    return run


def _finish(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, places = [unpack(z) for z in b["packed"]], b["at"].tolist()
            sure, more, n = b["sure"].tolist(), b["more"].tolist(), b["n_words"].tolist()
            for lo, hi in in_chunks(texts):
                text, at, h1, _ = _hashes(texts[lo:hi], places[lo:hi], window)
                marks, first = _mark(at, h1), np.searchsorted(text, np.arange(hi - lo + 1))
                rows = []
                for i in range(hi - lo):
                    mine = slice(first[i], first[i + 1])
                    found = more[lo + i]
                    again = at[mine][np.isin(marks[mine], np.asarray(found, np.int64))] if found is not None else at[:0]
                    starts = np.concatenate([np.asarray(sure[lo + i], np.int64), again])
                    rows.append((*_outcome(texts[lo + i], _covered(starts, int(n[lo + i]), window)),))
                out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])
                yield pd.concat([b[_OWN].iloc[lo:hi].reset_index(drop=True), out], axis=1)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = F.col(id_col).cast("bigint")
    rows = docs.select(F.coalesce(given, F.lit(0)).alias("doc_id"), given.isNotNull().alias("named"), F.xxhash64(text).alias("tx"), text.alias("text"))
    found = rows.mapInPandas(_occurrences(window, k), f"node bigint, before bigint, after bigint, {_OWN_DDL}, at int")
    spread = [f(c).alias(f"{c}_{n}") for c in ("before", "after") for n, f in (("lo", F.min), ("hi", F.max))]
    nodes = found.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *spread).where("n > 1")
    flags = (F.col("before_lo") == F.col("before_hi")).cast("bigint") + (F.col("after_lo") == F.col("after_hi")).cast("bigint") * 2
    nodes = materialise(nodes.select("node", flags.alias("flags")), "nodes")
    marks = found.select("node", *_OWN, "at").join(nodes, "node")
    mark = F.shiftleft(F.col("at").cast("bigint"), 34).bitwiseOR(F.shiftleft(F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)), 2)).bitwiseOR(F.col("flags"))
    # By id and text: however many rows share an id, a list is no longer than one text's.
    marks = marks.groupBy(*_OWN).agg(F.collect_set(mark).alias("marks"))
    bodies = rows.select(*_OWN, packed(F.col("text")).alias("packed"))
    both = bodies.join(marks, _OWN, "left")
    judged = materialise(both.select(*_OWN, "packed", "marks").mapInPandas(_judge(window, k), _JUDGED), "windows")
    done = judged.where("packed IS NULL").select("doc_id", "named", "n_words", "n_removed", "kept_sha256")
    pending = judged.where("packed IS NOT NULL")
    ends = pending.select(*_OWN, "packed", "at").mapInPandas(_window_hashes(window), f"{_OWN_DDL}, at int, h1 bigint, h2 bigint")
    twice = ends.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    twice = materialise(twice, "repeated-windows")  # a plain side for the join, so that a hot window's rows are split
    mark = F.shiftleft(F.col("at").cast("bigint"), 34).bitwiseOR(F.shiftleft(F.col("h1").bitwiseAND(F.lit(0xFFFFFFFF)), 2))
    more = ends.join(twice, ["h1", "h2"]).groupBy(*_OWN).agg(F.collect_set(mark).alias("more"))
    rest = pending.join(more, _OWN, "left")
    rest = rest.select(*_OWN, "packed", "n_words", "sure", "at", "more").mapInPandas(_finish(window), f"{_OWN_DDL}, n_words bigint, n_removed bigint, kept_sha256 string")
    out = done.unionByName(rest.select(*done.columns))
    return out.select(F.when(F.col("named"), F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
