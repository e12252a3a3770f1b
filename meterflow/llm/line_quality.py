"""Document quality from a linear-chain conditional random field over lines.

Every line of a text gets surface features (lengths and character classes) and
those of its neighbours. A two-state chain (bad, good) over the lines is trained
on the document labels, each line carrying its document's label. A document's
score is the mean of the forward-backward marginals of "good", weighted by line
length, then mapped through a logistic fitted on the same labelled rows.

The chain is trained on at most ``sample`` labelled rows (those with the smallest
hash of their id; ``MAX_SAMPLE`` unless given), rows that repeat id and text counting once. Of a
text of more than ``STRETCH * STRETCHES`` lines it sees that many stretches of
consecutive lines, spread evenly from the first line to the last; the logistic is
fitted on scores of all lines of those rows. Scoring covers every line of every
text. Only the text feeds a score.

Defined cases: rows with a null id are scored, never trained on, and not held out; a null text counts as empty and is one empty line; labels that are
null are ignored, several labels of a document count by their largest; without
any usable label the score is 0.5 for all. Very long texts and single lines of
any length are scored whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import cut_words, in_chunks, materialise

MAX_SAMPLE = 4000
STRETCH = 20
STRETCHES = 10
THRESHOLD = 0.7
HELD_OUT = 2  # crc32 of the id modulo 4

# Character classes counted per line, by byte.
_UPPER, _LOWER, _DIGIT, _BLANK, _MARK, _BAR, _STOP, _HIGH = range(8)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _BLANK
_CLASS[ord("|")] = _BAR
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = _STOP
_CLASS[128:] = _HIGH
N_OWN = 15


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with neighbours, line lengths in bytes, first line of each text)."""
    cut = cut_words(texts, spans=True)
    data = np.frombuffer(cut.data, np.uint8)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = ends - begins
    per_text = np.fromiter(((t or "").count("\n") + 1 for t in texts), np.int64, len(texts))
    line = np.searchsorted(ends, cut.spans[:, 0])
    again = np.zeros(len(line), bool)
    again[1:] = (cut.hashes[1:] == cut.hashes[:-1]) & (line[1:] == line[:-1])
    first = np.concatenate([[0], np.cumsum(per_text)])
    kind = _CLASS[data]
    counts = np.empty((len(n), 8))
    for c in range(8):
        total = np.concatenate([[0], np.cumsum(kind == c, dtype=np.int64)])
        counts[:, c] = total[ends] - total[begins]
    size = np.maximum(n, 1)[:, None]
    words = counts[:, _BLANK] + 1
    last = np.where(n > 0, data[np.maximum(ends - 1, 0)], 0)
    head = np.where(n > 0, data[begins], 0)
    own = np.empty((len(n), N_OWN))
    own[:, :8] = counts / size
    own[:, 8] = np.log1p(n) / 8
    own[:, 9] = np.minimum(n / words, 30) / 10
    own[:, 10] = last == ord(".")
    own[:, 11] = (head >= 65) & (head <= 90)
    own[:, 12] = counts[:, _UPPER] / np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1)
    own[:, 13] = np.minimum(counts[:, _MARK] / words, 4)
    own[:, 14] = np.bincount(line[again], minlength=len(n)) / np.maximum(np.bincount(line, minlength=len(n)), 1)
    text_of = np.repeat(np.arange(len(texts)), per_text)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (text_of[1:] == text_of[:-1])[:, None]
    before[1:] = own[:-1] * same
    after[:-1] = own[1:] * same
    return np.hstack([own, before, after, np.ones((len(n), 1))]), n, first


class Chain:
    """Two-state chain: ``w`` weighs features for "good", ``t`` scores moves between states."""

    def __init__(self, w: np.ndarray, t: np.ndarray, scale: tuple[float, float] = (1.0, 0.0)):
        self.w, self.t, self.scale = w, t, scale

    def raw_scores(self, texts: list[str | None]) -> np.ndarray:
        x, n, first = line_features(texts)
        good, _ = _forward_backward(x @ self.w, first, self.t)
        weight = n + 1.0
        total = np.add.reduceat(good * weight, first[:-1])
        return total / np.add.reduceat(weight, first[:-1])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        p = np.clip(self.raw_scores(texts), 1e-6, 1 - 1e-6)
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * np.log(p / (1 - p)) + b)))


def _forward_backward(unary: np.ndarray, first: np.ndarray, t: np.ndarray):
    """Marginals of state 1, and expected moves (2 x 2, summed over all lines).

    Texts are taken longest first, so step j works on the texts that have a j-th
    line as one slice; the number of steps is the longest text's line count.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    start, length = first[:-1][order], lengths[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")
    e = np.exp(t - t.max())
    odds = np.exp(np.clip(unary, -30, 30))
    emit = np.stack([1 / (1 + odds), odds / (1 + odds)], 1)
    alpha = np.empty_like(emit)
    beta = np.ones_like(emit)
    for j in range(steps):
        at = start[: active[j]] + j
        a = emit[at] if j == 0 else (alpha[at - 1] @ e) * emit[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    for j in range(steps - 2, -1, -1):
        at = start[: active[j + 1]] + j
        b = (beta[at + 1] * emit[at + 1]) @ e.T
        beta[at] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    both /= both.sum(1, keepdims=True)
    moves = np.zeros((2, 2))
    follow = np.ones(len(unary), bool)
    follow[first[1:] - 1] = False
    i = np.flatnonzero(follow)
    if len(i):
        pair = alpha[i][:, :, None] * e[None] * (emit[i + 1] * beta[i + 1])[:, None, :]
        moves = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
    return both[:, 1], moves


def train(features: list[np.ndarray], stretches: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.15, l2: float = 1e-3) -> Chain:
    """Gradient ascent (Adam) on the likelihood of the line labels.

    ``stretches`` are the numbers of consecutive lines that make up each
    document's features; no move is learned from one stretch to the next.
    """
    x = np.vstack(features)
    lengths = np.array([len(f) for f in features])
    runs = np.concatenate(stretches)
    first = np.concatenate([[0], np.cumsum(runs)])
    y = np.repeat(labels, lengths).astype(float)
    # Documents count alike and classes count alike, however many lines they have.
    share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    weight = np.repeat(share / lengths, lengths)
    of_run = np.repeat(labels, [len(s) for s in stretches])
    same = np.zeros((2, 2))
    for v in (0, 1):
        same[v, v] = (runs[of_run == v] - 1).sum()
    total = max(same.sum(), 1)
    p = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for r in range(1, rounds + 1):
        w, t = p[:-4], p[-4:].reshape(2, 2)
        good, moves = _forward_backward(x @ w, first, t)
        g = np.concatenate([x.T @ (weight * (y - good)), 0.05 * ((same - moves) / total).ravel()]) - l2 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-9)
    return Chain(p[:-4].copy(), p[-4:].reshape(2, 2).copy())


def _calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic of the log-odds, by Newton steps with a small ridge."""
    p = np.clip(raw, 1e-6, 1 - 1e-6)
    x = np.stack([np.log(p / (1 - p)), np.ones(len(p))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (labels - q) - 1e-3 * (b - [1, 0])
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, g), -2, 2)
    return float(max(b[0], 0.0)), float(b[1])


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``doc_id, tx, quality, text`` of at most ``sample`` labelled rows that are not held out."""
    use = labels.where(held_out(F.col("doc_id")) == F.lit(False)).where("quality IS NOT NULL AND doc_id IS NOT NULL")
    use = use.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # The sample is bounded by a parameter, so joining it by broadcast is too.
    use = use.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text")).join(F.broadcast(use), "doc_id").withColumn("tx", F.xxhash64("text"))
    # An id may stand on any number of rows: the bound holds for rows, and is found without their texts.
    few = rows.select("doc_id", "tx").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "tx").limit(sample)
    rows = rows.join(F.broadcast(few), ["doc_id", "tx"]).select("doc_id", "tx", "quality", "text")
    return materialise(rows.dropDuplicates(["doc_id", "tx"]), "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, sample: int = MAX_SAMPLE) -> Chain | None:
    """Train on a bounded sample of the labelled rows that are not held out."""
    chosen = _sample(docs, labels, sample)
    rows = chosen.mapInPandas(_sample_features, "doc_id bigint, tx bigint, quality int, x binary, runs array<bigint>").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["tx"]))
    if not rows:
        return None
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, 3 * N_OWN + 1).astype(float) for r in rows]
    y = np.array([int(r["quality"] > 0) for r in rows])
    if y.min() == y.max():
        return None
    model = train(x, [np.array(r["runs"], np.int64) for r in rows], y)
    scored = chosen.mapInPandas(_sample_scores(model), "doc_id bigint, tx bigint, raw double").collect()
    raw = {(r["doc_id"], r["tx"]): r["raw"] for r in scored}
    model.scale = _calibrate(np.array([raw[r["doc_id"], r["tx"]] for r in rows]), y)
    return model


def spread_lines(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of a text of ``n`` that training sees, and the lengths of their stretches."""
    if n <= STRETCH * STRETCHES:
        return np.arange(n), np.array([n])
    begin = np.arange(STRETCHES) * (n - STRETCH) // (STRETCHES - 1)
    return (begin[:, None] + np.arange(STRETCH)).ravel(), np.full(STRETCHES, STRETCH)


def _sample_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = b["text"].tolist()
        for lo, hi in in_chunks(texts):
            x, _, first = line_features(texts[lo:hi])
            picked = [spread_lines(int(n)) for n in np.diff(first)]
            rows = [x[first[i] + at].astype(np.float32).tobytes() for i, (at, _) in enumerate(picked)]
            yield b.iloc[lo:hi][["doc_id", "tx", "quality"]].assign(x=rows, runs=[runs for _, runs in picked])


def _sample_scores(model: Chain):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in in_chunks(texts):
                yield b.iloc[lo:hi][["doc_id", "tx"]].assign(raw=model.raw_scores(texts[lo:hi]))

    return run


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def score_column(model: Chain | None, text):
    """Quality score of a text column."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            texts = b.tolist()
            out = [model.scores(texts[lo:hi]) for lo, hi in in_chunks(texts)]
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = fit(docs, labels)
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
