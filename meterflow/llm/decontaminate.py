"""Benchmark decontamination: SimHash windows, multi-index blocks, exact check.

An item of n words is compared with every window of n words of every document.
Both become weighted sets of word shingles (five words; the whole sequence of a
shorter item), weights being counts. A window can reach the threshold only if
enough of its shingles occur in the item, so fingerprints are taken of exactly
the windows that hold that many; this drops no match. A text shorter than the
item is one window, which needs fewer of them and is decided without a
fingerprint, by the exact check alone. Fingerprints have 128
bits. An item's fingerprint is indexed in eight blocks of 16 bits; two
fingerprints within ``RADIUS`` bits agree in some block up to ``RADIUS // 8``
bits, so probing every block within that distance finds all pairs within the
radius. What is found is decided by the exact weighted Jaccard similarity.

The benchmark is read in blocks of bounded size, one pass over the documents per
block, so nothing of unknown size is sent to tasks. Documents are never shuffled.

Defined cases: letters are lower-cased and every ASCII character that is no
letter or digit separates words; a null text counts as empty; an item without
words matches nothing; repeated items are each reported; of equally similar
windows the first is reported. Texts and items of any length are read whole.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import cut_words, in_chunks, mix, rolling

SHINGLE = 5
PERCENT = 80
RADIUS = 40
BLOCKS = 8
BLOCK_ITEMS = 20_000  # items per pass
BLOCK_CHARS = 8_000_000  # text per pass
MATCH = "array<struct<item_id: bigint, similarity: double, start_word: bigint, n_words: bigint>>"

_SEEDS = (np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B))


def _bits(shingles: np.ndarray) -> np.ndarray:
    """128 bits of each shingle as +1 / -1."""
    words = np.stack([mix(shingles ^ s) for s in _SEEDS], 1)
    return np.unpackbits(words.view(np.uint8), axis=1).astype(np.int16) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """128-bit fingerprints, as eight 16-bit blocks, of summed bit votes."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


class Items:
    """Index of one block of benchmark items."""

    def __init__(self, ids: list, texts: list[str]):
        cut = cut_words([t.lower() for t in texts], plain=True)
        self.ids = np.array([-1 if i is None else i for i in ids], np.int64)
        self.null = np.array([i is None for i in ids], bool)
        self.words = cut.counts
        self.k = np.minimum(self.words, SHINGLE)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        keys, prints = [], []
        for i, (lo, hi) in enumerate(zip(cut.starts[:-1], cut.starts[1:])):
            g = rolling(cut.hashes[lo:hi], int(self.k[i])) if hi > lo else np.empty(0, np.uint64)
            u, c = np.unique(g, return_counts=True)
            self.grams.append((u, c))
            keys.append(u)
            prints.append(fingerprint(_bits(g).sum(0, dtype=np.int32)[None])[0] if len(g) else np.zeros(BLOCKS, np.uint16))
        owner = np.repeat(np.arange(len(keys)), [len(u) for u in keys])
        flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], owner[order]
        self.sizes = sorted(set(self.k[self.words > 0].tolist()))
        # A byte table in front of the sorted keys answers most probes at once.
        self.door = np.zeros(1 << 20, bool)
        self.door[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.prints = np.stack(prints) if prints else np.zeros((0, BLOCKS), np.uint16)

    def near(self, item: int, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints some block brings up for ``item`` and the radius confirms."""
        apart = np.bitwise_count(prints ^ self.prints[item])
        return (apart <= RADIUS // BLOCKS).any(1) & (apart.sum(1, dtype=np.int64) <= RADIUS)

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Positions whose shingle some item holds."""
        at = np.flatnonzero(self.door[(grams >> np.uint64(44)).astype(np.int64)])
        i = np.searchsorted(self.keys, grams[at])
        return at[self.keys[np.minimum(i, len(self.keys) - 1)] == grams[at]]


def _need(total: int, shingles: int) -> int:
    """Hits that a window of a text of so many shingles needs to be similar to an item of ``total``."""
    return -(-PERCENT * (total + min(total, shingles)) // (100 + PERCENT))


def _best_window(items: Items, item: int, grams: np.ndarray, at: np.ndarray) -> tuple[float, int] | None:
    """Best window of the item's size in a text: ``at`` are the positions of its shingles."""
    wanted, counts = items.grams[item]
    total = int(counts.sum())  # shingles of the item, and of a window
    need = _need(total, len(grams))
    best = None
    # Windows that hold `need` hits begin shortly before the first of `need` hits in reach.
    for j in range(len(at) - need + 1):
        if at[j + need - 1] - at[j] >= total:
            continue
        lo = max(int(at[j + need - 1]) - total + 1, 0 if j == 0 else int(at[j - 1]) + 1, 0)
        hi = int(at[j])
        starts = np.arange(lo, min(hi, max(len(grams) - total, 0)) + 1)
        if not len(starts):
            continue
        if len(grams) >= total:
            region = grams[starts[0] : starts[-1] + total]
            votes = np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(_bits(region), 0, dtype=np.int32)])
            prints = fingerprint(votes[total + np.arange(len(starts))] - votes[np.arange(len(starts))])
            starts = starts[items.near(item, prints)]
        for s in starts:
            u, c = np.unique(grams[s : s + total], return_counts=True)
            p = np.searchsorted(wanted, u)
            same = wanted[np.minimum(p, len(wanted) - 1)] == u
            both = int(np.minimum(c[same], counts[p[same]]).sum())
            union = total + int(c.sum()) - both
            if 100 * both >= PERCENT * union and (best is None or both / union > best[0]):
                best = (both / union, int(s))
    return best


def _matches(items: Items, texts: list[str]) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in texts]
    if not len(items.keys):
        return out
    cut = cut_words([t.lower() for t in texts], plain=True)
    found: dict[tuple[int, int], list[np.ndarray]] = {}
    for k in items.sizes:
        grams = rolling(cut.hashes, k)
        at = items.hits(grams)
        text = np.searchsorted(cut.starts, at, side="right") - 1
        fits = at + k <= cut.starts[text + 1]  # not over the end of a text
        at, text = at[fits], text[fits]
        lo = np.searchsorted(items.keys, grams[at], side="left")
        hi = np.searchsorted(items.keys, grams[at], side="right")
        n = hi - lo
        owner = items.owner[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        pos, text = np.repeat(at, n), np.repeat(text, n)
        fit = items.k[owner] == k
        owner, pos, text = owner[fit], pos[fit], text[fit]
        order = np.lexsort((pos, owner, text))
        owner, pos, text = owner[order], pos[order], text[order]
        edges = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])])) if len(owner) else np.empty(0, int)
        for a, b in zip(edges, np.append(edges[1:], len(owner))):
            i, t = int(owner[a]), int(text[a])
            total = int(items.words[i] - items.k[i] + 1)
            start, end = cut.starts[t], cut.starts[t + 1]
            if b - a < _need(total, int(end - start) - k + 1):
                continue
            hit = _best_window(items, i, grams[start : end - k + 1], pos[a:b] - start)
            if hit:
                out[t].append({"item_id": None if items.null[i] else int(items.ids[i]), "similarity": hit[0], "start_word": hit[1], "n_words": int(items.words[i])})
    return out


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """Blocks of bounded size of the benchmark."""
    ids, texts, chars = [], [], 0
    for r in benchmark.select(F.col(id_col).cast("bigint").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")).toLocalIterator():
        ids.append(r["i"])
        texts.append(r["t"])
        chars += len(r["t"])
        if len(ids) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield Items(ids, texts)
            ids, texts, chars = [], [], 0
    if ids:
        yield Items(ids, texts)


def match_column(spark, items: Items, text):
    """Array of matches of a text column with one block of items."""
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(MATCH)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            texts = b.tolist()
            yield pd.Series([m for lo, hi in in_chunks(texts) for m in _matches(shared.value, texts[lo:hi])], dtype=object)

    return match(F.coalesce(text.cast("string"), F.lit("")))


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words`` of every item found in a document."""
    spark = docs.sparkSession
    out = None
    for items in item_blocks(benchmark):
        m = docs.select("doc_id", F.explode(match_column(spark, items, F.col("text"))).alias("m")).select("doc_id", "m.*")
        out = m if out is None else out.union(m)
    return out if out is not None else spark.createDataFrame([], "doc_id bigint, item_id bigint, similarity double, start_word bigint, n_words bigint")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no item is found, all columns."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col("text").alias("t"))
    for items in item_blocks(benchmark):
        row = row.where(F.size(match_column(docs.sparkSession, items, F.col("t"))) == 0)
    return row.select("row.*")
