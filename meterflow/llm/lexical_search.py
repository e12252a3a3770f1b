"""Ranked lexical search: a sharded block index and Block-Max MaxScore over it.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lowered; inside the index a term is its 64-bit hash. A shard holds the lists of the
documents of about ``SHARD_CHARS`` characters, whole texts. A list is cut into
blocks of ``BLOCK`` postings. A block's first document and greatest impact lie
open, its documents and counts are packed bytes. An impact is the part of the score
that does not depend on the term's weight, so it is known when a shard is built:
two sums over all documents (their number and their terms) are taken before.

Queries run against all shards in blocks of items. In a shard, a query's lists are
ordered by their global bound (weight times the list's greatest impact). Lists are
opened from the highest bound on until the bounds of the rest together stay below
the score of the tenth best so far: these are the essential lists. For the
documents found there the other lists are asked one by one: a candidate whose score
so far, the maximum of its block and the bounds still to come stay below the
threshold is rejected before any block is unpacked. A bound equal to the threshold
rejects nothing, since ties are broken by id. The best of a task's shards are kept
in one heap an item, which also gives the next shard its threshold; the heaps of
all tasks are merged by a window.

Scores are integers, see ``impacts`` and ``weight_of``, the result is exact.

Defined cases: a null or empty text has no terms and is found by nothing; an item
without terms, or of none that a document holds, gives no rows; a null id comes
after all ids in a tie; repeated rows of documents are each ranked, repeated rows
of items are each answered; empty tables give no rows; extra columns are ignored.
Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from meterflow.llm.common import CHUNK_BYTES, cut_words, in_chunks, materialise

BLOCK = 128
SHARD_CHARS = 1 << 23
SHARD_DOCS = 1 << 16  # so that a place in a shard fits 16 bits
TOP = 10
ITEM_CHARS = 1 << 22  # characters of the items that are answered in one pass

# Fixed values of the score.
B = 90
K1_FACTOR = 8
SCALE = 1_000_000_000

INDEX = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("term", T.LongType()),  # null: the shard's documents
        T.StructField("n", T.LongType()),  # documents of the list
        T.StructField("firsts", T.ArrayType(T.IntegerType())),
        T.StructField("tops", T.ArrayType(T.IntegerType())),
        T.StructField("docs", T.BinaryType()),  # places after the block's first, 1 or 2 bytes each
        T.StructField("counts", T.BinaryType()),  # 1, 2 or 4 bytes each
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("norms", T.ArrayType(T.LongType())),
    ]
)


def norms(n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    return 100 - B + (B * n_terms * n_docs) // all_terms


def impacts(counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (SCALE * counts) // (1000 * counts + K1_FACTOR * norm)


def weight_of(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_hashes(texts: list[str | None]):
    """Terms of the texts as signed 64-bit hashes, and per text the place of its first term."""
    cut = cut_words(texts, lower=True, plain=True)
    return cut.hashes.view(np.int64), cut.starts


# --- building ---------------------------------------------------------------


def corpus_sums(texts: DataFrame) -> tuple[int, int]:
    """Documents with at least one term, and all terms, of ``texts(text)``."""

    def count(batches):
        docs = terms = 0
        for batch in batches:
            chunk = batch.column(0).to_pylist()
            for lo, hi in in_chunks(chunk):
                n = np.diff(term_hashes(chunk[lo:hi])[1])
                docs, terms = docs + int((n > 0).sum()), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [terms]})

    row = texts.mapInArrow(count, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _packed(values: np.ndarray, starts: np.ndarray, widths: tuple[int, ...]) -> pa.Array:
    """Unsigned little-endian bytes of ``values``, cut into lists at ``starts``; a list has one width."""
    top = np.maximum.reduceat(values, starts)
    width = np.array(widths)[np.searchsorted([1 << (8 * w) for w in widths], top, side="right")]
    sizes = np.diff(np.append(starts, len(values)))
    each = np.repeat(width, sizes)
    ends = np.cumsum(each)
    out = np.zeros(int(ends[-1]), np.uint8)
    at = ends - each
    for byte in range(widths[-1]):
        has = each > byte
        out[at[has] + byte] = (values[has] >> (8 * byte)) & 255
    offsets = np.concatenate([[0], np.cumsum(width * sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _nested(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


class _Shard:
    """Documents gathered until a shard is full."""

    def __init__(self):
        self.ids, self.terms, self.places, self.sizes, self.chars = [], [], [], [], 0

    def add(self, ids: list, texts: list[str | None]) -> None:
        hashes, starts = term_hashes(texts)
        self.terms.append(hashes)
        self.places.append(np.repeat(np.arange(len(texts)) + len(self.ids), np.diff(starts)))
        self.sizes.append(np.diff(starts))
        self.ids += ids
        self.chars += sum(len(t) for t in texts if t)

    def batches(self, number: int, n_docs: int, all_terms: int) -> Iterator[pa.RecordBatch]:
        """The shard's documents as one row, then its lists in the order of their terms."""
        norm = norms(np.concatenate(self.sizes), n_docs, max(all_terms, 1))
        lists = self._lists(norm)
        none = lambda kind, n: pa.nulls(n, kind)
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        names = INDEX.fieldNames()
        own = [pa.array([number], pa.int64()), none(pa.int64(), 1), pa.array([len(norm)], pa.int64()), none(ints, 1), none(ints, 1), none(pa.binary(), 1), none(pa.binary(), 1)]
        yield pa.RecordBatch.from_arrays([*own, pa.array([self.ids], longs), pa.array([norm], longs)], names=names)
        if lists is not None:
            n = len(lists[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), *lists, none(longs, n), none(longs, n)], names=names)

    def _lists(self, norm: np.ndarray) -> list[pa.Array] | None:
        terms, places = np.concatenate(self.terms), np.concatenate(self.places)
        if not len(terms):
            return None
        order = np.argsort(terms, kind="stable")  # places rise inside a term
        terms, places = terms[order], places[order]
        new = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (places[1:] != places[:-1])]))
        counts = np.diff(np.append(new, len(terms)))
        terms, places = terms[new], places[new]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        sizes = np.diff(np.append(starts, len(terms)))
        blocks = -(-sizes // BLOCK)
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begins = np.repeat(starts, blocks) + number * BLOCK
        spans = np.diff(np.append(begins, len(terms)))
        tops = np.maximum.reduceat(impacts(counts, norm[places]), begins)
        return [
            pa.array(terms[starts]),
            pa.array(sizes),
            _nested(places[begins], blocks, pa.int32()),
            _nested(tops, blocks, pa.int32()),
            _packed(places - np.repeat(places[begins], spans), starts, (1, 2)),
            _packed(counts, starts, (1, 2, 4)),
        ]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_chars: int = SHARD_CHARS) -> tuple[DataFrame, int]:
    """The written index of all documents, and the number of documents that hold a term."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_docs, all_terms = corpus_sums(rows.select("text"))

    def build(batches):
        shard, number = _Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for lo, hi in in_chunks(texts, min(CHUNK_BYTES, shard_chars)):
                for a in range(lo, hi, SHARD_DOCS):
                    b = min(a + SHARD_DOCS, hi)
                    if shard.ids and len(shard.ids) + b - a > SHARD_DOCS:
                        yield from shard.batches(number, n_docs, all_terms)
                        shard, number = _Shard(), number + 1
                    shard.add(ids[a:b], texts[a:b])
                if shard.chars >= shard_chars:
                    yield from shard.batches(number, n_docs, all_terms)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield from shard.batches(number, n_docs, all_terms)

    return materialise(rows.mapInArrow(build, INDEX), "lexical-index"), n_docs


# --- searching --------------------------------------------------------------


class Query:
    """Terms of an item and their weights."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray):
        self.terms, self.weights = terms, weights


class Heap:
    """The best documents so far: score falling, then id rising, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.score = self.id = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    @property
    def threshold(self) -> int:
        """Least score that can still enter; a document without any term never does."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def offer(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        best = np.lexsort((ids, null, -score))[: self.top]
        self.score, self.id, self.null = score[best], ids[best], null[best]


class Lists:
    """The lists of one shard that a block of items needs."""

    def __init__(self, rows: pa.Table):
        own = rows.filter(pa.compute.is_null(rows["term"])).to_pylist()[0]
        self.null = np.array([i is None for i in own["ids"]])
        self.ids = np.array([0 if i is None else i for i in own["ids"]], np.int64)
        self.norms = np.array(own["norms"], np.int64)
        rows = rows.filter(pa.compute.is_valid(rows["term"])).sort_by("term").combine_chunks()
        self.terms = rows["term"].to_numpy()
        self.sizes = rows["n"].to_numpy()
        blocks = -(-self.sizes // BLOCK)
        self.begin = np.concatenate([[0], np.cumsum(blocks)])
        self.firsts, self.tops = (np.concatenate([c.flatten().to_numpy() for c in rows[n].chunks] or [np.empty(0, np.int32)]).astype(np.int64) for n in ("firsts", "tops"))
        self.best = np.maximum.reduceat(self.tops, self.begin[:-1]) if len(self.terms) else self.tops
        self.packed = rows["docs"], rows["counts"]
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.single: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _unpack(self, at: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, impacts) of the postings lo..hi of a list; lo begins a block."""
        out = []
        for column in self.packed:
            body = column[at].as_buffer()
            width = len(body) // int(self.sizes[at])
            out.append(np.frombuffer(body, f"<u{width}")[lo:hi].astype(np.int64))
        first = self.firsts[self.begin[at] + lo // BLOCK : self.begin[at + 1]]
        places = out[0] + np.repeat(first, BLOCK)[: hi - lo]
        return places, impacts(out[1], self.norms[places])

    def list(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        if at not in self.whole:
            self.whole[at] = self._unpack(at, 0, int(self.sizes[at]))
        return self.whole[at]

    def blocks(self, at: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, impacts) of some blocks of a list, in order."""
        if at in self.whole or 2 * len(numbers) > self.begin[at + 1] - self.begin[at]:
            return self.list(at)
        parts = []
        for b in numbers.tolist():
            if (at, b) not in self.single:
                self.single[at, b] = self._unpack(at, b * BLOCK, min((b + 1) * BLOCK, int(self.sizes[at])))
            parts.append(self.single[at, b])
        return np.concatenate([p for p, _ in parts]), np.concatenate([i for _, i in parts])


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th greatest score, 0 where there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_shard(lists: Lists, query: Query, heap: Heap) -> None:
    """Offer the documents of a shard that can enter the heap."""
    at = np.searchsorted(lists.terms, query.terms)
    at[at == len(lists.terms)] = 0
    here = lists.terms[at] == query.terms if len(lists.terms) else np.zeros(len(at), bool)
    at, weights = at[here], query.weights[here]
    bounds = weights * lists.best[at] if len(at) else weights
    order = np.argsort(-bounds, kind="stable")
    at, weights, bounds = at[order].tolist(), weights[order].tolist(), bounds[order]
    left = np.append(np.cumsum(bounds[::-1])[::-1], 0).tolist()  # bound of the lists from here on

    # Essential lists, by falling bound, until the others cannot lift a document alone.
    threshold, partial, i = heap.threshold, np.zeros(len(lists.ids), np.int64), 0
    while i < len(at) and left[i] >= threshold:
        places, impact = lists.list(at[i])
        partial[places] += weights[i] * impact
        threshold = max(threshold, _kth(partial[places], heap.top))
        i += 1
    found = np.flatnonzero(partial)
    score = partial[found]

    for j in range(i, len(at)):
        fit = score + left[j] >= threshold
        found, score = found[fit], score[fit]
        if not len(found):
            return
        lo, hi = lists.begin[at[j]], lists.begin[at[j] + 1]
        block = np.searchsorted(lists.firsts[lo:hi], found, side="right") - 1
        top = np.where(block >= 0, weights[j] * lists.tops[lo + np.maximum(block, 0)], 0)
        fit = score + top + left[j + 1] >= threshold
        found, score, block = found[fit], score[fit], block[fit]
        wanted = np.unique(block[block >= 0])
        if len(wanted):
            places, impact = lists.blocks(at[j], wanted)
            hit = np.minimum(np.searchsorted(places, found), len(places) - 1)
            score = score + np.where(places[hit] == found, weights[j] * impact[hit], 0)
            threshold = max(threshold, _kth(score, heap.top))
    fit = score >= max(threshold, 1)
    if fit.any():
        heap.offer(score[fit], lists.ids[found[fit]], lists.null[found[fit]])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one shard after the other; rows come sorted by shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if held and held[0].column(0)[0].as_py() != int(shard[lo]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, distinct terms) of the items, in blocks of about ITEM_CHARS characters."""
    ids, terms, chars = [], [], 0
    for r in items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        ids.append(r["i"])
        terms.append(np.unique(term_hashes([r["t"]])[0]))
        chars += len(r["t"] or "") + 1
        if chars >= ITEM_CHARS:
            yield ids, terms
            ids, terms, chars = [], [], 0
    if ids:
        yield ids, terms


def search_block(spark: SparkSession, index: DataFrame, n_docs: int, terms: list[np.ndarray], top: int) -> DataFrame:
    """``item, score, doc_id`` of the best documents for the items, numbered from 0; one heap a task."""
    wanted = np.unique(np.concatenate(terms))
    table = spark.createDataFrame(pa.table({"term": wanted}))
    # The terms of one block of items, at most about ITEM_CHARS / 2.
    lists = index.join(F.broadcast(table), "term", "left_semi").select(*INDEX.fieldNames())
    df = {r["term"]: r["n"] for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    queries = []
    for t in terms:
        t = t[[x in df for x in t.tolist()]] if len(t) else t
        queries.append(Query(t, np.array([weight_of(n_docs, df[x]) for x in t.tolist()], np.int64)))
    shared = spark.sparkContext.broadcast(queries)

    def run(batches):
        queries = shared.value
        heaps = [Heap(top) for _ in queries]
        for rows in _shards(batches):
            lists = Lists(rows)
            for query, heap in zip(queries, heaps):
                if len(query.terms):
                    search_shard(lists, query, heap)
        item = np.repeat(np.arange(len(heaps)), [len(h.score) for h in heaps])
        score, ids, null = (np.concatenate([np.empty(0, kind)] + [getattr(h, f) for h in heaps]) for f, kind in (("score", np.int64), ("id", np.int64), ("null", bool)))
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(ids, mask=null)], names=["item", "score", "doc_id"])

    rows = index.where("term IS NULL").unionByName(lists).repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    query_col: str = "text",
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item, scores above 0."""
    spark = docs.sparkSession
    index, n_docs = build_index(docs, id_col, text_col, shard_chars)
    out = None
    for ids, terms in item_blocks(items, item_col, query_col):
        heaps = search_block(spark, index, n_docs, terms, top)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = heaps.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(ids)), "item bigint, item_id bigint")
        ranked = materialise(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
