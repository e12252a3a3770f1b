"""Importance resampling towards a target distribution of hashed word features.

Features are all runs of 1 to ``max_run`` consecutive words, joined by one space,
repeats counted; a feature's bucket is the unsigned crc32 of its UTF-8 bytes modulo
``BUCKETS``. Bucket counts of the raw documents and of the target texts give every
bucket an integer gain (a log ratio with add-one smoothing, in thousandths); a
document's weight is the sum of its features' gains, looked up in one array. The
score adds Gumbel noise drawn from the document's id, so that the highest scores
are a sample without replacement in proportion to the weights.

The drawn rows are found without a global sort: scores are written once, and the
cutoff is bisected by exact count jobs over that table, first over the score, then,
among the rows tied at the cutoff, over the id, then over the row's number (ids
that repeat). Drawn rows are range-partitioned and sorted inside their partitions;
a partition's offset is the number of drawn rows before it. Nothing but counts and
the two bucket arrays, both of fixed size, reaches the driver.

Defined cases: a null text has no words; a null id counts as empty text in the
hash and comes after all ids in a tie; repeated rows are each scored and drawn;
an empty table gives no rows; extra columns are ignored. Ids are integers.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from meterflow.llm.common import materialise

# Fixed values of the definition.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # over UTF-8 bytes, after A-Z became a-z
BUCKETS = 10_000
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10

SLICE = 1 << 20  # bytes of a text whose words are held at once
MEMO = 1 << 18  # words whose bucket is remembered in a worker
_ROW_BITS = 33  # of monotonically_increasing_id that number the rows of a partition


class _Buckets(dict):
    """Bucket of a feature, remembered for the words that came last."""

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % BUCKETS
        return bucket


def _slices(text: bytes) -> Iterator[bytes]:
    """``text`` in slices of about SLICE bytes that cut no word."""
    word = re.compile(WORD)
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        rest = word.match(text, end)
        end = rest.end() if rest else end
        yield text[at:end]
        at = end


def _features(text: bytes | None, memo: _Buckets, max_run: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of each slice of a text."""
    word = re.compile(WORD)
    carried: list[bytes] = []
    for piece in _slices((text or b"").lower()):  # bytes.lower changes A-Z only
        words = word.findall(piece)
        found = [np.fromiter(map(memo.__getitem__, words), np.int64, len(words))]
        joined = carried + words
        for run in range(2, max_run + 1):
            first = max(len(carried) - run + 1, 0)
            runs = [b" ".join(joined[i : i + run]) for i in range(first, len(joined) - run + 1)]
            found.append(np.fromiter(map(memo.__getitem__, runs), np.int64, len(runs)))
        carried = joined[-(max_run - 1) :] if max_run > 1 else []
        yield len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, text_col: str = "text", max_run: int = 1) -> np.ndarray:
    """Occurrences of each bucket over all texts; every task sums its own first."""

    def count(batches):
        total, memo = np.zeros(BUCKETS, np.int64), _Buckets()
        for batch in batches:
            for text in batch.column(0):
                for _, buckets in _features(text.as_py(), memo, max_run):
                    np.add.at(total, buckets, 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Integer gain of each bucket, in doubles up to the floor."""
    s_all, t_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(raw, target))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, max_run: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def score(batches):
        memo = _Buckets()
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                for n_words, buckets in _features(text.as_py(), memo, max_run):
                    out[:, i] += n_words, len(buckets), gains[buckets].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=["doc_id", "n_words", "n_features", "weight"])

    schema = T.StructType([rows.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])
    return rows.mapInArrow(score, schema)


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Integer noise in thousandths, from the first 8 hex digits of the id's salted digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def _least(rows: DataFrame, value: str, need: int) -> tuple[int, int]:
    """Least ``v`` with at least ``need`` rows of ``value <= v``, and how many those are.

    Bisection by count jobs; ``need`` is at least 1 and at most the rows whose value is not null.
    """
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    upto = None
    while lo < hi:
        mid = (lo + hi) // 2
        n = rows.where(F.col(value) <= F.lit(mid)).count()
        if n == need:
            return mid, n
        if n > need:
            hi, upto = mid, n
        else:
            lo = mid + 1
    return lo, rows.where(F.col(value) <= F.lit(lo)).count() if upto is None else upto


def drawn_rows(scores: DataFrame, need: int) -> Column:
    """Condition that holds for exactly ``need`` rows of ``scores(fall, doc_id, row)``: the least by fall, id, row."""
    if need <= 0:
        return F.lit(False)
    cut, n = _least(scores, "fall", need)
    if n == need:
        return F.col("fall") <= F.lit(cut)
    above = F.col("fall") < F.lit(cut)
    at = F.col("fall") == F.lit(cut)
    need -= scores.where(above).count()
    tied = scores.where(at)
    named = tied.where("doc_id IS NOT NULL").count()
    if need > named:  # ids that are null come last
        row, _ = _least(tied.where("doc_id IS NULL"), "row", need - named)
        return above | (at & (F.col("doc_id").isNotNull() | (F.col("row") <= F.lit(row))))
    if need == named:
        return above | (at & F.col("doc_id").isNotNull())
    doc, n = _least(tied, "doc_id", need)
    below, same = F.col("doc_id") < F.lit(doc), F.col("doc_id") == F.lit(doc)
    if n == need:
        return above | (at & F.coalesce(below | same, F.lit(False)))
    need -= tied.where(below).count()
    row, _ = _least(tied.where(same), "row", need)
    return above | (at & F.coalesce(below | (same & (F.col("row") <= F.lit(row))), F.lit(False)))


def with_ranks(rows: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``rows`` numbered 1, 2, 3... by ``order``: a range partition each, offsets from the partitions' counts."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(placed.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("__part", F.shiftright("__at", _ROW_BITS))
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # One row a range partition, however many rows are drawn.
    placed = placed.join(F.broadcast(parts), "__part")
    rank = F.col("__before") + F.col("__at").bitwiseAND((1 << _ROW_BITS) - 1) + F.lit(1)
    return placed.withColumn(out, rank.cast("bigint")).drop("__at", "__part", "__before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    max_run: int = 1,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null where the row is not drawn.

    ``percent`` of the documents with ``min_words`` words or more are drawn, rounded down.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, max_run), bucket_counts(target, target_col, max_run))
    scored = weigh(docs, gains, id_col, text_col, max_run)
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # Ascending in `fall` is descending in score.
    scored = scored.withColumn("fall", -F.col("score")).withColumn("row", F.monotonically_increasing_id())
    scored = materialise(scored, "scored")
    able = scored.where(F.col("n_words") >= F.lit(min_words))
    need = able.count() * percent // 100
    drawn = (F.col("n_words") >= F.lit(min_words)) & drawn_rows(able.select("fall", "doc_id", "row"), need)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = with_ranks(scored.where(drawn), [F.col("fall"), F.col("doc_id").asc_nulls_last(), F.col("row")], "rank")
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*columns, "rank").unionByName(rest.select(*columns, "rank"))
