"""Telegram framing (C1) over input splits, without moving the lines.

Same result as ``operators.framing``, for lines that arrive in order within the
tasks that read them, as file splits do. The framing automaton has two states
(outside and inside a telegram), and over a whole split it is a map from the
state before to the state after: an end line makes the state after a constant,
a start line behind the last end line (or without any) makes it "inside", and a
split with neither changes nothing. So

1. each task frames the telegrams that lie wholly inside one of its splits,
   between the first and the last end line, as one row with an array of lines,
   gives out the pieces at both ends of a split, up to the first end line and
   from the start line behind the last one, and the split's map;
2. a window over a capture's maps in order gives the state and the number of
   end lines before each split;
3. only the pieces go through an exchange, by capture and telegram number.
   Pieces that the state before rules out, or that no later end line closes,
   are dropped before it.

The lines are read once: what step 1 gives, the maps and the joined pieces are
written to the shared checkpoint folder when the operator is applied. Telegrams
are numbered by the maps of the splits that have end lines before them. The size of
those is known then, so joining them is a broadcast while they are small and a
shuffle of framed telegrams beyond that, as the planner finds. A task holds the
lines of one telegram, and of one that is not closed up to the end of its split,
besides ``FLUSH`` bytes of rows. Null lines count as blank.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trim_space
from ..session import work_dir

BLANK, OTHER, START, END = range(4)

# What a row of the in-task pass holds.
TELEGRAM = 0  # a whole telegram; its number counts the end lines of the split before it
BEFORE = 1  # lines up to the first start or end line: needed when the state before is "inside"
FROM = 2  # lines from the first start line, up to the first end line
TAIL = 3  # lines from the first start line after the last end line
# The map of a split; its number counts the split's end lines. The state after is
KEEPS, OUTSIDE, INSIDE = 4, 5, 6  # as it was before, or a constant

FLUSH = 1 << 21  # bytes of rows that are given out as one batch


def _kind_of(line: Column) -> Column:
    return (
        F.when(line.startswith("!"), END).when(line.startswith("/"), START).when(line == "", BLANK).otherwise(OTHER)
    ).cast("tinyint")


class _Walk:
    """Cuts the lines of one split after the other into telegrams, or into end pieces
    (``edges``), or, with ``edges`` None, into both and the split's map.

    ``names``: the columns whose value at the first line goes with a row.
    """

    def __init__(self, names: list[str], edges: bool | None):
        self.names, self.edges = names, edges
        self.split: int | None = None

    def open(self, split: int) -> None:
        self.split, self.ends, self.pieces, self.started = split, 0, 0, False
        self.pending: list[pa.RecordBatch] = []  # from a start line on, not closed yet
        self.first: pa.RecordBatch | None = None

    def row(self, kind: int, numbers: np.ndarray, lines: pa.ListArray, firsts: pa.RecordBatch) -> pa.RecordBatch:
        own = [firsts.column(n) for n in self.names]
        head = [pa.array(np.full(len(numbers), kind), pa.int8()), pa.array(numbers, pa.int64()), lines]
        return pa.RecordBatch.from_arrays(own + head, names=self.names + ["__kind", "__no", "lines"])

    def piece(self, kind: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The non-blank lines of ``rows`` as one numbered piece."""
        if self.edges is False:
            return
        kept = rows.filter(pc.not_equal(rows.column("__flag"), BLANK))
        if kept.num_rows:
            lines = pa.ListArray.from_arrays(pa.array([0, kept.num_rows], pa.int32()), kept.column("line"))
            yield self.row(kind, np.array([self.pieces]), lines, kept.slice(0, 1))
            self.pieces += 1

    def close(self) -> Iterator[pa.RecordBatch]:
        """End of the split: what is open is its tail (without any end line it was given out as its head)."""
        if self.split is not None and self.ends:
            for rows in self.pending:
                yield from self.piece(TAIL, rows)
        if self.edges is None and self.split is not None:
            after = INSIDE if self.pending or (self.started and not self.ends) else OUTSIDE if self.ends else KEEPS
            none = pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), self.first.column("line").slice(0, 0))
            yield self.row(after, np.array([self.ends]), none, self.first)
        self.split = None

    def head(self, rows: pa.RecordBatch, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        if not self.started:
            starts = np.flatnonzero(flags == START)
            at = int(starts[0]) if len(starts) else len(flags)
            self.started = bool(len(starts))
            # The end line belongs to this part when no start line comes before it.
            yield from self.piece(BEFORE, rows.slice(0, at))
        yield from self.piece(FROM, rows.slice(at))

    def run(self, rows: pa.RecordBatch, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Some more lines of the open split."""
        if self.first is None:
            self.first = rows.slice(0, 1)
        ends = np.flatnonzero(flags == END)
        if not self.ends:
            upto = int(ends[0]) + 1 if len(ends) else len(flags)
            yield from self.head(rows.slice(0, upto), flags[:upto])
            if not len(ends):
                return
            self.ends = 1
            rows, flags, ends = rows.slice(upto), flags[upto:], ends[1:] - upto
        if len(ends):
            last = int(ends[-1]) + 1
            if not self.edges:  # telegrams alone, or with the pieces
                yield from self.telegrams(pa.Table.from_batches([*self.pending, rows.slice(0, last)]))
            self.ends += len(ends)
            self.pending = []
            rows, flags = rows.slice(last), flags[last:]
        if not self.pending:
            starts = np.flatnonzero(flags == START)
            at = int(starts[0]) if len(starts) else len(flags)
            rows = rows.slice(at)
        if rows.num_rows:
            self.pending.append(rows)

    def telegrams(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Telegrams of lines whose last is an end line and before which an end line stands."""
        rows = table.combine_chunks().to_batches()[0]
        flags = rows.column("__flag").to_numpy()
        ends, starts = np.flatnonzero(flags == END), np.flatnonzero(flags == START)
        if not len(starts):
            return
        lo = np.concatenate([[0], ends[:-1] + 1])
        first = starts[np.minimum(np.searchsorted(starts, lo), len(starts) - 1)]
        whole = (first >= lo) & (first < ends)  # segments that hold a start line
        if not whole.any():
            return
        inside = np.zeros(len(flags) + 1, np.int64)
        inside[first[whole]] += 1
        inside[ends[whole] + 1] -= 1
        keep = (np.cumsum(inside[:-1]) > 0) & (flags != BLANK)
        count = np.concatenate([[0], np.cumsum(keep)])
        offsets = np.append(count[first[whole]], count[ends[whole][-1] + 1])
        lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows.column("line").filter(pa.array(keep)))
        yield self.row(TELEGRAM, self.ends + np.flatnonzero(whole), lines, rows.take(pa.array(first[whole])))


def _whole_splits(names: list[str], rows: pa.RecordBatch, flags: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """What ``_Walk`` with ``edges`` None gives for splits that lie wholly in ``rows``, worked out for all of them at once.

    ``bounds``: where the splits begin, and the end of the last one. Every row that is
    given out is a range of lines, and the ranges do not overlap.
    """
    n, lo, hi = len(flags), bounds[:-1], bounds[1:]
    ends, starts = np.flatnonzero(flags == END), np.flatnonzero(flags == START)
    a, b = np.searchsorted(ends, lo), np.searchsorted(ends, hi)  # the split's end lines
    some = b > a
    ends_, starts_ = np.append(ends, n), np.append(starts, n)

    def start_in(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first start line of each range, or its end."""
        return np.minimum(starts_[np.searchsorted(starts, begin)], end)

    upto = np.where(some, ends_[np.where(some, a, len(ends))] + 1, hi)
    at = start_in(lo, upto)
    after = np.where(some, ends_[np.where(some, b - 1, len(ends))] + 1, hi)
    tail = start_in(after, hi)
    split_of = np.searchsorted(bounds, ends, side="right") - 1
    later = np.arange(len(ends)) > a[split_of]  # all end lines but a split's first one
    till = ends[later] + 1
    first = start_in(ends[np.flatnonzero(later) - 1] + 1, till)
    whole = first < till
    till, first, number = till[whole], first[whole], (np.arange(len(ends)) - a[split_of])[later][whole]

    kept = flags != BLANK
    count = np.concatenate([[0], np.cumsum(kept)])
    before = (count[at] > count[lo]).astype(np.int64)
    opened = at < upto
    state = np.where((tail < hi) | (opened & ~some), INSIDE, np.where(some, OUTSIDE, KEEPS))
    kinds = [np.full(len(lo), BEFORE), np.full(len(lo), FROM), np.full(len(till), TELEGRAM), np.full(len(lo), TAIL), state]
    numbers = [np.zeros(len(lo), np.int64), before, number, before + opened, b - a]
    begin, end = np.concatenate([lo, at, first, tail, hi]), np.concatenate([at, upto, till, hi, hi])
    kind, number = np.concatenate(kinds), np.concatenate(numbers)
    given = np.flatnonzero((count[end] > count[begin]) | (kind >= KEEPS))
    # By place; a split's map stands behind its last line and in front of the next split's.
    given = given[np.lexsort((kind[given] < KEEPS, begin[given]))]
    kind, number, begin, end = kind[given], number[given], begin[given], end[given]

    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, end, -1)
    wanted = kept & (np.cumsum(steps[:-1]) > 0)
    count = np.concatenate([[0], np.cumsum(wanted)])
    lines = pa.ListArray.from_arrays(pa.array(np.append(count[begin], count[n]), pa.int32()), rows.column("line").filter(pa.array(wanted)))
    is_map = kind >= KEEPS
    head = np.append(np.flatnonzero(wanted), 0)[np.where(is_map, -1, count[begin])]
    head[is_map] = lo[np.searchsorted(hi, begin[is_map])]
    firsts = rows.select(names).take(pa.array(head))
    parts = [pa.array(kind, pa.int8()), pa.array(number, pa.int64()), lines]
    return pa.RecordBatch.from_arrays([*firsts.columns, *parts], names=names + ["__kind", "__no", "lines"])


def _in_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``FLUSH`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += r.nbytes + 64
        if size >= FLUSH:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _pass(lines: DataFrame, keys: list[str], keep: list[str], edges: bool | None) -> DataFrame:
    """The in-task pass: rows ``keys, keep, __kind, __no, lines``."""
    names = keys + keep
    # A split is told from the next by the digest of its name.
    rows = lines.select(*names, F.xxhash64(*keys).alias("__split"), "__flag", "line")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(cuts(batches))

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _Walk(names, edges)
        for batch in batches:
            split, flags = batch.column("__split").to_numpy(), batch.column("__flag").to_numpy()
            bounds = np.array([0, *(np.flatnonzero(split[1:] != split[:-1]) + 1), len(split)], np.int64)
            runs = list(zip(bounds.tolist(), bounds[1:].tolist()))
            for i, (lo, hi) in enumerate(runs):
                if lo == hi:
                    continue
                if edges is None and 0 < i < len(runs) - 1:
                    # Neither the first nor the last one: no other batch holds a part of it.
                    if i == 1:
                        yield from cut.close()
                        inner = bounds[1:-1]
                        yield _whole_splits(names, batch.slice(lo, inner[-1] - lo), flags[lo : inner[-1]], inner - lo)
                    continue
                if cut.split != int(split[lo]):
                    yield from cut.close()
                    cut.open(int(split[lo]))
                yield from cut.run(batch.slice(lo, hi - lo), flags[lo:hi])
        yield from cut.close()

    schema = T.StructType(
        [rows.schema[n] for n in names]
        + [T.StructField("__kind", T.ByteType()), T.StructField("__no", T.LongType()), T.StructField("lines", T.ArrayType(T.StringType()))]
    )
    return rows.mapInArrow(walk, schema)


def split_maps(framed: DataFrame, capture: Sequence[str], split: Sequence[str]) -> DataFrame:
    """One row a split: the state before it, the end lines before it, in it and in its whole capture."""
    kind = F.col("__kind")
    maps = framed.where(kind >= KEEPS).select(
        *capture, *split, F.col("__no").alias("__ends"), F.when(kind != KEEPS, kind == INSIDE).alias("__after")
    )
    order = Window.partitionBy(*capture).orderBy(*split)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return maps.select(
        *capture,
        *split,
        F.coalesce(F.last("__after", ignorenulls=True).over(before), F.lit(False)).alias("__inside"),
        F.coalesce(F.sum("__ends").over(before), F.lit(0)).alias("__before"),
        "__ends",
        F.sum("__ends").over(Window.partitionBy(*capture)).alias("__total"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frame_splits(
    lines: DataFrame,
    capture: Sequence[str],
    split: Sequence[str],
    position: str,
    keep: Sequence[str] = (),
    line: str = "line",
    telegram_col: str = "telegram_no",
) -> DataFrame:
    """Complete telegrams as ``capture, telegram_no, keep, lines``.

    ``split``: columns that order a capture's splits (may repeat columns of
    ``capture``). A split's lines have to arrive in one task, one after the other,
    with ``position`` rising (it says the order, its values are not read). ``keep``: columns whose value at the start line is kept.
    The telegram number is that of ``operators.framing.frame_lines``.
    """
    capture, keep = list(capture), list(keep)
    split = [c for c in split if c not in capture]
    keys = capture + split
    names = [*keys, *[c for c in keep if c not in keys]]
    rows = lines.select(*names, F.coalesce(trim_space(F.col(line)), F.lit("")).alias("line"))
    rows = rows.withColumn("__flag", _kind_of(F.col("line")))

    extra = names[len(keys) :]
    framed = _written(_pass(rows, keys, extra, edges=None), "framed")
    maps = _written(split_maps(framed, capture, split), "split-maps")

    def placed(df: DataFrame, maps: DataFrame, how: str) -> DataFrame:
        renamed = maps.select(*[F.col(c).alias(f"__m_{c}") for c in keys], "__inside", "__before", "__ends", "__total")
        same = [F.col(c).eqNullSafe(F.col(f"__m_{c}")) for c in keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        return df.join(renamed, on, how)

    # A split without end lines before it numbers its telegrams itself.
    whole = placed(framed.where(F.col("__kind") == TELEGRAM), _written(maps.where("__before > 0"), "split-maps"), "left")
    number = F.coalesce(F.col("__before"), F.lit(0)) + F.col("__no")
    whole = whole.select(*capture, number.cast("long").alias(telegram_col), *extra, "lines")

    pieces = placed(framed.where(F.col("__kind").between(BEFORE, TAIL)), maps, "inner")
    number = F.when(F.col("__kind") == TAIL, F.col("__before") + F.col("__ends")).otherwise(F.col("__before"))
    pieces = pieces.withColumn(telegram_col, number.cast("long"))
    wanted = (F.col("__kind") != BEFORE) | F.col("__inside")
    pieces = pieces.where(wanted & (F.col(telegram_col) < F.col("__total")))
    piece = F.struct(*[F.col(c) for c in split], F.col("__kind"), F.col("__no"), *[F.col(c).alias(f"__k_{c}") for c in extra], F.col("lines"))
    joined = pieces.groupBy(*capture, telegram_col).agg(F.sort_array(F.collect_list(piece)).alias("__p"))
    joined = joined.select(*capture, telegram_col, *[F.col("__p")[0][f"__k_{c}"].alias(c) for c in extra], F.flatten(F.col("__p.lines")).alias("lines"))

    out = whole.unionByName(_written(joined, "end-pieces"))
    return out.select(*capture, telegram_col, *[c for c in keep if c not in capture], "lines")
