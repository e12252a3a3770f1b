"""Ordered scans per key that stay parallel when one key holds most rows.

Running counts, running sums and "last non-null value so far" per key are
computed in two levels instead of one window over the whole key:

1. Rows are cut into blocks by a block column that never decreases along the
   order (for example ``seq div 1_000_000``, or the file and byte offset of a
   file split; any orderable, non-null value). A window partitioned by ``(key, block)`` gives the part of the scan
   inside the block; its size is bounded by the block.
2. One summary row per ``(key, block)`` is hash-aggregated from the same
   shuffled rows (no sort), a window over the summaries of each key gives
   what all earlier blocks contribute, and the result is joined back on
   ``(key, block)``. Only the summary table moves for that join (AQE
   broadcasts it when its measured size is small).

Both branches read one explicit shuffle of the rows: the row payload travels
as one struct that the summary branch also digests, and the block column is
not nullable (no inferred null filter lands on one side only), so column
pruning leaves the two exchanges identical and Spark reuses the first instead
of computing the input twice.

A hot key is spread over as many tasks as it has blocks, and the summary table
has one row per ``(key, block)`` pair. Keys are packed in one struct column so
that null key values group and join like any other value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BLOCK_ROWS = 1 << 20

_KEY = "__sc_key"
_BLOCK = "__sc_block"
_ROW = "__sc_row"


def block_of(order_value: Column, block_rows: int = DEFAULT_BLOCK_ROWS) -> Column:
    """Block number for an integral order value: ``order_value div block_rows``."""
    return F.floor(order_value / F.lit(block_rows)).cast("long")


def position_of(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def segmented_scan(
    df: DataFrame,
    keys: Sequence[str],
    block: Column | str,
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    inclusive: bool = False,
    position: Column | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add scan columns to ``df``.

    ``sums``: out column -> numeric expression; the running sum over the rows
    of the key before this row (``inclusive`` adds this row).
    ``lasts``: out column -> expression; the last non-null value over the rows
    of the key before this row (or up to it when ``inclusive``).
    ``totals``: out column -> numeric expression; the sum over all rows of the
    key.
    ``order`` must be a total order within a key. ``position``: optional
    single value rising with ``order``; a number keeps the block summary a
    hash aggregation. ``drop``: columns of ``df`` that are read by the expressions
    only and left out of the result. Columns that a caller never reads have to be
    named here: pruned later, on one of the two branches, they keep Spark from
    sharing the shuffle, and the input is computed twice.
    """
    sums = dict(sums or {})
    lasts = dict(lasts or {})
    totals = dict(totals or {})
    block_col = F.col(block) if isinstance(block, str) else block
    block_type = df.select(block_col).schema.fields[0].dataType
    if isinstance(block_type, T.IntegralType):
        # Not nullable, so no inferred null filter lands on one branch only.
        block_col = F.coalesce(block_col.cast("long"), F.lit(-1).cast("long"))
    payload = [c for c in df.columns if c not in keys and c not in order and c not in drop]

    values = [F.coalesce(e, F.lit(0)).alias(f"__sc_s_{n}") for n, e in sums.items()]
    values += [e.alias(f"__sc_l_{n}") for n, e in lasts.items()]
    values += [F.coalesce(e, F.lit(0)).alias(f"__sc_t_{n}") for n, e in totals.items()]
    base = df.select(
        F.struct(*[F.col(k) for k in keys]).alias(_KEY),
        block_col.alias(_BLOCK),
        *[F.col(c) for c in order],
        F.struct(*[F.col(c) for c in payload]).alias(_ROW),
        *values,
    )

    # One shuffle by (key, block), read by both branches below. Its partitions are
    # counted, so they are not merged by their bytes: rows are small here and may be the
    # telegrams of a capture afterwards, and as many tasks as cores end unevenly.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shuffled = base.repartition(tasks, _KEY, _BLOCK)

    in_block = Window.partitionBy(_KEY, _BLOCK).orderBy(*order)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    frame = upto if inclusive else before

    win = []
    for n in sums:
        win.append(F.coalesce(F.sum(f"__sc_s_{n}").over(frame), F.lit(0)).alias(f"__sc_is_{n}"))
    for n in lasts:
        win.append(F.last(f"__sc_l_{n}", ignorenulls=True).over(frame).alias(f"__sc_il_{n}"))
    rows = shuffled.select("*", *win)

    # Block summaries straight from the shuffled rows (hash aggregation, no
    # sort): block sums, the block's last non-null value, and a fixed-width
    # digest of the payload that keeps this branch reading the same shuffle.
    position = position_of(order) if position is None else position
    aggs = [F.sum(f"__sc_s_{n}").alias(f"__sc_bs_{n}") for n in sums]
    aggs += [
        F.max_by(F.col(f"__sc_l_{n}"), F.when(F.col(f"__sc_l_{n}").isNotNull(), position)).alias(f"__sc_bl_{n}")
        for n in lasts
    ]
    aggs += [F.sum(f"__sc_t_{n}").alias(f"__sc_bt_{n}") for n in totals]
    aggs.append(F.max(F.xxhash64(F.col(_ROW), *[F.col(c) for c in order])).alias("__sc_n"))
    summary = shuffled.groupBy(_KEY, _BLOCK).agg(*aggs)

    earlier = Window.partitionBy(_KEY).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(_KEY)
    carry = summary.select(
        F.col(_KEY).alias("__sc_ckey"),
        F.col(_BLOCK).alias("__sc_cblock"),
        "__sc_n",
        *[F.coalesce(F.sum(f"__sc_bs_{n}").over(earlier), F.lit(0)).alias(f"__sc_cs_{n}") for n in sums],
        *[F.last(f"__sc_bl_{n}", ignorenulls=True).over(earlier).alias(f"__sc_cl_{n}") for n in lasts],
        *[F.sum(f"__sc_bt_{n}").over(whole).alias(f"__sc_ct_{n}") for n in totals],
    )

    cond = (
        (rows[_KEY] == carry["__sc_ckey"])
        & (rows[_BLOCK] == carry["__sc_cblock"])
        & carry["__sc_n"].isNotNull()
    )
    joined = rows.join(carry, cond, "inner")
    outs = []
    for n in sums:
        outs.append((F.col(f"__sc_cs_{n}") + F.col(f"__sc_is_{n}")).alias(n))
    for n in lasts:
        outs.append(F.coalesce(F.col(f"__sc_il_{n}"), F.col(f"__sc_cl_{n}")).alias(n))
    for n in totals:
        outs.append(F.col(f"__sc_ct_{n}").alias(n))
    original = []
    for c in df.columns:
        if c in keys:
            original.append(F.col(f"{_KEY}.{c}").alias(c))
        elif c in order:
            original.append(F.col(c))
        elif c in payload:
            original.append(F.col(f"{_ROW}.{c}").alias(c))
    return joined.select(*original, *outs)


def dense_rank_in_key(
    df: DataFrame, keys: Sequence[str], block: Column | str, order: Sequence[str], out: str, start: int = 1
) -> DataFrame:
    """Row number per key in ``order`` (``start`` for the first row)."""
    scanned = segmented_scan(df, keys, block, order, sums={out: F.lit(1)}, inclusive=False)
    return scanned.withColumn(out, (F.col(out) + F.lit(start)).cast("long"))
