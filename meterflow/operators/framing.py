"""Telegram framing (C1): ordered text lines of a capture -> telegram lines.

Reading a capture line by line, a telegram starts at a line beginning with
``/`` (leading whitespace ignored), collects the non-empty lines after it, and
ends with a line beginning with ``!``. Lines before a start line are noise, a
``/`` inside a telegram is ordinary content, and a telegram without an end line
(end of capture) is dropped.

The same result without a state machine: number the segments of a capture by
the count of ``!`` lines strictly before each line. A line belongs to a
telegram when a ``/`` line of its own segment comes at or before it, and its
segment is closed by a later (or its own) ``!`` line. All three facts come out
of one block scan per capture (``operators.scan``), so a long capture is
framed by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import trim_space
from .scan import segmented_scan


def frame_lines(
    lines: DataFrame,
    capture: Sequence[str],
    order: Sequence[str],
    block: Column | str,
    line: str = "line",
    telegram_col: str = "telegram_no",
    position: Column | None = None,
) -> DataFrame:
    """Keep the lines that belong to complete telegrams.

    ``position``: optional single value rising with ``order`` (for example
    ``seq * 2**20 + line_no``); comparing one number is cheaper than
    comparing the ``order`` columns as a struct.

    Returns the input columns with ``line`` trimmed and ``telegram_col`` (the
    number of end lines before the telegram's end line in its capture; numbers
    of segments that hold no telegram are skipped).
    """
    t = trim_space(F.col(line))
    df = lines.withColumn(line, t)
    is_bang = F.col(line).startswith("!")
    is_slash = F.col(line).startswith("/")
    pos = position if position is not None else F.struct(*[F.col(c) for c in order])
    scanned = segmented_scan(
        df,
        keys=capture,
        block=block,
        order=order,
        sums={"__seg": F.when(is_bang, 1).otherwise(0)},
        lasts={"__last_bang": F.when(is_bang, pos), "__last_slash": F.when(is_slash, pos)},
        totals={"__bangs": F.when(is_bang, 1).otherwise(0)},
        inclusive=False,
        position=position,
    )
    ls, lb = F.col("__last_slash"), F.col("__last_bang")
    started = is_slash | (ls.isNotNull() & (lb.isNull() | (ls > lb)))
    closed = F.col("__seg") < F.col("__bangs")
    kept = scanned.where(started & closed & (F.col(line) != ""))
    return kept.withColumn(telegram_col, F.col("__seg").cast("long")).drop(
        "__seg", "__last_bang", "__last_slash", "__bangs"
    )


def telegram_summary(
    telegram_lines: DataFrame, capture: Sequence[str], order: Sequence[str], line: str = "line",
    telegram_col: str = "telegram_no", position: Column | None = None, carry: dict | None = None,
) -> DataFrame:
    """One row per telegram: line count, first and last line (plus ``carry`` aggregates)."""
    pos = position if position is not None else F.struct(*[F.col(c) for c in order])
    return telegram_lines.groupBy(*capture, telegram_col).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min_by(F.col(line), pos).alias("first_line"),
        F.max_by(F.col(line), pos).alias("last_line"),
        *[expr.alias(name) for name, expr in (carry or {}).items()],
    )
