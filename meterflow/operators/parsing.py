"""Telegram parsing (C2) and validity split.

Each line is matched against the OBIS patterns; per telegram the value of the
last matching line wins (an aggregate, so partial aggregation happens before
the shuffle and a very long telegram is no problem). A missing code reads as
the zero value (0 or an empty string), never null. A telegram without the main
timestamp is rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.obis import DST_FLAG_PATTERN, FIELD_PATTERNS, last_match, raw_match, typed
from ..schemas import READING_FIELDS, ZERO_VALUES

REJECT_MISSING_TIMESTAMP = "missing_timestamp"


def parse_telegram_lines(
    telegram_lines: DataFrame,
    telegram: Sequence[str],
    order: Sequence[str],
    line: str = "line",
    carry: Mapping[str, Column] | None = None,
    keep_dst_flag: bool = False,
    position: Column | None = None,
) -> DataFrame:
    """Group telegram lines into one reading per telegram.

    ``telegram``: columns identifying a telegram. ``carry``: extra aggregates
    to keep (for example ``{"seq": F.min("seq")}``).
    """
    l = F.col(line)
    # One regex evaluation per field and line, in a projection of its own.
    matched = telegram_lines.select(
        "*",
        *[raw_match(l, pattern, group).alias(f"__m_{field}") for field, pattern, group, _ in FIELD_PATTERNS],
        *([raw_match(l, DST_FLAG_PATTERN, 1).alias("__m_dstFlag")] if keep_dst_flag else []),
    )
    pos = position if position is not None else F.struct(*[F.col(c) for c in order])
    aggs = []
    # The 12-digit times travel as longs (and the DST flag as a number), so
    # every aggregation buffer is fixed width and Spark can hash-aggregate
    # (with partial aggregation) instead of sorting all lines.
    for field, _, _, spark_type in FIELD_PATTERNS:
        raw = F.col(f"__m_{field}")
        value = typed(raw, "long" if spark_type == "string" else spark_type)
        aggs.append(F.max_by(value, F.when(raw != "", pos)).alias(field))
    if keep_dst_flag:
        raw = F.col("__m_dstFlag")
        aggs.append(F.max_by(F.when(raw == "S", 1).when(raw == "W", 0), F.when(raw != "", pos)).alias("dstFlag"))
    for name, expr in (carry or {}).items():
        aggs.append(expr.alias(name))
    grouped = matched.groupBy(*telegram).agg(*aggs)
    filled = []
    for f in READING_FIELDS:
        col = F.col(f)
        if ZERO_VALUES[f] == "":
            col = F.lpad(col.cast("string"), 12, "0")
        filled.append(F.coalesce(col, F.lit(ZERO_VALUES[f])).alias(f))
    if keep_dst_flag:
        grouped = grouped.withColumn("dstFlag", F.when(F.col("dstFlag") == 1, "S").when(F.col("dstFlag") == 0, "W"))
    rest = [c for c in grouped.columns if c not in READING_FIELDS]
    return grouped.select(*rest, *filled)


def parse_telegrams(telegrams: DataFrame, lines: str = "lines", keep_dst_flag: bool = False) -> DataFrame:
    """One reading per telegram whose lines are an array, row by row without a shuffle.

    All other columns are kept. The same values as ``parse_telegram_lines``.
    """
    l = F.col(lines)
    out = [F.col(c) for c in telegrams.columns if c != lines]
    if keep_dst_flag:
        out.append(last_match(l, DST_FLAG_PATTERN, 1).alias("dstFlag"))
    for field, pattern, group, spark_type in FIELD_PATTERNS:
        raw = last_match(l, pattern, group)
        value = raw if spark_type == "string" else raw.try_cast(spark_type)
        out.append(F.coalesce(value, F.lit(ZERO_VALUES[field])).alias(field))
    return telegrams.select(*out)


def is_valid(readings: DataFrame) -> Column:
    return F.col("timestamp") != ""


def split_valid(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid readings, rejected readings with a ``reason`` column)."""
    valid = readings.where(is_valid(readings))
    rejected = readings.where(~is_valid(readings)).withColumn("reason", F.lit(REJECT_MISSING_TIMESTAMP))
    return valid, rejected


def with_validity(readings: DataFrame) -> DataFrame:
    """Readings with ``valid`` (boolean) and ``reason`` (null when valid)."""
    ok = is_valid(readings)
    return readings.withColumn("valid", ok).withColumn("reason", F.when(~ok, F.lit(REJECT_MISSING_TIMESTAMP)))
