"""Producer chain: capture lines -> telegrams -> readings -> change messages.

A2 -> C1 -> C2 -> C3 -> D1 -> D2 -> D3 -> D4 (-> A3 in ``plans.sinks``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import detect_changes, to_messages
from ..operators.parsing import parse_telegrams, with_validity
from ..operators.scan import DEFAULT_BLOCK_ROWS, block_of
from ..operators.split_framing import frame_splits
from ..schemas import DEFAULT_ELECTRICITY_TOPIC, DEFAULT_GAS_TOPIC
from ..sources import fixtures


def fixture_telegrams(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Telegrams of the per-meter fixture streams (C1): ``meter_id, telegram_no, seq, lines``.

    ``seq`` is the sequence number of the event whose text holds the start line. A
    meter's events of one block come out of the fixture's scan in one task; sorted
    there, they are a split of the meter's stream.
    """
    texts = fixtures.telegrams(spark, sf_dir, block_rows).withColumn("block", block_of(F.col("event_id"), block_rows))
    lines = texts.sortWithinPartitions("meter_id", "seq").select(
        "meter_id", "block", "seq", F.explode(F.split("telegram", "\n")).alias("line")
    )
    lines = lines.withColumn("pos", F.monotonically_increasing_id())
    return frame_splits(lines, capture=["meter_id"], split=["block"], position="pos", keep=["seq"])


def fixture_frames(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One row per telegram: line count, first and last line."""
    return fixture_telegrams(spark, sf_dir, block_rows).select(
        "meter_id",
        "telegram_no",
        "seq",
        F.size("lines").cast("long").alias("n_lines"),
        F.col("lines")[0].alias("first_line"),
        F.element_at("lines", -1).alias("last_line"),
    )


def fixture_readings(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """All parsed readings with ``valid`` and ``reason`` (C2 + C3), keyed by ``meter_id, seq``."""
    readings = parse_telegrams(fixture_telegrams(spark, sf_dir, block_rows))
    return with_validity(readings).drop("telegram_no")


def changes_from_readings(readings: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    valid = readings.where(F.col("valid")).drop("valid", "reason")
    return detect_changes(valid, key=["meter_id"], order=["seq"], block=block_of(F.col("seq"), block_rows))


def messages_from_changes(
    changes: DataFrame,
    processing_time: Column,
    electricity_topic: str = DEFAULT_ELECTRICITY_TOPIC,
    gas_topic: str = DEFAULT_GAS_TOPIC,
) -> DataFrame:
    return to_messages(changes, processing_time, electricity_topic, gas_topic, key=F.col("meter_id").cast("string"))
