"""Change detection and sparse update messages.

Each valid reading is compared with the previous valid reading of the same
meter (the all-zero reading before the first one). Electricity (7 fields) and
gas (2 fields) are judged apart: a topic gets a row when one of its fields
changed, or when there was no previous reading. Its payload holds the changed
fields plus the telegram time and the processing time.

The previous reading is a "last value before this row" scan per meter
(``operators.scan``), so a meter with a very long history is still handled by
many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import rfc3339_utc
from ..schemas import (
    DEFAULT_ELECTRICITY_TOPIC,
    DEFAULT_GAS_TOPIC,
    ELECTRICITY_FIELDS,
    FIELD_TYPES,
    GAS_FIELDS,
    READING_FIELDS,
    ZERO_VALUES,
)
from .scan import segmented_scan

ELECTRICITY = "electricity"
GAS = "gas"
TOPIC_FIELDS = {ELECTRICITY: ELECTRICITY_FIELDS, GAS: GAS_FIELDS}

# Payload key order: Go's JSON encoder writes map keys sorted.
PAYLOAD_KEYS = sorted(ELECTRICITY_FIELDS + GAS_FIELDS + ["processingTimestampUTC", "telegramTimestamp"])


def with_previous(readings: DataFrame, key: Sequence[str], order: Sequence[str], block: Column | str) -> DataFrame:
    """Add ``prev_<field>`` (zero values before the first reading) and ``is_first``."""
    prev = segmented_scan(
        readings,
        keys=key,
        block=block,
        order=order,
        lasts={"__prev": F.struct(*[F.col(f) for f in READING_FIELDS])},
        inclusive=False,
    )
    return prev.select(
        *[c for c in readings.columns],
        F.col("__prev").isNull().alias("is_first"),
        *[
            F.coalesce(F.col(f"__prev.{f}"), F.lit(ZERO_VALUES[f]).cast(FIELD_TYPES[f])).alias(f"prev_{f}")
            for f in READING_FIELDS
        ],
    )


def change_rows(with_prev: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per emitted (reading, topic) with changed values, others null."""
    changed = {f: F.col(f) != F.col(f"prev_{f}") for f in ELECTRICITY_FIELDS + GAS_FIELDS}

    def topic_row(topic: str) -> Column:
        own = TOPIC_FIELDS[topic]
        emit = F.col("is_first")
        for f in own:
            emit = emit | changed[f]
        values = [
            (F.when(changed[f], F.col(f)) if f in own else F.lit(None).cast(FIELD_TYPES[f])).alias(f)
            for f in ELECTRICITY_FIELDS + GAS_FIELDS
        ]
        return F.struct(F.lit(topic).alias("topic"), emit.alias("emit"), *values)

    exploded = with_prev.select(
        *key, *order, "timestamp", F.explode(F.array(topic_row(ELECTRICITY), topic_row(GAS))).alias("__c")
    )
    return exploded.where(F.col("__c.emit")).select(
        *key,
        *order,
        F.col("__c.topic").alias("topic"),
        F.col("timestamp").alias("telegramTimestamp"),
        *[F.col(f"__c.{f}").alias(f) for f in ELECTRICITY_FIELDS + GAS_FIELDS],
    )


def detect_changes(readings: DataFrame, key: Sequence[str], order: Sequence[str], block: Column | str) -> DataFrame:
    """Valid readings -> change rows (D1 + D2)."""
    return change_rows(with_previous(readings, key, order, block), key, order)


def encode_updates(changes: DataFrame, processing_time: Column) -> Column:
    """Sparse JSON payload: changed fields plus both times, keys sorted (D3).

    Unchanged fields are null in ``changes`` and left out of the text.
    """
    fields = {f: F.col(f) for f in ELECTRICITY_FIELDS + GAS_FIELDS}
    fields["processingTimestampUTC"] = rfc3339_utc(processing_time)
    fields["telegramTimestamp"] = F.col("telegramTimestamp")
    return F.to_json(F.struct(*[fields[k].alias(k) for k in PAYLOAD_KEYS]))


def to_messages(
    changes: DataFrame,
    processing_time: Column,
    electricity_topic: str = DEFAULT_ELECTRICITY_TOPIC,
    gas_topic: str = DEFAULT_GAS_TOPIC,
    key: Column | None = None,
) -> DataFrame:
    """Change rows -> topic records ``(key, value, topic, timestamp)`` plus the
    change row's own columns (D3 + D4). Message time is the processing time."""
    topic = F.when(F.col("topic") == ELECTRICITY, F.lit(electricity_topic)).otherwise(F.lit(gas_topic))
    passthrough = [c for c in changes.columns if c not in ELECTRICITY_FIELDS + GAS_FIELDS + ["topic", "telegramTimestamp"]]
    return changes.select(
        *passthrough,
        (key if key is not None else F.lit(None).cast("string")).alias("key"),
        encode_updates(changes, processing_time).alias("value"),
        topic.alias("topic"),
        processing_time.alias("timestamp"),
    )
