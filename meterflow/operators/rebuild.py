"""Consumer-side obligations (G1 - G3): de-duplicate raw rows, type the
payload, rebuild full readings from sparse updates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    ELECTRICITY_FIELDS,
    ELECTRICITY_PAYLOAD_SCHEMA,
    FIELD_TYPES,
    GAS_FIELDS,
    GAS_PAYLOAD_SCHEMA,
    RAW_COLUMNS,
    ZERO_VALUES,
)
from .scan import segmented_scan

TOPIC_SCHEMAS = {"electricity": ELECTRICITY_PAYLOAD_SCHEMA, "gas": GAS_PAYLOAD_SCHEMA}
TOPIC_FIELDS = {"electricity": ELECTRICITY_FIELDS, "gas": GAS_FIELDS}


def dedup_raw(raw: DataFrame, key: Sequence[str] = ("kafka_topic", "kafka_partition", "kafka_offset")) -> DataFrame:
    """One row per record position (G1).

    Copies of a record are reduced by an aggregate, so map-side partial
    aggregation folds them before the shuffle however many there are; the
    kept copy is the least by its remaining columns, a deterministic choice.
    """
    rest = [c for c in raw.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in rest])
    return raw.groupBy(*key).agg(F.min(packed).alias("__keep")).select(
        *key, *[F.col(f"__keep.{c}").alias(c) for c in rest]
    ).select(*raw.columns)


def dedup_stream(
    raw: DataFrame,
    delay: str = "1 hour",
    key: Sequence[str] = ("kafka_topic", "kafka_partition", "kafka_offset"),
    time: str = "kafka_timestamp",
) -> DataFrame:
    """One row per record position on a stream (G1).

    State is kept for ``delay`` of broker time: copies that come within it are
    dropped, later ones are not known any more.
    """
    return raw.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def typed_payload(raw: DataFrame, topic: str, payload_col: str = "raw_data") -> DataFrame:
    """Raw rows of one topic with the payload keys as typed columns.

    Absent keys are null (unchanged), not zero.
    """
    schema = TOPIC_SCHEMAS[topic]
    parsed = F.from_json(F.col(payload_col), schema)
    return raw.select("*", *[parsed[f.name].alias(f.name) for f in schema.fields])


def rebuild_readings(
    typed: DataFrame,
    topic: str,
    key: Sequence[str],
    order: Sequence[str],
    block: Column | str,
) -> DataFrame:
    """Full values per message from sparse updates.

    Per key and topic, each field is the last value carried by this or an
    earlier message, else its zero value. A block scan, so one meter with a
    long history is spread over many tasks.
    """
    fields = TOPIC_FIELDS[topic]
    scanned = segmented_scan(
        typed,
        keys=key,
        block=block,
        order=order,
        lasts={f"__rb_{f}": F.col(f) for f in fields},
        inclusive=True,
        drop=fields,
    )
    cols = [
        F.coalesce(F.col(f"__rb_{c}"), F.lit(ZERO_VALUES[c]).cast(FIELD_TYPES[c])).alias(c) if c in fields else F.col(c)
        for c in typed.columns
    ]
    return scanned.select(*cols)


RAW_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]
__all__ = ["dedup_raw", "typed_payload", "rebuild_readings", "RAW_COLUMNS", "RAW_KEY"]


ALL_PAYLOAD_FIELDS = ELECTRICITY_FIELDS + GAS_FIELDS


def typed_payload_all(raw: DataFrame, payload_col: str = "raw_data") -> DataFrame:
    """Payload keys of both topics as typed columns (absent keys null).

    The parsed payload is a column of its own, read by all fields: as part of each
    field's expression it is parsed once a field, with that field's schema.
    """
    from pyspark.sql import types as T

    schema = T.StructType(
        [T.StructField("telegramTimestamp", T.StringType()), T.StructField("processingTimestampUTC", T.StringType())]
        + [T.StructField(f, FIELD_TYPES[f]) for f in ALL_PAYLOAD_FIELDS]
    )
    parsed = raw.select("*", F.from_json(F.col(payload_col), schema).alias("__payload"))
    return parsed.select("*", *[F.col("__payload")[f.name].alias(f.name) for f in schema.fields]).drop("__payload")


def rebuild_all(
    typed: DataFrame,
    topic_col: str,
    topic_kinds: dict[str, str],
    key: Sequence[str],
    order: Sequence[str],
    block: Column | str,
) -> DataFrame:
    """G3 for both topics in one scan keyed by (key, topic).

    ``topic_kinds`` maps topic names to ``electricity`` or ``gas``. A row gets
    its own topic's fields rebuilt (zero before the first value) and null for
    the other topic's fields.
    """
    scanned = segmented_scan(
        typed,
        keys=[*key, topic_col],
        block=block,
        order=order,
        lasts={f"__rb_{f}": F.col(f) for f in ALL_PAYLOAD_FIELDS},
        inclusive=True,
        drop=ALL_PAYLOAD_FIELDS,
    )
    kind = F.lit(None).cast("string")
    for name, k in topic_kinds.items():
        kind = F.when(F.col(topic_col) == name, F.lit(k)).otherwise(kind)
    rebuilt = {}
    for f in ALL_PAYLOAD_FIELDS:
        own = kind == ("electricity" if f in ELECTRICITY_FIELDS else "gas")
        full = F.coalesce(F.col(f"__rb_{f}"), F.lit(ZERO_VALUES[f]).cast(FIELD_TYPES[f]))
        rebuilt[f] = F.when(own, full).cast(FIELD_TYPES[f]).alias(f)
    cols = [rebuilt.get(c, F.col(c)) for c in typed.columns]
    return scanned.select(*cols)
