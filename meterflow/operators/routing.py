"""Topic records -> raw table rows.

Per record, with no shuffle: the topic picks the raw table (E1), the envelope
becomes the seven raw columns with the payload kept verbatim (E2, E3), the
processing time and telegram time are read from the payload (E4, E5), a
malformed payload is skipped to the rejects or fails the batch (E6), and
absent times stay null or take zero values (E7).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import accept_repeated_keys, as_text, malformed_reason, parse, string_key
from ..functions.timestamps import parse_processing_ts, zero_time
from ..schemas import DEFAULT_ELECTRICITY_TOPIC, DEFAULT_GAS_TOPIC, RAW_COLUMNS

REASON_UNKNOWN_TOPIC = "unknown_topic"

DEFAULT_ROUTES = {DEFAULT_ELECTRICITY_TOPIC: "electricity", DEFAULT_GAS_TOPIC: "gas"}


def route_messages(
    messages: DataFrame,
    routes: Mapping[str, str] | None = None,
    on_malformed: str = "skip",
    absent: str = "null",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Kafka-shaped records -> raw columns plus ``route`` and ``reject_reason``.

    ``routes``: topic -> raw table name. A record whose topic is not listed,
    or whose payload is not one JSON object, gets a ``reject_reason`` (and
    ``route`` null). ``on_malformed="fail"`` raises instead for payloads of
    routed topics, failing the batch. ``absent="zero"`` fills a missing
    processing time with 0001-01-01T00:00:00Z and a missing telegram time
    with an empty string. ``keep``: record columns to pass through.
    """
    if on_malformed not in ("skip", "fail"):
        raise ValueError("on_malformed must be 'skip' or 'fail'")
    if absent not in ("null", "zero"):
        raise ValueError("absent must be 'null' or 'zero'")
    routes = dict(routes or DEFAULT_ROUTES)
    accept_repeated_keys(messages.sparkSession)

    route = F.lit(None).cast("string")
    for topic, table in routes.items():
        route = F.when(F.col("topic") == topic, F.lit(table)).otherwise(route)

    # Decode and parse once per record; later expressions read the columns.
    staged = messages.select(
        "*",
        as_text(F.col("value")).alias("__text"),
        parse(as_text(F.col("value"))).alias("__parsed"),
    )
    text = F.col("__text")
    parsed = F.col("__parsed")
    payload_reason = malformed_reason(F.col("value"), text, parsed)
    if on_malformed == "fail":
        # A filter, so that it is evaluated whatever columns are read later.
        at = F.concat(F.coalesce(F.col("topic"), F.lit("?")), F.lit("/"), F.coalesce(F.col("partition").cast("string"), F.lit("?")),
                      F.lit("@"), F.coalesce(F.col("offset").cast("string"), F.lit("?")))
        bad = F.raise_error(F.concat(F.lit("malformed payload at "), at, F.lit(": "), payload_reason)).cast("boolean")
        staged = staged.where(F.when(route.isNotNull() & payload_reason.isNotNull(), bad).otherwise(F.lit(True)))
    # The reason goes into two columns; as a column of its own it is worked out once.
    staged = staged.withColumn("__reason", F.when(route.isNull(), F.lit(REASON_UNKNOWN_TOPIC)).otherwise(payload_reason))
    reason = F.col("__reason")

    processing = parse_processing_ts(string_key(parsed, "processingTimestampUTC"))
    telegram = string_key(parsed, "telegramTimestamp")
    if absent == "zero":
        processing = F.coalesce(processing, zero_time())
        telegram = F.coalesce(telegram, F.lit(""))

    return staged.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        processing.alias("processing_timestamp"),
        telegram.alias("telegram_timestamp"),
        text.alias("raw_data"),
        F.when(reason.isNull(), route).alias("route"),
        reason.alias("reject_reason"),
        *keep,
    )


def raw_rows(routed: DataFrame, table: str) -> DataFrame:
    """Accepted rows of one raw table, in the seven raw columns."""
    return routed.where((F.col("route") == table) & F.col("reject_reason").isNull()).select(*RAW_COLUMNS)


def rejected_rows(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("reject_reason").isNotNull()).select(*RAW_COLUMNS, "reject_reason")
