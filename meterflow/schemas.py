"""Fixed schemas: reading, message envelope, raw table, offset ledger."""

from __future__ import annotations

from pyspark.sql import types as T

# Reading fields in telegram order, with their Spark types and zero values
# (a missing OBIS line reads as the zero value, not as null).
ELECTRICITY_FIELDS = [
    "electricityConsumption1",
    "electricityConsumption2",
    "electricityProduction1",
    "electricityProduction2",
    "currentTariff",
    "currentConsumption",
    "currentProduction",
]
GAS_FIELDS = ["gasTimestamp", "gasConsumption"]
READING_FIELDS = ["timestamp"] + ELECTRICITY_FIELDS + GAS_FIELDS

FIELD_TYPES = {
    "timestamp": T.StringType(),
    "electricityConsumption1": T.DoubleType(),
    "electricityConsumption2": T.DoubleType(),
    "electricityProduction1": T.DoubleType(),
    "electricityProduction2": T.DoubleType(),
    "currentTariff": T.IntegerType(),
    "currentConsumption": T.DoubleType(),
    "currentProduction": T.DoubleType(),
    "gasTimestamp": T.StringType(),
    "gasConsumption": T.DoubleType(),
}

ZERO_VALUES = {
    "timestamp": "",
    "electricityConsumption1": 0.0,
    "electricityConsumption2": 0.0,
    "electricityProduction1": 0.0,
    "electricityProduction2": 0.0,
    "currentTariff": 0,
    "currentConsumption": 0.0,
    "currentProduction": 0.0,
    "gasTimestamp": "",
    "gasConsumption": 0.0,
}

READING_SCHEMA = T.StructType([T.StructField(f, FIELD_TYPES[f]) for f in READING_FIELDS])

# Kafka source record, as Spark's Kafka connector delivers it.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

RAW_COLUMNS = [
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "processing_timestamp",
    "telegram_timestamp",
    "raw_data",
]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("processing_timestamp", T.TimestampType()),
        T.StructField("telegram_timestamp", T.StringType()),
        T.StructField("raw_data", T.StringType()),
    ]
)

LEDGER_COLUMNS = ["consumer_group_id", "topic", "partition", "last_offset", "updated_at"]

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("consumer_group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Payload keys of the two update messages.
PAYLOAD_TIME_KEYS = ["telegramTimestamp", "processingTimestampUTC"]
ELECTRICITY_PAYLOAD_SCHEMA = T.StructType(
    [T.StructField("telegramTimestamp", T.StringType()), T.StructField("processingTimestampUTC", T.StringType())]
    + [T.StructField(f, FIELD_TYPES[f]) for f in ELECTRICITY_FIELDS]
)
GAS_PAYLOAD_SCHEMA = T.StructType(
    [T.StructField("telegramTimestamp", T.StringType()), T.StructField("processingTimestampUTC", T.StringType())]
    + [T.StructField(f, FIELD_TYPES[f]) for f in GAS_FIELDS]
)

# Default names used by the reference's deployment.
DEFAULT_ELECTRICITY_TOPIC = "p1-electricity"
DEFAULT_GAS_TOPIC = "p1-gas"
DEFAULT_GROUP_ID = "p1-data-consumer-group"
