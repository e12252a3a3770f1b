"""Two-topic source (A1): Kafka when its connector is present, else a topic
log kept as files with the same record schema.

The file log is Parquet partitioned by ``topic`` with the Kafka record columns
(``key, value, partition, offset, timestamp, timestampType``); it is what
``plans.sinks.publish`` writes when no broker is configured. Reading it as a
stream picks up new files per micro-batch; ``maxFilesPerTrigger`` caps a batch
the way ``maxOffsetsPerTrigger`` does on Kafka.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MESSAGE_SCHEMA

FILE_LOG_SCHEMA = T.StructType([f for f in MESSAGE_SCHEMA.fields if f.name != "topic"] + [T.StructField("topic", T.StringType())])


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def topic_source(
    spark: SparkSession,
    topics: Sequence[str],
    stream: bool = True,
    bootstrap_servers: str | None = None,
    path: str | None = None,
    starting_offsets: str = "earliest",
    max_per_batch: int | None = None,
    options: Mapping[str, str] | None = None,
    min_per_batch: int | None = None,
    max_delay: str | None = None,
) -> DataFrame:
    """Records of ``topics`` in the Kafka source schema.

    With ``bootstrap_servers`` the Kafka connector is used (``subscribe`` to
    all topics at once, ``startingOffsets`` as given, earliest by default).
    ``min_per_batch`` and ``max_delay`` make a batch wait until it is full or the
    time is over (Kafka streams: ``minOffsetsPerTrigger``, ``maxTriggerDelay``).
    Otherwise ``path`` names a file topic log; resume positions are applied by
    ``operators.positions.resume`` and the stream checkpoint.
    """
    if bootstrap_servers:
        if not kafka_available(spark):
            raise RuntimeError("the Kafka connector is not on the classpath; use a file topic log (path=...)")
        reader = spark.readStream if stream else spark.read
        r = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets)
        )
        if max_per_batch and stream:
            r = r.option("maxOffsetsPerTrigger", str(max_per_batch))
        if min_per_batch and stream:
            r = r.option("minOffsetsPerTrigger", str(min_per_batch))
        if max_delay and stream:
            r = r.option("maxTriggerDelay", max_delay)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        return r.load()
    if not path:
        raise ValueError("give bootstrap_servers or a file topic log path")
    if stream:
        r = spark.readStream.schema(FILE_LOG_SCHEMA)
        if max_per_batch:
            r = r.option("maxFilesPerTrigger", str(max_per_batch))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = r.parquet(path)
    else:
        df = spark.read.schema(FILE_LOG_SCHEMA).parquet(path)
    return df.where(F.col("topic").isin(list(topics))).select(*[f.name for f in MESSAGE_SCHEMA.fields])
