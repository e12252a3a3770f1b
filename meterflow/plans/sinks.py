"""Sinks: topic publish (A3) and replay-safe raw append (A4)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import utc_wall_clock
from ..sources.topics import kafka_available


def publish(records: DataFrame, bootstrap_servers: str | None = None, path: str | None = None) -> None:
    """Write ``(key, value, topic, timestamp)`` records to topics (A3).

    With a broker, the Kafka sink: the broker assigns partitions and offsets.
    Else a plain append to a file topic log; a log has no broker to number its
    records, so ``partition`` and ``offset`` are columns of ``records`` then.
    """
    if bootstrap_servers:
        if not kafka_available(records.sparkSession):
            raise RuntimeError("the Kafka connector is not on the classpath")
        (records.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "timestamp")
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).save())
        return
    if not path:
        raise ValueError("give bootstrap_servers or a file topic log path")
    out = records.select(
        F.col("key").cast("string").cast("binary").alias("key"),
        F.col("value").cast("string").cast("binary").alias("value"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("topic"),
    )
    out.write.mode("append").partitionBy("topic").parquet(path)


def write_partition(
    rows: DataFrame, table: str, static: Mapping[str, str | int], dynamic: Sequence[str] = (), overwrite: bool = True
) -> None:
    """Write ``rows`` to the partition ``static`` of ``table``, in place of what it holds if ``overwrite``.

    A static partition spec: exactly that partition is replaced whatever the
    session's partition overwrite mode; ``dynamic`` partition columns below it
    (such as ``day``) come from the rows. Rows that are read from the table itself
    can only be added to it.
    """
    spark = rows.sparkSession
    target = [c for c in spark.table(table).columns if c not in static]
    view = f"__meterflow_batch_{uuid.uuid4().hex[:12]}"
    rows.select(*target).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT {'OVERWRITE' if overwrite else 'INTO'} TABLE {table} PARTITION ({', '.join([partition_spec(static), *dynamic])}) "
                  f"SELECT {', '.join(f'`{c}`' for c in target)} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def partition_spec(values: Mapping[str, str | int | None]) -> str:
    def literal(v):
        return "null" if v is None else f"'{v}'" if isinstance(v, str) else str(int(v))

    return ", ".join(f"{c} = {literal(v)}" for c, v in values.items())


def overwrite_batch(rows: DataFrame, table: str, ingest_id: str, batch_id: int, dynamic: Sequence[str] = ()) -> None:
    """Replace the ``(ingest_id, batch_id)`` partition of ``table`` with ``rows``."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", ingest_id):
        raise ValueError("ingest_id may hold letters, digits, '_', '.' and '-' only")
    write_partition(rows, table, {"ingest_id": ingest_id, "batch_id": int(batch_id)}, dynamic)


def append_raw(rows: DataFrame, table: str, ingest_id: str, batch_id: int, day: bool | None = None) -> None:
    """Write one batch into a raw table's ``(ingest_id, batch_id)`` partition (A4).

    Writing the same batch again replaces what the first attempt wrote, so a
    replayed micro-batch adds no rows.
    """
    if day is None:
        day = "day" in rows.sparkSession.table(table).columns
    cols = [c for c in rows.columns if c not in ("ingest_id", "batch_id", "day")]
    out = rows.select(*cols)
    if day:
        out = out.withColumn("day", F.to_date(utc_wall_clock(F.col("kafka_timestamp"))))
    overwrite_batch(out, table, ingest_id, batch_id, dynamic=["day"] if day else [])
