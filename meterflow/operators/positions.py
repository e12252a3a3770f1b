"""Positions: high-water marks, offset ledger upsert, lookup, resume.

The ledger holds ``(consumer_group_id, topic, partition) -> last_offset,
updated_at``. Parquet tables have no key and no MERGE, so an upsert is a union
reduced per key; stored as an append-only log (one slice per batch), the
current ledger is the same reduction at read time.

A log may carry an ``epoch`` per row. The highest epoch of a key wins, then the
offset: a rewind is written as a new epoch of its group and so survives the log,
its compaction, and writers that still hold an older epoch.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER_COLUMNS

LEDGER_KEY = ["consumer_group_id", "topic", "partition"]


def high_water(df: DataFrame, topic: str = "kafka_topic", partition: str = "kafka_partition",
               offset: str = "kafka_offset") -> DataFrame:
    """Greatest offset per topic partition (F1); offset 0 counts."""
    return df.groupBy(F.col(topic).alias("topic"), F.col(partition).cast("int").alias("partition")).agg(
        F.max(F.col(offset)).cast("long").alias("last_offset")
    )


def ledger_updates(high: DataFrame, group_id: str, updated_at: Column, epoch: int | None = None) -> DataFrame:
    """High-water rows as ledger rows of one consumer group (of an ``epoch``, where the ledger has them)."""
    out = high.select(
        F.lit(group_id).alias("consumer_group_id"), "topic", "partition", "last_offset", updated_at.alias("updated_at")
    )
    return out if epoch is None else out.withColumn("epoch", F.lit(epoch).cast("long"))


def _with_epoch(rows: DataFrame) -> DataFrame:
    epoch = F.coalesce(F.col("epoch"), F.lit(0)) if "epoch" in rows.columns else F.lit(0)
    return rows.select(*LEDGER_COLUMNS, epoch.cast("long").alias("epoch"))


def upsert_ledger(ledger: DataFrame, updates: DataFrame, rewind: bool = False) -> DataFrame:
    """Ledger with ``updates`` applied, one row per key (F2).

    By default a position never moves back inside an epoch: the row with the
    greater epoch, then the greater offset wins (the later update on a tie). With
    ``rewind=True`` the latest update wins even when its offset is lower. Rows
    without an epoch count as epoch 0; the result has the column if an input has.
    """
    both = _with_epoch(ledger).unionByName(_with_epoch(updates))
    rank = (
        F.struct(F.col("updated_at"), F.col("last_offset"))
        if rewind
        else F.struct(F.col("epoch"), F.col("last_offset"), F.col("updated_at"))
    )
    best = F.max_by(F.struct("last_offset", "updated_at", "epoch"), rank).alias("__best")
    kept = ["last_offset", "updated_at"] + (["epoch"] if "epoch" in ledger.columns + updates.columns else [])
    return both.groupBy(*LEDGER_KEY).agg(best).select(*LEDGER_KEY, *[F.col(f"__best.{c}").alias(c) for c in kept])


def group_epoch(ledger: DataFrame, group_id: str) -> int:
    """The highest epoch of a group, 0 without any."""
    top = _with_epoch(ledger).where(F.col("consumer_group_id") == group_id).agg(F.max("epoch")).first()[0]
    return top or 0


def last_offsets(spark: SparkSession, ledger: DataFrame, group_id: str, topics: Sequence[str]) -> DataFrame:
    """Stored positions of ``group_id`` for ``topics``.

    One row per stored (topic, partition); a topic without any stored
    position gets one row with null partition and offset ("from earliest").
    """
    wanted = spark.createDataFrame([(t,) for t in topics], "topic string")
    stored = ledger.where(F.col("consumer_group_id") == group_id).select("topic", "partition", "last_offset")
    return wanted.join(stored, "topic", "left")


def resume(messages: DataFrame, positions: DataFrame, topic: str = "topic", partition: str = "partition",
           offset: str = "offset") -> DataFrame:
    """Records after the stored position of their topic partition.

    Partitions without a stored position are read from the earliest record.
    The join is left to the planner: it broadcasts the positions (one row per
    topic partition) when their measured size is small. Works on streams too.
    """
    pos = positions.where(F.col("partition").isNotNull()).select(
        F.col("topic").alias("__r_topic"), F.col("partition").alias("__r_partition"), F.col("last_offset").alias("__r_last")
    )
    cond = (F.col(topic) == F.col("__r_topic")) & (F.col(partition) == F.col("__r_partition"))
    joined = messages.join(pos, cond, "left")
    return joined.where(F.col("__r_last").isNull() | (F.col(offset) > F.col("__r_last"))).drop(
        "__r_topic", "__r_partition", "__r_last"
    )


def starting_offsets_json(rows: Sequence, partitions: Mapping[str, Sequence[int]]) -> str:
    """Kafka ``startingOffsets`` JSON from collected lookup rows.

    ``partitions``: every partition of every subscribed topic. The connector
    wants all of them listed: a stored partition starts one after its position,
    one without a position at the earliest record (-2). A stored partition that
    the topic no longer has is an error. One row per topic partition, a bounded
    list.
    """
    out = {t: {str(p): -2 for p in sorted(ps)} for t, ps in partitions.items()}
    for r in rows:
        if r["partition"] is None or r["topic"] not in out:
            continue
        if str(r["partition"]) not in out[r["topic"]]:
            raise ValueError(f"stored position of unknown partition {r['topic']}/{r['partition']}")
        out[r["topic"]][str(r["partition"])] = int(r["last_offset"]) + 1
    return json.dumps(out, sort_keys=True)


def current_ledger(log: DataFrame) -> DataFrame:
    """The ledger held by an append-only position log: one row per key."""
    return upsert_ledger(log.limit(0), log)
