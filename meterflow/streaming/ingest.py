"""Streaming ingest (A1 -> E1..E7 -> A4, F1 -> F2, F5 - F7).

Batch numbers restart with a new checkpoint, so the write position of a stream
also holds a token that is stored beside its checkpoint: another checkpoint
writes to partitions of its own and never replaces what an earlier one wrote.

One micro-batch is routed once, then written to the two raw tables, the
rejects table and the position log, each into the batch's own
``(ingest_id, batch_id)`` partition, and last into the commit manifest: readers of
the committed views see all of a batch or nothing of it. The checkpoint is the
authority on what was consumed: if the job dies mid-batch, the batch is replayed
and its partitions are overwritten; a batch that is committed already is not
written again, also after it was folded into the day tables. The position log can
be rebuilt from the raw tables at any time with ``operators.positions.high_water``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import group_epoch, high_water, ledger_updates
from ..operators.routing import DEFAULT_ROUTES, raw_rows, rejected_rows, route_messages
from ..plans.commits import commit_batch, is_committed
from ..plans.sinks import append_raw, overwrite_batch
from ..schemas import DEFAULT_GROUP_ID


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    tables: Mapping[str, str],
    ingest_id: str,
    group_id: str = DEFAULT_GROUP_ID,
    routes: Mapping[str, str] | None = None,
    on_malformed: str = "skip",
    absent: str = "null",
    day: bool | None = None,
    updated_at: Column | None = None,
    epoch: int | None = None,
) -> None:
    """Write one batch of topic records to raw tables, rejects and positions, and commit it.

    ``epoch``: of the positions; the group's present one when not given.
    """
    spark = batch.sparkSession
    if "commits" in tables and is_committed(spark, tables, ingest_id, batch_id):
        return
    if epoch is None and "ledger_view" in tables:
        epoch = group_epoch(spark.table(tables["ledger_view"]), group_id)
    stamp = updated_at if updated_at is not None else F.current_timestamp()
    routes = dict(routes or DEFAULT_ROUTES)
    routed = route_messages(batch, routes, on_malformed, absent).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for table in sorted(set(routes.values())):
            append_raw(raw_rows(routed, table), tables[table], ingest_id, batch_id, day)
        if "rejects" in tables:
            append_raw(rejected_rows(routed), tables["rejects"], ingest_id, batch_id, day)
        if "ledger" in tables:
            positions = ledger_updates(high_water(routed), group_id, stamp, epoch or 0)
            overwrite_batch(positions, tables["ledger"], ingest_id, batch_id)
        if "commits" in tables:
            commit_batch(spark, tables, ingest_id, batch_id, stamp)
    finally:
        routed.unpersist()


def checkpoint_token(spark: SparkSession, checkpoint: str) -> str:
    """The token of a checkpoint folder, made on first use and stored in it."""
    path = f"{checkpoint.rstrip('/')}/write-position"
    fresh = spark.createDataFrame([(uuid.uuid4().hex[:12],)], "token string")
    fresh.coalesce(1).write.mode("ignore").text(path)
    return spark.read.text(path).first()[0]


def start_ingest(
    records: DataFrame,
    tables: Mapping[str, str],
    checkpoint: str,
    ingest_id: str,
    group_id: str = DEFAULT_GROUP_ID,
    routes: Mapping[str, str] | None = None,
    on_malformed: str = "skip",
    absent: str = "null",
    day: bool | None = None,
    processing_time: str | None = "5 seconds",
    available_now: bool = False,
    updated_at: Column | None = None,
):
    """Start the ingest stream (F5: ``processing_time`` trigger; F6: ``available_now`` drain).

    Rows are written under ``<ingest_id>-<token of the checkpoint>``.
    """
    position = f"{ingest_id}-{checkpoint_token(records.sparkSession, checkpoint)}"

    # A rewind while the stream runs does not concern it: its checkpoint leads.
    view = tables.get("ledger_view")
    epoch = group_epoch(records.sparkSession.table(view), group_id) if view else None

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, tables, position, group_id, routes, on_malformed, absent, day, updated_at, epoch)

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName(
        f"ingest_{ingest_id}"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
