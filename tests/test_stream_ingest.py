import uuid

from pyspark.sql import functions as F

from meterflow.operators.positions import current_ledger
from meterflow.plans.tables import setup_tables
from meterflow.session import work_dir
from meterflow.sources import fixtures
from meterflow.sources.topics import topic_source
from meterflow.streaming.ingest import ingest_batch, start_ingest

from .conftest import SF_SMALL

TOPICS = ["p1-electricity", "p1-gas", "p1-unknown"]


def tables(spark):
    return setup_tables(spark, f"t_{uuid.uuid4().hex[:8]}", work_dir(spark, "wh"), reset=True)


def counts(spark, names):
    return {t: spark.table(n).count() for t, n in names.items()}


def test_replayed_batch_adds_no_rows(spark):
    names = tables(spark)
    msgs = fixtures.messages(spark, SF_SMALL)
    ingest_batch(msgs, 3, names, "x")
    first = counts(spark, names)
    ingest_batch(msgs, 3, names, "x")
    assert counts(spark, names) == first
    assert first["electricity"] + first["gas"] + first["rejects"] == msgs.count()


def test_drain_in_batches_equals_one_and_restart(spark):
    msgs = fixtures.messages(spark, SF_SMALL)
    log = work_dir(spark, "log")
    msgs.where(F.col("offset") < 100).repartition(3).write.parquet(log)

    names_k = tables(spark)
    ckpt = work_dir(spark, "ck")
    src = topic_source(spark, TOPICS, path=log, max_per_batch=1)
    start_ingest(src, names_k, ckpt, "k", available_now=True).awaitTermination()
    # New records arrive; the same checkpoint resumes after what was consumed.
    msgs.where(F.col("offset") >= 100).repartition(2).write.mode("append").parquet(log)
    src = topic_source(spark, TOPICS, path=log, max_per_batch=1)
    start_ingest(src, names_k, ckpt, "k", available_now=True).awaitTermination()

    names_1 = tables(spark)
    src = topic_source(spark, TOPICS, path=log)
    start_ingest(src, names_1, work_dir(spark, "ck"), "one", available_now=True).awaitTermination()

    for t in ("electricity", "gas", "rejects"):
        a = spark.table(names_k[t]).drop("ingest_id", "batch_id")
        b = spark.table(names_1[t]).drop("ingest_id", "batch_id")
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert spark.table(names_k["electricity"]).select("batch_id").distinct().count() >= 3
    la = current_ledger(spark.table(names_k["ledger"])).select("topic", "partition", "last_offset")
    lb = current_ledger(spark.table(names_1["ledger"])).select("topic", "partition", "last_offset")
    assert sorted(map(tuple, la.collect())) == sorted(map(tuple, lb.collect()))


def test_batches_survive_static_overwrite_mode(spark):
    names = tables(spark)
    msgs = fixtures.messages(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        ingest_batch(msgs.where(F.col("offset") < 50), 0, names, "s")
        ingest_batch(msgs.where(F.col("offset") >= 50), 1, names, "s")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    total = sum(spark.table(names[t]).count() for t in ("electricity", "gas", "rejects"))
    assert total == msgs.count()


def test_a_new_checkpoint_never_replaces_earlier_batches(spark):
    msgs = fixtures.messages(spark, SF_SMALL)
    names = tables(spark)
    for part in (F.col("offset") < 100, F.col("offset") >= 100):
        log = work_dir(spark, "log")
        msgs.where(part).coalesce(1).write.parquet(log)
        start_ingest(topic_source(spark, TOPICS, path=log), names, work_dir(spark, "ck"), "same", available_now=True).awaitTermination()
    total = counts(spark, names)
    assert total["electricity"] + total["gas"] + total["rejects"] == msgs.count()
    assert spark.table(names["ledger"]).select("ingest_id").distinct().count() == 2
    top = {(r.topic, r.partition): r.last_offset for r in current_ledger(spark.table(names["ledger"])).collect()}
    want = {(r.topic, r.partition): r.o for r in msgs.groupBy("topic", "partition").agg(F.max("offset").alias("o")).collect()}
    assert top == want


def test_a_stream_resumes_from_the_ledger(spark):
    from meterflow.operators.positions import last_offsets, resume

    msgs = fixtures.messages(spark, SF_SMALL)
    log = work_dir(spark, "log")
    msgs.coalesce(1).write.parquet(log)
    names = tables(spark)
    ingest_batch(msgs.where("offset < 60"), 0, names, "first")
    positions = last_offsets(spark, current_ledger(spark.table(names["ledger"])), "p1-data-consumer-group", TOPICS)
    src = resume(topic_source(spark, TOPICS, path=log), positions)
    start_ingest(src, names, work_dir(spark, "ck"), "second", available_now=True).awaitTermination()
    assert sum(spark.table(names[t]).count() for t in ("electricity", "gas", "rejects")) == msgs.count()


def test_time_trigger_ingests_and_stops(spark):
    import time

    msgs = fixtures.messages(spark, SF_SMALL)
    log = work_dir(spark, "log")
    msgs.coalesce(1).write.parquet(log)
    names = tables(spark)
    q = start_ingest(topic_source(spark, TOPICS, path=log), names, work_dir(spark, "ck"), "timed", processing_time="1 second")
    try:
        end = time.time() + 90
        while time.time() < end and sum(spark.table(names[t]).count() for t in ("electricity", "gas", "rejects")) < msgs.count():
            spark.catalog.refreshTable(names["electricity"])
            time.sleep(1)
    finally:
        q.stop()
    assert sum(spark.table(names[t]).count() for t in ("electricity", "gas", "rejects")) == msgs.count()


def test_reset_empties_a_populated_table(spark):
    from meterflow.plans.tables import ensure_raw_table

    names = tables(spark)
    ingest_batch(fixtures.messages(spark, SF_SMALL), 0, names, "x")
    assert spark.table(names["gas"]).count() > 0
    ensure_raw_table(spark, names["gas"], work_dir(spark, "again"), reset=True)
    assert spark.table(names["gas"]).count() == 0


def test_write_position_is_checked(spark):
    import pytest

    with pytest.raises(ValueError):
        ingest_batch(fixtures.messages(spark, SF_SMALL), 0, tables(spark), "it's")


def test_compacted_ledger_says_the_same_in_one_slice(spark):
    from meterflow.plans.tables import compact_ledger

    names = tables(spark)
    msgs = fixtures.messages(spark, SF_SMALL)
    for i in range(3):
        ingest_batch(msgs.where(F.col("offset") % 3 == i), i, names, "x")
    read = lambda: sorted(tuple(r) for r in current_ledger(spark.table(names["ledger"])).drop("updated_at").collect())
    before = read()
    for _ in range(2):
        compact_ledger(spark, names["ledger"])
        assert read() == before and len(spark.sql(f"SHOW PARTITIONS {names['ledger']}").collect()) == 1


def test_streamed_copies_are_dropped(spark):
    from meterflow.operators.rebuild import dedup_stream
    from meterflow.operators.routing import raw_rows, route_messages

    raw = raw_rows(route_messages(fixtures.messages(spark, SF_SMALL)), "gas")
    path, out = work_dir(spark, "raw"), work_dir(spark, "once")
    for _ in range(2):
        raw.coalesce(1).write.mode("append").parquet(path)
    stream = dedup_stream(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "1").parquet(path), "400 days")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_dir(spark, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    once = spark.read.parquet(out)
    assert once.count() == raw.count() and once.exceptAll(raw).count() == 0
