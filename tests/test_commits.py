import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.operators.positions import current_ledger
from meterflow.plans import commits, sinks
from meterflow.plans.commits import compact_days, is_committed, partitions, rewind, vacuum
from meterflow.sources import fixtures
from meterflow.streaming import ingest
from meterflow.streaming.ingest import ingest_batch

from .conftest import SF_SMALL
from .test_stream_ingest import tables

RAW = ("electricity", "gas", "rejects")


@pytest.fixture(scope="module")
def msgs(spark):
    from meterflow.queries import _stored

    return _stored(fixtures.messages(spark, SF_SMALL), "records")


def seen(spark, names):
    """What readers of the views get: positions of the rows, and the ledger."""
    rows = []
    for t in RAW:
        rows += [(t, r.kafka_topic, r.kafka_partition, r.kafka_offset) for r in spark.table(names[f"{t}_view"]).collect()]
    ledger = current_ledger(spark.table(names["ledger_view"])).collect()
    return sorted(rows), sorted((r.topic, r.partition, r.last_offset) for r in ledger)


def part(msgs, i, n=4):
    return msgs.where(F.col("offset") % n == i)


class Killed(Exception):
    pass


@pytest.mark.parametrize("writes", range(5))
def test_a_kill_between_any_two_writes_leaves_no_visible_half(spark, msgs, monkeypatch, writes):
    names = tables(spark)
    ingest_batch(part(msgs, 0), 0, names, "x")
    before = seen(spark, names)
    write, done = sinks.write_partition, []

    def dying(*args, **kwargs):
        if len(done) == writes:
            raise Killed
        done.append(1)
        return write(*args, **kwargs)

    monkeypatch.setattr(sinks, "write_partition", dying)
    with pytest.raises(Killed):
        ingest_batch(part(msgs, 1), 1, names, "x")
    assert seen(spark, names) == before
    monkeypatch.setattr(sinks, "write_partition", write)
    ingest_batch(part(msgs, 1), 1, names, "x")
    rows, _ = seen(spark, names)
    assert len(rows) == len(set(rows)) == msgs.where("offset % 4 < 2").count()


def test_a_committed_batch_is_not_written_again(spark, msgs, monkeypatch):
    names = tables(spark)
    ingest_batch(part(msgs, 0), 7, names, "x")
    assert is_committed(spark, names, "x", 7) and not is_committed(spark, names, "x", 6) and not is_committed(spark, names, "y", 7)
    monkeypatch.setattr(ingest, "append_raw", None)
    ingest_batch(part(msgs, 0), 7, names, "x")


def test_compaction_by_day(spark, msgs):
    names = tables(spark)
    for i in range(3):
        ingest_batch(part(msgs, i), i, names, "x")
    ingest_batch(part(msgs, 3), 9, names, "y")
    before = seen(spark, names)
    assert compact_days(spark, names) == 1 and seen(spark, names) == before
    vacuum(spark, names)
    assert seen(spark, names) == before
    days = msgs.select(F.to_date("timestamp")).distinct().count()
    for t in RAW:
        assert not partitions(spark, names[t])
        assert 0 < len(partitions(spark, names[f"{t}_days"])) <= days
    # Nothing new: nothing to do. A replay of folded batches adds nothing.
    assert compact_days(spark, names) == 1
    for i, b, name in ((0, 0, "x"), (2, 2, "x"), (3, 9, "y")):
        ingest_batch(part(msgs, i), b, names, name)
    assert seen(spark, names) == before and not partitions(spark, names["commits"])
    # Late rows of old days make a new generation of those days only.
    again = msgs.where("offset < 3 AND topic = 'p1-gas'")
    ingest_batch(again, 10, names, "x")
    after = seen(spark, names)
    assert len(after[0]) == len(before[0]) + again.count()
    assert compact_days(spark, names) == 2 and seen(spark, names) == after
    vacuum(spark, names)
    assert seen(spark, names) == after
    generations = {int(p["generation"]) for p in partitions(spark, names["gas_days"])}
    assert generations == {1, 2} and {int(p["generation"]) for p in partitions(spark, names["electricity_days"])} == {1}
    assert len(partitions(spark, names["folds"])) == len(partitions(spark, names["ledger_folded"])) == 1


def test_a_day_filter_prunes_and_files_are_sorted(spark, msgs):
    names = tables(spark)
    ingest_batch(msgs, 0, names, "x")
    compact_days(spark, names)
    vacuum(spark, names)
    day = spark.table(names["electricity_view"]).where(F.col("day") == dt.date(2024, 1, 5))
    want = msgs.where("topic = 'p1-electricity' AND to_date(timestamp) = '2024-01-05'").join(
        spark.table(names["rejects_view"]), (F.col("offset") == F.col("kafka_offset")) & (F.col("topic") == F.col("kafka_topic")) & (F.col("partition") == F.col("kafka_partition")), "left_anti")
    assert day.count() == want.count() > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert any("day" in p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:])
    table = spark.table(names["electricity_days"])
    rows = table.select("kafka_partition", "kafka_offset", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).orderBy("i").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append((r.kafka_partition, r.kafka_offset))
    assert all(v == sorted(v) for v in by_file.values())


def test_rows_without_a_time_are_folded_too(spark, msgs):
    names = tables(spark)
    timeless = msgs.where("offset < 20").withColumn("timestamp", F.lit(None).cast("timestamp"))
    ingest_batch(timeless, 0, names, "x")
    before = seen(spark, names)
    compact_days(spark, names)
    vacuum(spark, names)
    assert seen(spark, names) == before
    ingest_batch(msgs.where("offset BETWEEN 20 AND 25").withColumn("timestamp", F.lit(None).cast("timestamp")), 1, names, "x")
    before = seen(spark, names)
    compact_days(spark, names)
    vacuum(spark, names)
    assert seen(spark, names) == before


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_a_fold_that_died_is_done_again(spark, msgs, monkeypatch, mode):
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        names = tables(spark)
        ingest_batch(part(msgs, 0), 0, names, "x")
        compact_days(spark, names)
        ingest_batch(part(msgs, 1), 1, names, "x")
        before = seen(spark, names)
        write = sinks.write_partition

        def dying(rows, table, *args, **kwargs):
            if table == names["folds"]:
                raise Killed
            return write(rows, table, *args, **kwargs)

        monkeypatch.setattr(commits, "write_partition", dying)
        with pytest.raises(Killed):
            compact_days(spark, names)
        assert seen(spark, names) == before
        vacuum(spark, names)
        assert seen(spark, names) == before
        monkeypatch.setattr(commits, "write_partition", write)
        assert compact_days(spark, names) == 2
        assert seen(spark, names) == before
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_a_rewind_survives_the_log_its_compaction_and_old_writers(spark, msgs):
    names = tables(spark)
    ingest_batch(msgs, 0, names, "x")
    top = {(t, p): o for t, p, o in seen(spark, names)[1]}
    positions = spark.createDataFrame([("p1-gas", 0, 5)], "topic string, partition int, last_offset long")
    assert rewind(spark, names, positions) == 1

    def gas():
        return {(t, p): o for t, p, o in seen(spark, names)[1]}

    assert gas() == {**top, ("p1-gas", 0): 5}
    # A writer that still holds the older epoch does not move it.
    ingest_batch(msgs.where("topic = 'p1-gas'"), 1, names, "x", epoch=0)
    assert gas() == {**top, ("p1-gas", 0): 5}
    ingest_batch(msgs.where("topic = 'p1-gas' AND partition = 0 AND offset BETWEEN 6 AND 8"), 2, names, "x")
    assert gas() == {**top, ("p1-gas", 0): 8}
    for _ in range(2):
        compact_days(spark, names)
        vacuum(spark, names)
        assert gas() == {**top, ("p1-gas", 0): 8}
        assert rewind(spark, names, positions) in (2, 3) and gas() == {**top, ("p1-gas", 0): 5}
        ingest_batch(msgs.where("topic = 'p1-gas' AND partition = 0 AND offset = 8"), 3 + _, names, "x")
