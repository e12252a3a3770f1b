"""G1 and G3 as stateful streams."""

import random

import numpy as np
from pyspark.sql import functions as F

from meterflow import queries
from meterflow.operators.rebuild import ALL_PAYLOAD_FIELDS, TOPIC_FIELDS, typed_payload_all
from meterflow.operators.routing import raw_rows, route_messages
from meterflow.schemas import FIELD_TYPES, ZERO_VALUES
from meterflow.session import work_dir
from meterflow.sources import fixtures
from meterflow.streaming.dedup import dedup_stream_exact, merge, unseen
from meterflow.streaming.rebuild import rebuild_stream

from .conftest import SF_SMALL


def test_interval_sets_equal_a_set():
    rng = random.Random(2)
    starts = ends = np.empty(0, np.int64)
    seen = set()
    for _ in range(200):
        offsets = np.array([rng.randrange(300) for _ in range(rng.randrange(8))], np.int64)
        new = unseen(offsets, starts, ends)
        want = []
        for o in offsets.tolist():
            want.append(o not in seen)
            seen.add(o)
        assert new.tolist() == want
        starts, ends = merge(offsets[new], starts, ends)
        assert {o for a, b in zip(starts, ends) for o in range(a, b + 1)} == seen
        assert (starts[1:] > ends[:-1] + 1).all()  # as few intervals as there can be


def drain(stream, out, ckpt):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()


def test_copies_of_any_age_are_dropped_over_a_restart(spark):
    raw = queries._stored(raw_rows(route_messages(fixtures.messages(spark, SF_SMALL)), "electricity"), "raw")
    path, out, ckpt = (work_dir(spark, n) for n in ("appends", "once", "ckpt"))
    stream = lambda: dedup_stream_exact(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "2").parquet(path), block_rows=64)
    old = raw.withColumn("kafka_timestamp", F.lit("1999-01-01").cast("timestamp"))
    for part in (raw.where("kafka_offset % 2 = 0"), raw.unionByName(raw)):
        part.repartition(3).write.mode("append").parquet(path)
    drain(stream(), out, ckpt)
    old.repartition(2).write.mode("append").parquet(path)  # copies that claim to be years older
    nowhere = raw.limit(3).withColumn("kafka_offset", F.lit(None).cast("long"))
    nowhere.write.mode("append").parquet(path)
    drain(stream(), out, ckpt)
    once = spark.read.schema(raw.schema).parquet(out)
    placed = once.where("kafka_offset IS NOT NULL")
    assert placed.count() == raw.count() and placed.exceptAll(raw).count() == 0
    assert once.count() == raw.count() + 3


def test_rebuild_survives_a_restart_in_the_middle(spark):
    records = queries._stored(queries._update_records(spark, SF_SMALL), "records")
    top = records.agg(F.max("offset")).first()[0]
    path, out, ckpt = (work_dir(spark, n) for n in ("appends", "rebuilt", "ckpt"))
    for lo in (0, top // 2 + 1):
        part = records.where(F.col("offset").between(lo, lo + top // 2))
        part.repartition(4, "key").write.mode("append").parquet(path)
        stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", "2").parquet(path)
        drain(queries.rebuilt_stream(stream), out, ckpt)
    want = queries.rebuild_readings(spark, SF_SMALL)
    got = spark.read.parquet(out)
    assert got.where("late").count() == 0
    values = lambda df: sorted(tuple(map(str, r)) for r in df.select(*want.columns).collect())
    assert values(got) == values(want)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_payloads_are_parsed_once_for_all_fields(spark):
    records = queries._stored(queries._update_records(spark, SF_SMALL), "records")
    odd = ['{"currentTariff":"x","gasTimestamp":5,"gasConsumption":1}', '{"currentTariff":99999999999,"currentConsumption":2}', "{}",
           '{"gasConsumption":1,"gasConsumption":null}', '{"gasConsumption":1', "[1]", None, '{"currentProduction":[1],"telegramTimestamp":"t"}']
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "id long, raw_data string")
    typed = typed_payload_all(raw)
    assert _plan(typed).count("from_json(") == 1
    names = [c for c in typed.columns if c not in raw.columns]
    alone = raw.select("*", *[F.from_json("raw_data", f"{c} {typed.schema[c].dataType.simpleString()}")[c].alias(c) for c in names])
    assert typed.orderBy("id").collect() == alone.orderBy("id").collect()
    routed = route_messages(records, keep=["key"]).where(F.col("reject_reason").isNull())
    assert _plan(typed_payload_all(routed).drop("raw_data")).count("from_json(") == 1


def test_rebuild_equals_a_model_over_batches_with_nulls_and_late_rows(spark):
    rng = random.Random(4)
    topics = {"p1-electricity": ["electricityConsumption1", "currentTariff"], "p1-gas": ["gasConsumption", "gasTimestamp"]}
    shape = "meter_id long, seq long, topic string, telegramTimestamp string, " + ", ".join(
        f"{f} {FIELD_TYPES[f].simpleString()}" for f in ALL_PAYLOAD_FIELDS)
    path, out, ckpt = (work_dir(spark, n) for n in ("appends", "rebuilt", "ckpt"))
    state, want = {}, []
    for b in range(3):
        rows = []
        for meter, topic, seq in sorted({(rng.choice([-1, 0, 1, 2]), rng.choice(list(topics)), rng.randrange(b * 8, b * 8 + 12)) for _ in range(40)}):
            meter = None if meter < 0 else meter
            values = {f: rng.choice([None, {"currentTariff": 2, "gasTimestamp": "240101000000"}.get(f, rng.random())]) for f in topics[topic]}
            rows.append((meter, seq, topic, f"t{b}", *[values.get(f) for f in ALL_PAYLOAD_FIELDS]))
            at, held = state.get((meter, topic), (-1, {}))
            if seq > at:
                held = {f: values[f] if values[f] is not None else held.get(f, ZERO_VALUES[f]) for f in values}
                state[meter, topic] = seq, held
            zeros = {f: held.get(f, ZERO_VALUES[f]) for f in TOPIC_FIELDS[topic.removeprefix("p1-")]}
            shown = values if seq <= at else zeros
            want.append((meter, seq, topic, f"t{b}", *[shown.get(f) for f in ALL_PAYLOAD_FIELDS], seq <= at))
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
        drain(rebuild_stream(spark.readStream.schema(shape).parquet(path), queries.TOPIC_KINDS), out, ckpt)
    got = spark.read.parquet(out).select("meter_id", "seq", "topic", "telegramTimestamp", *ALL_PAYLOAD_FIELDS, "late").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[-1] for w in want)
