import datetime as dt

import pytest

from meterflow.operators.positions import high_water, last_offsets, resume, upsert_ledger, starting_offsets_json

LEDGER = "consumer_group_id string, topic string, partition int, last_offset long, updated_at timestamp"
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def test_high_water_counts_offset_zero(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 1, 5), ("a", 1, 3)], "kafka_topic string, kafka_partition int, kafka_offset long")
    assert sorted(tuple(r) for r in high_water(df).collect()) == [("a", 0, 0), ("a", 1, 5)]


def test_upsert_keeps_greater_unless_rewind(spark):
    old = spark.createDataFrame([("g", "a", 0, 10, T1), ("g", "b", 0, 4, T1)], LEDGER)
    upd = spark.createDataFrame([("g", "a", 0, 7, T2), ("g", "c", 1, 0, T2)], LEDGER)
    keep = {(r.topic, r.partition): (r.last_offset, r.updated_at) for r in upsert_ledger(old, upd).collect()}
    assert keep == {("a", 0): (10, T1), ("b", 0): (4, T1), ("c", 1): (0, T2)}
    rw = {(r.topic, r.partition): r.last_offset for r in upsert_ledger(old, upd, rewind=True).collect()}
    assert rw[("a", 0)] == 7
    empty = spark.createDataFrame([], LEDGER)
    assert upsert_ledger(old, empty).count() == 2


def test_lookup_and_resume(spark):
    ledger = spark.createDataFrame([("g", "a", 0, 1, T1), ("g", "a", 1, 0, T1), ("h", "b", 0, 9, T1)], LEDGER)
    lo = last_offsets(spark, ledger, "g", ["a", "b"])
    rows = sorted((r.topic, r.partition, r.last_offset) for r in lo.collect())
    assert rows == [("a", 0, 1), ("a", 1, 0), ("b", None, None)]
    every = {"a": [0, 1, 2], "b": [0]}
    assert starting_offsets_json(lo.collect(), every) == '{"a": {"0": 2, "1": 1, "2": -2}, "b": {"0": -2}}'
    assert starting_offsets_json([], {"a": [1]}) == '{"a": {"1": -2}}'
    with pytest.raises(ValueError):
        starting_offsets_json(lo.collect(), {"a": [0]})
    msgs = spark.createDataFrame([("a", 0, o) for o in range(4)] + [("a", 1, 0), ("b", 0, 0)],
                                 "topic string, partition int, offset long")
    got = sorted(tuple(r) for r in resume(msgs, lo).collect())
    assert got == [("a", 0, 2), ("a", 0, 3), ("b", 0, 0)]
