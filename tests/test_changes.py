import json

from pyspark.sql import functions as F

from meterflow.operators.changes import detect_changes, to_messages
from meterflow.operators.scan import block_of
from meterflow.schemas import READING_FIELDS
from meterflow.sources.fixtures import processing_time_constant

Z = dict(timestamp="", electricityConsumption1=0.0, electricityConsumption2=0.0, electricityProduction1=0.0,
         electricityProduction2=0.0, currentTariff=0, currentConsumption=0.0, currentProduction=0.0,
         gasTimestamp="", gasConsumption=0.0)


def reading(meter, seq, **kw):
    r = dict(Z, timestamp=f"2401010000{seq:02d}")
    r.update(kw)
    return (meter, seq, *[r[f] for f in READING_FIELDS])


SCHEMA = ("meter_id long, seq long, timestamp string, electricityConsumption1 double, electricityConsumption2 double, "
          "electricityProduction1 double, electricityProduction2 double, currentTariff int, currentConsumption double, "
          "currentProduction double, gasTimestamp string, gasConsumption double")


def changes(spark, rows, block_rows=2):
    df = spark.createDataFrame(rows, SCHEMA)
    return detect_changes(df, ["meter_id"], ["seq"], block_of(F.col("seq"), block_rows))


def test_change_rules(spark):
    rows = [
        reading(1, 1),                                   # first reading, all zero: both topics, no fields
        reading(1, 2),                                   # nothing changed
        reading(1, 3, gasConsumption=1.5, gasTimestamp="240101000000"),  # only gas
        reading(1, 4, currentTariff=2, gasConsumption=1.5, gasTimestamp="240101000000"),
        reading(1, 5),                                   # codes vanish: change to zero
        reading(2, 1, currentConsumption=3.0),           # second meter interleaved
        reading(2, 2, currentConsumption=3.0),
    ]
    got = {(r.meter_id, r.seq, r.topic): r for r in changes(spark, rows).collect()}
    assert set(got) == {(1, 1, "electricity"), (1, 1, "gas"), (1, 3, "gas"), (1, 4, "electricity"),
                        (1, 5, "electricity"), (1, 5, "gas"), (2, 1, "electricity"), (2, 1, "gas")}
    assert got[(1, 1, "electricity")].currentConsumption is None
    assert got[(1, 3, "gas")].gasConsumption == 1.5 and got[(1, 3, "gas")].gasTimestamp == "240101000000"
    assert got[(1, 4, "electricity")].currentTariff == 2 and got[(1, 4, "electricity")].currentConsumption is None
    assert got[(1, 5, "gas")].gasTimestamp == "" and got[(1, 5, "gas")].gasConsumption == 0.0
    assert got[(2, 1, "electricity")].currentConsumption == 3.0


def test_payload_is_sparse_and_sorted(spark):
    rows = [reading(1, 1, currentConsumption=6.55, electricityConsumption1=1234.0)]
    msgs = to_messages(changes(spark, rows), processing_time_constant(spark)).collect()
    by_topic = {m.topic: m for m in msgs}
    e = json.loads(by_topic["p1-electricity"].value)
    assert list(e) == sorted(e)
    assert e == {"currentConsumption": 6.55, "electricityConsumption1": 1234.0,
                 "processingTimestampUTC": "2024-02-01T00:00:00Z", "telegramTimestamp": "240101000001"}
    g = json.loads(by_topic["p1-gas"].value)
    assert set(g) == {"processingTimestampUTC", "telegramTimestamp"}
