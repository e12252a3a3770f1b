import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.functions.timestamps import from_utc_wall_clock, kafka_ts, p1_time, rfc3339_utc, utc_wall_clock


@pytest.fixture(params=["UTC", "Europe/Amsterdam", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_half_hour_of_the_change_days(spark, zone):
    """Both days on which Amsterdam moves its clocks, in UTC."""
    starts = [dt.datetime(2024, 3, 31, tzinfo=dt.timezone.utc), dt.datetime(2024, 10, 27, tzinfo=dt.timezone.utc)]
    micros = [int((s + dt.timedelta(minutes=30 * i)).timestamp()) * 1_000_000 + i for s in starts for i in range(48)]
    df = spark.createDataFrame([(m,) for m in micros], "us bigint").withColumn("ts", F.timestamp_micros("us"))
    out = df.select(
        "us",
        utc_wall_clock(F.col("ts")).cast("string").alias("wall"),
        rfc3339_utc(F.col("ts")).alias("text"),
        F.unix_micros(from_utc_wall_clock(utc_wall_clock(F.col("ts")))).alias("back"),
        p1_time(utc_wall_clock(F.col("ts"))).alias("p1"),
    ).collect()
    for r in out:
        t = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=r.us)
        frac = f".{t.microsecond:06d}".rstrip("0") if t.microsecond else ""
        assert r.wall == t.strftime("%Y-%m-%d %H:%M:%S") + frac
        assert r.text == t.strftime("%Y-%m-%dT%H:%M:%S") + frac + "Z"
        assert r.back == r.us
        assert r.p1 == t.strftime("%y%m%d%H%M%S")


def test_broker_millis(spark, zone):
    r = spark.createDataFrame([(1711852200123,), (None,)], "ms bigint").select(F.unix_millis(kafka_ts(F.col("ms"))).alias("ms")).collect()
    assert [x.ms for x in r] == [1711852200123, None]
