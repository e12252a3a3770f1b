from pyspark.sql import functions as F

from meterflow import queries
from meterflow.plans import producer
from meterflow.schemas import READING_FIELDS
from meterflow.session import work_dir
from meterflow.streaming.changes import LATE, stream_changes

from .conftest import SF_SMALL


def drain(spark, path, schema, files=None):
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", str(files))
    out = work_dir(spark, "changes")
    stream = stream_changes(reader.parquet(path)).writeStream.format("parquet").option("path", out)
    stream.option("checkpointLocation", work_dir(spark, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def rows(df, cols):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


def test_many_files_per_append_equal_the_batch(spark):
    """32 files an append, no coalescing, few files a micro-batch: a meter is in one file of an append."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        readings = producer.fixture_readings(spark, SF_SMALL).where(F.col("valid")).select("meter_id", "seq", *READING_FIELDS)
        readings = queries._stored(readings, "readings")
        top = readings.agg(F.max("seq")).first()[0]
        path = work_dir(spark, "appends")
        for c in range(4):
            part = readings.where(F.floor(F.col("seq") * 4 / (top + 1)) == c)
            part.repartition(32, "meter_id").write.mode("append").parquet(path)
        got = drain(spark, path, readings.schema, files=8)
        want = queries.detect_changes(spark, SF_SMALL)
        assert rows(got, want.columns) == rows(want, want.columns)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_late_readings_are_marked_and_never_compared(spark):
    schema = producer.fixture_readings(spark, SF_SMALL).select("meter_id", "seq", *READING_FIELDS).schema

    def reading(seq, consumption):
        zero = {f.name: (1 if f.name in ("meter_id", "seq", "currentTariff") else "t" if f.dataType.simpleString() == "string" else 0.0) for f in schema.fields}
        return tuple({**zero, "seq": seq, "currentConsumption": consumption}[f.name] for f in schema.fields)

    path = work_dir(spark, "appends")
    for batch in ([reading(1, 1.0), reading(5, 5.0)], [reading(3, 3.0), reading(5, 9.0)], [reading(6, 5.0), reading(7, 6.0)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    got = drain(spark, path, schema, files=1).collect()
    assert sorted((r.seq, r.currentConsumption) for r in got if r.topic == LATE) == [(3, None), (5, None)]
    # 6 equals the last reading in order (5), so only 7 is a change.
    assert sorted((r.seq, r.currentConsumption) for r in got if r.topic == "electricity") == [(1, 1.0), (5, 5.0), (7, 6.0)]
