"""Work that is done once: lines are read once, groups of a stream are bounded, a reason is worked out once."""

from pyspark.sql import functions as F

from meterflow import queries
from meterflow.operators import rebuild
from meterflow.operators.routing import route_messages
from meterflow.operators.scan import block_of, segmented_scan
from meterflow.operators.split_framing import frame_splits
from meterflow.schemas import ELECTRICITY_FIELDS, GAS_FIELDS, MESSAGE_SCHEMA, READING_FIELDS, READING_SCHEMA
from meterflow.session import work_dir
from meterflow.sources import fixtures
from meterflow.streaming import keyed
from meterflow.streaming.changes import stream_changes

from .conftest import SF_SMALL


def test_framing_reads_its_lines_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def line(n):
        read.add(1)
        return ("/A", "x", "!")[n % 3]

    ids = spark.range(0, 900, 1, 1)
    df = ids.select(F.lit("m").alias("m"), F.floor(F.col("id") / 100).alias("split"), F.col("id").alias("pos"), line.asNondeterministic()("id").alias("line"))
    out = frame_splits(df, ["m"], ["split"], "pos")
    for _ in range(2):
        assert sorted((r.telegram_no, *r.lines) for r in out.collect()) == [(i, "/A", "x", "!") for i in range(300)]
    assert read.value == 900


def test_meters_of_a_stream_share_groups(spark):
    """Far more meters than groups, one of them null; the state is one row a group."""
    meters = 3 * keyed.GROUPS
    reading = [F.lit("t").alias(f.name) if f.dataType.simpleString() == "string" else F.col("seq").cast(f.dataType).alias(f.name) for f in READING_SCHEMA.fields]
    path, out = work_dir(spark, "appends"), work_dir(spark, "changes")
    for seq in (1, 2):
        meter = F.when(F.col("id") > 0, F.col("id") + (1 << 60))
        spark.range(meters).select(meter.alias("meter_id"), F.lit(seq).cast("long").alias("seq")).select("*", *reading).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", "1").parquet(path)
    q = stream_changes(stream.select("meter_id", "seq", *READING_FIELDS)).writeStream.format("parquet").option("path", out)
    q = q.option("checkpointLocation", work_dir(spark, "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= keyed.GROUPS
    got = spark.read.parquet(out)
    counts = {(r.topic, r.seq): (r.n, r.nulls) for r in got.groupBy("topic", "seq").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("meter_id").isNull().cast("int")).alias("nulls")).collect()}
    assert counts == {(t, s): (meters, 1) for t in ("electricity", "gas") for s in (1, 2)}
    assert got.where("meter_id IS NOT NULL").agg(F.max("meter_id")).first()[0] == (1 << 60) + meters - 1


def test_appends_are_few_files(spark):
    path = work_dir(spark, "appends")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        queries._write_in_order(spark.range(2000).withColumn("c", F.lit(0)), path, "c", 1, ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() <= queries.TRIGGER_FILES


def test_the_reason_is_worked_out_once(spark):
    plan = route_messages(spark.createDataFrame([], MESSAGE_SCHEMA).union(spark.createDataFrame([], MESSAGE_SCHEMA)))._jdf.queryExecution().analyzed().toString()
    assert plan.count("unknown_topic") == 1


def _plan(df):
    """The plan as it is run, without the adaptive steps."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rebuilding_parses_its_payloads_once(spark):
    """both branches of the scan read one shuffle of the typed payloads."""
    msgs = spark.range(100).select(F.lit("m").alias("m"), F.col("id").alias("seq"), F.lit("p1-gas").alias("topic"), F.lit('{"gasConsumption":1.5}').alias("raw_data"))
    typed = rebuild.typed_payload_all(msgs.union(msgs.where("false"))).drop("raw_data", "processingTimestampUTC")
    out = rebuild.rebuild_all(typed, "topic", queries.TOPIC_KINDS, key=["m"], order=["seq"], block=block_of(F.col("seq"), 7))
    plan = _plan(out.select("m", "seq", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS))
    assert "ReusedExchange" in plan
    assert {(r.gasConsumption, r.currentTariff) for r in out.collect()} == {(1.5, None)}


def test_a_scan_counts_its_partitions(spark):
    """light rows that become heavy ones are not merged by their bytes."""
    df = spark.range(10).select(F.lit("m").alias("m"), "id")
    assert "REPARTITION_BY_NUM" in _plan(segmented_scan(df, ["m"], block_of(F.col("id"), 2), ["id"], sums={"n": F.lit(1)}))


def test_texts_are_short_expressions(spark):
    """the generated methods stay short enough to be compiled."""
    plan = fixtures.telegrams(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert plan.count("lpad(") <= 4
    plan = fixtures.messages(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1


def test_micro_batches_follow_from_the_rows(spark):
    """one batch per append here, however many files the records were kept in."""
    conf = {"spark.sql.files.openCostInBytes": str(1 << 27), "spark.sql.files.maxPartitionBytes": str(1 << 27)}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        names = queries._stream_ingest_run(spark, SF_SMALL)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert spark.table(names["commits"]).count() == 4
