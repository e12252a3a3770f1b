"""Registered queries: one per operator group, each reading the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB text of the same name in ``meterflow.oracle``.
Timestamps are returned as TIMESTAMP_NTZ holding the UTC wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import producer
from .schemas import ELECTRICITY_FIELDS, GAS_FIELDS, READING_FIELDS

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def frame_telegrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telegrams of each meter's line stream, with line count, first and last line."""
    return producer.fixture_frames(spark, sf_dir).select(
        "meter_id", "telegram_no", "n_lines", "first_line", "last_line", "seq"
    )


@register
def parse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + C3: valid readings of every telegram."""
    r = producer.fixture_readings(spark, sf_dir)
    return r.where(F.col("valid")).select("meter_id", "seq", *READING_FIELDS)


@register
def reject_telegrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telegrams without the main timestamp."""
    r = producer.fixture_readings(spark, sf_dir)
    return r.where(~F.col("valid")).select("meter_id", "seq", *READING_FIELDS, "reason")


@register
def detect_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2: per meter and topic, the fields that changed."""
    changes = producer.changes_from_readings(producer.fixture_readings(spark, sf_dir))
    return changes.select(
        "meter_id", "seq", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS
    )


# --- producer: messages --------------------------------------------------

def _processing_time(spark: SparkSession):
    from .sources.fixtures import processing_time_constant

    return processing_time_constant(spark)


def _utc(spark: SparkSession, col):
    from .functions.timestamps import utc_wall_clock

    return utc_wall_clock(F.col(col) if isinstance(col, str) else col)


def _change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = producer.changes_from_readings(producer.fixture_readings(spark, sf_dir))
    return producer.messages_from_changes(changes, _processing_time(spark))


@register
def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D4: sparse JSON update records for the two topics."""
    m = _change_messages(spark, sf_dir)
    return m.select("meter_id", "seq", "topic", "key", "value", _utc(spark, "timestamp").alias("timestamp"))


# --- consumer: routing and raw rows --------------------------------------

def _routed(spark: SparkSession, sf_dir: str, absent: str = "null") -> DataFrame:
    from .plans.consumer import fixture_routed

    return fixture_routed(spark, sf_dir, absent=absent)


def _raw_out(spark: SparkSession, df: DataFrame) -> DataFrame:
    return df.select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        _utc(spark, "kafka_timestamp").alias("kafka_timestamp"),
        _utc(spark, "processing_timestamp").alias("processing_timestamp"),
        "telegram_timestamp",
        "raw_data",
    )


@register
def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E6: where each record goes, and why a record is rejected."""
    r = _routed(spark, sf_dir)
    return r.select("kafka_topic", "kafka_partition", "kafka_offset", "route", "reject_reason")


@register
def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E6: the rejects table."""
    r = _routed(spark, sf_dir).where(F.col("reject_reason").isNotNull())
    return r.select("kafka_topic", "kafka_partition", "kafka_offset", "reject_reason", "raw_data")


@register
def raw_electricity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the electricity raw table."""
    from .operators.routing import raw_rows

    return _raw_out(spark, raw_rows(_routed(spark, sf_dir), "electricity"))


@register
def raw_gas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the gas raw table."""
    from .operators.routing import raw_rows

    return _raw_out(spark, raw_rows(_routed(spark, sf_dir), "gas"))


@register
def raw_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows of both raw tables with absent times zero-filled."""
    r = _routed(spark, sf_dir, absent="zero").where(F.col("reject_reason").isNull())
    return r.select(
        "route",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        _utc(spark, "kafka_timestamp").alias("kafka_timestamp"),
        _utc(spark, "processing_timestamp").alias("processing_timestamp"),
        "telegram_timestamp",
        "raw_data",
    )


# --- positions ------------------------------------------------------------

GROUP = "p1-data-consumer-group"
TOPIC_KINDS = {"p1-electricity": "electricity", "p1-gas": "gas"}
OTHER_GROUP = "p1-audit-group"


def _ts(spark: SparkSession, text: str):
    from .functions.timestamps import from_utc_wall_clock

    return from_utc_wall_clock(F.lit(text))


def _ledgers(spark: SparkSession, sf_dir: str):
    from .operators.positions import high_water, ledger_updates

    r = _routed(spark, sf_dir)
    cut = _ts(spark, "2024-01-16 00:00:00")
    early = _ts(spark, "2024-01-08 00:00:00")
    old = ledger_updates(high_water(r.where(F.col("kafka_timestamp") < cut)), GROUP, _ts(spark, "2024-01-16 00:00:00"))
    old = old.unionByName(
        ledger_updates(high_water(r.where(F.col("kafka_timestamp") < early)), OTHER_GROUP, _ts(spark, "2024-01-08 00:00:00"))
    )
    fresh = ledger_updates(
        high_water(r.where(F.col("kafka_topic") == "p1-electricity")), GROUP, _ts(spark, "2024-02-01 00:00:00")
    )
    stale = ledger_updates(
        high_water(r.where((F.col("kafka_topic") == "p1-gas") & (F.col("kafka_timestamp") < early))),
        GROUP,
        _ts(spark, "2024-02-02 00:00:00"),
    )
    return old, fresh.unionByName(stale)


def _ledger_out(spark: SparkSession, df: DataFrame) -> DataFrame:
    return df.select("consumer_group_id", "topic", "partition", "last_offset", _utc(spark, "updated_at").alias("updated_at"))


@register
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """greatest consumed offset per topic partition."""
    from .operators.positions import high_water as hw

    return hw(_routed(spark, sf_dir))


@register
def upsert_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stored positions after applying fresh and stale updates."""
    from .operators.positions import upsert_ledger as up

    old, updates = _ledgers(spark, sf_dir)
    return _ledger_out(spark, up(old, updates))


@register
def upsert_ledger_rewind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with rewind: the latest update wins even when lower."""
    from .operators.positions import upsert_ledger as up

    old, updates = _ledgers(spark, sf_dir)
    return _ledger_out(spark, up(old, updates, rewind=True))


@register
def last_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """positions of one group for a topic list, none for unknown topics."""
    from .operators.positions import last_offsets as lo
    from .operators.positions import upsert_ledger as up

    old, updates = _ledgers(spark, sf_dir)
    return lo(spark, up(old, updates), GROUP, ["p1-electricity", "p1-gas", "p1-water"])


@register
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records after the stored positions (from earliest where none)."""
    from .operators.positions import last_offsets as lo
    from .operators.positions import resume as rs
    from .sources import fixtures

    old, _ = _ledgers(spark, sf_dir)
    pos = lo(spark, old, GROUP, ["p1-electricity", "p1-gas"])
    msgs = fixtures.messages(spark, sf_dir)
    return rs(msgs, pos).select("topic", "partition", "offset")


@register
def payload_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + E6: long strings, repeated keys, escapes and text after the object, one payload per event."""
    from .functions.timestamps import p1_time
    from .operators.routing import route_messages as rm
    from .sources.fixtures import events

    eid = F.col("event_id")
    pad = F.expr("repeat('x', cast(2000 + event_id % 5000 as int))")
    quoted = F.when(eid % 3 == 0, F.lit('\\"}{\\\\')).otherwise(F.lit(""))
    value = F.concat(
        F.lit('{"telegramTimestamp":"old","pad":"'), pad, quoted, F.lit('","telegramTimestamp":"'), p1_time(F.col("ts")), F.lit('"}'),
        F.when(eid % 5 == 0, F.lit(" more")).otherwise(F.lit("")),
    )
    records = events(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit("p1-gas").alias("topic"),
        F.lit(0).alias("partition"), eid.cast("long").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    return rm(records).select("kafka_offset", "route", "reject_reason", "telegram_timestamp", F.length("raw_data").cast("bigint").alias("n_chars"))


# --- consumer-side obligations ----------------------------------------------

@register
def dedup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: raw rows after a replay wrote every third record again."""
    from .operators.rebuild import dedup_raw as dd
    from .operators.routing import raw_rows

    raw = raw_rows(_routed(spark, sf_dir), "electricity")
    replay = raw.where(F.col("kafka_offset") % 3 == 0)
    return _raw_out(spark, dd(raw.unionByName(replay).unionByName(replay)))


@register
def typed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Electricity payloads as typed columns (absent keys null)."""
    from .operators.rebuild import typed_payload as tp
    from .operators.routing import raw_rows
    from .schemas import ELECTRICITY_PAYLOAD_SCHEMA

    t = tp(raw_rows(_routed(spark, sf_dir), "electricity"), "electricity")
    return t.select("kafka_partition", "kafka_offset", *[f.name for f in ELECTRICITY_PAYLOAD_SCHEMA.fields])


@register
def rebuild_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full readings rebuilt from the sparse update records, per topic."""
    from .operators.rebuild import rebuild_all, typed_payload_all
    from .operators.scan import block_of

    msgs = _change_messages(spark, sf_dir).select("meter_id", "seq", "topic", F.col("value").alias("raw_data"))
    typed = typed_payload_all(msgs).drop("raw_data", "processingTimestampUTC")
    out = rebuild_all(typed, "topic", TOPIC_KINDS, key=["meter_id"], order=["seq"], block=block_of(F.col("seq")))
    return out.select("meter_id", "seq", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS)


# --- sources, tables, sinks, streams ----------------------------------------
# These write derived inputs into a fresh folder under the session's
# checkpoint root (``session.work_dir``), then run the job over them.

def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, kept in a fresh folder."""
    from .session import work_dir

    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILE_ROWS = 500_000  # of a stream's appended file; the files of a trigger bound a micro-batch
TRIGGER_FILES = 8


def _write_in_order(df: DataFrame, path: str, chunk: str, chunks: int, key: list[str]) -> None:
    """Write ``df`` in ``chunks`` sequential appends by ``chunk`` value.

    An append holds all rows of a ``key`` in one file, so a file stream reads
    a key in order however many files it takes per micro-batch. The number of files
    follows from the rows, so micro-batches do not become many and small.
    """
    rows = {r[0]: r[1] for r in df.groupBy(chunk).count().collect()}
    for c in range(chunks):
        files = max(TRIGGER_FILES, -(-rows.get(c, 0) // FILE_ROWS))
        df.where(F.col(chunk) == c).drop(chunk).repartition(files, *key).write.mode("append").parquet(path)


@register
def capture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + C1 + C2: telegram text files per meter, framed split by split and parsed."""
    from .operators.parsing import parse_telegrams
    from .operators.split_framing import frame_splits
    from .session import work_dir
    from .sources import fixtures
    from .sources.captures import capture_source, write_captures

    path = work_dir(spark, "captures")
    write_captures(fixtures.telegrams(spark, sf_dir), path, "meter_id", ["seq"], "telegram")
    telegrams = frame_splits(capture_source(spark, path), ["meter_id"], ["capture_file", "split_start"], "pos")
    readings = parse_telegrams(telegrams)
    return readings.select(F.col("meter_id").cast("long").alias("meter_id"), "telegram_no", *READING_FIELDS)


@register
def table_setup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 - B5 + A4: create namespace and tables, ingest one batch twice
    (a replay), read the electricity table back."""
    import uuid

    from .plans.tables import setup_tables
    from .session import work_dir
    from .sources import fixtures
    from .streaming.ingest import ingest_batch

    ns = f"meterflow_{uuid.uuid4().hex[:8]}"
    names = setup_tables(spark, ns, work_dir(spark, "warehouse"), day=True, reset=True)
    msgs = fixtures.messages(spark, sf_dir)
    for _ in range(2):
        ingest_batch(msgs, 0, names, ingest_id="setup", updated_at=_ts(spark, "2024-02-01 00:00:00"))
    return _raw_out(spark, spark.table(names["electricity"]))


def _committed(spark: SparkSession, names: dict[str, str], *more: str) -> DataFrame:
    """Committed rows of both raw tables, read through the views."""
    parts = []
    for t in ("electricity", "gas"):
        df = spark.table(names[f"{t}_view"])
        parts.append(df.select(F.lit(t).alias("route"), *_raw_out(spark, df).columns, *more))
    both = parts[0].unionByName(parts[1])
    times = {c: _utc(spark, c) for c in ("kafka_timestamp", "processing_timestamp")}
    return both.select(*[times[c].alias(c) if c in times else F.col(c) for c in both.columns])


def _stream_ingest_run(spark: SparkSession, sf_dir: str):
    import uuid

    from .plans.tables import setup_tables
    from .session import work_dir
    from .sources import fixtures
    from .sources.topics import topic_source
    from .streaming.ingest import start_ingest

    log = work_dir(spark, "topic-log")
    msgs = fixtures.messages(spark, sf_dir)
    # Four appends in time order, in files of bounded size.
    chunked = msgs.withColumn("__chunk", F.floor((F.dayofmonth(_utc(spark, "timestamp")) - 1) * 4 / 31).cast("int"))
    # Ingest needs no order inside an append: its rows are dealt by offset, and the number
    # of micro-batches follows from the rows, not from the tasks that wrote them.
    _write_in_order(_stored(chunked, "records"), log, "__chunk", 4, ["topic", "partition", "offset"])
    ns = f"meterflow_{uuid.uuid4().hex[:8]}"
    names = setup_tables(spark, ns, work_dir(spark, "warehouse"), reset=True)
    src = topic_source(spark, ["p1-electricity", "p1-gas", "p1-unknown"], stream=True, path=log, max_per_batch=TRIGGER_FILES)
    q = start_ingest(src, names, work_dir(spark, "ckpt"), ingest_id="stream", available_now=True,
                     updated_at=_ts(spark, "2024-02-01 00:00:00"))
    q.awaitTermination()
    return names


@register
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A4 + F5 - F7: file topic log drained by a stream into the raw tables."""
    names = _stream_ingest_run(spark, sf_dir)
    return _committed(spark, names)


@register
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 + F7: the ledger a stream leaves after draining the topic log."""
    from .operators.positions import current_ledger

    names = _stream_ingest_run(spark, sf_dir)
    return current_ledger(spark.table(names["ledger_view"])).select(
        "consumer_group_id", "topic", "partition", "last_offset"
    )


@register
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 stateful: readings arrive as a stream in four appends; state per meter."""
    from .session import work_dir
    from .streaming.changes import stream_changes as sc

    readings = producer.fixture_readings(spark, sf_dir).where(F.col("valid")).select("meter_id", "seq", *READING_FIELDS)
    readings = _stored(readings, "readings")
    src_path = work_dir(spark, "appends")
    # Four appends by sequence range; the driver reads one scalar (the top seq).
    top = readings.agg(F.max("seq")).first()[0] or 0
    chunked = readings.withColumn("__chunk", F.floor(F.col("seq") * 4 / (top + 1)).cast("int"))
    _write_in_order(chunked, src_path, "__chunk", 4, ["meter_id"])
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", str(TRIGGER_FILES)).parquet(src_path)
    out = work_dir(spark, "changes")
    q = (sc(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", work_dir(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select(
        "meter_id", "seq", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS
    )


@register
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + A1 + E + G: publish update records to a topic log, read them back,
    rebuild full readings per meter in offset order."""
    from .operators.routing import route_messages
    from .operators.scan import block_of, segmented_scan
    from .plans.sinks import publish
    from .session import work_dir
    from .sources.topics import topic_source

    log = work_dir(spark, "published")
    # A file log has no broker: positions come with the records, dense per
    # topic partition in meter and sequence order.
    msgs = _change_messages(spark, sf_dir).withColumn("partition", (F.col("meter_id") % 4).cast("int"))
    msgs = segmented_scan(
        msgs,
        keys=["topic", "partition"],
        block=F.struct(F.col("meter_id"), block_of(F.col("seq"))),
        order=["meter_id", "seq"],
        sums={"offset": F.lit(1).cast("long")},
        inclusive=False,
    )
    publish(msgs, path=log)
    records = topic_source(spark, ["p1-electricity", "p1-gas"], stream=False, path=log)
    routed = route_messages(records, keep=["key"]).withColumn("meter", F.col("key").cast("string"))
    from .operators.rebuild import rebuild_all, typed_payload_all

    # Only what is returned goes into the scan: with columns that are pruned on one of its
    # branches, the log would be read and its payloads parsed once for each branch.
    accepted = routed.where(F.col("reject_reason").isNull()).select("meter", "kafka_topic", "kafka_offset", "raw_data")
    typed = typed_payload_all(accepted).drop("processingTimestampUTC", "raw_data")
    rebuilt = rebuild_all(typed, "kafka_topic", TOPIC_KINDS, key=["meter"], order=["kafka_offset"],
                          block=block_of(F.col("kafka_offset")))
    out = rebuilt.select(F.col("meter").cast("long").alias("meter_id"), F.col("kafka_topic").alias("topic"),
                         "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS)
    return out.select("meter_id", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS)


# --- commits, compaction, rewinds ---------------------------------------------

def _fresh_tables(spark: SparkSession) -> dict[str, str]:
    import uuid

    from .plans.tables import setup_tables
    from .session import work_dir

    return setup_tables(spark, f"meterflow_{uuid.uuid4().hex[:8]}", work_dir(spark, "warehouse"), reset=True)


@register
def committed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 + A4: three batches are ingested, of a fourth only one table was written when its writer
    stopped; readers of the committed views see the three."""
    from .operators.routing import raw_rows, route_messages
    from .plans.sinks import append_raw
    from .sources import fixtures
    from .streaming.ingest import ingest_batch

    names = _fresh_tables(spark)
    msgs = _stored(fixtures.messages(spark, sf_dir), "records")
    quarter = lambda i: msgs.where(F.col("offset") % 4 == i)
    for i in range(3):
        ingest_batch(quarter(i), i, names, "batches", updated_at=_ts(spark, "2024-02-01 00:00:00"))
    append_raw(raw_rows(route_messages(quarter(3)), "electricity"), names["electricity"], "batches", 3)
    return _committed(spark, names)


@register
def compacted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + A4: batches folded into day tables in two generations, one batch after them, and a replay
    of a folded batch; rows with their day, read through the committed views."""
    from .plans.commits import compact_days, vacuum
    from .sources import fixtures
    from .streaming.ingest import ingest_batch

    names = _fresh_tables(spark)
    msgs = _stored(fixtures.messages(spark, sf_dir), "records")

    def ingest(i):
        ingest_batch(msgs.where(F.col("offset") % 4 == i), i, names, "batches", updated_at=_ts(spark, "2024-02-01 00:00:00"))

    ingest(0)
    ingest(1)
    compact_days(spark, names)
    ingest(2)
    compact_days(spark, names)
    vacuum(spark, names)
    ingest(0)
    ingest(3)
    return _committed(spark, names, "day")


@register
def ledger_rewind_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a rewind in the stored ledger, records ingested after it, then compaction; the positions left."""
    from .operators.positions import current_ledger
    from .operators.positions import high_water as hw
    from .plans.commits import compact_days, rewind
    from .sources import fixtures
    from .streaming.ingest import ingest_batch

    names = _fresh_tables(spark)
    at = _ts(spark, "2024-02-01 00:00:00")
    msgs = _stored(fixtures.messages(spark, sf_dir), "records")
    ingest_batch(msgs, 0, names, "first", updated_at=at)
    electricity = msgs.where(F.col("topic") == "p1-electricity")
    back = hw(electricity, "topic", "partition", "offset").withColumn("last_offset", F.least(F.col("last_offset"), F.lit(9)))
    rewind(spark, names, back, GROUP, at)
    ingest_batch(electricity.where(F.col("offset").between(10, 50)), 0, names, "second", updated_at=at)
    compact_days(spark, names)
    left = current_ledger(spark.table(names["ledger_view"]))
    return left.select("consumer_group_id", "topic", "partition", "last_offset", F.col("epoch").cast("int").alias("epoch"))


@register
def position_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ranges of offsets that log, stored rows and ledger disagree on."""
    from .operators.audit import position_audit as audit
    from .operators.positions import high_water as hw
    from .sources import fixtures

    log = fixtures.messages(spark, sf_dir).select("topic", "partition", "offset")
    positions = hw(log, "topic", "partition", "offset").withColumn("last_offset", F.col("last_offset") - 20)
    kept = log.where(F.floor(F.col("offset") / 25) % 7 != 3)
    again = kept.where((F.col("offset") % 101).isin(7, 8))
    alien = log.where(F.col("offset") % 211 < 2).withColumn("offset", F.col("offset") + 5_000_000)
    return audit(log, kept.unionByName(again).unionByName(alien), positions)


@register
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 on a stream: raw rows, then copies of every third of them twice, as a stream of small batches."""
    from .operators.routing import raw_rows
    from .session import work_dir
    from .streaming.dedup import dedup_stream_exact

    raw = _stored(raw_rows(_routed(spark, sf_dir), "electricity"), "raw")
    path, out = work_dir(spark, "appends"), work_dir(spark, "once")
    for part in (raw, raw.where(F.col("kafka_offset") % 3 == 0), raw.where(F.col("kafka_offset") % 3 == 0)):
        part.write.mode("append").parquet(path)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "4").parquet(path)
    q = (dedup_stream_exact(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", work_dir(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return _raw_out(spark, spark.read.schema(raw.schema).parquet(out))


def rebuilt_stream(records: DataFrame) -> DataFrame:
    """Streamed update records, keyed by meter, routed (E), typed (G2) and rebuilt."""
    from .operators.rebuild import typed_payload_all
    from .operators.routing import route_messages as rm
    from .streaming.rebuild import rebuild_stream

    routed = rm(records, keep=["key"]).where(F.col("reject_reason").isNull())
    typed = typed_payload_all(routed).select(
        F.col("key").cast("string").cast("long").alias("meter_id"), F.col("kafka_offset").alias("seq"),
        F.col("kafka_topic").alias("topic"), "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS,
    )
    return rebuild_stream(typed, TOPIC_KINDS)


def _update_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update messages as topic records: a meter's sequence number is its offset."""
    msgs = _change_messages(spark, sf_dir)
    return msgs.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic",
        (F.col("meter_id") % 4).cast("int").alias("partition"), F.col("seq").alias("offset"), "timestamp",
        F.lit(0).alias("timestampType"),
    )


@register
def stream_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 on a stream, after E: full readings from sparse records that arrive in four appends."""
    from .session import work_dir

    records = _stored(_update_records(spark, sf_dir), "records")
    top = records.agg(F.max("offset")).first()[0] or 0
    chunked = records.withColumn("__chunk", F.floor(F.col("offset") * 4 / (top + 1)).cast("int"))
    path, out = work_dir(spark, "appends"), work_dir(spark, "rebuilt")
    _write_in_order(chunked, path, "__chunk", 4, ["key"])
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", str(TRIGGER_FILES)).parquet(path)
    q = (rebuilt_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", work_dir(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).drop("late").select(
        "meter_id", "seq", "topic", "telegramTimestamp", *ELECTRICITY_FIELDS, *GAS_FIELDS
    )
