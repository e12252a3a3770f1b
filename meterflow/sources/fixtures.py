"""Telegrams and topic messages derived from the ``events`` table.

One telegram per event, the meter being ``user_id``. Registers are running sums
per meter in whole thousandths so that every engine prints the same digits.
Some events carry edge cases, chosen by ``event_id`` residues (every row is
kept; the residue only picks the shape):

==========  =====================================================
residue     telegram shape
==========  =====================================================
% 11 == 0   CR LF line ends
% 13 == 0   gas line missing (gas reads as zero)
% 17 == 0   a stale current-consumption line before the real one
% 19 == 0   a noise line before the start line
% 23 == 0   main timestamp line missing (telegram rejected)
% 29 == 0   lines indented with space and tab
% 31 == 0   a stray end line before the start (closes nothing)
% 37 == 0   a second start line inside the telegram
% 41 == 0   end line missing (runs into the next telegram)
==========  =====================================================

The running sums and the per-meter sequence use the block scan, so one busy
meter does not end up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import from_utc_wall_clock, p1_time, rfc3339_utc
from ..operators.scan import DEFAULT_BLOCK_ROWS, block_of, segmented_scan
from ..schemas import DEFAULT_ELECTRICITY_TOPIC, DEFAULT_GAS_TOPIC

UNKNOWN_TOPIC = "p1-unknown"
# Few topic partitions hold all records: smaller blocks keep their scan on all cores.
MESSAGE_BLOCK_ROWS = 1 << 17


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _num(c: Column) -> Column:
    """Whole thousandths as ``dddddd.ddd`` (at least six integer digits)."""
    whole = F.floor(c / 1000).cast("long").cast("string")
    frac = (c % 1000).cast("string")
    # lpad cuts longer text, so pad only up to six digits.
    padded = F.lpad(whole, F.greatest(F.length(whole), F.lit(6)), F.lit("0"))
    return F.concat(padded, F.lit("."), F.lpad(frac, 3, "0"))


def meter_registers(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Per event: meter, sequence number and running registers in thousandths."""
    ev = events(spark, sf_dir)
    v = (F.round(F.col("value") * 100).cast("long") * 10).alias("v")
    base = ev.select("event_id", F.col("user_id").alias("meter_id"), "ts", "event_type", v)
    et = F.col("event_type")
    scanned = segmented_scan(
        base,
        keys=["meter_id"],
        block=block_of(F.col("event_id"), block_rows),
        order=["event_id"],
        sums={
            "seq": F.lit(1).cast("long"),
            "c1": F.when(et.isin("click", "view"), F.col("v")).otherwise(0),
            "c2": F.when(et == "purchase", F.col("v")).otherwise(0),
            "p1": F.when(et == "signup", F.col("v")).otherwise(0),
            "p2": F.when(et == "error", F.col("v")).otherwise(0),
            "gas": F.when(F.col("event_id") % 5 == 0, F.col("v")).otherwise(0),
        },
        inclusive=True,
    )
    return scanned.select(
        "event_id",
        "meter_id",
        F.col("seq").cast("long").alias("seq"),
        "ts",
        "event_type",
        "v",
        *[F.col(c).cast("long").alias(c) for c in ["c1", "c2", "p1", "p2", "gas"]],
        F.when(et.isin("click", "view"), 1).otherwise(2).alias("tariff"),
        F.when(F.col("event_id") % 7 == 0, F.col("v")).otherwise(0).alias("cp"),
    )


def telegrams(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One telegram text per event: ``(meter_id, seq, event_id, telegram)``."""
    r = meter_registers(spark, sf_dir, block_rows)
    eid = F.col("event_id")

    def has(n: int) -> Column:
        return eid % n == 0

    indent = F.when(has(29), F.lit(" \t")).otherwise(F.lit(""))
    # The numbers of a telegram go through one lambda. Written out one by one they make
    # the stage's generated method longer than the 8,000 bytes of code that the JVM
    # compiles, and every telegram is then built by its interpreter.
    registers = ("c1", "c2", "p1", "p2", "v", "cp", "gas")
    nums = F.transform(F.array(*[F.col(c).cast("long") for c in registers]), _num)
    time = p1_time(F.col("ts"))
    r = r.select("meter_id", "seq", "event_id", "tariff", nums.alias("nums"), time.alias("time"))
    num = {c: F.col("nums")[i] for i, c in enumerate(registers)}

    # Null: a line that is left out.
    body = F.array(
        F.when(~has(23), F.concat(F.lit("0-0:1.0.0("), F.col("time"), F.lit("W)"))),
        F.concat(F.lit("1-0:1.8.1("), num["c1"], F.lit("*kWh)")),
        F.concat(F.lit("1-0:1.8.2("), num["c2"], F.lit("*kWh)")),
        F.concat(F.lit("1-0:2.8.1("), num["p1"], F.lit("*kWh)")),
        F.concat(F.lit("1-0:2.8.2("), num["p2"], F.lit("*kWh)")),
        F.concat(F.lit("0-0:96.14.0(000"), F.col("tariff").cast("string"), F.lit(")")),
        F.when(has(17), F.lit("1-0:1.7.0(000000.000*kW)")),
        F.concat(F.lit("1-0:1.7.0("), num["v"], F.lit("*kW)")),
        F.concat(F.lit("1-0:2.7.0("), num["cp"], F.lit("*kW)")),
        F.when(
            ~has(13),
            F.concat(F.lit("0-1:24.2.1("), F.rpad(F.left(F.col("time"), F.lit(8)), 12, "0"), F.lit("W)("), num["gas"], F.lit("*m3)")),
        ),
    )
    head = F.array(F.when(has(31), F.lit("!")), F.when(has(19), F.lit("noise")), F.lit("/SYN5"), F.when(has(37), F.lit("/XYZ5")), F.lit(""))
    end = F.array(F.when(~has(41), F.concat(F.lit("!"), F.lpad((eid % 10000).cast("string"), 4, "0"))))
    lines = F.concat(head, F.transform(body, lambda l: F.concat(indent, l)), end)
    joined = F.array_join(lines, "\n")
    text = F.when(has(11), F.regexp_replace(joined, "\n", "\r\n")).otherwise(joined)
    return r.select("meter_id", "seq", "event_id", text.alias("telegram"))


def telegram_lines(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The telegrams of each meter as one ordered line stream per meter.

    Columns ``meter_id, seq, line_no, line``; the stream order is ``(seq, line_no)``.
    """
    t = telegrams(spark, sf_dir, block_rows)
    return t.select("meter_id", "seq", F.posexplode(F.split("telegram", "\n")).alias("line_no", "line")).select(
        "meter_id", "seq", F.col("line_no").cast("long").alias("line_no"), "line"
    )


def messages(spark: SparkSession, sf_dir: str, block_rows: int = MESSAGE_BLOCK_ROWS) -> DataFrame:
    """Topic records in the Kafka source shape, one per event.

    Topic by event type, partition ``user_id % 2``, offsets dense per
    (topic, partition) in ``event_id`` order, broker time = event time (UTC),
    key = the meter id. Payloads are update messages with edge cases:
    ``% 97`` broken JSON, ``% 89`` an array, ``% 83`` a number as telegram
    time and an unparsable processing time, ``% 79`` an empty object,
    ``% 73`` text after the object, ``% 71`` JSON null, ``% 67`` a time with
    offset and nine fraction digits, ``% 61`` a bare year as time.
    """
    ev = events(spark, sf_dir)
    et = F.col("event_type")
    topic = (
        F.when(et.isin("click", "view", "purchase"), F.lit(DEFAULT_ELECTRICITY_TOPIC))
        .when(et == "signup", F.lit(DEFAULT_GAS_TOPIC))
        .otherwise(F.lit(UNKNOWN_TOPIC))
    )
    base = ev.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        topic.alias("topic"),
        (F.col("user_id") % 2).cast("int").alias("partition"),
    )
    with_offsets = segmented_scan(
        base,
        keys=["topic", "partition"],
        block=block_of(F.col("event_id"), block_rows),
        order=["event_id"],
        sums={"offset": F.lit(1).cast("long")},
        inclusive=False,
    )
    eid = F.col("event_id")
    v = (F.round(F.col("value") * 100).cast("long") * 10).cast("string")
    wall = F.col("ts").cast("timestamp_ntz").cast("string")
    tf = F.concat(F.left(wall, F.lit(10)), F.lit("T"), F.substring(wall, 12, 8), F.lit("."), F.rpad(F.substring(wall, 21, 6), 6, "0"))
    # Both times once, as columns: as parts of each payload's shape they make the stage's
    # generated method too long for the JVM to compile.
    with_offsets = with_offsets.select("*", tf.alias("__tf"), p1_time(F.col("ts")).alias("__time"))
    tf, time = F.col("__tf"), F.col("__time")
    good = F.concat(
        F.lit('{"currentConsumption":'),
        v,
        F.lit(',"processingTimestampUTC":"'),
        tf,
        F.lit('Z","telegramTimestamp":"'),
        time,
        F.lit('"}'),
    )
    value = (
        F.when(eid % 97 == 0, F.lit("{broken"))
        .when(eid % 89 == 0, F.lit("[1,2]"))
        .when(eid % 83 == 0, F.lit('{"telegramTimestamp":5,"processingTimestampUTC":"nope"}'))
        .when(eid % 79 == 0, F.lit("{}"))
        .when(eid % 73 == 0, F.concat(good, F.lit(" trailing")))
        .when(eid % 71 == 0, F.lit("null"))
        .when(
            eid % 67 == 0,
            F.concat(
                F.lit('{"processingTimestampUTC":"'),
                tf,
                F.lit('789+02:00","telegramTimestamp":"'),
                time,
                F.lit('"}'),
            ),
        )
        .when(eid % 61 == 0, F.lit('{"processingTimestampUTC":"2025","telegramTimestamp":"x"}'))
        .otherwise(good)
    )
    return with_offsets.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        "topic",
        "partition",
        F.col("offset").cast("long").alias("offset"),
        from_utc_wall_clock(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def processing_time_constant(spark: SparkSession, text: str = "2024-02-01 00:00:00") -> Column:
    """A fixed processing time (UTC) for reproducible runs."""
    return from_utc_wall_clock(F.lit(text))


__all__ = [
    "events",
    "meter_registers",
    "telegrams",
    "telegram_lines",
    "messages",
    "processing_time_constant",
    "rfc3339_utc",
]
