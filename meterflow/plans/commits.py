"""Commit manifest, committed views, compaction by day, rewinds.

A batch is written to several tables. It is visible once its row stands in the
manifest: ``ingest_commits`` has one partition, written last and in one file, per
``(ingest_id, batch_id)``. The views (``*_view``) join on it, so a reader sees the
rows of all tables and the positions of a batch, or nothing.

``compact_days`` folds committed batches into day tables, sorted by topic,
partition and offset. A fold is a numbered generation: it rewrites the days that
the folded batches touch, adds the ledger they amount to, and becomes visible as
one file of ``ingest_folds``, which says completely which batch ranges are folded
and which generation of each day counts. Before that file stands, the views show
the batches; after it, the days. A replayed batch is found in the ranges and not
written again. Commits that arrive during a fold are left for the next.
``vacuum`` drops what the last fold made unreachable.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timestamps import utc_wall_clock
from ..operators.positions import current_ledger, group_epoch
from ..schemas import DEFAULT_GROUP_ID, LEDGER_COLUMNS, RAW_COLUMNS
from ..session import work_dir
from .sinks import overwrite_batch, partition_spec, write_partition

COMMIT_DDL = "committed_at TIMESTAMP"
# kind 'batches': a range of folded batches; kind 'day': the generation of a table's day that counts.
FOLD_DDL = (
    "kind STRING, table_name STRING, ingest_id STRING, first_batch BIGINT, last_batch BIGINT, day DATE, day_generation BIGINT"
)
FOLDED = ("electricity", "gas", "rejects")
DROP_AT_ONCE = 500

_DAY_SQL = "CAST(timestampadd(MICROSECOND, unix_micros(kafka_timestamp), TIMESTAMP_NTZ '1970-01-01 00:00:00') AS DATE)"


def _columns(name: str) -> list[str]:
    return RAW_COLUMNS + (["reject_reason"] if name == "rejects" else [])


def create_views(spark: SparkSession, names: Mapping[str, str]) -> dict[str, str]:
    """Views of committed rows (raw columns and ``day``) and positions; their names under ``<table>_view``."""
    last = f"SELECT * FROM {names['folds']} WHERE generation = (SELECT max(generation) FROM {names['folds']})"
    visible = (
        f"SELECT c.ingest_id, c.batch_id FROM {names['commits']} c LEFT ANTI JOIN ({last}) f "
        "ON f.kind = 'batches' AND f.ingest_id = c.ingest_id AND c.batch_id BETWEEN f.first_batch AND f.last_batch"
    )
    out = {}
    for name in FOLDED:
        cols = ", ".join(_columns(name))
        out[f"{name}_view"] = view = f"{names[name]}_committed"
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS "
            f"SELECT {cols}, {_DAY_SQL} AS day FROM {names[name]} r "
            f"LEFT SEMI JOIN ({visible}) v ON r.ingest_id = v.ingest_id AND r.batch_id = v.batch_id "
            f"UNION ALL SELECT {cols}, day FROM {names[name + '_days']} d "
            f"LEFT SEMI JOIN ({last}) l ON l.kind = 'day' AND l.table_name = '{name}' "
            "AND l.day <=> d.day AND l.day_generation = d.generation"
        )
    cols = ", ".join(f"`{c}`" for c in [*LEDGER_COLUMNS, "epoch"])
    out["ledger_view"] = f"{names['ledger']}_committed"
    spark.sql(
        f"CREATE OR REPLACE VIEW {out['ledger_view']} AS "
        f"SELECT {cols} FROM {names['ledger']} r "
        f"LEFT SEMI JOIN ({visible}) v ON r.ingest_id = v.ingest_id AND r.batch_id = v.batch_id "
        f"UNION ALL SELECT {cols} FROM {names['ledger_folded']} "
        f"WHERE generation = (SELECT max(generation) FROM {names['folds']})"
    )
    return out


# --- commits --------------------------------------------------------------------


def commit_batch(spark: SparkSession, names: Mapping[str, str], ingest_id: str, batch_id: int, at: Column) -> None:
    """Make a batch visible: one row in one file, in a partition of its own."""
    row = spark.range(0, 1, 1, 1).select(at.cast("timestamp").alias("committed_at"))
    overwrite_batch(row, names["commits"], ingest_id, batch_id)


def _last_fold(spark: SparkSession, names: Mapping[str, str]) -> tuple[int, DataFrame]:
    folds = spark.table(names["folds"])
    generation = folds.agg(F.max("generation")).first()[0] or 0
    return generation, folds.where(F.col("generation") == generation)


def is_committed(spark: SparkSession, names: Mapping[str, str], ingest_id: str, batch_id: int) -> bool:
    """Whether a batch stands in the manifest, by itself or in a folded range."""
    own = spark.table(names["commits"]).where((F.col("ingest_id") == ingest_id) & (F.col("batch_id") == batch_id))
    if not own.isEmpty():
        return True
    _, fold = _last_fold(spark, names)
    here = F.lit(int(batch_id)).between(F.col("first_batch"), F.col("last_batch"))
    return not fold.where((F.col("kind") == "batches") & (F.col("ingest_id") == ingest_id) & here).isEmpty()


# --- rewind -----------------------------------------------------------------------


def rewind(
    spark: SparkSession, names: Mapping[str, str], positions: DataFrame, group_id: str = DEFAULT_GROUP_ID,
    updated_at: Column | None = None,
) -> int:
    """Set a group's ``positions(topic, partition, last_offset)``, also backwards (F2). Returns the new epoch.

    The positions are a committed slice of the log in the group's next epoch, so
    they outrank whatever older epochs say, now and after a compaction.
    Partitions that are not named keep their position.
    """
    epoch = group_epoch(spark.table(names["ledger_view"]), group_id) + 1
    stamp = updated_at if updated_at is not None else F.current_timestamp()
    rows = positions.select(
        F.lit(group_id).alias("consumer_group_id"),
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("last_offset").cast("long").alias("last_offset"),
        stamp.alias("updated_at"),
        F.lit(epoch).cast("long").alias("epoch"),
    )
    ingest_id = "rewind-" + re.sub(r"[^A-Za-z0-9_.-]", "_", group_id)
    overwrite_batch(rows, names["ledger"], ingest_id, epoch)
    commit_batch(spark, names, ingest_id, epoch, stamp)
    return epoch


# --- compaction -------------------------------------------------------------------


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranges(batches: DataFrame) -> DataFrame:
    """``ingest_id, first_batch, last_batch`` with touching ranges joined."""
    order = Window.partitionBy("ingest_id").orderBy("first_batch", "last_batch")
    reach = F.max("last_batch").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first_batch") > reach + 1), 1).otherwise(0)
    island = F.sum("__new").over(order)
    marked = batches.withColumn("__new", new).withColumn("__island", island)
    return marked.groupBy("ingest_id", "__island").agg(F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch")).drop("__island")


def _fold_rows(kind: str, df: DataFrame, **values: Column) -> DataFrame:
    """Rows of the fold table; columns that ``values`` does not give are null."""
    fields = [f.strip().split(" ") for f in FOLD_DDL.split(",")]
    values["kind"] = F.lit(kind)
    return df.select(*[values.get(c, F.lit(None)).cast(t.lower()).alias(c) for c, t in fields])


def compact_days(spark: SparkSession, names: Mapping[str, str]) -> int:
    """Fold the committed batches into the day tables and the folded ledger (B5). Returns the generation that counts.

    The work is that of the folded batches and of the days they touch.
    """
    last, state = _last_fold(spark, names)
    generation = last + 1
    state = _kept(state, "fold-state")
    ranges = state.where("kind = 'batches'").select("ingest_id", "first_batch", "last_batch")
    commits = spark.table(names["commits"]).select("ingest_id", "batch_id").distinct()
    r = ranges.withColumnRenamed("ingest_id", "__i")
    folded = (F.col("ingest_id") == F.col("__i")) & F.col("batch_id").between(F.col("first_batch"), F.col("last_batch"))
    # What is folded is fixed here: a commit that comes later stays for the next fold.
    batches = _kept(commits.join(r, folded, "left_anti"), "fold-batches")
    if batches.isEmpty():
        return last
    # What a fold that died before its commit may have left.
    for table in (*[names[f"{name}_days"] for name in FOLDED], names["ledger_folded"], names["folds"]):
        drop_partitions(spark, table, [p for p in partitions(spark, table) if int(p["generation"]) >= generation])
    rows = []
    for name in FOLDED:
        cols = _columns(name)
        new = spark.table(names[name]).join(batches, ["ingest_id", "batch_id"], "left_semi")
        new = new.select(*cols, F.to_date(utc_wall_clock(F.col("kafka_timestamp"))).alias("day"))
        touched = _kept(new.select(F.col("day").alias("__d")).distinct(), "fold-touched")
        on_touched = F.col("day").eqNullSafe(F.col("__d"))
        counted = state.where((F.col("kind") == "day") & (F.col("table_name") == name)).select("day", "day_generation")
        c = counted.select(F.col("day").alias("__cd"), "day_generation")
        current = F.col("day").eqNullSafe(F.col("__cd")) & (F.col("generation") == F.col("day_generation"))
        old = spark.table(names[f"{name}_days"]).join(c, current, "left_semi").join(touched, on_touched, "left_semi")
        order = ["day", "kafka_topic", "kafka_partition", "kafka_offset"]
        merged = new.unionByName(old.select(*cols, "day")).repartitionByRange(*order).sortWithinPartitions(*order)
        write_partition(merged, names[f"{name}_days"], {"generation": generation}, dynamic=["day"], overwrite=False)
        rows.append(_fold_rows("day", counted.join(touched, on_touched, "left_anti"), table_name=F.lit(name), day=F.col("day"), day_generation=F.col("day_generation")))
        rows.append(_fold_rows("day", touched, table_name=F.lit(name), day=F.col("__d"), day_generation=F.lit(generation)))
    slices = spark.table(names["ledger"]).join(batches, ["ingest_id", "batch_id"], "left_semi")
    before = spark.table(names["ledger_folded"]).where(F.col("generation") == last)
    columns = [*LEDGER_COLUMNS, "epoch"]
    ledger = current_ledger(slices.select(*columns).unionByName(before.select(*columns)))
    write_partition(ledger, names["ledger_folded"], {"generation": generation}, overwrite=False)
    one = F.col("batch_id")
    ranges = _ranges(ranges.unionByName(batches.select("ingest_id", one.alias("first_batch"), one.alias("last_batch"))))
    fold = _fold_rows("batches", ranges, **{c: F.col(c) for c in ranges.columns})
    for part in rows:
        fold = fold.unionByName(part)
    # One file: the fold is there or not.
    write_partition(fold.coalesce(1), names["folds"], {"generation": generation}, overwrite=False)
    return generation


def drop_partitions(spark: SparkSession, table: str, specs: Sequence[Mapping[str, str | None]]) -> None:
    """Drop partitions, many in a statement, and delete their files (a table with a location keeps them otherwise)."""
    if not specs:
        return
    types = dict(spark.table(table).dtypes)
    location = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location")
    for at in range(0, len(specs), DROP_AT_ONCE):
        part = specs[at : at + DROP_AT_ONCE]
        texts = [partition_spec({c: int(v) if types[c] == "bigint" else v for c, v in s.items()}) for s in part]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({t})" for t in texts))
    hadoop = spark._jvm.org.apache.hadoop.fs
    for spec in specs:
        path = hadoop.Path("/".join([location.rstrip("/"), *[f"{c}={_NO_VALUE if v is None else v}" for c, v in spec.items()]]))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partitions(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """The partitions of a table, by name."""
    names = (dict(x.split("=", 1) for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return [{c: None if v in (_NO_VALUE, "null") else v for c, v in p.items()} for p in names]


def vacuum(spark: SparkSession, names: Mapping[str, str]) -> None:
    """Drop folded batches, days that a later generation replaced, and earlier folds.

    Readers that planned before the last fold may still want these: run it when they are done.
    """
    generation, state = _last_fold(spark, names)
    if not generation:
        return
    ranges = [(r["ingest_id"], r["first_batch"], r["last_batch"]) for r in state.where("kind = 'batches'").collect()]
    counted = {(r["table_name"], r["day"] and str(r["day"])): r["day_generation"] for r in state.where("kind = 'day'").collect()}
    # Names of partitions only: batches since the last time, and days.
    for name in (*FOLDED, "ledger", "commits"):
        specs = {(p["ingest_id"], int(p["batch_id"])) for p in partitions(spark, names[name])}
        gone = sorted(s for s in specs if any(s[0] == i and lo <= s[1] <= hi for i, lo, hi in ranges))
        drop_partitions(spark, names[name], [{"ingest_id": i, "batch_id": str(b)} for i, b in gone])
    for name in FOLDED:
        days = partitions(spark, names[f"{name}_days"])
        gone = [p for p in days if int(p["generation"]) <= generation and counted.get((name, p["day"])) != int(p["generation"])]
        drop_partitions(spark, names[f"{name}_days"], gone)
    for table in (names["ledger_folded"], names["folds"]):
        drop_partitions(spark, table, [p for p in partitions(spark, table) if int(p["generation"]) < generation])
