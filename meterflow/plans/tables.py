"""Table definitions (B1 - B5): namespace, two raw tables, offset ledger.

Raw tables are Parquet tables by default (``fmt`` names another table format
that the session has, such as Iceberg; only Parquet has been run here) with the seven declared columns plus the write position ``ingest_id,
batch_id``: a replayed micro-batch overwrites exactly its own partition, so
replays do not duplicate rows. ``day=True`` adds a ``day`` partition below it
(UTC date of the broker time) for pruning. Beside them stand the commit manifest,
the day tables that ``plans.commits.compact_days`` folds batches into, and views
that show committed rows only (``plans.commits``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.positions import current_ledger
from ..session import work_dir
from .commits import COMMIT_DDL, FOLD_DDL, create_views, drop_partitions
from .sinks import overwrite_batch

RAW_DDL = (
    "kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP, "
    "processing_timestamp TIMESTAMP, telegram_timestamp STRING, raw_data STRING"
)
REJECT_DDL = RAW_DDL + ", reject_reason STRING"
LEDGER_DDL = "consumer_group_id STRING, topic STRING, `partition` INT, last_offset BIGINT, updated_at TIMESTAMP, epoch BIGINT"
POSITION_DDL = "ingest_id STRING, batch_id BIGINT"


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """B1: create the namespace when missing."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _create(spark: SparkSession, name: str, columns: str, partitions: list[str], location: str | None,
            codec: str | None, reset: bool, fmt: str) -> None:
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    loc = f" LOCATION '{location}'" if location else ""
    opts = f" OPTIONS ('compression' '{codec}')" if codec and fmt != "iceberg" else ""
    props = f" TBLPROPERTIES ('write.parquet.compression-codec' = '{codec}')" if codec and fmt == "iceberg" else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{opts}{parts}{loc}{props}")


def raw_partitions(day: bool) -> list[str]:
    # Write position first: a batch is replaced by a static partition spec,
    # whatever the session's partition overwrite mode.
    return ["ingest_id", "batch_id"] + (["day"] if day else [])


def ensure_raw_table(spark: SparkSession, name: str, location: str | None = None, day: bool = False,
                     codec: str | None = "zstd", reset: bool = False, fmt: str = "parquet",
                     rejects: bool = False) -> None:
    """Raw table with the declared columns; ``reset`` drops it first."""
    cols = (REJECT_DDL if rejects else RAW_DDL) + ", " + POSITION_DDL + (", day DATE" if day else "")
    _create(spark, name, cols, raw_partitions(day), location, codec, reset, fmt)


def ensure_ledger(spark: SparkSession, name: str, location: str | None = None, reset: bool = False,
                  fmt: str = "parquet") -> None:
    """Offset ledger, an append-only log of positions per batch.

    Parquet tables take no key constraint; the key (group, topic, partition)
    is kept by ``operators.positions.upsert_ledger`` when the log is read.
    """
    _create(spark, name, LEDGER_DDL + ", " + POSITION_DDL, ["ingest_id", "batch_id"], location, None, reset, fmt)


def setup_tables(spark: SparkSession, namespace: str, location: str | None = None, day: bool = False,
                 reset: bool = False, fmt: str = "parquet") -> dict[str, str]:
    """The whole setup: namespace, raw tables, rejects, ledger, commit manifest and views. Returns their names."""
    ensure_namespace(spark, namespace, location)
    names = {
        "electricity": f"{namespace}.raw_p1_electricity",
        "gas": f"{namespace}.raw_p1_gas",
        "rejects": f"{namespace}.raw_p1_rejects",
        "ledger": f"{namespace}.kafka_offsets",
    }

    def at(name: str) -> str | None:
        return f"{location.rstrip('/')}/{names[name].split('.')[-1]}" if location else None

    ensure_raw_table(spark, names["electricity"], at("electricity"), day=day, reset=reset, fmt=fmt)
    ensure_raw_table(spark, names["gas"], at("gas"), day=day, reset=reset, fmt=fmt)
    ensure_raw_table(spark, names["rejects"], at("rejects"), day=day, reset=reset, rejects=True, fmt=fmt)
    ensure_ledger(spark, names["ledger"], at("ledger"), reset=reset, fmt=fmt)

    names |= {
        "commits": f"{namespace}.ingest_commits",
        "folds": f"{namespace}.ingest_folds",
        "electricity_days": f"{namespace}.raw_p1_electricity_days",
        "gas_days": f"{namespace}.raw_p1_gas_days",
        "rejects_days": f"{namespace}.raw_p1_rejects_days",
        "ledger_folded": f"{namespace}.kafka_offsets_folded",
    }
    _create(spark, names["commits"], f"{COMMIT_DDL}, {POSITION_DDL}", ["ingest_id", "batch_id"], at("commits"), None, reset, fmt)
    _create(spark, names["folds"], f"{FOLD_DDL}, generation BIGINT", ["generation"], at("folds"), None, reset, fmt)
    for name, columns in (("electricity", RAW_DDL), ("gas", RAW_DDL), ("rejects", REJECT_DDL)):
        days = f"{name}_days"
        _create(spark, names[days], f"{columns}, generation BIGINT, day DATE", ["generation", "day"], at(days), "zstd", reset, fmt)
    _create(spark, names["ledger_folded"], f"{LEDGER_DDL}, generation BIGINT", ["generation"], at("ledger_folded"), None, reset, fmt)
    return names | create_views(spark, names)


COMPACTED = "compacted"


def compact_ledger(spark: SparkSession, name: str) -> None:
    """Fold the ledger's slices into one, so that reading it does not grow with its age.

    The current positions are computed and kept aside first, then written as a
    slice of their own, then the slices that were there before are dropped. A
    position found twice in between changes nothing, and batches written
    meanwhile keep their slices.
    """
    old = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]  # names, one per batch since the last time
    if not old:
        return
    path = work_dir(spark, "ledger")
    current_ledger(spark.table(name)).write.parquet(path)
    # Slices are folded whatever the manifest says: for a ledger without one. With
    # one, ``plans.commits.compact_days`` folds the committed slices.
    taken = [int(p.rsplit("=", 1)[1]) for p in old if p.startswith(f"ingest_id={COMPACTED}/")]
    overwrite_batch(spark.read.parquet(path), name, COMPACTED, max(taken, default=-1) + 1)
    drop_partitions(spark, name, [dict(x.split("=", 1) for x in p.split("/")) for p in old])
