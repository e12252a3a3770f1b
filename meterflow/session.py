"""Session settings and shared scratch locations.

Scratch data (stream checkpoints, derived inputs, tables written by queries)
lives under the folder the cluster names in ``spark.checkpoint.dir``. Only when
that is unset (local runs, tests) is a temporary folder chosen and set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small local inputs: keep shuffles split across all cores. On a cluster
    # the partitions are far above this floor anyway.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Repeated JSON keys are accepted, last one wins, as the reference's
    # decoders do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "meterflow", shuffle_partitions: int | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if is_local(master):
        # Local mode runs everything in the driver JVM. A cluster keeps its own
        # number of reducers: adaptive execution only ever lowers it.
        conf["spark.driver.memory"] = "8g"
        shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k.replace("__", "."): str(v) for k, v in extra.items()})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    If none is set, a temporary folder in local mode; an error on a cluster,
    where every executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="meterflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - some sessions refuse core settings at runtime
            pass
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing folder below the checkpoint root, unique per call."""
    return f"{checkpoint_root(spark)}/meterflow/{name}-{uuid.uuid4().hex[:12]}"


def session_time_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")
