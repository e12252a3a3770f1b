"""Telegram capture source (A2): text files of meter output, read line by line.

A capture file is split like any text file; each line keeps its file, the
byte offset of its split and an id that rises in reading order inside the
split. (file, split) is a natural scan block for framing: a long capture is
framed by as many tasks as it has splits, and only the per-split summaries
travel between them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING_TASKS = 4  # a core
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def capture_source(spark: SparkSession, path: str, where: Column | str | None = None, **options: str) -> DataFrame:
    """Lines of all capture files under ``path``, nested folders included.

    ``where``: a filter on the folder layout's columns. It is applied below the
    row ids, so it prunes folders. Lines end at LF only; a CR is part of the
    line (framing trims it).

    Columns: partition columns of the folder layout (for example
    ``meter_id``), ``capture_file``, ``split_start``, ``pos``, ``line``.
    ``(capture_file, split_start, pos)`` orders the lines of a file.
    """
    reader = spark.read.option("lineSep", "\n")
    for k, v in options.items():
        reader = reader.option(k, v)
    # Folders are listed by tasks, one a folder up to this setting's 10,000.
    tasks = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(tasks), LISTING_TASKS * max(spark.sparkContext.defaultParallelism, 8))))
    try:
        df = reader.text(path)
        parts = [c for c in df.columns if c != "value"]
        if not parts and "recursiveFileLookup" not in options:
            # No partition folders: plain nested folders are searched as well.
            df = reader.option("recursiveFileLookup", "true").text(path)
    finally:
        spark.conf.set(_LISTING, tasks)
    if where is not None:
        df = df.where(where)
    return df.select(
        *parts,
        F.col("_metadata.file_path").alias("capture_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def write_captures(texts: DataFrame, path: str, capture: str, order: Sequence[str], text: str) -> None:
    """A folder of capture files: the texts of a ``capture`` in ``order``, each ended by a LF, below ``capture=value``.

    A capture is one file, or one for each task that its texts are spread over; their
    names rise with the order. The layout is that of Spark's ``partitionBy`` writer,
    which is what writes to a file system other than the local one. There it takes 4 ms
    a file on eight cores (checksum files, modes set by child processes), so the files of
    a local or mounted folder are written by the tasks themselves. A file gets its name
    when it is whole, and a task that runs again replaces its files by the same.
    """
    placed = texts.repartitionByRange(capture, *order).sortWithinPartitions(capture, *order).select(capture, text)
    spark = texts.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(folder).toUri()
    if uri.getScheme() != "file":
        placed.write.partitionBy(capture).text(path)
        return
    top = uri.getPath()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, open_, part, files = None, None, f"part-{TaskContext.get().partitionId():08d}.txt", 0
        try:
            for batch in batches:
                ids, rows = batch.column(0), batch.column(1).to_pylist()
                changes = np.flatnonzero(np.asarray(ids[1:].to_pylist(), object) != np.asarray(ids[:-1].to_pylist(), object)) + 1
                bounds = [0, *changes.tolist(), len(rows)]
                for lo, hi in zip(bounds, bounds[1:]):
                    if lo == hi:
                        continue
                    if ids[lo].as_py() != name or open_ is None:
                        if open_ is not None:
                            _finish(open_, part)
                        name, files = ids[lo].as_py(), files + 1
                        folder = f"{top}/{name}"
                        os.makedirs(folder, exist_ok=True)
                        open_ = open(f"{folder}/.{uuid.uuid4().hex}", "wb")
                    open_.write(b"\n".join(rows[lo:hi]) + b"\n")
            if open_ is not None:
                _finish(open_, part)
                open_ = None
        finally:
            if open_ is not None:
                open_.close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    os.makedirs(top, exist_ok=True)
    value = F.coalesce(F.col(capture).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    folder = F.concat(F.lit(f"{capture}="), value)
    rows = placed.select(folder.alias("folder"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def _finish(file, name: str) -> None:
    file.close()
    os.replace(file.name, f"{os.path.dirname(file.name)}/{name}")


def capture_block():
    return F.struct(F.col("capture_file"), F.col("split_start"))
