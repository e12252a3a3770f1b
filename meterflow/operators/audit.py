"""Audit of positions (F4): what the log, the stored rows and the ledger say of each offset.

Two steps. Offsets are cut into blocks; per topic partition and block the log's and
the stored offsets are summarised (count, sum, exclusive-or of digests) by an
aggregate with map-side combine, so one row a block is exchanged. Only blocks whose
summaries differ, or that reach beyond the stored position, are looked at offset by
offset. Neighbouring offsets of one kind become ranges by row numbers from a block
scan: no window spans a whole topic partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import DEFAULT_BLOCK_ROWS, block_of, dense_rank_in_key

DOUBLED = "doubled"  # stored more than once
UNLOGGED = "unlogged"  # stored, but not in the log
MISSING = "missing"  # in the log at or below the position, not stored
PENDING = "pending"  # in the log beyond the position, not stored yet
AHEAD = "ahead"  # stored beyond the position

_KEY = ["topic", "partition"]


def _same(columns: list[str], prefix: str) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def position_audit(log: DataFrame, stored: DataFrame, positions: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``topic, partition, kind, first_offset, last_offset``: ranges of offsets that are not as they should be.

    ``log`` and ``stored``: rows with ``topic, partition, offset``. ``positions``:
    ``topic, partition, last_offset`` of one group; a partition without one is
    read from the start, all of it beyond the position. An offset has the first
    kind that fits of doubled, unlogged, missing or pending, ahead.
    """

    def side(df: DataFrame, logged: int) -> DataFrame:
        return df.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), F.lit(logged).alias("logged"))

    both = side(log, 1).unionByName(side(stored, 0)).withColumn("block", block_of(F.col("offset"), block_rows))
    last = positions.select(*[F.col(c).alias(f"__p_{c}") for c in _KEY], F.col("last_offset").alias("__last"))
    beyond = F.col("__last").isNull() | (F.col("offset") > F.col("__last"))

    def summary(logged: int) -> list[Column]:
        own = F.col("logged") == logged
        place = F.col("offset") - F.col("block") * block_rows
        return [
            F.sum(F.when(own, 1).otherwise(0)).alias(f"__n{logged}"),
            F.coalesce(F.sum(F.when(own, place)), F.lit(0)).alias(f"__s{logged}"),
            F.coalesce(F.bit_xor(F.when(own, F.xxhash64("offset"))), F.lit(0)).alias(f"__x{logged}"),
        ]

    sums = both.groupBy(*_KEY, "block").agg(*summary(1), *summary(0), F.max("offset").alias("offset"))
    sums = sums.join(last, _same(_KEY, "__p_"), "left")
    differ = (F.col("__n1") != F.col("__n0")) | (F.col("__s1") != F.col("__s0")) | (F.col("__x1") != F.col("__x0"))
    suspect = sums.where(differ | beyond).select(*[F.col(c).alias(f"__b_{c}") for c in [*_KEY, "block"]])

    look = both.join(suspect, _same([*_KEY, "block"], "__b_"), "left_semi")
    seen = look.groupBy(*_KEY, "offset").agg(F.sum("logged").alias("__l"), F.sum(1 - F.col("logged")).alias("__s"))
    seen = seen.join(last, _same(_KEY, "__p_"), "left")
    kind = (
        F.when(F.col("__s") > 1, DOUBLED)
        .when(F.col("__l") == 0, UNLOGGED)
        .when((F.col("__s") == 0) & ~beyond, MISSING)
        .when(F.col("__s") == 0, PENDING)
        .when(beyond, AHEAD)
    )
    found = seen.select(*_KEY, "offset", kind.alias("kind")).where("kind IS NOT NULL")
    numbered = dense_rank_in_key(found, [*_KEY, "kind"], block_of(F.col("offset"), block_rows), ["offset"], "__rn")
    island = (F.col("offset") - F.col("__rn")).alias("__island")
    ranges = numbered.groupBy(*_KEY, "kind", island).agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    return ranges.drop("__island")
