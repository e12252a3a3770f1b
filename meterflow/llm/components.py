"""Connected components of a link table, by alternating star contraction.

Each round replaces links by links to smaller nodes: first every node hands its
larger neighbours to its smallest one (large star), then its smaller ones
(small star). The table never grows and is written out after every star, so a
star reads only the previous one and takes no more tasks than its rows need; it
is done when two stars in a row change nothing. No neighbourhood is collected: the smallest
neighbour is a hash aggregate, and a hot node's links are split by the adaptive
skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import fitted, materialise


def _star(links: DataFrame, large: bool, rows: int) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    side = both.where("b > a" if large else "b < a")
    moved = side.join(least, "a").select(F.col("b").alias("x"), F.col("m"))
    if not large:
        moved = moved.union(least.select(F.col("a").alias("x"), "m"))
    moved = fitted(moved.where("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")), 2 * rows)
    return fitted(moved.distinct(), rows)


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reachable."""
    now = materialise(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    def stamp(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    last, calm, large = stamp(now), 0, True
    while last[0] and calm < 2:
        now = materialise(_star(now, large, last[0]), "links")
        this = stamp(now)
        # A star moves links to smaller nodes or drops some, so an equal table is unchanged.
        calm = calm + 1 if this == last else 0
        last, large = this, not large
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
