"""Consumer chain, batch form: topic records -> raw rows, rejects, positions.

A1 -> E1..E7 -> (A4) -> F1 -> F2. The streaming form wraps the same functions
in ``foreachBatch`` (``meterflow.streaming.ingest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.routing import DEFAULT_ROUTES, route_messages
from ..sources import fixtures


def fixture_routed(spark: SparkSession, sf_dir: str, on_malformed: str = "skip", absent: str = "null") -> DataFrame:
    return route_messages(fixtures.messages(spark, sf_dir), DEFAULT_ROUTES, on_malformed, absent)
