"""OBIS line patterns of a P1 telegram and their typed extraction.

Each pattern is anchored at the start of a trimmed line only; text after the
closing parenthesis is allowed. Exactly three decimals are required.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The OBIS patterns that must match the reference's, in telegram
# order (field name, regular expression, capture group).
TIMESTAMP_PATTERN = r"^0-0:1\.0\.0\(([0-9]{12})[WS]\)"
ELECTRICITY_CONSUMPTION_1_PATTERN = r"^1-0:1\.8\.1\(([0-9]+\.[0-9]{3})\*kWh\)"
ELECTRICITY_CONSUMPTION_2_PATTERN = r"^1-0:1\.8\.2\(([0-9]+\.[0-9]{3})\*kWh\)"
ELECTRICITY_PRODUCTION_1_PATTERN = r"^1-0:2\.8\.1\(([0-9]+\.[0-9]{3})\*kWh\)"
ELECTRICITY_PRODUCTION_2_PATTERN = r"^1-0:2\.8\.2\(([0-9]+\.[0-9]{3})\*kWh\)"
TARIFF_PATTERN = r"^0-0:96\.14\.0\(([0-9]{4})\)"
CURRENT_CONSUMPTION_PATTERN = r"^1-0:1\.7\.0\(([0-9]+\.[0-9]{3})\*kW\)"
CURRENT_PRODUCTION_PATTERN = r"^1-0:2\.7\.0\(([0-9]+\.[0-9]{3})\*kW\)"
GAS_PATTERN = r"^0-1:24\.2\.1\(([0-9]{12})[WS]\)\(([0-9]+\.[0-9]{3})\*m3\)"

# (field, pattern, group, spark type). Gas timestamp and gas volume come from
# the same line.
FIELD_PATTERNS = [
    ("timestamp", TIMESTAMP_PATTERN, 1, "string"),
    ("electricityConsumption1", ELECTRICITY_CONSUMPTION_1_PATTERN, 1, "double"),
    ("electricityConsumption2", ELECTRICITY_CONSUMPTION_2_PATTERN, 1, "double"),
    ("electricityProduction1", ELECTRICITY_PRODUCTION_1_PATTERN, 1, "double"),
    ("electricityProduction2", ELECTRICITY_PRODUCTION_2_PATTERN, 1, "double"),
    ("currentTariff", TARIFF_PATTERN, 1, "int"),
    ("currentConsumption", CURRENT_CONSUMPTION_PATTERN, 1, "double"),
    ("currentProduction", CURRENT_PRODUCTION_PATTERN, 1, "double"),
    ("gasTimestamp", GAS_PATTERN, 1, "string"),
    ("gasConsumption", GAS_PATTERN, 2, "double"),
]

# Daylight-saving flag of the main timestamp (W winter, S summer); kept as an
# extra column so that the repeated autumn hour stays distinguishable.
DST_FLAG_PATTERN = r"^0-0:1\.0\.0\([0-9]{12}([WS])\)"

# What a line of each pattern starts with, up to the bracket.
CODES = {
    TIMESTAMP_PATTERN: "0-0:1.0.0(",
    ELECTRICITY_CONSUMPTION_1_PATTERN: "1-0:1.8.1(",
    ELECTRICITY_CONSUMPTION_2_PATTERN: "1-0:1.8.2(",
    ELECTRICITY_PRODUCTION_1_PATTERN: "1-0:2.8.1(",
    ELECTRICITY_PRODUCTION_2_PATTERN: "1-0:2.8.2(",
    TARIFF_PATTERN: "0-0:96.14.0(",
    CURRENT_CONSUMPTION_PATTERN: "1-0:1.7.0(",
    CURRENT_PRODUCTION_PATTERN: "1-0:2.7.0(",
    GAS_PATTERN: "0-1:24.2.1(",
    DST_FLAG_PATTERN: "0-0:1.0.0(",
}


def raw_match(line: Column, pattern: str, group: int) -> Column:
    """Captured text, or '' when the line does not match. Every group here
    captures at least one digit, so '' means no match. The expression runs only
    on lines that start with the pattern's code."""
    return F.when(line.startswith(CODES[pattern]), F.regexp_extract(line, pattern, group)).otherwise("")


def last_match(lines: Column, pattern: str, group: int) -> Column:
    """Captured text of the last line of an array that matches; null without any."""
    own = F.filter(lines, lambda l: l.startswith(CODES[pattern]))
    texts = F.filter(F.transform(own, lambda l: F.regexp_extract(l, pattern, group)), lambda t: t != "")
    return F.try_element_at(texts, F.lit(-1))


def typed(raw: Column, spark_type: str) -> Column:
    """Typed value of a ``raw_match``; null when it did not match."""
    value = raw if spark_type == "string" else raw.try_cast(spark_type)
    return F.when(raw != "", value)
