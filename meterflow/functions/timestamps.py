"""Time helpers: broker time, RFC 3339 processing time, UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3339 date-time with a mandatory zone: 'Z' or +hh:mm. Any number of
# fraction digits is accepted (comma or dot); digits past microseconds are cut.
RFC3339_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"

ZERO_TIME_UTC = "0001-01-01 00:00:00"


def kafka_ts(millis: Column) -> Column:
    """Broker time given as milliseconds since the epoch, as a timestamp."""
    return F.timestamp_millis(millis.cast("long"))


def parse_processing_ts(text: Column) -> Column:
    """RFC 3339 time with zone to a timestamp; null if bad or absent."""
    s = F.regexp_replace(text, ",", ".")
    s = F.regexp_replace(s, r"(\.[0-9]{1,6})[0-9]*", "$1")
    return F.when(text.rlike(RFC3339_PATTERN), F.try_to_timestamp(s))


def utc_wall_clock(ts: Column) -> Column:
    """TIMESTAMP (an instant) to TIMESTAMP_NTZ holding its UTC wall clock.

    Counts microseconds from the epoch, so the session's zone and its clock
    changes play no part.
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def from_utc_wall_clock(ntz: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock to TIMESTAMP (an instant)."""
    return F.concat(ntz.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def zero_time() -> Column:
    """0001-01-01T00:00:00Z, the zero value of a Go time."""
    return from_utc_wall_clock(F.lit(ZERO_TIME_UTC))


def rfc3339_utc(ts: Column) -> Column:
    """Format an instant as RFC 3339 in UTC, trailing fraction zeros dropped."""
    return F.concat(F.replace(utc_wall_clock(ts).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def p1_time(ntz: Column) -> Column:
    """Wall clock as the twelve digits of a telegram, read off its text form (no zone involved)."""
    return F.substring(F.translate(ntz.cast("string"), "-+: .", ""), 3, 12)
