"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters, the set Go's TrimSpace
# removes (Spark's one-argument trim strips only the space character).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace, including CR and tabs."""
    return F.btrim(col, F.lit(WHITE_SPACE))
