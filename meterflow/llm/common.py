"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared checkpoint folder, and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 1 << 16


def fitted(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, whose last stage reads up to about ``rows`` rows, with no more tasks than these are worth, but two for each core.

    A shuffle has as many partitions as the session says, however few rows go
    through it. Partitions are only put together, nothing is dealt anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(2 * cores, math.ceil(rows / task_rows)))


def packed(text: Column) -> Column:
    """Texts compressed for a shuffle, of which they would be most."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zlib.compress(t.encode("utf-8", "surrogatepass"), 1))

    return pack(text)


def unpack(body: bytes) -> str:
    return zlib.decompress(body).decode("utf-8", "surrogatepass")


# --- words of many texts at once, as 64-bit hashes -------------------------
#
# A text is cut into words at byte level. Each word gets the polynomial hash of
# its bytes, read off one running sum over the whole buffer, so no Python code
# runs per word. All arithmetic wraps at 2^64.

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    if n:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POW.get(int(base))
    if have is None or len(have) <= n:
        have = _POW[int(base)] = _powers(base, max(n, 1024))
    return have[: n + 1]


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _lowered(values: np.ndarray) -> np.ndarray:
    out = values.copy()
    out[65:91] = values[97:123]
    return out


_VALUES_LOWER = _lowered(_VALUES)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_IS_PLAIN = _IS_SPACE.copy()  # every ASCII character but letters and digits
_IS_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = True


class Words:
    """Words of a run of texts: ``hashes`` of all words, and per text its first word index."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, spans: np.ndarray | None = None, data: bytes = b""):
        self.hashes, self.starts, self.spans, self.data = hashes, starts, spans, data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)


def cut_words(texts: list[str | None], lower: bool = False, plain: bool = False, spans: bool = False) -> Words:
    """Words of ``texts`` (None counts as empty).

    Words are maximal runs of bytes outside space and 0x09-0x0D; with ``plain``
    every ASCII byte that is no letter or digit separates words. ``lower`` hashes
    A-Z as a-z. ``spans`` also returns the byte range of every word.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw) + b"\n"
    buf = np.frombuffer(data, np.uint8)
    space = (_IS_PLAIN if plain else _IS_SPACE)[buf]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    begin = np.flatnonzero(edge == -1)
    end = np.flatnonzero(edge == 1)
    values = (_VALUES_LOWER if lower else _VALUES)
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    up = powers(_BASE, len(buf))
    np.cumsum(values[buf] * up[:-1], out=total[1:])
    hashes = (total[end] - total[begin]) * powers(_INVERSE, len(buf))[begin]
    lengths = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    offset = np.concatenate([[0], np.cumsum(lengths)])
    starts = np.searchsorted(begin, offset).astype(np.int64)
    return Words(mix(hashes), starts, np.stack([begin, end], 1) if spans else None, data)


def in_chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters each; a longer text stands alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n + 1
    if lo < len(texts):
        yield lo, len(texts)


_STEP = np.uint64(0xA24BAED4963EE407 | 5)
_STEP_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values; one fewer than ``k`` shorter than the input."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    if k <= 8:
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * _STEP + hashes[j : n - k + 1 + j]
        return mix(out)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(hashes * powers(_STEP, n)[:-1], out=total[1:])
    return mix((total[k:] - total[:-k]) * powers(_STEP_INVERSE, n)[: n - k + 1])
