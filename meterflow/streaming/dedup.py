"""Exact de-duplication of raw rows on a stream (G1).

State is what offsets were seen, as sets of intervals: per topic partition and block
of ``block_rows`` offsets, the starts and ends of the runs seen so far. Offsets come
nearly without gaps, so a block that is read through is one interval, and state
grows with the number of blocks and gaps, not with the rows. Nothing is forgotten:
a copy is dropped however late it comes.

Blocks are keys of their own, so that a topic partition that is read from far back is
worked on by many tasks. A block's rows of a micro-batch come as Arrow batches; each
is checked against the intervals and merged into them before the next is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.scan import block_of

BLOCK_OFFSETS = 1 << 18
_STATE = "starts array<long>, ends array<long>"


def unseen(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which offsets lie in none of the intervals (both ends inside) and are the first of their value."""
    first = np.zeros(len(offsets), bool)
    first[np.unique(offsets, return_index=True)[1]] = True
    at = np.searchsorted(starts, offsets, side="right") - 1
    inside = (at >= 0) & (ends[np.maximum(at, 0)] >= offsets) if len(starts) else np.zeros(len(offsets), bool)
    return first & ~inside


def merge(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with some unseen offsets added, touching ones joined."""
    if not len(offsets):
        return starts, ends
    lo = np.concatenate([starts, offsets])
    hi = np.concatenate([ends, offsets])
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1] + 1]))  # intervals are disjoint
    return lo[new], hi[np.append(new[1:], len(lo)) - 1]


def dedup_stream_exact(
    raw: DataFrame,
    key: Sequence[str] = ("kafka_topic", "kafka_partition"),
    offset: str = "kafka_offset",
    block_rows: int = BLOCK_OFFSETS,
) -> DataFrame:
    """One row per record position, over the whole life of the stream.

    Of copies, the first to arrive is kept (within a micro-batch: any of them).
    Rows without an offset are all kept, as no position says they are copies.
    """
    columns = raw.columns

    def keep(group_key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [])
        starts, ends = (np.array(x, np.int64) for x in held)
        for rows in batches:
            offsets = rows[offset]
            known = offsets.notna().to_numpy()
            fresh = ~known
            values = offsets[known].to_numpy(np.int64)
            new = unseen(values, starts, ends)
            fresh[known] = new
            starts, ends = merge(values[new], starts, ends)
            yield rows.loc[fresh, columns]
        state.update((starts.tolist(), ends.tolist()))

    blocks = raw.withColumn("__block", block_of(F.col(offset), block_rows))
    return blocks.groupBy(*key, "__block").applyInPandasWithState(
        keep, raw.schema, _STATE, "append", GroupStateTimeout.NoTimeout
    )
