"""Change detection on a stream of readings (D1 stateful).

State per meter is its last valid reading and that reading's order value (no
timeout). Meters are dealt into groups by their hash (``streaming.keyed``). Within a
micro-batch the readings of all meters of a group are sorted and compared with the
previous one vectorised in pandas; the last ones become the new state.

Across micro-batches the source has to deliver a meter in order, as a topic
partition does, and as files do when every append holds a meter in one file. A
reading that still comes late (its order value is not above the state's) is
never compared and never becomes the state: it is returned as a row with topic
``late``. A group's rows of one micro-batch are held in memory together, so a
busy stream needs the source's per-trigger cap; the cap does not change results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import ELECTRICITY_FIELDS, FIELD_TYPES, GAS_FIELDS, READING_FIELDS, ZERO_VALUES
from . import keyed

LATE = "late"
TOPICS = {"electricity": ELECTRICITY_FIELDS, "gas": GAS_FIELDS}


def output_schema(key: str, order: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField(order, T.LongType()),
            T.StructField("topic", T.StringType()),
            T.StructField("telegramTimestamp", T.StringType()),
        ]
        + [T.StructField(f, FIELD_TYPES[f]) for f in ELECTRICITY_FIELDS + GAS_FIELDS]
    )


def _state_rows(key: str, order: str) -> T.StructType:
    """A group's state: one row a meter."""
    ids = [T.StructField(key, T.LongType()), T.StructField(keyed.NAMED, T.BooleanType()), T.StructField(order, T.LongType())]
    return T.StructType(ids + [T.StructField(f, FIELD_TYPES[f]) for f in READING_FIELDS])


def _changes_of_meters(key: str, order: str):
    held_schema = _state_rows(key, order)

    def shown(rows: pd.DataFrame, topic: str, changed: dict[str, np.ndarray]) -> pd.DataFrame:
        out = pd.DataFrame({key: keyed.ids(rows, key), order: rows[order], "topic": topic, "telegramTimestamp": rows["timestamp"]})
        for f in ELECTRICITY_FIELDS + GAS_FIELDS:
            own = rows[f].astype(object).where(changed[f], None) if f in changed else pd.Series(None, index=rows.index, dtype=object)
            out[f] = keyed.typed(FIELD_TYPES[f], own)
        return out

    def fn(group_key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = keyed.in_order(batches, state, [key], order)
        late = rows[keyed.LATE].to_numpy(bool)
        out = [shown(rows[late], LATE, {})] if late.any() else []
        rows = rows[~late].reset_index(drop=True)
        held, start = rows[keyed.HELD].to_numpy(bool), rows["start"].to_numpy()
        first = np.ones(len(rows), bool)
        first[1:] = start[1:] != start[:-1]
        for topic, fields in TOPICS.items():
            changed = {}
            for f in fields:
                now = rows[f].to_numpy()
                before = np.roll(now, 1)
                before[first] = ZERO_VALUES[f]
                changed[f] = np.asarray(now != before, bool)
            emit = ~held & (first | np.logical_or.reduce(list(changed.values())))
            if emit.any():
                out.append(shown(rows[emit], topic, {f: c[emit] for f, c in changed.items()}))
        keyed.keep(state, rows.iloc[keyed.last_of(rows)], held_schema)
        if out:
            yield pd.concat(out, ignore_index=True)

    return fn


def stream_changes(readings: DataFrame, key: str = "meter_id", order: str = "seq") -> DataFrame:
    """Valid readings (stream) -> change rows, same rows as the batch D1 + D2."""
    rows = readings.select(key, order, *READING_FIELDS)
    return keyed.dealt(rows, key).applyInPandasWithState(
        _changes_of_meters(key, order), output_schema(key, order), keyed.STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
