"""Full readings rebuilt from sparse updates on a stream.

State per (topic, meter) is the last value of each of the topic's fields, and the order
value it was reached at; it lives in the checkpoint and is there again after a
restart. Meters are dealt into groups by their hash (``streaming.keyed``), and a
micro-batch's rows of a group are worked on together: a meter's messages are put
in order, absent fields take the value before (zero before the first), and the last
row becomes the state.

Order across micro-batches is the source's: a topic partition delivers a meter in
order. A message that comes late (not above the state's order value) changes
nothing and is given out with its own fields only, marked in ``late``. A group's
messages of one micro-batch are held together: the source's per-trigger cap bounds
them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.rebuild import ALL_PAYLOAD_FIELDS, TOPIC_FIELDS
from ..schemas import FIELD_TYPES, ZERO_VALUES
from . import keyed


def rebuild_stream(typed: DataFrame, topic_kinds: Mapping[str, str], topic: str = "topic", key: str = "meter_id", order: str = "seq") -> DataFrame:
    """Typed sparse messages (stream) -> the same rows with full fields and ``late``.

    ``topic_kinds`` maps topic names to ``electricity`` or ``gas``. Columns: ``key,
    order, topic, telegramTimestamp``, all payload fields (null for the other topic's), ``late``.
    """
    kinds = dict(topic_kinds)
    columns = [key, order, topic, "telegramTimestamp", *ALL_PAYLOAD_FIELDS]
    rows = typed.select(*columns)
    schema = T.StructType([*rows.schema.fields, T.StructField("late", T.BooleanType())])

    ids = [T.StructField(keyed.NAMED, T.BooleanType()), *(rows.schema[c] for c in (key, topic, order))]
    held_schema = T.StructType(ids + [T.StructField(f, FIELD_TYPES[f]) for f in ALL_PAYLOAD_FIELDS])

    zeros = {f: ZERO_VALUES[f] for f in ALL_PAYLOAD_FIELDS}
    owner = {f: k for k, fields in TOPIC_FIELDS.items() for f in fields}
    names = sorted(kinds)

    def fill(group_key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Groups are many and a frame's operations have a fixed cost each, so the work is done on arrays.
        new, held = list(batches), keyed.held(state)
        rows, is_held, late, start = keyed.ordered(new, held, [key, topic], order, {topic: names})
        kind = np.array([kinds[t] for t in names], object)[rows[topic]]
        here = np.arange(len(start))
        last = np.flatnonzero(~late)
        last = last[np.append(start[last][1:] != start[last][:-1], len(last) > 0)]
        shown, kept = {}, {}
        for f in ALL_PAYLOAD_FIELDS:
            text = isinstance(FIELD_TYPES[f], T.StringType)
            own = keyed.column(new, held, f, object if text else np.float64)[rows[keyed.ROW]]
            there, mine = ~pd.isna(own), kind == owner[f]
            # The last value at or before each message of its key, else zero.
            at = np.maximum.accumulate(np.where(there & ~late, here, -1))
            full = np.where(at >= start, own[np.maximum(at, 0)], zeros[f])
            kept[f] = np.where(mine, full, zeros[f])[last]
            shown[f] = np.where(mine & (there | ~late), np.where(late, own, full), None if text else np.nan)[~is_held]
        ids = {c: rows[c][last] for c in (keyed.NAMED, key, order)} | {topic: np.array(names, object)[rows[topic][last]]}
        keyed.keep_columns(state, ids | kept, held_schema)
        out = {c: rows[c][~is_held] for c in (keyed.NAMED, key, order)}
        stamps = keyed.column(new, held, "telegramTimestamp", object)[rows[keyed.ROW]][~is_held]
        out |= {topic: np.array(names, object)[rows[topic][~is_held]], "telegramTimestamp": stamps, **shown, "late": late[~is_held]}
        pdf = pd.DataFrame(out)
        yield pdf.assign(**{key: keyed.ids(pdf, key)})[[*columns, "late"]]

    return keyed.dealt(rows, key).applyInPandasWithState(fill, schema, keyed.STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
