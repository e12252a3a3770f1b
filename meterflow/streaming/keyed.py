"""State of many keys in one group of a stateful stream.

A call of the state function costs the same for one row as for thousands, so keys are
dealt into a fixed number of groups by their hash and a call works on all rows of
its group at once. The group's state is one table, a row per key, held as Arrow bytes.

Ids travel beside a flag that says they are not null: pandas would turn them to floats.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState

GROUPS = 512
GROUP, NAMED, HELD, LATE = "__group", "__named", "__held", "__late"
ROW = "__row"
STATE_SCHEMA = T.StructType([T.StructField("rows", T.BinaryType())])


def dealt(rows: DataFrame, key: str, groups: int = GROUPS):
    """``rows`` grouped by the hash of ``key``, which is 0 where ``NAMED`` is false."""
    rows = rows.withColumn(GROUP, F.pmod(F.xxhash64(F.col(key)), F.lit(groups)).cast("int")).withColumn(NAMED, F.col(key).isNotNull())
    return rows.withColumn(key, F.coalesce(F.col(key), F.lit(0).cast("long"))).groupBy(GROUP)


def in_order(batches: Iterator[pd.DataFrame], state: GroupState, keys: Sequence[str], order: str) -> pd.DataFrame:
    """The rows of a group behind the rows its keys' state holds, by key and order.

    ``HELD`` marks the state's rows, ``LATE`` those whose order value is not above the
    state's, or repeats one. ``start`` is the place of a key's first row.
    """
    new = pd.concat(list(batches), ignore_index=True).drop(columns=GROUP)
    new[HELD] = False
    if state.exists:
        held = pa.ipc.open_stream(state.get[0]).read_pandas()
        held[HELD] = True
        new = pd.concat([held, new], ignore_index=True)
    rows = new.sort_values([NAMED, *keys, HELD, order], ascending=[True] * (len(keys) + 1) + [False, True], kind="stable", ignore_index=True)
    n = len(rows)
    first = np.ones(n, bool)
    names = rows[[NAMED, *keys]]
    first[1:] = (names.iloc[1:].to_numpy() != names.iloc[:-1].to_numpy()).any(1)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    at, held = rows[order].to_numpy(), rows[HELD].to_numpy(bool)
    again = np.zeros(n, bool)
    again[1:] = ~first[1:] & ~held[:-1] & (at[1:] == at[:-1])
    rows[LATE] = ~held & (again | (held[start] & (at <= at[start])))
    return rows.assign(start=start)


def held(state: GroupState) -> pa.Table | None:
    """The state's rows, one a key."""
    return pa.ipc.open_stream(state.get[0]).read_all() if state.exists else None


def column(batches: Sequence[pd.DataFrame], held: pa.Table | None, name: str, dtype: type) -> np.ndarray:
    """A column of the state's rows and the new ones behind them; a column the state has not is null there."""
    parts = [b[name].to_numpy(dtype) for b in batches]
    if held is not None and name in held.column_names:
        parts.insert(0, held.column(name).to_numpy().astype(dtype, copy=False))
    elif held is not None:
        parts.insert(0, np.full(held.num_rows, None, dtype))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def ordered(
    batches: Sequence[pd.DataFrame], held: pa.Table | None, keys: Sequence[str], order: str, codes: Mapping[str, Sequence[str]]
) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """``in_order`` on arrays: the id columns, ``HELD``, ``LATE`` and ``start`` of all rows, by key and order.

    Columns named in ``codes`` come as places in their list of values (a value it has
    not is an error). ``ROW`` holds where a row stood in the columns that ``column`` gives.
    """
    cols = {NAMED: column(batches, held, NAMED, bool)}
    for c in keys:
        if c in codes:
            place, values = pd.factorize(column(batches, held, c, object), use_na_sentinel=False)
            known = {v: i for i, v in enumerate(codes[c])}
            cols[c] = np.array([known[v] for v in values], np.int64)[place]
        else:
            cols[c] = column(batches, held, c, np.int64)
    at = [b[order].to_numpy() for b in batches]
    if held is not None:
        at.insert(0, held.column(order).to_numpy())
    cols[order] = np.concatenate(at)
    n = len(cols[order])
    is_held = np.arange(n) < (held.num_rows if held is not None else 0)
    # The last one sorts first; nulls of the order come last.
    place = np.lexsort((cols[order], ~is_held, *[cols[c] for c in reversed([NAMED, *keys])]))
    cols = {c: v[place] for c, v in cols.items()} | {ROW: place}
    is_held, at = is_held[place], cols[order]
    first = np.ones(n, bool)
    first[1:] = np.logical_or.reduce([cols[c][1:] != cols[c][:-1] for c in (NAMED, *keys)])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    again = np.zeros(n, bool)
    again[1:] = ~first[1:] & ~is_held[:-1] & (at[1:] == at[:-1])
    return cols, is_held, ~is_held & (again | (is_held[start] & (at <= at[start]))), start


def last_of(rows: pd.DataFrame) -> np.ndarray:
    """Places of each key's last row, ``rows`` being those that are not late."""
    start = rows["start"].to_numpy()
    return np.flatnonzero(np.append(start[1:] != start[:-1], len(start) > 0))


def keep(state: GroupState, rows: pd.DataFrame, schema: T.StructType) -> None:
    """``rows``, one a key, become the state."""
    _store(state, pa.Table.from_pandas(rows[schema.names], schema=to_arrow_schema(schema), preserve_index=False))


def keep_columns(state: GroupState, columns: Mapping[str, np.ndarray], schema: T.StructType) -> None:
    """The same of arrays."""
    fields = to_arrow_schema(schema)
    _store(state, pa.Table.from_arrays([pa.array(columns[f.name], f.type, from_pandas=True) for f in fields], schema=fields))


def _store(state: GroupState, table: pa.Table) -> None:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))


def ids(rows: pd.DataFrame, key: str) -> pd.Series:
    """The ids again, null where they were."""
    return rows[key].astype("Int64").where(rows[NAMED].astype(bool))


def typed(field_type: T.DataType, col: pd.Series) -> pd.Series:
    """A column with nulls as the output's Arrow conversion takes it."""
    if isinstance(field_type, T.StringType):
        return col.astype(object).where(col.notna(), None)
    return col.astype("Int32" if isinstance(field_type, T.IntegerType) else "float64")
