import pytest

import __spark_entry__ as entry
from meterflow import oracle
from meterflow.queries import REGISTRY

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["meter_id", "seq", "topic"]


def test_every_query_has_an_oracle(spark):
    assert set(REGISTRY) == set(oracle.registry())
    assert set(REGISTRY) <= set(entry.queries()) and set(oracle.registry()) <= set(entry.oracle_sql())


def values(rows):
    return sorted(tuple(str(x) for x in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_oracle_agrees_on_small_tables(spark, duck, name):
    df = REGISTRY[name](spark, SF_SMALL)
    rel = duck.sql(oracle.registry()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    theirs = rel.select(*[f'"{c}"' for c in cols]).fetchall()
    assert values(df.select(*cols).collect()) == values(theirs)


@pytest.mark.parametrize("name", ["change_messages", "raw_electricity", "raw_zero_fill", "upsert_ledger", "payload_edges"])
def test_results_do_not_depend_on_the_session_zone(spark, name):
    cols = sorted(REGISTRY[name](spark, SF_SMALL).columns)
    seen = []
    for zone in ("UTC", "Europe/Amsterdam"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            seen.append(values(REGISTRY[name](spark, SF_SMALL).select(*cols).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1]
