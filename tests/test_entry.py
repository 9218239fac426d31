"""The driver's contract: queries run, and those with SQL agree with DuckDB."""

import pytest

import __spark_entry__ as entry
from kinsift.plans import catalog

SF = "/root/testdata/sf0.001"


def canonical(rows):
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "embeddings", "part"):
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = connection.sql(f"select {quoted} from ({catalog.ORACLE_SQL[name]})").fetchall()
    assert canonical(tuple(r) for r in df.select(*columns).collect()) == canonical(want)


def test_contract(spark):
    assert entry.entry(spark).columns == ["country", "s1_id", "cand_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
