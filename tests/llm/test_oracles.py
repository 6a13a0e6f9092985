"""Operators that SQL can express, against DuckDB over whole tables."""

import os

import pytest

from ledgerloom.llm import oracles, queries

duckdb = pytest.importorskip("duckdb")
FOLDER = f"/root/testdata/sf{os.environ.get('LEDGERLOOM_SF', '0.001')}"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.mark.parametrize("key", sorted(oracles.SQL))
def test_same_rows_as_duckdb(spark, tmp_path, key):
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    df = queries.queries()[key](spark, FOLDER)
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    df.write.parquet(f"{tmp_path}/got")
    con.execute(f"CREATE TEMP TABLE got AS SELECT {columns} FROM '{tmp_path}/got/*.parquet'")
    con.execute(f"CREATE TEMP TABLE want AS SELECT {columns} FROM ({oracles.SQL[key]}) q")
    for one, other in (("got", "want"), ("want", "got")):
        assert con.execute(f"SELECT * FROM {one} EXCEPT ALL SELECT * FROM {other}").fetchall() == []
