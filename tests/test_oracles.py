"""Registered queries against DuckDB. ``LEDGERLOOM_ALL=1`` checks every one at
``LEDGERLOOM_SF`` (0.001); the default is one query per layer."""

import os

import pytest

import __spark_entry__ as entry
from workload import queries as workload_queries

duckdb = pytest.importorskip("duckdb")

FOLDER = f"/root/testdata/sf{os.environ.get('LEDGERLOOM_SF', '0.001')}"
SAMPLE = ["b_accounts", "s_customers", "ri_loans_clean", "kpi_branch_performance", "master_loan_analysis_joined"]
KEYS = sorted(workload_queries.queries()) if os.environ.get("LEDGERLOOM_ALL") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


def test_every_query_has_an_oracle():
    assert set(workload_queries.queries()) == set(entry.oracle_sql()) & set(workload_queries.queries())


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_as_duckdb(spark, tmp_path, key):
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    df = entry.queries()[key](spark, FOLDER)
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    df.write.parquet(f"{tmp_path}/got")
    con.execute(f"CREATE TEMP TABLE got AS SELECT {columns} FROM '{tmp_path}/got/*.parquet'")
    con.execute(f"CREATE TEMP TABLE want AS SELECT {columns} FROM ({entry.oracle_sql()[key]}) q")
    for one, other in (("got", "want"), ("want", "got")):
        assert con.execute(f"SELECT * FROM {one} EXCEPT ALL SELECT * FROM {other}").fetchall() == []
