import os
import threading

import pytest

from ledgerloom.sources import scratch
from workload import queries as workload

FOLDER = "/root/testdata/sf0.001"


def staged(spark):
    folder = scratch.scratch_dir(spark)
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
def test_queries_store_their_tables_once(spark):
    plans = workload.queries()
    names = ("kpi_high_value_txn", "customer_risk_score", "master_fact", "kpi_high_value_txn_sketch")
    for name in names:
        plans[name](spark, FOLDER).count()
    first = staged(spark)
    for name in (*names, "kpi_high_value_txn_certificate"):
        plans[name](spark, FOLDER).count()
    assert first and staged(spark) == first


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
def test_placed_amounts_store_no_other_column(spark):
    workload.forget()
    workload.queries()["kpi_high_value_txn_default"](spark, FOLDER)
    banks = [b for b in workload._banks.values() if "stored_amounts" in b.__dict__]
    assert [b.stored_amounts.columns for b in banks] == [["transaction_id", "transaction_amount"]]
    assert not any("stored_fact" in b.__dict__ for b in banks)


def test_clear_removes_the_folder(spark):
    scratch.stage(spark.range(3), "three")
    folder = scratch.scratch_dir(spark)
    assert any(name.startswith("three-") for name in os.listdir(folder))
    workload.forget()
    scratch.clear(spark)
    assert not os.path.exists(folder)


class Cluster:
    """What scratch_dir reads of a session whose executors are other machines."""

    class sparkContext:
        applicationId, master = "app-x", "spark://host:7077"

    class conf:
        @staticmethod
        def get(name, default):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Cluster)


def test_tables_are_stored_at_once(spark, monkeypatch):
    """Each of the two waits for the other one."""
    both = threading.Barrier(2, timeout=30)
    write = scratch.stage
    monkeypatch.setattr(scratch, "stage", lambda df, label: both.wait() >= 0 and write(df, label))
    got = scratch.stage_all({"two": spark.range(2), "five": spark.range(5)})
    assert {name: df.count() for name, df in got.items()} == {"two": 2, "five": 5}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
def test_risky_accounts_are_stored_alone(spark):
    bank = workload.Bank(spark, FOLDER)
    low = {r.account_id for r in bank.risky["accounts"].collect()}
    found = {r.account_id for r in bank.risky["transactions"].collect()}
    assert found and found <= low


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
def test_a_certificate_stores_no_fact(spark):
    workload.forget()
    before = staged(spark)
    assert workload.queries()["kpi_high_value_txn_certificate"](spark, FOLDER).count() == 1
    assert [name.split("-")[0] for name in staged(spark) if name not in before] == ["fact_sketches"]
