import pytest

from ledgerloom.model import ENTITIES, TRANSACTIONS
from ledgerloom.operators import integrity
from ledgerloom.operators.skew import hot_keys


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "customers": spark.createDataFrame([("C1",), ("C2",)], "customer_id string"),
        "branches": spark.createDataFrame([("B1",)], "branch_id string"),
        "accounts": spark.createDataFrame(
            [("A1", "C1", "B1"), ("A2", "C9", "B1"), ("A3", "C2", "B9"), ("A4", None, "B1")],
            "account_id string, customer_id string, branch_id string",
        ),
        "loans": spark.createDataFrame(
            [("L1", "C1", "B1"), ("L2", "C9", "B9")], "loan_id string, customer_id string, branch_id string"
        ),
        "transactions": spark.createDataFrame(
            [("T1", "A1"), ("T2", "A2"), ("T3", "A7"), ("T4", "A1")], "transaction_id string, account_id string"
        ),
    }


def counts(report):
    return {r.check: (r.orphans, r.ok) for r in report.collect()}


def test_report_counts_missing_keys_as_orphans(tables):
    assert counts(integrity.ri_report(tables)) == {
        "accounts.customer_id -> customers": (2, False),
        "accounts.branch_id -> branches": (1, False),
        "loans.customer_id -> customers": (1, False),
        "loans.branch_id -> branches": (1, False),
        "transactions.account_id -> accounts": (1, False),
    }


def test_enforcement_cascades_and_leaves_no_orphans(tables, rows):
    kept = integrity.enforce_integrity(tables)
    assert rows(kept["accounts"]) == [("A1", "C1", "B1")]
    assert rows(kept["loans"]) == [("L1", "C1", "B1")]
    assert rows(kept["transactions"]) == [("T1", "A1"), ("T4", "A1")]
    assert all(n == 0 and ok for n, ok in counts(integrity.ri_report(kept)).values())


def test_orphan_rows(tables, rows):
    assert rows(integrity.orphans(tables["accounts"], tables["customers"], "customer_id"), "account_id") == [
        ("A2",),
        ("A4",),
    ]


def test_slicing_changes_nothing(tables, rows):
    moves = tables["transactions"]
    hot = {"account_id": hot_keys(moves, "account_id", share=0.3)}
    sliced = integrity.enforce_entity(moves, TRANSACTIONS, tables, hot)
    assert rows(sliced) == rows(integrity.enforce_entity(moves, TRANSACTIONS, tables))
    assert sliced.columns == moves.columns


def test_marks_tell_all_that_the_joins_tell(tables, rows):
    marks = dict(tables)
    for name in ("accounts", "loans", "transactions"):
        marks[name] = integrity.marked(tables[name], ENTITIES[name], marks)
        assert marks[name].columns == [*tables[name].columns, integrity.BROKEN]
    assert rows(marks["accounts"], "account_id", "_broken") == [("A1", 0), ("A2", 1), ("A3", 4), ("A4", 1)]
    # The account of T2 is there, but stays behind; that of T3 is missing.
    assert rows(marks["transactions"], "transaction_id", "_broken") == [("T1", 0), ("T2", 2), ("T3", 1), ("T4", 0)]
    assert rows(integrity.marked_report(marks)) == rows(integrity.ri_report(tables))
    kept = integrity.enforce_integrity(tables)
    for name in ("accounts", "loans", "transactions"):
        assert rows(integrity.unbroken(marks[name])) == rows(kept[name])
    gone = integrity.orphans(tables["accounts"], tables["branches"], "branch_id")
    assert rows(integrity.marked_orphans(marks["accounts"], ENTITIES["accounts"], "branch_id")) == rows(gone)


def test_marks_take_one_join_for_each_relation(tables):
    marks = dict(tables)
    for name in ("accounts", "loans", "transactions"):
        marks[name] = integrity.marked(tables[name], ENTITIES[name], marks)
    plan = marks["accounts"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
    report = integrity.marked_report({**tables, **{n: m.select("_broken") for n, m in marks.items() if "_broken" in m.columns}})
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2 + 2 + 3


def test_an_absent_foreign_key_is_no_rule(tables, rows):
    got = integrity.marked(tables["loans"], ENTITIES["loans"], tables, optional_fks=("branch_id",))
    assert rows(got, "loan_id", "_broken") == [("L1", 0), ("L2", 1)]


def test_marks_of_sliced_keys(tables, rows):
    moves = tables["transactions"]
    hot = {"account_id": hot_keys(moves, "account_id", share=0.3)}
    sliced = integrity.marked(moves, TRANSACTIONS, tables, hot)
    assert rows(sliced) == rows(integrity.marked(moves, TRANSACTIONS, tables))
