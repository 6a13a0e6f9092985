import pytest

from ledgerloom.model import ACCOUNTS, BRANCHES, LOANS
from ledgerloom.plans import pipeline
from ledgerloom.sources.raw import absent_columns, conform, read_raw, source_mark, unknown_columns


@pytest.fixture()
def write(tmp_path):
    def files(**content):
        for name, text in content.items():
            (tmp_path / f"{name}.csv").write_text(text)
        return str(tmp_path)

    return files


def test_every_file_is_matched_by_its_own_header(spark, write, rows):
    folder = write(
        Bank_Branch_1="branch_id,branch_name,state\nb1,Elm,ohio\n",
        Bank_Branch_2="STATE,BRANCH_ID,BRANCH_NAME\niowa,b2,Oak\n",
        Bank_Branch_3="branch_id,city\nb3,york\n",
        Bank_Branch_4="",
    )
    got = read_raw(spark, BRANCHES, folder)
    assert rows(got) == [("b1", "Elm", None, "ohio"), ("b2", "Oak", None, "iowa"), ("b3", None, "york", None)]
    assert absent_columns(got) == set()


def test_a_given_header_must_be_that_of_all_files(spark, write, rows):
    header = ["branch_id", "branch_name", "state"]
    folder = write(Bank_Branch_1="branch_id,branch_name,state\nb1,Elm,ohio\n")
    assert rows(read_raw(spark, BRANCHES, folder, header_names=header)) == [("b1", "Elm", None, "ohio")]
    write(Bank_Branch_2="state,branch_id,branch_name\niowa,b2,Oak\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw(spark, BRANCHES, folder, header_names=header).collect()


def test_columns_that_no_file_has_are_marked(spark, write):
    folder = write(Bank_Loan_1="loan_id,customer_id\nl1,c1\n", Bank_Loan_2="CUSTOMER_ID,LOAN_ID,LOAN_TYPE\nc1,l2,car\n")
    assert absent_columns(read_raw(spark, LOANS, folder)) == {"branch_id", "loan_amount", "loan_status"}


def test_two_columns_of_one_name_are_an_error(spark):
    with pytest.raises(ValueError, match="opening_balance"):
        conform(spark.createDataFrame([("1", "2")], "balance string, opening_balance string"), ACCOUNTS)


ODD_NAMES = ["Bank_Branch 2024", "Bank_Branch[1]", "Bank_Branch%20x", "Bank_Branch{a,b}", "Bank_Branch#1?", "Bank_Branch-ä+é", "Bank_Branch\\d"]


@pytest.mark.parametrize("folder", ["plain", "with a space", "in [1] %41 {x}"])
def test_files_and_folders_of_any_name(spark, tmp_path, rows, folder):
    (tmp_path / folder).mkdir()
    for i, name in enumerate(ODD_NAMES):
        header = "branch_id,state" if i % 2 else "STATE,BRANCH_ID"
        (tmp_path / folder / f"{name}.csv").write_text(f"{header}\n" + (f"b{i},s{i}\n" if i % 2 else f"s{i},b{i}\n"))
    # A folder is given as a pattern, like any path of a Spark reader; its files are not.
    pattern = f"{tmp_path}/{folder.replace('[', '?').replace(']', '?').replace('{', '?').replace('}', '?')}"
    got = read_raw(spark, BRANCHES, pattern)
    assert rows(got, "branch_id", "branch_state") == [(f"b{i}", f"s{i}") for i in range(len(ODD_NAMES))]


def test_headers_are_trimmed_and_quoted(spark, write, rows):
    folder = write(
        Bank_Branch_1=" branch_id ,\tBranch_Name, state \nb1,Elm,ohio\n",
        Bank_Branch_2='\ufeff"branch_id","state","note, \'odd\'"\nb2,iowa,x\n',
        Bank_Branch_3="\n  \nstate,branch_id\nutah,b3\n",
        Bank_Branch_4="branch_id,,x,x\r\nb4,1,2,3\r\n",
    )
    with pytest.warns(UserWarning, match="note, 'odd'"):
        got = read_raw(spark, BRANCHES, folder)
    assert rows(got, "branch_id", "branch_name", "branch_state") == [
        ("b1", "Elm", "ohio"), ("b2", None, "iowa"), ("b3", None, "utah"), ("b4", None, None)
    ]
    assert absent_columns(got) == {"city"} and unknown_columns(got) == {"note, 'odd'", "x"}


def test_the_number_of_jobs_does_not_grow_with_the_files(spark, tmp_path):
    def jobs(count):
        (tmp_path / str(count)).mkdir()
        for i in range(count):
            (tmp_path / str(count) / f"Bank_Branch_{i}.csv").write_text(f"branch_id,state,x{i % 3}\nb{i},s\n")
        spark.sparkContext.setJobGroup(f"read-{count}", "headers")
        with pytest.warns(UserWarning):
            read_raw(spark, BRANCHES, f"{tmp_path}/{count}")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"read-{count}"))

    few = jobs(3)
    assert few <= 2 and jobs(60) == few
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_mark_of_a_source_follows_its_files_or_rows(spark, write):
    folder = write(Bank_Branch_1="branch_id,state\nb1,ohio\n")
    one = source_mark(read_raw(spark, BRANCHES, folder))
    assert one == source_mark(read_raw(spark, BRANCHES, folder))
    write(Bank_Branch_2="branch_id,state\nb2,ohio\n")
    assert one != source_mark(read_raw(spark, BRANCHES, folder))
    rows = spark.range(20).selectExpr("cast(id AS string) AS branch_id", "id % 3 AS n")
    assert source_mark(rows) == source_mark(rows.repartition(4)) != source_mark(rows.where("id < 19"))


FILES = {
    "Bank_Customer_1": "customer_id,first_name\nc1,ann\n",
    "Bank_Branch_1": "branch_id,branch_name,state\nb1,Elm,ohio\n",
    "Bank_Account_1": "account_id,customer_id,branch_id,balance\na1,c1,b1,10\n",
    "Bank_Loan_1": "loan_id,customer_id,loan_amount,loan_type,loan_status\nl1,c1,500,car,active\nl2,c9,700,car,active\nl3,,1,car,x\n",
    "Bank_Trans_1": "transaction_id,account_id,amount,transaction_type,transaction_media,transaction_date\nt1,a1,5,x,y,2024-01-01\n",
}


@pytest.mark.parametrize("split", [False, True])
def test_loans_without_a_branch_are_kept(spark, write, tmp_path, rows, split):
    folder = write(**FILES)
    options = pipeline.Options(exact=True, scale=2, split_hot_keys=split)
    wanted = {"kept_loans", "master_loan_analysis", "ri_report", "ri_report_after", "master_table", "master_fact"}
    got = pipeline.run(pipeline.read_sources(spark, folder), f"{tmp_path}/lake", options, only=wanted)
    assert rows(got["silver_loans"], "loan_id") == [("L1",), ("L2",)]
    assert rows(got["kept_loans"], "loan_id", "loan_amount") == [("L1", 500.0)]
    assert rows(got["master_loan_analysis"]) == [("car", 1, 500.0)]
    assert "loans.branch_id -> branches" not in {r.check for r in got["ri_report"].collect()}
    assert {r.orphans for r in got["ri_report_after"].collect()} == {0}
    assert rows(got["master_fact"], "transaction_id", "customer_id") == [("T1", "C1")]
    assert rows(got["master_table"], "customer_id", "loan_id", "transaction_id") == [("C1", "L1", "T1")]
