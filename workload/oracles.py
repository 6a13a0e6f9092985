"""DuckDB SQL for every query, put together from named parts.

Each part says plainly what a dataset is; wide joins are written out and window
functions run over whole tables, so nothing here shares the Spark plans' shape.
"""

from __future__ import annotations

import re

from ledgerloom.operators.quantile import ERROR
from workload.queries import LOADED, SEED
from workload.raw import CLEAN, RAW


def _txt(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('', 'null', 'NULL') THEN {c} END"


def _ident(c: str) -> str:
    return f"upper(trim({_txt(c)})) AS {c}"


def _title(c: str) -> str:
    words = f"string_split(lower(trim({_txt(c)})), ' ')"
    return f"coalesce(array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' '), 'Unknown') AS {c}"


def _trimmed(c: str, default: str) -> str:
    return f"coalesce(trim({_txt(c)}), '{default}') AS {c}"


def _day(c: str) -> str:
    shape = r"\d{4}-\d{2}-\d{2}"
    parsed = f"CASE WHEN regexp_full_match({c}, '{shape}') THEN cast(try_strptime({c}, '%Y-%m-%d') AS DATE) END"
    return f"coalesce({parsed}, DATE '1900-01-01') AS {c}"


def _digits(c: str) -> str:
    return f"try_cast(regexp_replace({_txt(c)}, '[^0-9]', '', 'g') AS BIGINT) AS {c}"


def _finite(number: str) -> str:
    return f"CASE WHEN isfinite({number}) THEN {number} END"


def _money(c: str) -> str:
    return _finite(f"try_cast(regexp_replace({_txt(c)}, '[^0-9.-]', '', 'g') AS DOUBLE)") + f" AS {c}"


def _number(c: str) -> str:
    return _finite(f"try_cast({_txt(c)} AS DOUBLE)") + f" AS {c}"


def _known(c: str, default: str = "'Unknown'") -> str:
    """An order that puts the value for a missing one last."""
    return f"nullif({c}, {default}) NULLS LAST"


_NO_DAY = "DATE '1900-01-01'"


_READ = {
    "customers": [
        _ident("customer_id"),
        _title("first_name"),
        _title("last_name"),
        _txt("email") + " AS email",
        _digits("phone_number"),
        _title("city"),
        _title("occupation"),
        _day("dob"),
    ],
    "branches": [
        _ident("branch_id"),
        _trimmed("branch_name", "Unknown Branch"),
        _txt("city") + " AS city",
        _title("branch_state"),
        "src_ord",
    ],
    "accounts": [
        _ident("account_id"),
        _ident("customer_id"),
        _ident("branch_id"),
        _title("account_type"),
        _title("account_status"),
        _money("opening_balance"),
        _day("account_open_date"),
    ],
    "transactions": [
        _ident("transaction_id"),
        _ident("account_id"),
        _title("transaction_type"),
        _trimmed("transaction_media", "Unknown"),
        _number("transaction_amount"),
        _day("transaction_date"),
        "ord1",
        "ord2",
    ],
    "loans": [
        _ident("loan_id"),
        _ident("customer_id"),
        _ident("branch_id"),
        _number("loan_amount"),
        _txt("loan_type") + " AS loan_type",
        _txt("loan_status") + " AS loan_status",
    ],
}

# key, required foreign keys, imputed column and its type, order among copies
_SILVER = {
    "customers": (
        "customer_id", [], ("phone_number", "BIGINT"),
        f"{_known('first_name')}, {_known('last_name')}, email NULLS LAST, phone_number NULLS LAST, "
        f"{_known('city')}, {_known('occupation')}, {_known('dob', _NO_DAY)}",
    ),
    "branches": (
        "branch_id", [], None,
        f"src_ord, {_known('branch_name', repr('Unknown Branch'))}, city NULLS LAST, {_known('branch_state')}",
    ),
    "accounts": (
        "account_id", ["customer_id", "branch_id"], ("opening_balance", "DOUBLE"),
        f"customer_id, branch_id, {_known('account_type')}, {_known('account_status')}, opening_balance NULLS LAST, "
        f"{_known('account_open_date', _NO_DAY)}",
    ),
    "loans": (
        "loan_id", ["customer_id", "branch_id"], ("loan_amount", "DOUBLE"),
        "customer_id, branch_id, loan_amount NULLS LAST, loan_type NULLS LAST, loan_status NULLS LAST",
    ),
    "transactions": (
        "transaction_id", ["account_id"], ("transaction_amount", "DOUBLE"),
        f"nullif(transaction_date, {_NO_DAY}) DESC NULLS LAST, ord1, ord2, account_id, {_known('transaction_type')}, "
        f"{_known('transaction_media')}, transaction_amount NULLS LAST",
    ),
}


def _silver(name: str) -> str:
    key, fks, imputed, order = _SILVER[name]
    present = " AND ".join(f"{k} IS NOT NULL" for k in [key, *fks])
    dropped = {"branches": ", src_ord", "transactions": ", ord1, ord2"}.get(name, "")
    fill = ""
    if imputed:
        c, t = imputed
        fill = f" REPLACE (coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM typed_{name}), cast(0 AS {t})) AS {c})"
    return f"""
SELECT * EXCLUDE (place{dropped}){fill}
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS place
      FROM typed_{name} WHERE {present}) ranked
WHERE place = 1"""


def _sum(expr: str) -> str:
    return f"cast(sum(cast({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def _avg(expr: str) -> str:
    return f"cast(sum(cast({expr} AS DECIMAL(18,2))) AS DOUBLE) / nullif(count({expr}), 0)"


def _exact_sum(expr: str) -> str:
    """The sum of doubles as whole multiples of 2^-60, rounded to a double once (by way of text)."""
    return f"cast(cast(sum(cast({expr} * pow(2, 60) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 60)"


def _exact_mean(expr: str) -> str:
    return f"{_exact_sum(expr)} / nullif(count({expr}), 0)"


def _by_cells(select: str, column: str, source: str, p: float) -> str:
    """``select`` from the cell (equal leading binary digits) that has the quantile: its least and largest value."""
    return f"""
SELECT * FROM (WITH measured AS (SELECT {column} AS x FROM {source} WHERE {column} IS NOT NULL),
binary_ AS (SELECT x, floor(log2(abs(x))) + CASE WHEN abs(x) >= pow(2, floor(log2(abs(x))) + 1) THEN 1
                                          WHEN abs(x) < pow(2, floor(log2(abs(x)))) THEN -1 ELSE 0 END AS e FROM measured),
cells AS (SELECT min(x) AS least, max(x) AS most, count(*) AS n FROM binary_
          GROUP BY sign(x), e, floor(abs(x) * pow(2, 12 - e))),
ranked AS (SELECT *, sum(n) OVER (ORDER BY least) AS upto, sum(n) OVER () AS total FROM cells),
certified AS (SELECT most AS quantile, least FROM ranked WHERE upto >= ceil({p} * total) ORDER BY upto LIMIT 1)
{select}) by_cells"""


def _ranked(source: str, column: str, p: float, sign: int) -> str:
    """The value one rank error beside a quantile."""
    return f"(SELECT quantile_disc({column}, {p + sign * ERROR!r}) FROM {source})"


_PARTS: dict[str, str] = {}
for _n in RAW:
    _PARTS[f"raw_{_n}"] = RAW[_n]
    _PARTS[f"clean_{_n}"] = CLEAN[_n]
    _PARTS[f"typed_{_n}"] = f"SELECT {', '.join(_READ[_n])} FROM raw_{_n}"
    _PARTS[f"silver_{_n}"] = _silver(_n)

_PARTS["kept_accounts"] = """
SELECT * FROM silver_accounts
WHERE customer_id IN (SELECT customer_id FROM silver_customers)
  AND branch_id IN (SELECT branch_id FROM silver_branches)"""
_PARTS["kept_loans"] = """
SELECT * FROM silver_loans
WHERE customer_id IN (SELECT customer_id FROM silver_customers)
  AND branch_id IN (SELECT branch_id FROM silver_branches)"""
_PARTS["kept_transactions"] = """
SELECT * FROM silver_transactions WHERE account_id IN (SELECT account_id FROM kept_accounts)"""
_PARTS["fact"] = """
SELECT t.transaction_id, t.account_id, a.customer_id, a.branch_id,
       t.transaction_amount, t.transaction_type, t.transaction_date
FROM kept_transactions t JOIN kept_accounts a ON t.account_id = a.account_id"""
_PARTS["wide"] = """
SELECT c.customer_id, c.first_name, c.last_name, c.email, c.phone_number, c.city, c.occupation, c.dob,
       a.account_id, a.branch_id, a.account_type, a.account_status, a.opening_balance, a.account_open_date,
       t.transaction_id, t.transaction_type, t.transaction_media, t.transaction_amount, t.transaction_date,
       l.loan_id, l.loan_amount, l.loan_type, l.loan_status, l.branch_id AS loan_branch_id,
       b.branch_name, b.city AS branch_city, b.branch_state
FROM silver_customers c
LEFT JOIN kept_accounts a ON c.customer_id = a.customer_id
LEFT JOIN kept_transactions t ON a.account_id = t.account_id
LEFT JOIN kept_loans l ON c.customer_id = l.customer_id
LEFT JOIN silver_branches b ON a.branch_id = b.branch_id"""
_PARTS["owned"] = """
SELECT c.customer_id, a.account_id, a.branch_id, a.opening_balance
FROM silver_customers c LEFT JOIN kept_accounts a ON c.customer_id = a.customer_id"""

_SEGMENT = """CASE WHEN opening_balance > 50000 THEN 'High Value'
     WHEN opening_balance > 20000 THEN 'Medium Value' ELSE 'Low Value' END AS segment"""


def _hit(row: str, name: str, limit: str, slot: int = 0) -> str:
    digest = f"md5(concat_ws('|', {row}, '{name}{slot // 8}', '{SEED}'))"
    return f"substr({digest}, {slot % 8 * 4 + 1}, 4) < '{limit}'"


# Shares 0.10, 0.05, 0.30 and 0.50 of 65536, in hex.
_NULL, _COPY, _UPPER, _LOWER = "199a", "0ccd", "4ccd", "8000"


def _hole(c: str, slot: int) -> str:
    return f"CASE WHEN NOT ({_hit('row_id', 'null', _NULL, slot)}) THEN {c} END"


def _noise(c: str, row: str, slot: int) -> str:
    return (
        f"CASE WHEN {_hit(row, 'upper', _UPPER, slot)} THEN upper({c}) "
        f"WHEN {_hit(row, 'lower', _LOWER, slot)} THEN lower({c}) ELSE {c} END"
    )


_COLUMNS = {
    "customers": "customer_id first_name last_name email phone_number city occupation dob".split(),
    "branches": "branch_id branch_name city branch_state".split(),
    "accounts": "account_id customer_id branch_id account_type account_status opening_balance account_open_date".split(),
    "transactions": (
        "transaction_id account_id transaction_type transaction_media transaction_amount transaction_date".split()
    ),
    "loans": "loan_id customer_id branch_id loan_amount loan_type loan_status".split(),
}
_NUMBERS = {"opening_balance", "transaction_amount", "loan_amount"}


def _holes(columns: list[str], blank: bool) -> list[str]:
    found = []
    for i, c in enumerate(columns):
        hole = _hole(c, i)
        found.append(f"coalesce({hole}, '') AS {c}" if blank and c not in _NUMBERS else f"{hole} AS {c}")
    return found


def _noisy(columns: list[str], row: str) -> list[str]:
    text = [c for c in columns if c not in _NUMBERS]
    return [f"{_noise(c, row, text.index(c))} AS {c}" if c in text else c for c in columns]


def _bronze(name: str) -> str:
    columns = _COLUMNS[name]
    holes = ", ".join(_holes(columns, blank=True))
    out = _noisy(columns, "row_id || '#' || copy") if name in ("accounts", "customers") else columns
    return f"""
SELECT {', '.join(out)} FROM (
  SELECT row_id, {holes}, '0' AS copy FROM clean_{name}
  UNION ALL
  SELECT row_id, {holes}, '1' AS copy FROM clean_{name} WHERE {_hit('row_id', 'copy', _COPY)}) both_copies"""


def _bronze_steps() -> dict[str, str]:
    columns = _COLUMNS["accounts"]
    return {
        "b_nulls": f"SELECT row_id, {', '.join(_holes(columns, blank=False))} FROM clean_accounts",
        "b_duplicates": "SELECT * FROM clean_accounts UNION ALL "
        f"SELECT * FROM clean_accounts WHERE {_hit('row_id', 'copy', _COPY)}",
        "b_blanks": f"SELECT row_id, {', '.join(_holes(columns, blank=True))} FROM clean_accounts",
        "b_case_noise": f"SELECT row_id, {', '.join(_noisy(columns, 'row_id'))} FROM clean_accounts",
    }


def _report(suffix: str, prefix: str) -> str:
    checks = [
        ("accounts", "customer_id", "customers"),
        ("accounts", "branch_id", "branches"),
        ("loans", "customer_id", "customers"),
        ("loans", "branch_id", "branches"),
        ("transactions", "account_id", "accounts"),
    ]
    rows = []
    for child, fk, parent in checks:
        p = f"{prefix}accounts" if parent == "accounts" else f"silver_{parent}"
        rows.append(
            f"SELECT '{child}.{fk} -> {parent}' AS \"check\", count(*) AS orphans, count(*) = 0 AS ok "
            f"FROM {prefix}{child} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{fk} = x.{fk})"
        )
    return " UNION ALL ".join(rows)


def _money_kpis(_sum, _avg) -> dict[str, str]:
    """The KPIs, by how amounts are summed."""
    return {
    "kpi_total_business": f"""
SELECT count(transaction_id) AS total_transactions, {_sum('transaction_amount')} AS total_revenue,
       {_avg('transaction_amount')} AS avg_transaction_value FROM fact""",
    "kpi_transaction_type": f"""
SELECT transaction_type, count(*) AS txn_count, {_sum('transaction_amount')} AS total_amount
FROM fact GROUP BY transaction_type""",
    "kpi_top_customers": f"""
SELECT customer_id, {_sum('transaction_amount')} AS total_spent, count(*) AS txn_count
FROM fact GROUP BY customer_id ORDER BY total_spent DESC""",
    "kpi_branch_performance": f"""
SELECT branch_id, count(*) AS total_transactions, {_sum('transaction_amount')} AS branch_revenue
FROM fact GROUP BY branch_id ORDER BY branch_revenue DESC""",
    "kpi_monthly_trend": f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, {_sum('transaction_amount')} AS monthly_revenue,
       count(*) AS txn_count FROM fact GROUP BY month ORDER BY month""",
    "kpi_account_type": f"""
SELECT a.account_type, {_sum('f.transaction_amount')} AS total_amount, count(*) AS txn_count
FROM fact f JOIN kept_accounts a ON f.account_id = a.account_id GROUP BY a.account_type""",
    "kpi_customer_branch": f"""
SELECT customer_id, branch_id, {_sum('transaction_amount')} AS total_amount
FROM fact GROUP BY customer_id, branch_id ORDER BY total_amount DESC""",
    "kpi_high_value_txn": """
SELECT * FROM fact WHERE transaction_amount >= (SELECT quantile_disc(transaction_amount, 0.9) FROM fact)""",
    "customer_risk_score": f"""
SELECT *, CASE WHEN risk_score >= 0.9 THEN 'High' WHEN risk_score >= 0.6 THEN 'Medium' ELSE 'Low' END AS risk_band
FROM (SELECT customer_id, transaction_count, total_amount, avg_amount,
             (percent_rank() OVER (ORDER BY transaction_count) + percent_rank() OVER (ORDER BY total_amount)
              + percent_rank() OVER (ORDER BY avg_amount)) / 3 AS risk_score
      FROM (SELECT customer_id, count(*) AS transaction_count, {_sum('transaction_amount')} AS total_amount,
                   {_avg('transaction_amount')} AS avg_amount
            FROM fact GROUP BY customer_id) per_customer) scored""",
    }


_MONEY_KPIS = _money_kpis(_sum, _avg)
_NO_DOUBLES = ("kpi_high_value_txn", "customer_risk_score")

_FACT_COLUMNS = (
    "transaction_id, account_id, customer_id, branch_id, transaction_amount, transaction_type, transaction_date"
)

_MASTER = {
    "master_table": "SELECT * FROM wide",
    "master_table_expanded": "SELECT * FROM wide",
    "master_fact_joined": f"SELECT {_FACT_COLUMNS} FROM wide",
    "master_fact": """
SELECT t.transaction_id, o.account_id, o.customer_id, o.branch_id, t.transaction_amount, t.transaction_type,
       t.transaction_date
FROM owned o LEFT JOIN kept_transactions t ON o.account_id = t.account_id""",
    "master_customer_summary_joined": f"""
SELECT customer_id, {_sum('opening_balance')} AS total_balance,
       {_sum('transaction_amount')} AS total_transaction_amount, {_avg('opening_balance')} AS avg_balance,
       count(transaction_id) AS transaction_count FROM wide GROUP BY customer_id""",
    "master_customer_summary": f"""
SELECT c.customer_id, x.total_balance, y.total_transaction_amount, x.avg_balance,
       coalesce(y.n, 0) AS transaction_count
FROM silver_customers c
LEFT JOIN (SELECT customer_id, {_sum('opening_balance')} AS total_balance, {_avg('opening_balance')} AS avg_balance
           FROM kept_accounts GROUP BY customer_id) x ON c.customer_id = x.customer_id
LEFT JOIN (SELECT customer_id, {_sum('transaction_amount')} AS total_transaction_amount, count(*) AS n
           FROM fact GROUP BY customer_id) y ON c.customer_id = y.customer_id""",
    "master_branch_performance_joined": f"""
SELECT branch_id, {_sum('transaction_amount')} AS total_amount, count(transaction_id) AS transaction_count,
       {_avg('opening_balance')} AS avg_balance FROM wide GROUP BY branch_id""",
    "master_branch_performance": f"""
SELECT x.branch_id, y.total_amount, coalesce(y.n, 0) AS transaction_count, x.avg_balance
FROM (SELECT branch_id, {_avg('opening_balance')} AS avg_balance FROM kept_accounts GROUP BY branch_id) x
LEFT JOIN (SELECT branch_id, {_sum('transaction_amount')} AS total_amount, count(*) AS n
           FROM fact GROUP BY branch_id) y ON x.branch_id = y.branch_id""",
    "master_loan_analysis_joined": f"""
SELECT loan_type, count(*) AS total_loans, {_avg('loan_amount')} AS avg_loan_amount FROM wide GROUP BY loan_type""",
    "master_loan_analysis": f"""
SELECT loan_type, count(*) AS total_loans, {_avg('loan_amount')} AS avg_loan_amount
FROM kept_loans GROUP BY loan_type""",
    "master_transaction_summary_joined": f"""
SELECT transaction_type, {_sum('transaction_amount')} AS total_amount, count(*) AS transaction_count
FROM wide GROUP BY transaction_type""",
    "master_transaction_summary": f"""
SELECT transaction_type, {_sum('transaction_amount')} AS total_amount, count(*) AS transaction_count
FROM fact GROUP BY transaction_type""",
    "monthly_trends_joined": f"""
SELECT cast(year(transaction_date) AS INTEGER) AS year, cast(month(transaction_date) AS INTEGER) AS month,
       {_sum('transaction_amount')} AS monthly_revenue, count(transaction_id) AS transactions
FROM wide GROUP BY 1, 2""",
    "monthly_trends": f"""
SELECT cast(year(transaction_date) AS INTEGER) AS year, cast(month(transaction_date) AS INTEGER) AS month,
       {_sum('transaction_amount')} AS monthly_revenue, count(transaction_id) AS transactions
FROM fact GROUP BY 1, 2""",
    "customer_segmentation": f"SELECT *, {_SEGMENT} FROM owned",
    "customer_segmentation_joined": f"SELECT *, {_SEGMENT} FROM wide",
    "top_customers": """
SELECT * FROM owned ORDER BY opening_balance DESC NULLS LAST, account_id NULLS LAST, customer_id LIMIT 10""",
    "top_customers_joined": """
SELECT * FROM wide
ORDER BY opening_balance DESC NULLS LAST, account_id NULLS LAST, customer_id, transaction_id NULLS LAST,
         loan_id NULLS LAST LIMIT 10""",
    "high_risk_customers": """
SELECT o.*, l.n_loans FROM owned o
JOIN (SELECT customer_id, count(*) AS n_loans FROM kept_loans GROUP BY customer_id) l ON o.customer_id = l.customer_id
WHERE o.opening_balance < 1000""",
    "high_risk_customers_joined": "SELECT * FROM wide WHERE loan_id IS NOT NULL AND opening_balance < 1000",
}


def _finals() -> dict[str, str]:
    finals = dict(_bronze_steps())
    for name in RAW:
        finals[f"b_{name}"] = _bronze(name)
        finals[f"s_{name}"] = f"SELECT * FROM silver_{name}"
    finals["impute_median"] = """
SELECT customer_id, loan_type,
       coalesce(try_cast(loan_amount AS DOUBLE),
                (SELECT quantile_disc(try_cast(loan_amount AS DOUBLE), 0.5) FROM raw_loans), 0) AS loan_amount
FROM raw_loans"""
    finals["ri_report"] = _report("", "silver_")
    finals["ri_report_marked"] = finals["ri_report"]
    finals["ri_report_after"] = _report("_after", "kept_")
    finals["ri_orphans"] = """
SELECT * FROM silver_transactions t
WHERE NOT EXISTS (SELECT 1 FROM silver_accounts a WHERE a.account_id = t.account_id)"""
    for name in ("accounts", "loans", "transactions"):
        finals[f"ri_{name}_clean"] = f"SELECT * FROM kept_{name}"
    finals["dim_customers"] = "SELECT customer_id, first_name, last_name, city FROM silver_customers"
    finals["dim_branches"] = "SELECT branch_id, branch_name, branch_state FROM silver_branches"
    finals["dim_accounts"] = """
SELECT account_id, customer_id, branch_id, account_type, opening_balance, account_open_date FROM kept_accounts"""
    finals["fact_transactions"] = "SELECT * FROM fact"
    finals["fact_transactions_sliced"] = "SELECT * FROM fact"
    # The same accounts, by way of CSV files.
    finals["csv_accounts"] = "SELECT * FROM silver_accounts"
    # Ordered and limited forms of the KPIs. Ties go by the key.
    finals["kpi_top_customers_10"] = f"{_MONEY_KPIS['kpi_top_customers']}, customer_id LIMIT 10"
    finals["kpi_customer_branch_10"] = f"{_MONEY_KPIS['kpi_customer_branch']}, customer_id, branch_id LIMIT 10"
    finals["kpi_top_customers_stored_10"] = finals["kpi_top_customers_10"]
    finals["kpi_customer_branch_stored_10"] = finals["kpi_customer_branch_10"]
    finals["kpi_branch_performance_ordered"] = _MONEY_KPIS["kpi_branch_performance"]
    finals["kpi_monthly_trend_ordered"] = f"""
SELECT * FROM ({_MONEY_KPIS['kpi_monthly_trend']}) q WHERE month <> '1900-01' ORDER BY month"""
    finals["kpi_high_value_txn_sketch"] = f"""
SELECT * FROM fact WHERE transaction_amount >= ({_by_cells('SELECT quantile FROM certified', 'transaction_amount', 'fact', 0.9)})"""
    finals["kpi_high_value_txn_certificate"] = _by_cells("""
SELECT c.quantile, (SELECT count(*) FROM measured WHERE x < c.least) + 1 AS rank_low,
       (SELECT count(*) FROM measured WHERE x <= c.quantile) AS rank_high, (SELECT count(x) FROM measured) AS n
FROM certified c""", "transaction_amount", "fact", 0.9)
    loans = "(SELECT customer_id, loan_type, try_cast(loan_amount AS DOUBLE) AS loan_amount FROM raw_loans) loans"
    finals["impute_median_sketch"] = f"""
SELECT * REPLACE (coalesce(loan_amount, ({_by_cells('SELECT quantile FROM certified', 'loan_amount', loans, 0.5)}), 0) AS loan_amount)
FROM {loans}"""
    finals["kpi_high_value_txn_default"] = f"""
SELECT transaction_id, transaction_amount,
       CASE WHEN transaction_amount < {_ranked('fact', 'transaction_amount', 0.9, -1)} THEN 'out'
            WHEN transaction_amount < {_ranked('fact', 'transaction_amount', 0.9, 1)} THEN 'either' ELSE 'in' END AS place
FROM fact"""
    finals["impute_median_default"] = """
SELECT loan_id, try_cast(loan_amount AS DOUBLE) AS loan_amount,
       CASE WHEN try_cast(loan_amount AS DOUBLE) IS NULL THEN true END AS within_error FROM raw_loans"""
    finals["s_branches_loaded"] = f"SELECT *, TIMESTAMP '{LOADED}' AS _silver_loaded_at FROM silver_branches"
    finals |= {f"{name}_doubles": sql for name, sql in _money_kpis(_exact_sum, _exact_mean).items() if name not in _NO_DOUBLES}
    finals["customer_sums_doubles"] = f"""
SELECT customer_id, count(*) AS transaction_count, {_exact_sum('transaction_amount')} AS total_amount,
       {_exact_mean('transaction_amount')} AS avg_amount FROM fact GROUP BY customer_id"""
    finals["master_transaction_summary_doubles"] = f"""
SELECT transaction_type, {_exact_sum('transaction_amount')} AS total_amount, count(*) AS transaction_count
FROM fact GROUP BY transaction_type"""
    finals["monthly_trends_doubles"] = f"""
SELECT cast(year(transaction_date) AS INTEGER) AS year, cast(month(transaction_date) AS INTEGER) AS month,
       {_exact_sum('transaction_amount')} AS monthly_revenue, count(transaction_id) AS transactions
FROM fact GROUP BY 1, 2"""
    finals["run_dim_accounts"] = finals["dim_accounts"]
    finals["run_kept_loans"] = finals["ri_loans_clean"]
    finals["run_ri_report_after"] = finals["ri_report_after"]
    return {**finals, **_MONEY_KPIS, **_MASTER}


def _needed(sql: str, found: list[str]) -> list[str]:
    """Names of the parts a statement reads, each after those it reads itself."""
    for name in re.findall(r"\b\w+\b", sql):
        if name in _PARTS and name not in found:
            _needed(_PARTS[name], found)
            if name not in found:
                found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for key, sql in _finals().items():
        parts = ",\n".join(f"{name} AS MATERIALIZED ({_PARTS[name].strip()})" for name in _needed(sql, []))
        statements[key] = f"WITH {parts}\n{sql.strip()}"
    return statements
