"""Row layout and cleaning rules of the five banking entities.

Every raw column arrives as text. An :class:`Entity` says what each column is
(identifier, label, number, day, or left as it is); the silver plan turns those
rules into one projection, so no cleaner has to look at ``df.columns``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# What stands for a missing value, and what replaces it.
MISSING_TOKENS = ("", "null", "NULL")
UNKNOWN = "Unknown"
UNKNOWN_BRANCH = "Unknown Branch"
SENTINEL_DAY = "1900-01-01"
DAY_FORMAT = "yyyy-MM-dd"
AUDIT_COLUMN = "_silver_loaded_at"


@dataclass(frozen=True)
class Ident:
    """Identifier: trimmed, upper case, never defaulted."""

    name: str
    type: str = "string"


@dataclass(frozen=True)
class Label:
    """Trimmed text; ``title`` capitalises words; missing becomes ``default``."""

    name: str
    title: bool = True
    default: str = UNKNOWN
    type: str = "string"


@dataclass(frozen=True)
class AsIs:
    """Text passed through untouched (missing tokens become NULL)."""

    name: str
    type: str = "string"


@dataclass(frozen=True)
class Amount:
    """Number; unreadable values are imputed with the column's median.

    ``reading`` is how text becomes a number: ``digits`` keeps digits only,
    ``money`` also accepts currency signs and separators, ``plain`` casts.
    """

    name: str
    reading: str
    type: str = "double"


@dataclass(frozen=True)
class Day:
    """``yyyy-MM-dd`` date; unreadable values become the sentinel day."""

    name: str
    type: str = "date"


@dataclass(frozen=True)
class Entity:
    name: str
    fields: tuple
    parents: dict[str, str] = field(default_factory=dict)  # fk column -> entity
    aliases: dict[str, str] = field(default_factory=dict)  # raw name -> column
    glob: str = "*.csv"
    latest: str | None = None  # keep the row with the greatest value

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def foreign_keys(self) -> list[str]:
        return list(self.parents)

    @property
    def amounts(self) -> list[Amount]:
        return [f for f in self.fields if isinstance(f, Amount)]


# Columns, raw spellings, file globs and relations of the entities.
CUSTOMERS = Entity(
    "customers",
    (
        Ident("customer_id"),
        Label("first_name"),
        Label("last_name"),
        AsIs("email"),
        Amount("phone_number", "digits", "bigint"),
        Label("city"),
        Label("occupation"),
        Day("dob"),
    ),
    aliases={"phone": "phone_number"},
    glob="Bank_Customer*.csv",
)

BRANCHES = Entity(
    "branches",
    (
        Ident("branch_id"),
        Label("branch_name", title=False, default=UNKNOWN_BRANCH),
        AsIs("city"),
        Label("branch_state"),
    ),
    aliases={"state": "branch_state"},
    glob="Bank_Branch*.csv",
)

ACCOUNTS = Entity(
    "accounts",
    (
        Ident("account_id"),
        Ident("customer_id"),
        Ident("branch_id"),
        Label("account_type"),
        Label("account_status"),
        Amount("opening_balance", "money"),
        Day("account_open_date"),
    ),
    parents={"customer_id": "customers", "branch_id": "branches"},
    aliases={"balance": "opening_balance", "created_date": "account_open_date"},
    glob="Bank_Account*.csv",
)

LOANS = Entity(
    "loans",
    (
        Ident("loan_id"),
        Ident("customer_id"),
        Ident("branch_id"),
        Amount("loan_amount", "plain"),
        AsIs("loan_type"),
        AsIs("loan_status"),
    ),
    parents={"customer_id": "customers", "branch_id": "branches"},
    glob="Bank_Loan*.csv",
)

TRANSACTIONS = Entity(
    "transactions",
    (
        Ident("transaction_id"),
        Ident("account_id"),
        Label("transaction_type"),
        Label("transaction_media", title=False),
        Amount("transaction_amount", "plain"),
        Day("transaction_date"),
    ),
    parents={"account_id": "accounts"},
    aliases={
        "amount": "transaction_amount",
        # Spelling found in raw files; both spellings are accepted.
        "transcation_id": "transaction_id",
        "transcation_type": "transaction_type",
        "transcation_media": "transaction_media",
        "transcation_amount": "transaction_amount",
        "transcation_date": "transaction_date",
    },
    glob="Bank_Trans*.csv",
    latest="transaction_date",
)

ENTITIES = {e.name: e for e in (CUSTOMERS, BRANCHES, ACCOUNTS, LOANS, TRANSACTIONS)}

# Every (child, foreign key, parent) the data must respect, in report order.
RELATIONS = [
    (e.name, fk, parent) for e in (ACCOUNTS, LOANS, TRANSACTIONS) for fk, parent in e.parents.items()
]
