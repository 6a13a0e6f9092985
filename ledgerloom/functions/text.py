"""Column expressions that turn raw text into typed, normalised values.

The rules are nested per field, so they are written as SQL text and parsed once
per field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.model import DAY_FORMAT, MISSING_TOKENS, SENTINEL_DAY, Amount, AsIs, Day, Ident, Label

_WELL_FORMED = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_TOKENS = ", ".join(f"'{token}'" for token in MISSING_TOKENS)


def _blank_to_null(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ({_TOKENS}) THEN {c} END"


def blank_to_null(c: str) -> Column:
    """NULL for blank text and for the tokens that stand for a missing value."""
    return F.expr(_blank_to_null(c))


def ident(c: str) -> Column:
    return F.expr(f"upper(trim({_blank_to_null(c)}))")


def label(c: str, title: bool, default: str) -> Column:
    text = f"trim({_blank_to_null(c)})"
    return F.expr(f"coalesce({f'initcap({text})' if title else text}, '{default}')")


def digits(c: str, type: str = "bigint") -> Column:
    """Digits of a phone-like text; NULL if there are none or too many."""
    return F.expr(f"try_cast(regexp_replace({_blank_to_null(c)}, '[^0-9]', '') AS {type})")


def money(c: str, type: str = "double") -> Column:
    """Amount in free text such as ``$1,234.50``.

    A well-formed number, exponent included, is cast as it stands: stripping
    would lose the exponent. The sign is kept.
    """
    text = f"trim({_blank_to_null(c)})"
    bare = f"regexp_replace({text}, '[^0-9.-]', '')"
    return F.expr(f"try_cast(CASE WHEN {text} RLIKE '{_WELL_FORMED}' THEN {text} ELSE {bare} END AS {type})")


def plain_number(c: str, type: str = "double") -> Column:
    return F.expr(f"try_cast({_blank_to_null(c)} AS {type})")


def finite(c: str) -> Column:
    """Text such as ``NaN`` or ``1e999`` is no amount: NULL. (NaN sorts above infinity.) For a column
    that has been read already, in a projection of its own: then the text is read once."""
    return F.expr(f"CASE WHEN abs({c}) < double('Infinity') THEN {c} END").alias(c)


def sentinel_day() -> Column:
    return F.expr(f"DATE '{SENTINEL_DAY}'")


def day(c: str) -> Column:
    return F.expr(f"coalesce(try_to_date({_blank_to_null(c)}, '{DAY_FORMAT}'), DATE '{SENTINEL_DAY}')")


def placeholders(fields: Sequence) -> dict[str, Column]:
    """The value that stands for a missing one, of the columns that have such a value."""
    found = {f.name: F.lit(f.default) for f in fields if isinstance(f, Label)}
    return found | {f.name: sentinel_day() for f in fields if isinstance(f, Day)}


_READINGS = {"digits": digits, "money": money, "plain": plain_number}


def read_fields(raw: DataFrame, fields: Sequence, others: Sequence[str] = ()) -> DataFrame:
    """The typed values of raw text columns, before any median imputation."""
    typed = raw.select(*[read_field(f) for f in fields], *others)
    doubles = {f.name for f in fields if isinstance(f, Amount) and f.type in ("double", "float")}
    return typed.select(*(finite(c) if c in doubles else c for c in typed.columns))


def read_field(f) -> Column:
    """The typed value of one column; of a double it may be infinite or NaN."""
    match f:
        case Ident():
            value = ident(f.name)
        case Label():
            value = label(f.name, f.title, f.default)
        case AsIs():
            value = blank_to_null(f.name)
        case Amount():
            value = _READINGS[f.reading](f.name, f.type)
        case Day():
            value = day(f.name)
        case _:
            raise TypeError(f"no reading for {f!r}")
    return value.alias(f.name)
