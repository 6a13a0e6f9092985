"""Repeatable random draws.

A draw depends only on the row's identity, a name and a seed, so the same rows
are hit however the data is partitioned and whenever a task is run again.
(``rand(seed)`` follows partition numbers and does not have this property.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 4  # a draw has 16 bits
_PER_DIGEST = 8  # an MD5 digest has 32 hex digits


def threshold(p: float) -> str:
    """Fixed-width hex text ``t`` with ``P(draw < t) = p`` in 1/65536 steps."""
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"not a probability: {p}")
    steps = round(p * 16**_HEX_DIGITS)
    return "g" if steps == 16**_HEX_DIGITS else f"{steps:0{_HEX_DIGITS}x}"


def hit(row_id: Column, name: str, seed: int, p: float, slot: int = 0) -> Column:
    """True for a share ``p`` of the rows, independently for each name and slot.

    One digest serves eight slots, so a draw per column of a row costs Spark one
    evaluation of the common digest, not one per column.
    """
    block, place = divmod(slot, _PER_DIGEST)
    digest = F.md5(F.concat_ws("|", row_id, F.lit(f"{name}{block}"), F.lit(str(seed))))
    # Hex digits of equal length compare as text in the order of the numbers.
    return F.substring(digest, place * _HEX_DIGITS + 1, _HEX_DIGITS) < F.lit(threshold(p))
