"""Customer risk score.

The score is meant to reflect transaction count, total and average amount; no
formula is given for it anywhere, so this one is our own definition: the mean of
the customer's percent ranks in the three measures, with fixed bands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import sums
from ledgerloom.operators.ranks import percent_ranks

HIGH, MEDIUM = 0.9, 0.6


MEASURES = ["transaction_count", "total_amount", "avg_amount"]


def customer_sums(fact: DataFrame, scale: int | None = None) -> DataFrame:
    columns = {"transaction_count": sums.ROWS, "total_amount": sums.TOTAL, "avg_amount": sums.MEAN}
    return sums.grouped(fact, ["customer_id"], "transaction_amount", columns, scale)


def score(measured: DataFrame) -> DataFrame:
    """Rank and band customers. Several branches of the plan read ``measured``."""
    ranks = percent_ranks(measured, "customer_id", MEASURES)
    mean = f"({' + '.join(f'{m}_rank' for m in MEASURES)}) / {len(MEASURES)} AS risk_score"
    scored = ranks.selectExpr("customer_id", *MEASURES, mean)
    band = f"CASE WHEN risk_score >= {HIGH}D THEN 'High' WHEN risk_score >= {MEDIUM}D THEN 'Medium' ELSE 'Low' END"
    return scored.withColumn("risk_band", F.expr(band))


def customer_risk_score(fact: DataFrame, scale: int | None = None) -> DataFrame:
    """``fact`` should be a stored table; else store ``customer_sums`` first."""
    return score(customer_sums(fact, scale))
