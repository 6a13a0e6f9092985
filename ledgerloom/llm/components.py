"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut


#: Links a task handles at least.
TASK_LINKS = 50_000


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b) but the roots themselves;
    the root is the smallest node of the component.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours, then its smaller ones, to the smallest of its neighbourhood. Minima
    are combined before the shuffle and a hot node's links are an ordinary join, which
    AQE can split. The number of rounds grows with the logarithm of the path lengths."""
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    # A round has no more links than two for each of the first ones.
    tasks = 1 + 2 * state[0] // TASK_LINKS
    while True:
        links = links.coalesce(tasks)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = cut(large.where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        low = links.groupBy("a").agg(F.min("b").alias("low"))
        small = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = cut(small.union(low.select("a", F.col("low").alias("b"))).coalesce(tasks).distinct().coalesce(tasks))
        before, state = state, _state(links)
        if before == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
