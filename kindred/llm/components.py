"""Connected components of links between long ids, as an alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.plans.resolve import contract
from kindred.sources.scratch import Scratch


def roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` (the smallest id it reaches) of every id that a link names and that is not itself a root.

    ``links`` has longs ``x`` and ``y``. Self-links, NULLs and repeats are ignored.
    The rounds are written to shared storage, so a lost executor costs one round.
    """
    graph = (
        links.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("x") != F.col("y")))
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .distinct()
    )
    stars, _ = contract(graph, scratch)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
