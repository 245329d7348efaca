"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.llm.staging import Staging


def _written(edges: DataFrame, staging: Staging, name: str) -> tuple[DataFrame, tuple]:
    """The written edges, and numbers that change with them, taken on the way."""
    seen = Observation()
    marked = edges.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    written = staging.table(marked, name)
    return written, (seen.get.get("rows"), seen.get.get("sum"))


def components(links: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots: root is the least node of its component.

    Each round ties every node to the least of its neighbours, first for the larger neighbours and then
    for the smaller ones, until nothing changes; rounds grow with the logarithm of the longest chain.
    Minima are taken inside each task before the shuffle, and joins on them can be split, so a node may
    have any number of links. Each round is written once.
    """
    first = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, mark = _written(first, staging, f"{name}_0")
    turn = 0
    while True:
        turn += 1
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionAll(least.select("a", F.col("least").alias("b")))
            .where("a <> b")
            .distinct()
        )
        small, found = _written(small, staging, f"{name}_{turn}")
        staging.drop(f"{name}_{turn - 1}")
        if found == mark:
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges, mark = small, found
