"""Joins that stay balanced when a key is missing or hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def probe(key: str, spread_by: str) -> str:
    """What ``lookup`` joins on: the key, or for a NULL key a hash of the columns
    ``spread_by``, which is always negative."""
    return f"coalesce({key}, ~shiftrightunsigned(xxhash64({spread_by}), 1)) AS {key}_probe"


def lookup(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, spread_by: str) -> DataFrame:
    """Left join of ``facts`` to ``dim`` on a bigint key that is often NULL; ``dim_key``,
    which must be a name ``facts`` does not have, is dropped again.

    In a shuffle join all NULL keys would go to one task; their hash spreads them over all
    tasks, and the extra condition keeps them unmatched whatever ids ``dim`` holds. No hint
    is given: Spark broadcasts ``dim`` if its size allows, and otherwise shuffles and splits
    hot keys of ``facts`` (adaptive skew join), which is why ``facts`` is the left side.

    ``facts`` may bring its probe column along. If it stems from a filtered scan, Spark can
    then prune ``dim`` by the keys that occur (runtime bloom filter).
    """
    if f"{key}_probe" not in facts.columns:
        facts = facts.selectExpr("*", probe(key, spread_by))
    matching = F.expr(f"{key}_probe = {dim_key} AND {key} IS NOT NULL")
    return facts.join(dim, matching, "left").drop(f"{key}_probe", dim_key)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, NULLs last.

    An aggregate rather than a window: each task first reduces its own rows, so a hot key
    never gathers in one task.
    """
    ranked = ", ".join(f"{c} IS NULL AS no_{c}, {c}" for c in order)
    best = df.groupBy(key).agg(F.expr(f"min(struct({ranked}))").alias("_best"))
    return best.selectExpr(key, *[f"_best.{c} AS {c}" for c in order])
