"""Gapless ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(frame: DataFrame) -> int:
    """Parts into which the rows of one group are dealt: as many as a shuffle has partitions."""
    return max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ranked(frame: DataFrame, group: list[str], order: Column | str, name: str, at: Column | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... inside each group, without gaps.

    Rows with equal ``order`` are equal as a whole, so it doesn't matter which comes first. Each group is dealt into parts by a hash of ``order``; rows are
    numbered inside their part and shifted by the rows of the parts before. So one group that holds most
    rows is numbered by all tasks, and a second run gives the same numbers. ``frame`` is read twice: pass
    a written table. With ``at``, a number from 0 to under 1 that never falls along ``order``, the parts are
    ranges of it and the ranks follow ``order`` itself.
    """
    parts = spread(frame)
    order = F.col(order) if isinstance(order, str) else order
    part, before, inner = "__part", "__before", "__inner"
    dealt = frame.withColumn(part, F.pmod(F.xxhash64(order), F.lit(parts)) if at is None else F.floor(at * parts))
    counts = dealt.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*group, part, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias(before))
    numbered = dealt.withColumn(inner, F.row_number().over(Window.partitionBy(*group, part).orderBy(order)) - 1)
    return (
        numbered.join(shifts, [*group, part])
        .withColumn(name, (F.col(before) + F.col(inner)).cast("long"))
        .drop(part, before, inner)
    )
