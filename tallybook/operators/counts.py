"""Row counts of the steps of a booking run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.storage import stage


def rows(step: str) -> dict[str, Column]:
    """The count of all rows of a step."""
    return {step: F.count("*")}


def checked_rows(step: str, prefix: str) -> dict[str, Column]:
    """The counts of a checked table, of its valid and of its invalid rows."""
    valid = F.col("error").isNull()
    return rows(step) | {
        f"{prefix}_valid": F.count_if(valid),
        f"{prefix}_invalid": F.count_if(~valid),
    }


class StepCounts(dict):
    """Rows by step, counted by the tasks that write the tables.

    The numbers come from the last stage of a write, of which Spark takes each partition's once, so a
    task that runs twice doesn't count twice, and no table is read again to be counted.
    """

    def stage(
        self, df: DataFrame, path: str, counted: Mapping[str, Column], *partition_by: str
    ) -> DataFrame:
        """``storage.stage`` that takes down the counts on the way."""
        seen = Observation()
        columns = [count.alias(step) for step, count in counted.items()]
        staged = stage(df.observe(seen, *columns), path, *partition_by)
        self.update({step: seen.get.get(step) or 0 for step in counted})
        return staged
