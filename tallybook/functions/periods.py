"""Booking months."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """A half-open range of days."""

    start: date
    end: date

    @classmethod
    def month(cls, year: int, month: int) -> Period:
        following = date(year + month // 12, month % 12 + 1, 1)
        return cls(date(year, month, 1), following)

    def months(self) -> list[date]:
        """The first days of the months that the period touches."""
        out, month = [], self.start.replace(day=1)
        while month < self.end:
            out.append(month)
            month = Period.month(month.year, month.month).end
        return out


def in_period(df: DataFrame, column: str, period: Period | None) -> DataFrame:
    """Rows of the period. A plain range on the column, so it prunes files and row groups."""
    if period is None:
        return df
    kind = df.schema[column].dataType.simpleString()
    start, end = (F.lit(d).cast(kind) for d in (period.start, period.end))
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def previous_month_start(as_of: Column) -> Column:
    return F.add_months(F.trunc(as_of, "MM"), -1)


def previous_month_end(as_of: Column) -> Column:
    """First day after the previous month."""
    return F.trunc(as_of, "MM")


def previous_month(spark: SparkSession, as_of: date) -> Period:
    """The calendar month before the one ``as_of`` lies in, by the same columns."""
    day = F.lit(as_of)
    start, end = previous_month_start(day).alias("start"), previous_month_end(day).alias("end")
    return Period(*spark.range(1).select(start, end).first())
