"""Transaction categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import fixed


def _in(ids: tuple[int, ...]) -> str:
    return f"id_transaction_type IN ({', '.join(map(str, ids))})"


# Category of a row, NULL for a type that is not routed. No join: 14 fixed ids.
BUCKET = (
    "CASE " + " ".join(f"WHEN {_in(ids)} THEN '{b}'" for b, ids in fixed.BUCKETS.items()) + " END"
)


def route(sc: DataFrame) -> DataFrame:
    """All routed rows with their category."""
    return sc.selectExpr("*", f"{BUCKET} AS bucket").where("bucket IS NOT NULL")


def bucket(sc: DataFrame, name: str) -> DataFrame:
    """Rows of one category, commented or not; the filter is on the type id, so it is
    pushed to the source."""
    return sc.where(_in(fixed.BUCKETS[name]))


def category(written: DataFrame, name: str, commented: bool = False) -> DataFrame:
    """One category of the written table of all; only its own files are read, and of the commented
    subset only those."""
    rows = written.where(F.col("bucket") == name)
    return (rows.where("commented = 1") if commented else rows).drop("bucket", "commented")


def commented(rows: DataFrame) -> DataFrame:
    return rows.where("comment IS NOT NULL")


def item_price_rows(rows: DataFrame) -> DataFrame:
    return rows.where(_in(fixed.ITEM_PRICE_TYPES))


def commission_type_rows(rows: DataFrame) -> DataFrame:
    return rows.where(_in(fixed.COMMISSION_TYPES))


def booked_rows(rows: DataFrame) -> DataFrame:
    """The rows that postings are made of."""
    return rows.where(_in(fixed.ITEM_PRICE_TYPES + fixed.COMMISSION_TYPES))
