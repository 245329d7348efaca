"""Matching seller rows with the retail list, the maps and the order side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.keys import BOOKING_KEY, LEDGER_KEY_PARTS
from tallybook.operators.routing import item_price_rows
from tallybook.sources.schemas import ORDER_COLUMNS

ITEM = "oms_id_sales_order_item"


def without_retail(sc: DataFrame, retail: DataFrame) -> DataFrame:
    """Rows whose seller is not a retail seller; rows without a short code stay."""
    return sc.join(retail.select("short_code"), "short_code", "left_anti").select(*sc.columns)


def missing_beneficiary(sc: DataFrame, beneficiary_map: DataFrame) -> DataFrame:
    """One row per transaction whose seller has no beneficiary code."""
    codes = beneficiary_map.select("short_code")
    return sc.join(codes, "short_code", "left_anti").select(*sc.columns)


def seller_gate_counts(checked: DataFrame, beneficiary_map: DataFrame) -> DataFrame:
    """One row: ``missing``, the number of rows of ``missing_beneficiary``, and ``invalid`` rows of a checked
    table, by one pass over it. Rows are counted by seller before they meet the map."""
    valid = F.col("error").isNull()
    counted = checked.groupBy("short_code", valid.alias("valid")).agg(F.count("*").alias("rows"))
    codes = beneficiary_map.select("short_code").distinct().withColumn("has_code", F.lit(True))
    missing = F.when(F.col("valid") & F.col("has_code").isNull(), F.col("rows")).otherwise(0)
    invalid = F.when(F.col("valid"), 0).otherwise(F.col("rows"))
    return counted.join(codes, "short_code", "left").agg(
        F.coalesce(F.sum(missing), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(invalid), F.lit(0)).alias("invalid"),
    )


def unique_item_ids(sc: DataFrame) -> DataFrame:
    return sc.select(ITEM).distinct()


def match_orders(sc: DataFrame, oms: DataFrame) -> DataFrame:
    """Item-price rows with their order data (NULL where unmatched) and ledger key.

    ``oms`` has one row per item, so a hot item is only ever on the left side, where the
    adaptive skew join splits it.
    """
    order_columns = [c for c in ORDER_COLUMNS if c != ITEM]
    matched = item_price_rows(sc).join(oms.select(*ORDER_COLUMNS), ITEM, "left")
    return matched.selectExpr(*sc.columns, *order_columns, f"{BOOKING_KEY} AS ledger_map_key")


def missing_ledger_keys(valid_item_prices: DataFrame, ledger_map: DataFrame) -> DataFrame:
    """The four parts of each ledger key the map lacks, once per key.

    Rows are reduced to distinct parts first, so only those take part in the join.
    """
    parts = valid_item_prices.select("ledger_map_key", *LEDGER_KEY_PARTS).distinct()
    unmapped = parts.join(ledger_map.select("ledger_map_key"), "ledger_map_key", "left_anti")
    first = F.min(F.struct(*LEDGER_KEY_PARTS)).alias("first")
    return unmapped.groupBy("ledger_map_key").agg(first).select("first.*")
