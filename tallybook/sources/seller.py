"""Seller transactions with their type, seller, order and statement."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallybook.functions.joins import lookup, probe
from tallybook.functions.money import MONEY
from tallybook.functions.periods import Period, in_period
from tallybook.sources.schemas import SELLER_COLUMNS


def seller_extract(
    tables: Mapping[str, DataFrame],
    period: Period | None = None,
    retail: DataFrame | None = None,
) -> DataFrame:
    """One row per transaction of the period (all periods if none is given).

    Missing partners leave NULLs. ``booking_period`` is the first day of the month. With a
    ``retail`` list the rows of those sellers are left out. The list is matched with the
    sellers, not with the far more numerous transactions, and the rows are gone before the
    large joins. Types are joined before the items too, so that rows of one category are picked
    before the transactions are shuffled.
    """
    transactions = in_period(tables["transaction"], "created_at", period).selectExpr(
        "id_transaction",
        f"CAST(value AS {MONEY}) AS transaction_value",
        "description AS comment",
        "ref",
        "fk_tre2_account_statement_group AS fk_type",
        "fk_seller",
        "fk_transaction_statement AS fk_statement",
        "trunc(created_at, 'MM') AS booking_period",
    )
    row = "id_transaction"
    keys = ("fk_seller", "ref", "fk_type", "fk_statement")
    transactions = transactions.selectExpr("*", *[probe(key, row) for key in keys])
    sellers = tables["seller"].selectExpr(
        "id_seller", "id_seller AS id_supplier", "short_code", "name AS supplier_name"
    )
    if retail is not None:
        listed = retail.distinct().selectExpr("short_code", "true AS is_retail")
        sellers = sellers.join(listed, "short_code", "left")
    items = tables["sales_order_item"].selectExpr(
        "id_sales_order_item", "src_id AS oms_id_sales_order_item", "fk_sales_order"
    )
    orders = tables["sales_order"].select("id_sales_order", "order_nr")
    types = tables["tre2_account_statement_group"].selectExpr(
        "id_tre2_account_statement_group AS id_type",
        "id_tre2_account_statement_group AS id_transaction_type",
        "name AS transaction_type",
    )
    statements = tables["transaction_statement"].selectExpr(
        "id_transaction_statement AS id_statement",
        "id_transaction_statement",
        "start_date AS statement_start_date",
        "end_date AS statement_end_date",
    )
    out = lookup(transactions, sellers, "fk_seller", "id_seller", row)
    if retail is not None:
        out = out.where("is_retail IS NULL")
    out = lookup(out, types, "fk_type", "id_type", row)
    # Items get their order before they meet the transactions, and of a period only those are read on
    # that a transaction names: so the wide rows are shuffled once, by item. Transactions of all periods
    # name most items, and finding these would shuffle both once more.
    if period is not None:
        named = transactions.selectExpr("ref AS id_sales_order_item").distinct()
        items = items.join(named, "id_sales_order_item", "left_semi")
    placed = lookup(items, orders, "fk_sales_order", "id_sales_order", "id_sales_order_item")
    out = lookup(out, placed, "ref", "id_sales_order_item", row)
    out = lookup(out, statements, "fk_statement", "id_statement", row)
    return out.select(*SELLER_COLUMNS, "booking_period")
