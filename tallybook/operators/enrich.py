"""Row-level results: item prices and commissions with codes, vouchers, revenue and VAT."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import fixed
from tallybook.functions.money import MONEY, commission_revenue, commission_vat
from tallybook.operators.routing import commission_type_rows

# The columns of the row-level results, in their order.
PRICE_COLUMNS = (
    "booking_period",
    "oms_id_sales_order_item",
    "order_nr",
    "id_supplier",
    "short_code",
    "supplier_name",
    "id_transaction_type",
    "transaction_type",
    "transaction_value",
    "comment",
    "item_status",
    "payment_method",
    "shipment_provider_name",
    "paid_price",
    "voucher",
    "ledger",
    "subledger",
    "beneficiary_code",
)
COMMISSION_COLUMNS = (
    "booking_period",
    "oms_id_sales_order_item",
    "order_nr",
    "id_supplier",
    "short_code",
    "supplier_name",
    "transaction_type",
    "transaction_value",
    "commission_revenue",
    "commission_vat",
    "comment",
    "beneficiary_code",
)


# Sign of a paid price by its type or kind.
SIGN = "CASE WHEN {0} = " + str(fixed.ITEM_PRICE_CREDIT) + " THEN 1 ELSE -1 END"


def price_rows(
    valid_item_prices: DataFrame, ledger_map: DataFrame, beneficiary_map: DataFrame
) -> DataFrame:
    """Both kinds of item-price rows with codes; ``paid_price`` carries the sign of its
    kind, and voucher + paid price = transaction value."""
    paid = f"CAST({SIGN.format('id_transaction_type')} * paid_price AS {MONEY})"
    return (
        valid_item_prices.withColumn("paid_price", F.expr(paid))
        .withColumn("voucher", F.expr("transaction_value - paid_price"))
        .join(ledger_map, "ledger_map_key", "left")
        .join(beneficiary_map, "short_code", "left")
        .select(*PRICE_COLUMNS)
    )


def ipc_final(prices: DataFrame) -> DataFrame:
    return prices.where(f"id_transaction_type = {fixed.ITEM_PRICE_CREDIT}")


def ipt_final(prices: DataFrame) -> DataFrame:
    return prices.where(f"id_transaction_type = {fixed.ITEM_PRICE}")


def commission_rows(sc: DataFrame, beneficiary_map: DataFrame) -> DataFrame:
    """Commissions and commission credits, split into revenue and VAT."""
    split = commission_type_rows(sc).selectExpr(
        "*",
        f"{commission_revenue('transaction_value')} AS commission_revenue",
        f"{commission_vat('transaction_value')} AS commission_vat",
    )
    return split.join(beneficiary_map, "short_code", "left").select(*COMMISSION_COLUMNS)
