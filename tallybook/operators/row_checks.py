"""Which booked rows and which uploaded rows are valid."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallybook import fixed
from tallybook.functions.rules import (
    IS_INTEGER,
    REQUIRED_DATE,
    REQUIRED_NUMBER,
    REQUIRED_TEXT,
    Field,
    matches,
    one_of,
    with_error,
)

SELLER_ROW = (
    Field("id_transaction", (REQUIRED_NUMBER,)),
    Field("oms_id_sales_order_item", (REQUIRED_NUMBER,)),
    Field("order_nr", (REQUIRED_TEXT, IS_INTEGER)),
    Field("id_supplier", (REQUIRED_NUMBER,)),
    Field("short_code", (REQUIRED_TEXT,)),
    Field("id_transaction_type", (REQUIRED_NUMBER,)),
    Field("transaction_type", (REQUIRED_TEXT,)),
    Field("transaction_value", (REQUIRED_NUMBER,)),
    Field("id_transaction_statement", (REQUIRED_NUMBER,)),
    Field("statement_start_date", (REQUIRED_DATE,)),
    Field("statement_end_date", (REQUIRED_DATE,)),
)

# The order columns of an item-price row.
ORDER_PART = (
    Field("item_status", (REQUIRED_TEXT,)),
    Field("payment_method", (REQUIRED_TEXT,)),
    Field("shipment_provider_name", (REQUIRED_TEXT,)),
    Field("paid_price", (REQUIRED_NUMBER,)),
)
_UNCHECKED_AFTER_MATCH = {
    "id_transaction",
    "id_transaction_type",
    "id_transaction_statement",
    "statement_start_date",
    "statement_end_date",
}
ITEM_PRICE_ROW = (
    tuple(f for f in SELLER_ROW if f.column not in _UNCHECKED_AFTER_MATCH) + ORDER_PART
)

SHORT_CODE = Field(
    "short_code", (REQUIRED_TEXT, matches(fixed.SHORT_CODE_FORMAT)), label="ShortCode"
)
BENEFICIARY_UPLOAD = (
    SHORT_CODE,
    Field(
        "beneficiary_code",
        (REQUIRED_TEXT, IS_INTEGER, matches(fixed.BENEFICIARY_CODE_FORMAT)),
        label="BeneficiaryCode",
    ),
)
RETAIL_UPLOAD = (SHORT_CODE,)
LEDGER_MAP_UPLOAD = (
    Field(
        "transaction_type", (REQUIRED_TEXT, one_of(fixed.LEDGER_MAP_TYPES)), label="TransactionType"
    ),
    Field("item_status", (REQUIRED_TEXT, one_of(fixed.ITEM_STATUSES)), label="ItemStatus"),
    Field("payment_method", (REQUIRED_TEXT, one_of(fixed.PAYMENT_METHODS)), label="PaymentMethod"),
    Field(
        "shipment_provider_name",
        (REQUIRED_TEXT, one_of(fixed.SHIPMENT_PROVIDERS)),
        label="ShipmentProviderName",
    ),
    Field("ledger", (REQUIRED_TEXT, IS_INTEGER, one_of(fixed.LEDGERS)), label="Ledger"),
    Field("subledger", (IS_INTEGER, one_of(fixed.SUBLEDGERS)), label="Subledger"),
)

# The columns shown for a rejected row.
SELLER_REJECT_COLUMNS = (
    "error",
    "oms_id_sales_order_item",
    "order_nr",
    "short_code",
    "supplier_name",
    "transaction_type",
    "transaction_value",
    "statement_start_date",
    "statement_end_date",
)
ITEM_PRICE_REJECT_COLUMNS = (
    "error",
    "oms_id_sales_order_item",
    "order_nr",
    "short_code",
    "supplier_name",
    "transaction_type",
    "transaction_value",
    "item_status",
    "payment_method",
    "shipment_provider_name",
    "paid_price",
)


def check_seller_rows(sc: DataFrame) -> DataFrame:
    """Adds ``error``: NULL for a valid row. Split with ``valid_rows`` / ``invalid_rows``."""
    return with_error(sc, SELLER_ROW)


def check_item_price_rows(item_prices: DataFrame) -> DataFrame:
    return with_error(item_prices, ITEM_PRICE_ROW)
