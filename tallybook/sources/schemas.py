"""Columns the jobs read from each source table, and of the reference maps."""

from __future__ import annotations

# Seller side.
SELLER_TABLES = {
    "transaction": (
        "id_transaction bigint, value decimal(18,4), description string, created_at timestamp, "
        "ref bigint, fk_tre2_account_statement_group bigint, fk_seller bigint, "
        "fk_transaction_statement bigint"
    ),
    "tre2_account_statement_group": "id_tre2_account_statement_group bigint, name string",
    "seller": "id_seller bigint, short_code string, name string",
    "sales_order_item": "id_sales_order_item bigint, src_id bigint, fk_sales_order bigint",
    "sales_order": "id_sales_order bigint, order_nr string",
    "transaction_statement": "id_transaction_statement bigint, start_date date, end_date date",
}

# Order side.
ORDER_TABLES = {
    "ims_sales_order_item": (
        "id_sales_order_item bigint, fk_sales_order bigint, fk_sales_order_item_status bigint, "
        "paid_price decimal(18,4)"
    ),
    "ims_sales_order": "id_sales_order bigint, payment_method string",
    "oms_package_item": "fk_sales_order_item bigint, fk_package bigint",
    "oms_package_dispatching": "fk_package bigint, fk_shipment_provider bigint",
    "oms_shipment_provider": "id_shipment_provider bigint, shipment_provider_name string",
    "ims_sales_order_item_status": "id_sales_order_item_status bigint, name string",
}

# Only needed for the keys of shipped items.
STATUS_HISTORY = {
    "ims_sales_order_item_status_history": (
        "fk_sales_order_item bigint, fk_sales_order_item_status bigint, created_at timestamp"
    ),
}

# Reference maps.
MAP_TABLES = {
    "beneficiary_code_map": "short_code string, beneficiary_code bigint",
    "retail_short_code": "short_code string",
    "ledger_map": (
        "transaction_type string, item_status string, payment_method string, "
        "shipment_provider_name string, ledger bigint, subledger bigint"
    ),
}

# What makes a row of a map unique.
MAP_KEYS = {
    "beneficiary_code_map": ("short_code",),
    "retail_short_code": ("short_code",),
    "ledger_map": ("transaction_type", "item_status", "payment_method", "shipment_provider_name"),
}

ALL_TABLES = SELLER_TABLES | ORDER_TABLES | STATUS_HISTORY | MAP_TABLES

# Result columns of the two extracts.
SELLER_COLUMNS = (
    "id_transaction",
    "oms_id_sales_order_item",
    "order_nr",
    "id_supplier",
    "short_code",
    "supplier_name",
    "transaction_type",
    "id_transaction_type",
    "transaction_value",
    "id_transaction_statement",
    "statement_start_date",
    "statement_end_date",
    "comment",
)
ORDER_COLUMNS = (
    "oms_id_sales_order_item",
    "item_status",
    "payment_method",
    "shipment_provider_name",
    "paid_price",
)
# The seller columns that booking goes on with.
STAGED_COLUMNS = (
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
)
