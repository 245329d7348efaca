"""Error texts and format rules on rows written by hand."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tallybook.functions.rules import with_error
from tallybook.operators.row_checks import (
    BENEFICIARY_UPLOAD,
    ITEM_PRICE_ROW,
    LEDGER_MAP_UPLOAD,
    RETAIL_UPLOAD,
    SELLER_ROW,
)


def errors(spark, rows, schema, rules):
    df = spark.createDataFrame(rows, schema)
    return [row["error"] for row in with_error(df, rules).collect()]


@pytest.mark.parametrize(
    ("code", "error"),
    [
        ("IR12ABC", None),
        ("IR12abc", "ShortCode: must be in a valid format."),
        ("IR1ABCD", "ShortCode: must be in a valid format."),
        ("IR12ABC\n", "ShortCode: must be in a valid format."),
        (" IR12ABC", "ShortCode: must be in a valid format."),
        ("IR١٢ABC", "ShortCode: must be in a valid format."),
        ("", "ShortCode: cannot be blank."),
        (None, "ShortCode: cannot be blank."),
    ],
)
def test_short_code(spark, code, error):
    assert errors(spark, [(code,)], "short_code string", RETAIL_UPLOAD) == [error]


@pytest.mark.parametrize(
    ("number", "message"),
    [
        ("3000000001", None),
        ("30000000019", None),
        ("300000001", "must be in a valid format"),
        ("2000000001", "must be in a valid format"),
        ("3x", "must be an integer number"),
        ("3000000001\n", "must be an integer number"),
        ("0", "must be in a valid format"),
        ("-7", "must be in a valid format"),
        ("+7", "must be in a valid format"),
        ("007", "must be an integer number"),
        ("1.5", "must be an integer number"),
        ("1e3", "must be an integer number"),
        ("", "cannot be blank"),
    ],
)
def test_beneficiary_code(spark, number, message):
    schema = "short_code string, beneficiary_code string"
    expected = message and f"BeneficiaryCode: {message}."
    assert errors(spark, [("IR12ABC", number)], schema, BENEFICIARY_UPLOAD) == [expected]


def test_two_bad_fields_are_listed_by_name(spark):
    schema = "short_code string, beneficiary_code string"
    assert errors(spark, [("", "x")], schema, BENEFICIARY_UPLOAD) == [
        "BeneficiaryCode: must be an integer number; ShortCode: cannot be blank."
    ]


LEDGER_SCHEMA = (
    "transaction_type string, item_status string, payment_method string, "
    "shipment_provider_name string, ledger string, subledger string"
)
LEDGER_ROW = ("Item Price", "delivered", "SEP", "NA", "13004", "4000000001")


@pytest.mark.parametrize(
    ("position", "text", "error"),
    [
        (5, "", None),
        (5, None, None),
        (5, "4000000005", "Subledger: must be a valid value."),
        (5, "x", "Subledger: must be an integer number."),
        (4, "", "Ledger: cannot be blank."),
        (4, "31006", "Ledger: must be a valid value."),
        (4, "013004", "Ledger: must be an integer number."),
        (0, "item price", "TransactionType: must be a valid value."),
        (1, None, "ItemStatus: cannot be blank."),
        (2, "Cash", "PaymentMethod: must be a valid value."),
        (3, "DHL", "ShipmentProviderName: must be a valid value."),
    ],
)
def test_ledger_map_row(spark, position, text, error):
    row = list(LEDGER_ROW)
    row[position] = text
    assert errors(spark, [tuple(row)], LEDGER_SCHEMA, LEDGER_MAP_UPLOAD) == [error]


def test_seller_row_reports_every_field_in_order(spark):
    schema = (
        "id_transaction bigint, oms_id_sales_order_item bigint, order_nr string, "
        "id_supplier bigint, short_code string, id_transaction_type bigint, "
        "transaction_type string, transaction_value decimal(18,4), "
        "id_transaction_statement bigint, statement_start_date date, statement_end_date date"
    )
    blank = (None, 0, "A1", 0, "", None, None, None, 0, None, None)
    assert errors(spark, [blank], schema, SELLER_ROW) == [
        "id_supplier: cannot be blank; id_transaction: cannot be blank; "
        "id_transaction_statement: cannot be blank; id_transaction_type: cannot be blank; "
        "oms_id_sales_order_item: cannot be blank; order_nr: must be an integer number; "
        "short_code: cannot be blank; statement_end_date: cannot be blank; "
        "statement_start_date: cannot be blank; transaction_type: cannot be blank; "
        "transaction_value: cannot be blank."
    ]


def test_item_price_row_does_not_check_statements(spark):
    schema = (
        "oms_id_sales_order_item bigint, order_nr string, id_supplier bigint, "
        "short_code string, transaction_type string, transaction_value decimal(18,4), "
        "item_status string, payment_method string, shipment_provider_name string, "
        "paid_price decimal(18,4)"
    )
    price = Decimal("5.0000")
    rows = [
        (1, "5", 1, "IR12ABC", "Item Price", price, None, "SEP", "NA", Decimal(0)),
        (1, "5", 1, "IR12ABC", "Item Price", price, "closed", "SEP", "NA", price),
    ]
    assert errors(spark, rows, schema, ITEM_PRICE_ROW) == [
        "item_status: cannot be blank; paid_price: cannot be blank.",
        None,
    ]
