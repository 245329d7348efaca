"""Small hand-made source tables for one booking run."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallybook.sources.schemas import ALL_TABLES

APRIL = datetime(2018, 4, 10, 12)


def money(text: str) -> Decimal:
    return Decimal(text)


def transaction(id_, value, type_, ref, seller=1, statement=1, comment=None, at=APRIL):
    return (id_, money(value), comment, at, ref, type_, seller, statement)


ROWS = {
    "transaction": [
        transaction(1, "100", 17, 11),
        transaction(2, "50", 17, 12, comment="x"),
        transaction(3, "-100", 18, 13, seller=2),
        transaction(4, "-109", 78, 11),
        transaction(5, "10.9", 19, None, seller=2),  # no item: rejected
        transaction(6, "-5", 13, 11),
        transaction(7, "70", 17, 11, seller=3),  # retail
        transaction(8, "80", 17, 11, statement=None),  # no statement: rejected
        transaction(9, "30", 17, 14),  # unknown to the order side
        transaction(10, "40", 17, 15),  # paid nothing
        transaction(11, "-21.8", 2, 13, seller=2),
        transaction(12, "90", 17, 11, at=datetime(2018, 5, 1)),  # next month
        transaction(13, "90", 17, 11, at=datetime(2018, 3, 31, 23, 59, 59)),  # month before
    ],
    "tre2_account_statement_group": [
        (17, "Item Price Credit"),
        (18, "Item Price"),
        (78, "fee 78"),
        (2, "fee 2"),
        (19, "fee 19"),
        (13, "fee 13"),
    ],
    "seller": [(1, "IR00001", "One"), (2, "IR00002", "Two"), (3, "IR00003", "Retail")],
    "sales_order_item": [(i, i, 100 + i) for i in (11, 12, 13, 14, 15)],
    "sales_order": [(100 + i, str(900 + i)) for i in (11, 12, 13, 14, 15)],
    "transaction_statement": [(1, date(2018, 4, 1), date(2018, 4, 30))],
    "ims_sales_order_item": [
        (11, 211, 1, money("90")),
        (12, 212, 1, money("20")),
        (13, 213, 1, money("90")),
        (15, 215, 1, money("0")),
        (99, 211, 1, money("1")),
    ],
    "ims_sales_order": [(211, "SEP"), (212, "SEP"), (213, "PEC"), (215, "SEP")],
    "oms_package_item": [(11, 1), (11, 2), (12, 1), (13, 3), (15, 1)],
    "oms_package_dispatching": [(1, 1), (1, 1), (2, 2), (3, 2)],
    "oms_shipment_provider": [(1, "Post"), (2, "Tipax")],
    "ims_sales_order_item_status": [(1, "delivered"), (2, "closed")],
    "ims_sales_order_item_status_history": [(11, 5, APRIL), (13, 5, None), (12, 4, APRIL)],
    "beneficiary_code_map": [("IR00001", 3000000001), ("IR00002", 3000000002)],
    "retail_short_code": [("IR00003",)],
    "ledger_map": [
        ("Item Price Credit", "delivered", "SEP", "Post", 13004, 4000000001),
        ("Item Price", "delivered", "PEC", "Tipax", 94001, None),
    ],
}


def source_tables(spark: SparkSession, **changed: list[tuple]) -> dict[str, DataFrame]:
    return {
        name: spark.createDataFrame((ROWS | changed)[name], schema)
        for name, schema in ALL_TABLES.items()
    }
