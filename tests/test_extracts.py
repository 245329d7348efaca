"""The two extracts against a plain nested-loop join on random tables with gaps."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from tallybook.functions.periods import Period
from tallybook.sources.orders import order_extract, shipped_ledger_keys
from tallybook.sources.schemas import ALL_TABLES, SELLER_COLUMNS
from tallybook.sources.seller import seller_extract


def maybe(rng, values):
    """One of the values, an id no table has, or None."""
    return rng.choice([*values, 999, None])


def last(value):
    return (value is None, value)


def partners(rows, column, key):
    """Rows of a left join: those with the key, or one of only None."""
    found = [r for r in rows if key is not None and r[column] == key]
    return found or [(None,) * 8]


def order_tables(rng):
    ids = range(1, 13)
    return {
        "ims_sales_order_item": [
            (
                rng.choice(ids),
                maybe(rng, range(5)),
                maybe(rng, (1, 2)),
                rng.choice([Decimal(n) for n in range(4)] + [None]),
            )
            for _ in range(16)
        ],
        "ims_sales_order": [(i, rng.choice(["SEP", "PEC", None])) for i in range(5)],
        "oms_package_item": [(maybe(rng, ids), maybe(rng, range(6))) for _ in range(30)],
        "oms_package_dispatching": [
            (maybe(rng, range(6)), maybe(rng, (1, 2, 3))) for _ in range(12)
        ],
        "oms_shipment_provider": [(1, "Tipax"), (2, "Post"), (3, "NA")],
        "ims_sales_order_item_status": [(1, "delivered"), (2, "closed")],
        "ims_sales_order_item_status_history": [
            (rng.choice(ids), rng.choice([4, 5]), rng.choice([datetime(2018, 1, 1), None]))
            for _ in range(20)
        ],
    }


def joined_orders(t):
    for item in t["ims_sales_order_item"]:
        for order in partners(t["ims_sales_order"], 0, item[1]):
            for status in partners(t["ims_sales_order_item_status"], 0, item[2]):
                for package in partners(t["oms_package_item"], 0, item[0]):
                    for dispatch in partners(t["oms_package_dispatching"], 0, package[1]):
                        for provider in partners(t["oms_shipment_provider"], 0, dispatch[1]):
                            # The provider id decides, also one that names no provider.
                            yield (item[0], status[1], order[1], provider[1], item[3], dispatch[1])


@pytest.mark.parametrize("seed", range(4))
def test_order_extract(spark, seed):
    rng = random.Random(seed)
    t = order_tables(rng)
    tables = {n: spark.createDataFrame(rows, ALL_TABLES[n]) for n, rows in t.items()}
    wanted = rng.sample(range(1, 13), 8)
    ids = spark.createDataFrame([(i,) for i in wanted], "oms_id_sales_order_item bigint")

    def expected(keep):
        best = {}
        for row in joined_orders(t):
            rank = (last(row[1]), last(row[2]), last(row[5]), last(row[4]))
            if row[0] in keep and (row[0] not in best or rank < best[row[0]][0]):
                best[row[0]] = (rank, row[:5])
        return {row for _, row in best.values()}

    assert {tuple(r) for r in order_extract(tables, ids).collect()} == expected(wanted)
    assert {tuple(r) for r in order_extract(tables).collect()} == expected(range(13))

    shipped = {h[0] for h in t["ims_sales_order_item_status_history"] if h[1] == 5 and h[2]}
    keys = [
        None if None in row[1:4] else "-".join(row[1:4])
        for row in joined_orders(t)
        if row[0] in shipped and row[0] in wanted
    ]
    got = [r[0] for r in shipped_ledger_keys(tables, ids).collect()]
    assert len(got) == len(set(got))
    assert set(got) == set(keys)


@pytest.mark.parametrize("seed", range(3))
def test_seller_extract(spark, seed):
    rng = random.Random(seed)
    start = datetime(2018, 3, 25)
    t = {
        "transaction": [
            (
                n,
                rng.choice([None, Decimal("0.0000"), Decimal("12.5000")]),
                rng.choice([None, "", "text"]),
                start + timedelta(hours=rng.randrange(24 * 45)),
                maybe(rng, range(6)),
                maybe(rng, (17, 18)),
                maybe(rng, range(4)),
                maybe(rng, (1, 2)),
            )
            for n in range(60)
        ],
        "tre2_account_statement_group": [(17, "Item Price Credit"), (18, "Item Price")],
        "seller": [(0, "IR00000", "Zero"), (1, None, "One"), (2, "IR00002", "Two"), (3, "", "")],
        "sales_order_item": [(n, maybe(rng, (7, 8)), maybe(rng, range(4))) for n in range(6)],
        "sales_order": [(n, rng.choice([None, str(n)])) for n in range(4)],
        "transaction_statement": [(1, date(2018, 4, 1), date(2018, 4, 30)), (2, None, None)],
    }
    tables = {n: spark.createDataFrame(rows, ALL_TABLES[n]) for n, rows in t.items()}
    expected = []
    for txn in t["transaction"]:
        if not datetime(2018, 4, 1) <= txn[3] < datetime(2018, 5, 1):
            continue
        for group in partners(t["tre2_account_statement_group"], 0, txn[5]):
            for seller in partners(t["seller"], 0, txn[6]):
                for item in partners(t["sales_order_item"], 0, txn[4]):
                    for order in partners(t["sales_order"], 0, item[2]):
                        for st in partners(t["transaction_statement"], 0, txn[7]):
                            expected.append(
                                (txn[0], item[1], order[1], *seller[:3], group[1], group[0])
                                + (txn[1], *st[:3], txn[2], date(2018, 4, 1))
                            )
    april = Period.month(2018, 4)
    got = seller_extract(tables, april)
    assert got.columns == [*SELLER_COLUMNS, "booking_period"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    retail = spark.createDataFrame([("IR00002",), ("IR00002",), (None,)], "short_code string")
    kept = [row for row in expected if row[4] != "IR00002"]
    without = seller_extract(tables, april, retail)
    assert sorted(map(repr, map(tuple, without.collect()))) == sorted(map(repr, kept))
