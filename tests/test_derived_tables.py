"""Known counts and invariants of the derived tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.queries import BOOKED_MONTH, Booking, FlatBooking
from tallybook import fixed
from tallybook.functions.rules import invalid_rows, valid_rows
from tallybook.operators import enrich, matching, postings, routing
from tallybook.operators.row_checks import check_item_price_rows
from tallybook.sources import maps
from tests.conftest import SF


@pytest.fixture(scope="module")
def month(spark):
    return FlatBooking(spark, SF, BOOKED_MONTH)


@pytest.fixture(scope="module")
def whole(spark):
    return Booking(spark, SF)


def test_counts_of_one_month(month):
    matched = matching.match_orders(month.sc, month.oms)
    checked = check_item_price_rows(matched)
    valid = valid_rows(checked)
    assert month.sc.count() == 54
    assert matched.count() == 15
    assert matched.where("item_status IS NULL").count() == 5
    assert valid.count() == 10
    assert month.sc.where(F.col("id_transaction_type").isin(*fixed.COMMISSION_TYPES)).count() == 13
    template = postings.posting_template(month.booked)
    assert template.count() == 26
    assert template.agg(F.sum("amount")).first()[0] == pytest.approx(0, abs=1e-6)


def test_counts_with_gaps_in_the_maps(month):
    valid = valid_rows(check_item_price_rows(matching.match_orders(month.sc, month.oms)))
    gaps = maps.read_ledger_map(month.view("ledger_rows_gaps"))
    assert matching.missing_beneficiary(month.sc, month.view("benef_gaps")).count() == 10
    assert matching.missing_ledger_keys(valid, gaps).count() == 1


def test_valid_and_invalid_rows_make_up_the_input(whole):
    assert whole.extract.count() == 6000
    checked = whole.checked
    assert valid_rows(checked).count() + invalid_rows(checked).count() == checked.count()
    prices = whole.item_prices_checked
    assert valid_rows(prices).count() + invalid_rows(prices).count() == prices.count()
    assert valid_rows(checked).count() == whole.sc.count()


def test_every_routed_row_has_one_category(whole):
    parts = {name: routing.bucket(whole.sc, name).count() for name in fixed.BUCKETS}
    assert all(parts.values())
    assert sum(parts.values()) == routing.route(whole.sc).count()


def test_totals_follow_from_the_values(whole):
    total = postings.posting(whole.booked, "total").groupBy("account_free").agg(
        F.sum("amount").alias("amount")
    )
    signs = (
        F.when(F.col("id_transaction_type").isin(*fixed.COMMISSION_TYPES), 1)
        .when(F.col("id_transaction_type").isin(*fixed.ITEM_PRICE_TYPES), -1)
    )
    prices = whole.item_prices_valid.select("short_code", "id_transaction_type", "transaction_value")
    commissions = whole.sc.where(
        F.col("id_transaction_type").isin(*fixed.COMMISSION_TYPES)
    ).select("short_code", "id_transaction_type", "transaction_value")
    expected = (
        prices.unionByName(commissions)
        .join(whole.beneficiary_map, "short_code")
        .groupBy("beneficiary_code")
        .agg(F.sum(signs * F.col("transaction_value")).cast("double").alias("amount"))
    )
    assert dict(map(tuple, total.collect())) == pytest.approx(
        dict(map(tuple, expected.collect()))
    )


def test_revenue_and_vat_make_up_the_commission(whole):
    rows = enrich.commission_rows(whole.sc, whole.beneficiary_map)
    gap = F.abs(
        F.col("commission_revenue") + F.col("commission_vat")
        + F.col("transaction_value").cast("double")
    )
    assert rows.agg(F.max(gap)).first()[0] < 1e-6


def test_voucher_and_paid_price_make_up_the_value(whole):
    odd = whole.prices.where("voucher + paid_price <> transaction_value")
    assert odd.isEmpty()
