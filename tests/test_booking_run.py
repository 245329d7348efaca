"""A whole run on hand-made tables: results, reject files, gates."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook.functions.periods import Period, previous_month
from tallybook.operators.gates import MissingBeneficiaryCodes, MissingLedgerKeys, NotBalanced
from tallybook.plans.booking import run_booking
from tallybook.sinks.files import plain_number, write_csv
from tallybook.sources.maps import DuplicateKeys
from tests.tables import ROWS, source_tables

APRIL = Period.month(2018, 4)


def read_csv(spark, path):
    return spark.read.option("header", True).option("escape", '"').csv(str(path))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run") / "out")
    return run_booking(source_tables(spark), out, APRIL, details=True)


def test_postings(run):
    lines = {
        (r["posting"], r["account_code"], r["account_free"]): r["amount"]
        for r in run.template.collect()
    }
    assert lines == pytest.approx(
        {
            ("voucher", 62002, None): 10 + 30 - 10,
            ("ipc_paid_price", 13004, 4000000001): 110,
            ("ipt_paid_price", 94001, None): -90,
            ("commission_vat", 32021, None): 9 + 1.8,
            ("commission_revenue", 62001, 3000000001): 100,
            ("commission_revenue", 62001, 3000000002): 20,
            ("total", 31002, 3000000001): -(100 + 50 + 109),
            ("total", 31002, 3000000002): -(-100 + 21.8),
        }
    )
    assert sum(lines.values()) == pytest.approx(0)


def test_counts(run):
    assert run.counts == {
        "extracted": 11,
        "beneficiary_map": 2,
        "ledger_map": len(ROWS["ledger_map"]),
        "orders": 4,
        "without_retail": 10,
        "seller_rows_valid": 8,
        "seller_rows_invalid": 2,
        "missing_beneficiary": 0,
        "item_prices": 5,
        "item_prices_valid": 3,
        "item_prices_invalid": 2,
        "missing_ledger_keys": 0,
        "posting_lines": 8,
    }


def test_rejected_rows(spark, run):
    sellers = read_csv(spark, f"{run.out}/invalid_seller_rows")
    assert {r["error"] for r in sellers.collect()} == {
        "oms_id_sales_order_item: cannot be blank; order_nr: cannot be blank.",
        "id_transaction_statement: cannot be blank; statement_end_date: cannot be blank; "
        "statement_start_date: cannot be blank.",
    }
    prices = read_csv(spark, f"{run.out}/invalid_item_price_rows")
    assert {(r["oms_id_sales_order_item"], r["error"]) for r in prices.collect()} == {
        (
            "14",
            "item_status: cannot be blank; paid_price: cannot be blank; "
            "payment_method: cannot be blank; shipment_provider_name: cannot be blank.",
        ),
        ("15", "paid_price: cannot be blank."),
    }
    assert len(sellers.columns) == 9
    assert len(prices.columns) == 11


def test_template_file(spark, run):
    folder = f"{run.out}/posting_template/booking_period=2018-04-01"
    rows = read_csv(spark, folder)
    assert rows.columns == ["Account Code", "Account Free", "Amount"]
    values = {tuple(r) for r in rows.collect()}
    assert ("62002", None, "30") in values
    assert ("94001", None, "-90") in values
    assert ("62001", "3000000001", "100") in values
    assert len(values) == 8


def test_details(spark, run):
    details = f"{run.out}/details"
    assert read_csv(spark, f"{details}/ipc_final").count() == 2
    assert len(read_csv(spark, f"{details}/ipc_final").columns) == 16
    ipt = read_csv(spark, f"{details}/ipt_final").collect()
    assert [(r["paid_price"], r["voucher"]) for r in ipt] == [("-90.0000", "-10.0000")]
    assert len(read_csv(spark, f"{details}/commission_final").columns) == 11
    assert read_csv(spark, f"{details}/commission_final").count() == 2
    assert read_csv(spark, f"{details}/sc").count() == 8
    assert read_csv(spark, f"{details}/item_price_credit_valid").count() == 2
    assert read_csv(spark, f"{details}/item_price_valid").count() == 1
    month = "booking_period=2018-04-01"
    assert read_csv(spark, f"{details}/voucher/{month}").count() == 1


def test_all_months_book_each_month_as_if_alone(spark, tmp_path):
    whole = run_booking(source_tables(spark), str(tmp_path / "all"), every_month=True).template
    months = {r["booking_period"] for r in whole.select("booking_period").collect()}
    assert months == {date(2018, 3, 1), date(2018, 4, 1), date(2018, 5, 1)}
    april = whole.where(whole.booking_period == date(2018, 4, 1))
    alone = run_booking(source_tables(spark), str(tmp_path / "one"), APRIL).template
    assert sorted(map(tuple, april.collect()), key=str) == sorted(
        map(tuple, alone.collect()), key=str
    )


def test_missing_beneficiary_code_stops_and_is_logged(spark, tmp_path):
    tables = source_tables(spark, beneficiary_code_map=[("IR00001", 3000000001)])
    with pytest.raises(MissingBeneficiaryCodes) as stop:
        run_booking(tables, str(tmp_path / "out"), APRIL)
    logged = [tuple(r) for r in read_csv(spark, stop.value.log).collect()]
    assert logged == [("IR00002",)] * 2  # one line per transaction
    assert not (tmp_path / "out" / "postings").exists()


def test_missing_ledger_key_stops_and_is_logged(spark, tmp_path):
    tables = source_tables(spark, ledger_map=ROWS["ledger_map"][1:])
    with pytest.raises(MissingLedgerKeys) as stop:
        run_booking(tables, str(tmp_path / "out"), APRIL)
    assert [tuple(r) for r in read_csv(spark, stop.value.log).collect()] == [
        ("Item Price Credit", "delivered", "SEP", "Post", "0", "0")
    ]
    assert not (tmp_path / "out" / "postings").exists()


def test_doubled_map_key_is_refused(spark, tmp_path):
    doubled = [*ROWS["beneficiary_code_map"], ("IR00001", 3000000009)]
    with pytest.raises(DuplicateKeys) as refused:
        run_booking(
            source_tables(spark, beneficiary_code_map=doubled), str(tmp_path / "out"), APRIL
        )
    assert [r["short_code"] for r in read_csv(spark, refused.value.log).collect()] == ["IR00001"]


def test_orders_are_those_of_booked_items_in_any_period(spark, tmp_path):
    result = run_booking(source_tables(spark), str(tmp_path / "out"), details=True, every_month=True)
    booked = {r[0] for r in read_csv(spark, f"{result.out}/details/sc").collect()}
    assert {r[0] for r in read_csv(spark, f"{result.out}/details/oms").collect()} <= booked


def test_postings_out_of_balance_leave_the_earlier_ones(spark, tmp_path):
    out = str(tmp_path / "out")
    before = sorted(map(str, run_booking(source_tables(spark), out, APRIL).template.collect()))
    unlisted = [(*row[:4], 99999, None) for row in ROWS["ledger_map"]]
    with pytest.raises(NotBalanced) as stop:
        run_booking(source_tables(spark, ledger_map=unlisted), out, APRIL)
    assert read_csv(spark, stop.value.log).count() == 1
    assert sorted(map(str, spark.read.parquet(f"{out}/postings").collect())) == before
    rows = read_csv(spark, f"{out}/posting_template/booking_period=2018-04-01")
    assert rows.count() == len(before)


def test_a_run_leaves_no_intermediate_tables(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    run_booking(source_tables(spark), str(tmp_path / "out"), APRIL)
    assert not list(Path(shared).glob("_work-*")) and not list(tmp_path.glob("**/_work-*"))


def test_the_default_is_the_previous_month(spark, tmp_path):
    result = run_booking(source_tables(spark), str(tmp_path / "out"))
    assert result.counts["extracted"] == 0


def test_amounts_keep_all_their_digits(spark):
    values = [0.1, 30.0, -90.0, 1e-7, 0.00012345678901234567, 123456789012.34567, 1.5e15, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    printed = [r[0] for r in df.select(plain_number(F.col("amount"))).collect()]
    assert [float(p) for p in printed] == values
    assert printed[:3] == ["0.1", "30", "-90"] and not any("E" in p for p in printed)


def test_blanks_survive_in_logs(spark, tmp_path):
    write_csv(spark.createDataFrame([("  x ",)], "v string"), str(tmp_path / "log"))
    assert read_csv(spark, tmp_path / "log").first()["v"] == "  x "


def test_empty_input_gives_an_empty_template_with_heading(spark, tmp_path):
    result = run_booking(source_tables(spark, transaction=[]), str(tmp_path / "out"), APRIL)
    assert result.template.count() == 0
    assert result.counts["extracted"] == 0
    rejected = read_csv(spark, f"{result.out}/invalid_seller_rows")
    assert rejected.columns[0] == "error"
    assert rejected.count() == 0


def test_a_clean_run_replaces_the_logs_of_a_stopped_one(spark, tmp_path):
    out = str(tmp_path / "out")
    gaps = source_tables(spark, beneficiary_code_map=ROWS["beneficiary_code_map"][:1])
    with pytest.raises(MissingBeneficiaryCodes) as stop:
        run_booking(gaps, out, APRIL)
    assert read_csv(spark, stop.value.log).count() == 2
    run_booking(source_tables(spark), out, APRIL)
    assert read_csv(spark, stop.value.log).count() == 0


def test_period_bounds(spark):
    assert previous_month(spark, date(2018, 1, 15)) == Period.month(2017, 12)
    assert previous_month(spark, date(2018, 5, 1)) == APRIL
    assert Period.month(2017, 12).end == date(2018, 1, 1)
