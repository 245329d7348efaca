"""Booking month after month into one place, and runs that are killed on the way."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from tallybook.filesystem import FileSystem
from tallybook.functions.periods import Period
from tallybook.operators import routing
from tallybook.plans import booking
from tallybook.plans.booking import run_booking
from tallybook.sinks import files, publication
from tests.tables import ROWS, source_tables, transaction
from tests.test_scale import plan_of

MARCH, APRIL, MAY = (Period.month(2018, month) for month in (3, 4, 5))
MAY_ROWS = [
    transaction(20, "60", 17, 11, at=datetime(2018, 5, 3)),
    transaction(21, "-10.9", 78, 11, at=datetime(2018, 5, 31, 23, 59)),
]


def lines(spark, out, month=None):
    rows = spark.read.parquet(f"{out}/postings").collect()
    return sorted(str(r) for r in rows if month is None or r["booking_period"] == month)


def template_bytes(out, month):
    (file,) = (p for p in (out / "posting_template" / f"booking_period={month}").iterdir() if p.suffix == ".csv")
    return file.name, file.read_bytes()


def months(out, table):
    return sorted(p.name.removeprefix("booking_period=") for p in (out / table).iterdir() if "=" in p.name)


def test_months_are_booked_one_after_the_other_into_one_place(spark, tmp_path):
    out = tmp_path / "out"
    tables = source_tables(spark, transaction=[*ROWS["transaction"], *MAY_ROWS])
    run_booking(tables, str(out), APRIL)
    april, april_file = lines(spark, out), template_bytes(out, "2018-04-01")
    result = run_booking(tables, str(out), MAY)
    assert months(out, "postings") == months(out, "posting_template") == ["2018-04-01", "2018-05-01"]
    assert lines(spark, out, date(2018, 4, 1)) == april
    assert template_bytes(out, "2018-04-01") == april_file
    may, may_file = lines(spark, out, date(2018, 5, 1)), template_bytes(out, "2018-05-01")
    assert sorted(map(str, result.template.collect())) == may != []

    more = source_tables(spark, transaction=[*ROWS["transaction"], *MAY_ROWS, transaction(30, "7", 17, 11)])
    run_booking(more, str(out), APRIL)
    assert lines(spark, out, date(2018, 4, 1)) != april
    assert template_bytes(out, "2018-04-01") != april_file
    assert lines(spark, out, date(2018, 5, 1)) == may
    assert template_bytes(out, "2018-05-01") == may_file


def test_a_month_without_rows_any_more_is_emptied(spark, tmp_path):
    out = tmp_path / "out"
    run_booking(source_tables(spark), str(out), APRIL)
    gone = source_tables(spark, transaction=[r for r in ROWS["transaction"] if r[3].month != 4])
    run_booking(gone, str(out), APRIL)
    assert months(out, "postings") == []
    assert template_bytes(out, "2018-04-01") == ("posting_template.csv", b"Account Code,Account Free,Amount\n")


def test_booking_all_months_replaces_all(spark, tmp_path):
    out = tmp_path / "out"
    run_booking(source_tables(spark), str(out), every_month=True)
    assert months(out, "postings") == ["2018-03-01", "2018-04-01", "2018-05-01"]
    run_booking(source_tables(spark, transaction=MAY_ROWS), str(out), every_month=True)
    assert months(out, "postings") == months(out, "posting_template") == ["2018-05-01"]


def test_the_template_is_one_file_in_the_order_of_the_postings(spark, tmp_path):
    out = tmp_path / "out"
    run_booking(source_tables(spark), str(out), APRIL)
    name, content = template_bytes(out, "2018-04-01")
    assert name == "posting_template.csv"
    assert content.decode().replace('""', "").splitlines() == [
        "Account Code,Account Free,Amount",
        "62002,,30",
        "13004,4000000001,110",
        "94001,,-90",
        "32021,,10.8",
        "62001,3000000001,100",
        "62001,3000000002,20",
        "31002,3000000001,-259",
        "31002,3000000002,78.2",
    ]


def test_parts_of_a_large_month_are_joined_in_order(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "DATE'2018-04-01' AS booking_period", "'total' AS posting", "31002L AS account_code", "id AS account_free", "CAST(id AS double) AS amount"
    )
    size = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files.write_template(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", size)
    (file,) = (p for p in (tmp_path / "t" / "booking_period=2018-04-01").iterdir() if p.suffix == ".csv")
    assert file.read_text() == "Account Code,Account Free,Amount\n" + "".join(f"31002,{i},{i}\n" for i in range(40_000))
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["booking_period=2018-04-01"]


class Killed(BaseException):
    pass


@pytest.mark.parametrize("at", ["write_template", "write_categories", "commit"])
def test_a_run_killed_before_it_is_ready_leaves_the_earlier_results(spark, tmp_path, monkeypatch, at):
    out = tmp_path / "out"
    run_booking(source_tables(spark), str(out), APRIL, details=True)
    before = lines(spark, out), template_bytes(out, "2018-04-01"), sorted((out / "details").rglob("*.csv"))

    def killed(*args, **kwargs):
        raise Killed

    monkeypatch.setattr(publication.Publication if at == "commit" else files, at, killed)
    with pytest.raises(Killed):
        run_booking(source_tables(spark, transaction=ROWS["transaction"][:1]), str(out), APRIL, details=True)
    assert (lines(spark, out), template_bytes(out, "2018-04-01"), sorted((out / "details").rglob("*.csv"))) == before
    assert not [p for p in out.iterdir() if p.name.startswith(("_new-", "_ready"))]


@pytest.mark.parametrize("moves", range(4))
def test_a_run_killed_while_it_publishes_is_finished_by_the_next(spark, tmp_path, monkeypatch, moves):
    out, other = tmp_path / "out", tmp_path / "other"
    run_booking(source_tables(spark), str(out), APRIL, details=True)
    changed = source_tables(spark, transaction=ROWS["transaction"][:1])
    run_booking(changed, str(other), APRIL, details=True)
    left, move = [moves], FileSystem.move

    def killed(self, source, target):
        if "_ready" in source:
            if not left[0]:
                raise Killed
            left[0] -= 1
        return move(self, source, target)

    monkeypatch.setattr(FileSystem, "move", killed)
    if moves < 3:
        with pytest.raises(Killed):
            run_booking(changed, str(out), APRIL, details=True)
        monkeypatch.undo()
        publication.recover(spark, str(out))
    else:
        run_booking(changed, str(out), APRIL, details=True)
    assert lines(spark, out) == lines(spark, other)
    assert template_bytes(out, "2018-04-01") == template_bytes(other, "2018-04-01")
    assert not (out / "_ready").exists()


def test_details_hold_all_categories_from_one_pass(spark, tmp_path):
    result = run_booking(source_tables(spark), str(tmp_path / "out"), APRIL, details=True)
    written = spark.read.parquet(f"{result.out}/details/categories")
    sc = spark.read.option("header", True).csv(f"{result.out}/details/sc")
    assert written.count() == sc.count() == 8
    prices = routing.category(written, "item_price_credit")
    assert sorted(r["oms_id_sales_order_item"] for r in prices.collect()) == [11, 12, 14, 15]
    assert [r["comment"] for r in routing.category(written, "item_price_credit", commented=True).collect()] == ["x"]
    assert routing.category(written, "storage_fee").count() == 1
    assert "bucket" not in prices.columns
    scan = next(x for x in plan_of(routing.category(written, "item_price", commented=True)).splitlines() if "FileScan" in x)
    assert "bucket" in scan.split("PartitionFilters")[1] and "commented" in scan.split("PartitionFilters")[1]


def test_counts_need_no_second_read(spark, tmp_path, monkeypatch):
    """Counts come from the writes: no written table is only counted afterwards."""
    read = []
    monkeypatch.setattr(booking, "stage", lambda df, path, *by, s=booking.stage: read.append(path) or s(df, path, *by))
    result = run_booking(source_tables(spark), str(tmp_path / "out"), APRIL)
    assert sorted(p.rsplit("/", 1)[1] for p in read) == ["balance", "sums"]
    assert result.counts["seller_rows_valid"] == 8 and result.counts["posting_lines"] == 8


def test_only_one_claims_a_place(spark, tmp_path):
    fs = FileSystem(spark, str(tmp_path))
    for name in "abcd":
        fs.make(f"{tmp_path}/{name}")
        fs.write_text(f"{tmp_path}/{name}/who", name)
    assert fs.claim(f"{tmp_path}/a", f"{tmp_path}/place one")
    assert not fs.claim(f"{tmp_path}/b", f"{tmp_path}/place one")
    assert fs.read_text(f"{tmp_path}/place one/who") == "a" and fs.exists(f"{tmp_path}/b")
    assert fs._renamed(f"{tmp_path}/c", f"{tmp_path}/two")
    assert not fs._renamed(f"{tmp_path}/d", f"{tmp_path}/two")
    assert fs.read_text(f"{tmp_path}/two/who") == "c"
    assert fs.names(f"{tmp_path}/none") == []
