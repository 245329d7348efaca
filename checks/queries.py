"""Every operator as a query over the derived source tables, whole tables, all months."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from tallybook import fixed
from tallybook.filesystem import FileSystem
from tallybook.functions.joins import first_per_key
from tallybook.functions.keys import LEDGER_KEY_PARTS
from tallybook.functions.periods import (
    Period,
    in_period,
    previous_month_end,
    previous_month_start,
)
from tallybook.functions.rules import invalid_rows, valid_rows
from tallybook.operators import counts, enrich, matching, postings, routing, uploads
from tallybook.operators.row_checks import (
    ITEM_PRICE_REJECT_COLUMNS,
    SELLER_REJECT_COLUMNS,
    check_item_price_rows,
    check_seller_rows,
)
from tallybook.sinks import files
from tallybook.sinks.files import write_csv
from tallybook.sources import maps, orders, seller
from tallybook.sources.readers import read_upload
from tallybook.sources.schemas import STAGED_COLUMNS
from tallybook.storage import work_folder

BOOKED_MONTH = Period.month(1996, 12)


def publish(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates as text, money as double."""
    shown = []
    for name, kind in df.dtypes:
        if kind == "date":
            shown.append(f"CAST({name} AS string) AS {name}")
        elif kind.startswith("decimal"):
            shown.append(f"CAST({name} AS double) AS {name}")
        elif kind == "int":
            shown.append(f"CAST({name} AS bigint) AS {name}")
        else:
            shown.append(name)
    return df.selectExpr(*shown)


class Booking:
    """The steps of a booking run as lazy DataFrames."""

    #: What makes the source tables; the benchmark takes written ones.
    sources_of = fixture.Sources

    def __init__(self, spark: SparkSession, sf_dir: str, period: Period | None = None) -> None:
        self.sources = self.sources_of(spark, sf_dir)
        self.view = self.sources.view
        self.period = period

    @cached_property
    def tables(self) -> Mapping[str, DataFrame]:
        return self.sources.source_tables()

    @cached_property
    def extract(self) -> DataFrame:
        return seller.seller_extract(self.tables, self.period)

    @cached_property
    def retail(self) -> DataFrame:
        return maps.read_retail_list(self.tables["retail_short_code"])

    @cached_property
    def ledger_map(self) -> DataFrame:
        return maps.read_ledger_map(self.tables["ledger_map"])

    @cached_property
    def beneficiary_map(self) -> DataFrame:
        return maps.read_beneficiary_map(self.tables["beneficiary_code_map"])

    @cached_property
    def no_retail(self) -> DataFrame:
        return seller.seller_extract(self.tables, self.period, self.retail)

    @cached_property
    def checked(self) -> DataFrame:
        return check_seller_rows(self.no_retail)

    @cached_property
    def sc(self) -> DataFrame:
        return valid_rows(self.checked).select(*STAGED_COLUMNS)

    @cached_property
    def item_ids(self) -> DataFrame:
        return matching.unique_item_ids(self.sc)

    @cached_property
    def oms(self) -> DataFrame:
        """Orders to match with. Of a period only those of its items are joined; of all periods all, as
        finding their ids would take all transactions through the extract once more."""
        return orders.order_extract(self.tables, None if self.period is None else self.item_ids)

    @cached_property
    def booked_oms(self) -> DataFrame:
        """The orders of the booked items."""
        return orders.order_extract(self.tables, self.item_ids, most=self.period is None)

    @cached_property
    def item_prices(self) -> DataFrame:
        return matching.match_orders(self.sc, self.oms)

    @cached_property
    def item_prices_checked(self) -> DataFrame:
        return check_item_price_rows(self.item_prices)

    @cached_property
    def item_prices_valid(self) -> DataFrame:
        return valid_rows(self.item_prices_checked)

    @cached_property
    def prices(self) -> DataFrame:
        return enrich.price_rows(self.item_prices_valid, self.ledger_map, self.beneficiary_map)

    @cached_property
    def booked(self) -> DataFrame:
        return postings.book(
            self.item_prices_valid, self.sc, self.ledger_map, self.beneficiary_map
        )

    @cached_property
    def booked_commissions(self) -> DataFrame:
        return postings.book_commissions(self.sc, self.beneficiary_map)


class FlatBooking(Booking):
    """The same from the joined source, which has no statements to check."""

    @cached_property
    def sc(self) -> DataFrame:
        rows = in_period(self.view("flat_raw"), "created_at", self.period)
        rows = rows.selectExpr("*", "trunc(created_at, 'MM') AS booking_period")
        return matching.without_retail(rows, self.retail).where(
            "id_supplier <> 0 AND transaction_value <> 0 AND oms_id_sales_order_item <> 0"
        ).select(*STAGED_COLUMNS)

    @cached_property
    def oms(self) -> DataFrame:
        return first_per_key(
            self.view("flat_orders"),
            "oms_id_sales_order_item",
            ["item_status", "payment_method", "shipment_provider_name", "paid_price"],
        )


def previous_month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month a run would book, for every day with transactions taken as its date."""
    transactions = fixture.Sources(spark, sf_dir).view("txn")
    days = transactions.select(F.to_date("created_at").alias("as_of"))
    return publish(
        days.distinct().select(
            "as_of",
            previous_month_start(F.col("as_of")).alias("period_start"),
            previous_month_end(F.col("as_of")).alias("period_end"),
        )
    )


def _step_counts(b: Booking) -> DataFrame:
    """The counts of a run, taken as a run takes them: while its tables are written.

    As nothing is booked, the tables hold only what later counts need.
    """
    spark = b.sources.spark
    seen = counts.StepCounts()
    with work_folder(spark, spark.conf.get("spark.sql.warehouse.dir")) as work:
        for name in ("ledger_map", "beneficiary_map"):
            setattr(b, name, seen.stage(getattr(b, name), f"{work}/{name}", counts.rows(name)))
        extracted = in_period(b.tables["transaction"], "created_at", b.period)
        seen["extracted"] = extracted.count()
        both = counts.checked_rows("without_retail", "seller_rows")
        kept = [c for c in STAGED_COLUMNS if c not in ("booking_period", "supplier_name", "comment")]
        b.checked = seen.stage(b.checked.select(*kept, "error"), f"{work}/seller_rows", both)
        b.sc = valid_rows(b.checked)
        lacking = matching.missing_beneficiary(b.sc, b.beneficiary_map)
        seen.stage(lacking, f"{work}/no_code", counts.rows("missing_beneficiary"))
        b.oms = seen.stage(b.booked_oms, f"{work}/orders", counts.rows("orders"))
        both = counts.checked_rows("item_prices", "item_prices")
        parts = b.item_prices_checked.select("ledger_map_key", *LEDGER_KEY_PARTS, "error")
        b.item_prices_checked = seen.stage(parts, f"{work}/item_prices", both)
        lacking = matching.missing_ledger_keys(b.item_prices_valid, b.ledger_map)
        seen.stage(lacking, f"{work}/no_ledger", counts.rows("missing_ledger_keys"))
    return spark.createDataFrame(list(seen.items()), "step string, rows bigint")


def _named(rows: DataFrame) -> DataFrame:
    """The printed template with the amount as a number again, which both engines print alike."""
    period, code, free, amount = (F.col(f"`{c}`") for c in rows.columns)
    return rows.select(
        period,
        code.alias("account_code"),
        free.alias("account_free"),
        amount.cast("double").alias("amount"),
    )


def _csv(kind: str, view: str) -> Callable[[Booking], DataFrame]:
    """The view written as CSV files, with a column whose values hold line breaks, and read as an upload."""

    def read(b: Booking) -> DataFrame:
        spark, columns = b.sources.spark, uploads.UPLOADS[kind].columns
        note = F.lit('first\nsecond, "third"').alias("note")
        line = F.col("row_no").cast("string").alias("line")
        path = scratch_folder(spark)
        write_csv(b.view(view).select(note, *columns, line), path)
        return read_upload(spark, path, ["line", *columns]).select("line", *columns)

    return read


def scratch_folder(spark: SparkSession) -> str:
    """A folder that all executors reach, deleted when the program ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/_scratch-{uuid.uuid4().hex}"
    files_there = FileSystem(spark, path)

    def clear() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before, with its folders
            files_there.delete(path)

    atexit.register(clear)
    return path


_VIEWS = {"benef_code_map": "beneficiary", "retail_supplier": "retail", "ledger_map": "ledger"}


def _upload_log(b: Booking) -> DataFrame:
    """What the error logs of the three uploads say, each row as one text."""
    logs = []
    for kind, view in _VIEWS.items():
        wrong = invalid_rows(_upload(kind, f"up_{view}")(b))
        text = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in uploads.UPLOADS[kind].columns])
        logs.append(wrong.select(F.lit(kind).alias("upload"), "error", text.alias("line")))
    return reduce(DataFrame.unionAll, logs)


def _upload_gate(b: Booking) -> DataFrame:
    """All or nothing: of a file with one invalid row nothing is stored."""
    out = []
    for kind, view in _VIEWS.items():
        for state in ("up", "ok"):
            invalid = F.count_if(F.col("error").isNotNull())
            counted = _upload(kind, f"{state}_{view}")(b).agg(
                F.count("*").alias("rows"), invalid.alias("invalid_rows"), (invalid == 0).alias("accepted")
            )
            out.append(counted.select(F.lit(f"{state}_{view}").alias("upload"), "*"))
    return reduce(DataFrame.unionAll, out)


def _gates(b: Booking) -> DataFrame:
    """What stops a run with incomplete maps: missing codes do, invalid rows don't."""
    sellers = matching.seller_gate_counts(b.checked, b.view("benef_gaps")).selectExpr(
        "stack(2, 'missing_beneficiary_codes', missing, missing > 0, 'invalid_seller_rows', invalid, false)"
        " AS (gate, rows, stops)"
    )
    ledger_map = maps.read_ledger_map(b.view("ledger_rows_gaps"))
    keys = matching.missing_ledger_keys(b.item_prices_valid, ledger_map)
    found = {
        "missing_ledger_keys": (keys, F.count("*") > 0),
        "invalid_item_price_rows": (invalid_rows(b.item_prices_checked), F.lit(False)),
    }
    counted = [
        df.agg(F.count("*").alias("rows"), stops.alias("stops")).select(F.lit(gate).alias("gate"), "*")
        for gate, (df, stops) in found.items()
    ]
    return reduce(DataFrame.unionAll, counted, sellers)


def _upload(kind: str, view: str) -> Callable[[Booking], DataFrame]:
    return lambda b: uploads.check_upload(b.view(view), uploads.UPLOADS[kind])


def _append(kind: str, rows: str, stored: str) -> Callable[[Booking], DataFrame]:
    return lambda b: uploads.plan_append(b.view(rows), b.view(stored), uploads.UPLOADS[kind])


STEPS: dict[str, Callable[[Booking], DataFrame]] = {
    "sc_extract": lambda b: b.extract,
    "oms_extract": lambda b: b.booked_oms,
    "ledger_map_read": lambda b: maps.read_ledger_map(b.view("ledger_rows_raw")),
    "beneficiary_map_read": lambda b: b.beneficiary_map,
    "retail_list_read": lambda b: b.retail,
    "ledger_map_key": lambda b: b.item_prices.select("oms_id_sales_order_item", "ledger_map_key"),
    "duplicate_map_keys": lambda b: maps.duplicate_keys(b.view("benef_doubled"), ["short_code"]),
    "retail_filter": lambda b: b.no_retail,
    "sc_valid": lambda b: valid_rows(b.checked),
    "sc_invalid": lambda b: invalid_rows(b.checked),
    "type_routing": lambda b: routing.route(b.sc),
    "bucket_comment": lambda b: routing.commented(routing.route(b.sc)),
    "unique_item_ids": lambda b: b.item_ids,
    "item_price_credit_oms": lambda b: routing.bucket(b.item_prices, "item_price_credit"),
    "item_price_oms": lambda b: routing.bucket(b.item_prices, "item_price"),
    "item_price_and_credit": lambda b: b.item_prices,
    "scoms_valid": lambda b: b.item_prices_valid,
    "scoms_invalid": lambda b: invalid_rows(b.item_prices_checked),
    "item_price_credit_valid": lambda b: routing.bucket(b.item_prices_valid, "item_price_credit"),
    "item_price_valid": lambda b: routing.bucket(b.item_prices_valid, "item_price"),
    "missing_beneficiary": lambda b: matching.missing_beneficiary(b.sc, b.view("benef_gaps")),
    "missing_ledger_key": lambda b: matching.missing_ledger_keys(
        b.item_prices_valid, maps.read_ledger_map(b.view("ledger_rows_gaps"))
    ),
    "ipc_final": lambda b: enrich.ipc_final(b.prices),
    "ipt_final": lambda b: enrich.ipt_final(b.prices),
    "commission_final": lambda b: enrich.commission_rows(b.sc, b.beneficiary_map),
    "voucher_ledger_amount": lambda b: postings.posting(b.booked, "voucher"),
    "ipc_paid_price_ledger_amount": lambda b: postings.posting(b.booked, "ipc_paid_price"),
    "ipt_paid_price_ledger_amount": lambda b: postings.posting(b.booked, "ipt_paid_price"),
    "commission_vat_ledger_amount": lambda b: postings.posting(
        b.booked_commissions, "commission_vat"
    ),
    "commission_revenue_ledger_amount": lambda b: postings.posting(
        b.booked_commissions, "commission_revenue"
    ),
    "total_ledger_amount": lambda b: postings.posting(b.booked, "total"),
    "posting_template": lambda b: postings.posting_template(b.booked),
    "zero_balance": lambda b: postings.balance(postings.posting_sums(b.booked)),
    "step_counts": _step_counts,
    # What the files of a run hold, before it is written as text.
    "rejected_seller_rows": lambda b: invalid_rows(b.checked).select(*SELLER_REJECT_COLUMNS),
    "rejected_item_price_rows": lambda b: invalid_rows(b.item_prices_checked).select(
        *ITEM_PRICE_REJECT_COLUMNS
    ),
    "missing_short_codes_log": lambda b: matching.missing_beneficiary(
        b.sc, b.view("benef_gaps")
    ).select("short_code"),
    "missing_ledger_keys_log": lambda b: files.with_empty_codes(
        matching.missing_ledger_keys(
            b.item_prices_valid, maps.read_ledger_map(b.view("ledger_rows_gaps"))
        )
    ),
    "template_rows": lambda b: _named(files.template_rows(postings.posting_template(b.booked))),
    "upload_beneficiary": _upload("benef_code_map", "up_beneficiary"),
    "upload_retail": _upload("retail_supplier", "up_retail"),
    "upload_ledger_map": _upload("ledger_map", "up_ledger"),
    "append_beneficiary": _append("benef_code_map", "ok_beneficiary", "benef"),
    "append_retail": _append("retail_supplier", "ok_retail", "retail"),
    "append_ledger_map": _append("ledger_map", "ok_ledger", "ledger_rows_gaps"),
    "csv_beneficiary": _csv("benef_code_map", "up_beneficiary"),
    "csv_retail": _csv("retail_supplier", "up_retail"),
    "csv_ledger_map": _csv("ledger_map", "up_ledger"),
    "upload_log": _upload_log,
    "upload_gate": _upload_gate,
    "run_gates": _gates,
    "export_ipc_final": lambda b: enrich.ipc_final(b.prices).select(*files.PRICE_EXPORT),
    "export_ipt_final": lambda b: enrich.ipt_final(b.prices).select(*files.PRICE_EXPORT),
    "shipped_ledger_keys": lambda b: orders.shipped_ledger_keys(b.tables, b.item_ids),
} | {
    f"bucket_{name}": (lambda b, name=name: routing.bucket(b.sc, name)) for name in fixed.BUCKETS
}


def _whole(step: Callable[[Booking], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: publish(step(Booking(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _whole(step) for name, step in STEPS.items()
} | {
    "previous_month_window": previous_month_window,
    # A booking month is a feature of the extract; these two book a single one.
    "sc_extract_month": lambda spark, sf_dir: publish(
        Booking(spark, sf_dir, BOOKED_MONTH).extract
    ),
    "posting_template_month": lambda spark, sf_dir: publish(
        postings.posting_template(Booking(spark, sf_dir, BOOKED_MONTH).booked)
    ),
    "posting_template_flat": lambda spark, sf_dir: publish(
        postings.posting_template(FlatBooking(spark, sf_dir).booked)
    ),
}

