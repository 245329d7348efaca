"""A booking run: sources in, postings and reject files out.

Each table that several later steps read is written once to the shared folder and read
back: a lost executor costs the tasks it ran, not the joins before them, and every later
step reads only the columns and rows it needs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.periods import Period, in_period, previous_month
from tallybook.functions.rules import invalid_rows, valid_rows
from tallybook.operators import enrich, matching, postings, routing
from tallybook.operators.counts import StepCounts, checked_rows, rows
from tallybook.operators.gates import MissingBeneficiaryCodes, MissingLedgerKeys, NotBalanced
from tallybook.operators.row_checks import (
    ITEM_PRICE_REJECT_COLUMNS,
    SELLER_REJECT_COLUMNS,
    check_item_price_rows,
    check_seller_rows,
)
from tallybook.sinks import files
from tallybook.sinks.publication import Publication, publication
from tallybook.sources import maps
from tallybook.sources.orders import order_extract
from tallybook.sources.schemas import STAGED_COLUMNS
from tallybook.sources.seller import seller_extract
from tallybook.storage import stage, work_folder

REJECTED_SELLER_ROWS = "invalid_seller_rows"
REJECTED_ITEM_PRICES = "invalid_item_price_rows"
MISSING_SHORT_CODES = "missing_beneficiary_codes"
MISSING_KEYS = "missing_ledger_keys"
DOUBLED_KEYS = "doubled_map_keys"
BALANCE = "unbalanced_months"
POSTINGS = "postings"
TEMPLATE = "posting_template"
DETAILS = "details"


@dataclass(frozen=True)
class BookingResult:
    """Where the results lie, and what each step counted."""

    template: DataFrame
    out: str
    counts: Mapping[str, int] = field(default_factory=dict)


def run_booking(
    tables: Mapping[str, DataFrame],
    out: str,
    period: Period | None = None,
    details: bool = False,
    every_month: bool = False,
) -> BookingResult:
    """Book one period: by default the calendar month before today's, or with ``every_month``
    each month there is, at once.

    ``tables`` are the source tables and maps by name. Invalid rows go to their reject file
    and the run continues; a doubled map key, a seller without beneficiary code or a missing
    ledger key is logged and stops the run, and so do postings that do not sum to zero. Each
    log is written in every run, with only its heading if there is nothing to tell, so none is
    left over from an earlier run. ``details`` also exports the row-level tables.

    Postings, template and details are published together by a run that got that far. A run
    replaces the months it booked, also those that have no postings any more, and leaves the other
    months that lie in ``out``. The template is one file for each month, in the order of the postings.
    """
    spark = tables["transaction"].sparkSession
    if period is None and not every_month:
        period = previous_month(spark, date.today())
    with work_folder(spark, out) as work, publication(spark, out) as new:
        return _book(tables, out, None if every_month else period, details, work, new)


def _book(
    tables: Mapping[str, DataFrame],
    out: str,
    period: Period | None,
    details: bool,
    work: str,
    new: Publication,
) -> BookingResult:
    counts = StepCounts()

    ledger_map = maps.checked_map(
        maps.read_ledger_map(tables["ledger_map"]),
        ["ledger_map_key"],
        f"{work}/ledger_map",
        f"{out}/{DOUBLED_KEYS}/ledger_map",
        "ledger map",
        lambda df, path: counts.stage(df, path, rows("ledger_map")),
    )
    beneficiary_map = maps.checked_map(
        maps.read_beneficiary_map(tables["beneficiary_code_map"]),
        ["short_code"],
        f"{work}/beneficiary_map",
        f"{out}/{DOUBLED_KEYS}/beneficiary_code_map",
        "beneficiary map",
        lambda df, path: counts.stage(df, path, rows("beneficiary_map")),
    )
    retail = maps.read_retail_list(tables["retail_short_code"])

    # Seller rows. Those of retail sellers are gone before the joins, so all are counted at the source.
    counts["extracted"] = in_period(tables["transaction"], "created_at", period).count()
    checked = counts.stage(
        check_seller_rows(seller_extract(tables, period, retail)),
        f"{work}/seller_rows",
        checked_rows("without_retail", "seller_rows"),
    )
    files.write_csv(invalid_rows(checked), f"{out}/{REJECTED_SELLER_ROWS}", SELLER_REJECT_COLUMNS)
    sc = valid_rows(checked).select(*STAGED_COLUMNS)

    # Every seller needs a beneficiary code.
    missing = counts.stage(
        matching.missing_beneficiary(sc, beneficiary_map),
        f"{work}/no_code",
        rows("missing_beneficiary"),
    )
    log = f"{out}/{MISSING_SHORT_CODES}"
    files.write_missing_short_codes(missing, log)
    if counts["missing_beneficiary"]:
        raise MissingBeneficiaryCodes("sellers without beneficiary code", log)

    # Item prices with their orders.
    ids = matching.unique_item_ids(sc)
    oms = counts.stage(
        order_extract(tables, ids, most=period is None), f"{work}/orders", rows("orders")
    )
    checked_prices = counts.stage(
        check_item_price_rows(matching.match_orders(sc, oms)),
        f"{work}/item_prices",
        checked_rows("item_prices", "item_prices"),
    )
    files.write_csv(
        invalid_rows(checked_prices), f"{out}/{REJECTED_ITEM_PRICES}", ITEM_PRICE_REJECT_COLUMNS
    )
    item_prices = valid_rows(checked_prices)

    # Every item price needs a ledger.
    lacking = counts.stage(
        matching.missing_ledger_keys(item_prices, ledger_map),
        f"{work}/no_ledger",
        rows("missing_ledger_keys"),
    )
    log = f"{out}/{MISSING_KEYS}"
    files.write_missing_ledger_keys(lacking, log)
    if counts["missing_ledger_keys"]:
        raise MissingLedgerKeys("item prices without ledger", log)

    # Postings: checked on the written sums, then published.
    booked = postings.book(item_prices, sc, ledger_map, beneficiary_map)
    sums = stage(postings.posting_sums(booked), f"{work}/sums")
    balances = stage(postings.balance(sums), f"{work}/balance")
    log = f"{out}/{BALANCE}"
    files.write_csv(balances.where("NOT balanced"), log)
    if not balances.where("NOT balanced").isEmpty():
        raise NotBalanced("postings do not sum to zero", log)
    template = counts.stage(
        postings.amounts(sums), new.path(POSTINGS), rows("posting_lines"), "booking_period"
    )
    months = None if period is None else period.months()
    files.write_template(template, new.path(TEMPLATE), months or ())
    if details:
        prices = enrich.price_rows(item_prices, ledger_map, beneficiary_map)
        _write_details(
            new.path(DETAILS),
            sc,
            oms,
            checked_prices.drop("error"),
            item_prices,
            stage(prices, f"{work}/prices"),
            enrich.commission_rows(sc, beneficiary_map),
            template,
        )
        new.replace_table(DETAILS)
    booked_months = None if months is None else [str(month) for month in months]
    new.replace_months(POSTINGS, booked_months)
    new.replace_months(TEMPLATE, booked_months)
    new.commit()

    published = template.sparkSession.read.schema(template.schema).parquet(f"{out}/{POSTINGS}")
    if months is not None:
        published = published.where(F.col("booking_period").isin(months))
    return BookingResult(published, out, dict(counts))


def _write_details(
    folder: str,
    sc: DataFrame,
    oms: DataFrame,
    matched: DataFrame,
    item_prices: DataFrame,
    prices: DataFrame,
    commissions: DataFrame,
    template: DataFrame,
) -> None:
    """Row-level tables and single postings as files, for checks by hand."""
    files.write_categories(routing.route(sc), f"{folder}/{files.CATEGORIES}")
    files.write_ids(sc, f"{folder}/sc")
    files.write_ids(oms, f"{folder}/oms")
    for kind in ("item_price_credit", "item_price"):
        files.write_ids(routing.bucket(matched, kind), f"{folder}/{kind}_oms")
        files.write_ids(routing.bucket(item_prices, kind), f"{folder}/{kind}_valid")
    files.write_csv(enrich.ipc_final(prices), f"{folder}/ipc_final", files.PRICE_EXPORT)
    files.write_csv(enrich.ipt_final(prices), f"{folder}/ipt_final", files.PRICE_EXPORT)
    files.write_csv(commissions, f"{folder}/commission_final", files.COMMISSION_EXPORT)
    for name in postings.POSTINGS:
        files.write_template(template.where(F.col("posting") == name), f"{folder}/{name}")
