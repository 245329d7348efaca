"""General-ledger postings and the zero-balanced template.

Postings are sums, and every step up to them is linear. So matched rows are summed per ledger
key and seller before the map joins: a hot seller or category shrinks to a few rows inside each
task before any shuffle, and the maps meet sums per seller instead of all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import fixed
from tallybook.functions.keys import BOOKING_KEY, LEDGER_KEY_PARTS
from tallybook.functions.money import MONEY_SUM, commission_revenue, commission_vat, money_sum
from tallybook.operators.enrich import SIGN
from tallybook.operators.routing import commission_type_rows

LINE_KEY = ("booking_period", "posting", "account_code", "account_free")
BOOKED = (
    "booking_period",
    "kind",
    "ledger",
    "subledger",
    "beneficiary_code",
    "value",
    "paid",
)


def _with_codes(sums: DataFrame, ledger_map: DataFrame, beneficiary_map: DataFrame) -> DataFrame:
    return (
        sums.selectExpr("*", f"{BOOKING_KEY} AS ledger_map_key")
        .join(ledger_map, "ledger_map_key", "left")
        .join(beneficiary_map, "short_code", "left")
        .select(*BOOKED)
    )


def book_item_prices(
    valid_item_prices: DataFrame, ledger_map: DataFrame, beneficiary_map: DataFrame
) -> DataFrame:
    """Matched and checked item prices, summed per month, kind, account and seller."""
    rows = valid_item_prices.withColumnRenamed("id_transaction_type", "kind")
    sums = rows.groupBy("booking_period", "kind", *LEDGER_KEY_PARTS, "short_code").agg(
        F.expr(money_sum("transaction_value", "value")),
        F.expr(money_sum(f"CAST({SIGN.format('kind')} * paid_price AS {MONEY_SUM})", "paid")),
    )
    return _with_codes(sums, ledger_map, beneficiary_map)


def book_commissions(sc: DataFrame, beneficiary_map: DataFrame) -> DataFrame:
    """Commissions, summed per month and seller; they need no order data."""
    sums = (
        commission_type_rows(sc)
        .groupBy("booking_period", "short_code")
        .agg(F.expr(money_sum("transaction_value", "value")))
    )
    return sums.join(beneficiary_map, "short_code", "left").selectExpr(
        "booking_period",
        "CAST(NULL AS bigint) AS kind",
        "CAST(NULL AS bigint) AS ledger",
        "CAST(NULL AS bigint) AS subledger",
        "beneficiary_code",
        "value",
        f"CAST(0 AS {MONEY_SUM}) AS paid",
    )


def book(
    valid_item_prices: DataFrame,
    sc: DataFrame,
    ledger_map: DataFrame,
    beneficiary_map: DataFrame,
) -> DataFrame:
    """Everything the postings need, summed per month, kind, account and seller."""
    prices = book_item_prices(valid_item_prices, ledger_map, beneficiary_map)
    return prices.unionByName(book_commissions(sc, beneficiary_map))


@dataclass(frozen=True)
class Line:
    """How a booked sum becomes a posting line: which sums, which account, which money."""

    applies: str
    account_code: str
    account_free: str
    goods: str = "0"
    commission: str = "0"


_BY_SUBLEDGER = f"ledger IN ({', '.join(map(str, fixed.LEDGERS_BOOKED_BY_SUBLEDGER))})"

# Voucher and paid price of an item price add up to its value, hence the goods of "total".
LINES = {
    "voucher": Line("kind IS NOT NULL", str(fixed.VOUCHER_ACCOUNT), "NULL", "value - paid"),
    "ipc_paid_price": Line(
        f"kind = {fixed.ITEM_PRICE_CREDIT} AND {_BY_SUBLEDGER}", "ledger", "subledger", "paid"
    ),
    "ipt_paid_price": Line(
        f"kind = {fixed.ITEM_PRICE} AND {_BY_SUBLEDGER}", "ledger", "subledger", "paid"
    ),
    "commission_vat": Line(
        "kind IS NULL", str(fixed.COMMISSION_VAT_ACCOUNT), "NULL", commission="value"
    ),
    "commission_revenue": Line(
        "kind IS NULL",
        str(fixed.COMMISSION_REVENUE_ACCOUNT),
        "beneficiary_code",
        commission="value",
    ),
    "total": Line(
        "true",
        str(fixed.SELLER_ACCOUNT),
        "beneficiary_code",
        "CASE WHEN kind IS NOT NULL THEN value ELSE 0 END",
        "CASE WHEN kind IS NULL THEN value ELSE 0 END",
    ),
}
POSTINGS = tuple(LINES)


def _columns(posting: str) -> list[str]:
    line = LINES[posting]
    return [
        f"'{posting}' AS posting",
        f"CAST({line.account_code} AS bigint) AS account_code",
        f"CAST({line.account_free} AS bigint) AS account_free",
        f"CAST({line.goods} AS {MONEY_SUM}) AS goods",
        f"CAST({line.commission} AS {MONEY_SUM}) AS commission",
    ]


# Money is summed as exact decimals; the commission factors apply to the sums.
_AMOUNT = f"""
    CASE posting
        WHEN 'commission_vat' THEN {commission_vat('commission')}
        WHEN 'commission_revenue' THEN {commission_revenue('commission')}
        WHEN 'total' THEN (CAST(goods AS double) + {commission_revenue('commission')}
                           + {commission_vat('commission')}) * -1
        ELSE CAST(goods AS double) END"""


def _sum_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*LINE_KEY).agg(
        F.expr(money_sum("goods", "goods")), F.expr(money_sum("commission", "commission"))
    )


def amounts(sums: DataFrame) -> DataFrame:
    """The posting lines of exact sums, with the commission factors applied."""
    return sums.selectExpr(*LINE_KEY, f"{_AMOUNT} AS amount")


def posting(booked: DataFrame, name: str) -> DataFrame:
    """Lines of one posting."""
    lines = booked.where(LINES[name].applies).selectExpr("booking_period", *_columns(name))
    return amounts(_sum_lines(lines)).drop("posting")


def posting_sums(booked: DataFrame) -> DataFrame:
    """All six postings in one pass, as exact sums: each booked sum becomes up to four lines."""
    lines = ", ".join(
        f"CASE WHEN {line.applies} THEN struct({', '.join(_columns(name))}) END"
        for name, line in LINES.items()
    )
    return _sum_lines(booked.selectExpr("booking_period", f"inline(array_compact(array({lines})))"))


def posting_template(booked: DataFrame) -> DataFrame:
    return amounts(posting_sums(booked))


def balance(sums: DataFrame) -> DataFrame:
    """Per month: do the postings sum to zero?

    Checked on the exact sums, so a single wrong cent shows in any turnover: the goods of all
    other postings are those of the sellers' total, and VAT, revenue and total rest on the same
    commission. The doubles made from them differ from that by their last digits only.
    """
    def of(column: str, posting: str) -> str:
        return f"coalesce(sum({column}) FILTER (WHERE posting = '{posting}'), 0)"

    goods = "coalesce(sum(goods) FILTER (WHERE posting <> 'total'), 0)"
    base = of("commission", "total")
    return sums.groupBy("booking_period").agg(
        F.count("*").alias("lines"),
        F.expr(
            f"{goods} = {of('goods', 'total')} AND {of('commission', 'commission_vat')} = {base} "
            f"AND {of('commission', 'commission_revenue')} = {base}"
        ).alias("balanced"),
    )
