"""Result files. Each step has its own folder, which a new run replaces."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import fixed
from tallybook.filesystem import FileSystem
from tallybook.operators.enrich import COMMISSION_COLUMNS, PRICE_COLUMNS
from tallybook.operators.postings import POSTINGS

# The detail exports are the row-level results of one month and one price type each.
PRICE_EXPORT = [c for c in PRICE_COLUMNS if c not in ("booking_period", "id_transaction_type")]
COMMISSION_EXPORT = [c for c in COMMISSION_COLUMNS if c != "booking_period"]

TEMPLATE_FILE = "posting_template.csv"
CATEGORIES = "categories"


def write_csv(
    df: DataFrame,
    path: str,
    columns: Iterable[str] | None = None,
    by: Iterable[str] = (),
    header: bool = True,
) -> None:
    """All rows, by default with a header, also when there are none. Blanks stay as they are."""
    rows = df.select(*columns) if columns else df
    writer = rows.write.mode("overwrite").partitionBy(*by).option("header", header)
    writer.option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def plain_number(amount: Column) -> Column:
    """All digits of a double, without exponent and without trailing zeros.

    A double has at most 17 digits, so a large one has few after the point and a small one few
    zeros before them: one of the two decimals holds it whole.
    """
    text = amount.cast("string")
    digits = (
        F.when(text.contains("E-"), amount.cast("decimal(38,37)").cast("string"))
        .when(text.contains("E"), amount.cast("decimal(38,10)").cast("string"))
        .otherwise(text)
    )
    return F.regexp_replace(F.regexp_replace(digits, r"(\.[0-9]*?)0+\z", "$1"), r"\.\z", "")


def template_rows(template: DataFrame) -> DataFrame:
    """The template as text under its printed heading, an empty text for no value.

    Months follow each other, and in a month the postings, in the order in which they are
    defined; only their place tells apart two lines of one account.
    """
    place = F.array_position(F.array(*[F.lit(name) for name in POSTINGS]), F.col("posting"))
    template = template.orderBy("booking_period", place, "account_code", "account_free")
    values = (
        F.col("account_code").cast("string"),
        F.col("account_free").cast("string"),
        plain_number(F.col("amount")),
    )
    return template.select(
        "booking_period",
        *[
            F.coalesce(value, F.lit("")).alias(title)
            for value, title in zip(values, fixed.TEMPLATE_HEADER, strict=True)
        ],
    )


def _part_number(name: str) -> tuple[int, str]:
    """Parts of one sorted write in their order: part-00012-..., of which one may be cut in several."""
    return int(name.split("-")[1]), name


def write_template(template: DataFrame, path: str, months: Iterable[date] = ()) -> None:
    """One folder per booking month with one file, in the order of ``template_rows``.

    Tasks write the sorted rows as parts, and the parts of a month are joined byte by byte under one
    heading. ``months`` get a file, with the heading alone, also when they have no rows.
    """
    parts, files = f"{path}/_parts", FileSystem(template.sparkSession, path)
    write_csv(template_rows(template), parts, by=["booking_period"], header=False)
    written = [name for name in files.names(parts) if name.startswith("booking_period=")]
    for name in sorted({*written, *(f"booking_period={month}" for month in months)}):
        inside = [n for n in files.names(f"{parts}/{name}") if n.startswith("part-")]
        files.make(f"{path}/{name}")
        files.join(
            [f"{parts}/{name}/{part}" for part in sorted(inside, key=_part_number)],
            f"{path}/{name}/{TEMPLATE_FILE}",
            ",".join(fixed.TEMPLATE_HEADER) + "\n",
        )
    files.delete(parts)


def write_categories(routed: DataFrame, path: str) -> None:
    """All category tables by one pass: a folder for each category, and in it one for commented rows.

    Rows are dealt by category before they are written, so that each has few files; Spark splits a large
    category over many tasks and merges small ones.
    """
    rows = routed.withColumn("commented", F.col("comment").isNotNull().cast("int"))
    by = ["bucket", "commented"]
    rows.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_ids(df: DataFrame, path: str) -> None:
    write_csv(df, path, ["oms_id_sales_order_item"])


def with_empty_codes(missing: DataFrame) -> DataFrame:
    """The missing keys with empty codes, ready to be filled in."""
    zero = F.lit(0).cast("bigint")
    return missing.withColumn("ledger", zero).withColumn("subledger", zero)


def write_missing_ledger_keys(missing: DataFrame, path: str) -> None:
    write_csv(with_empty_codes(missing), path)


def write_missing_short_codes(missing: DataFrame, path: str) -> None:
    write_csv(missing, path, ["short_code"])
