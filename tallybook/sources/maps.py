"""Reference maps: ledger codes, beneficiary codes and retail sellers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.keys import MAP_KEY
from tallybook.sinks.files import write_csv
from tallybook.storage import stage


class DuplicateKeys(ValueError):
    """A reference map that would book some rows twice; ``log`` lists every doubled key."""

    def __init__(self, reason: str, log: str) -> None:
        super().__init__(f"{reason}, see {log}")
        self.log = log


def read_ledger_map(ledger_map: DataFrame) -> DataFrame:
    return ledger_map.selectExpr(f"{MAP_KEY} AS ledger_map_key", "ledger", "subledger")


def read_beneficiary_map(beneficiary_code_map: DataFrame) -> DataFrame:
    return beneficiary_code_map.select("short_code", "beneficiary_code")


def read_retail_list(retail_short_code: DataFrame) -> DataFrame:
    return retail_short_code.select("short_code")


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL keys match nothing."""
    counted = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.where("rows > 1")


def checked_map(
    df: DataFrame,
    keys: Iterable[str],
    path: str,
    log: str,
    name: str = "map",
    write: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """The rows of a map that can match, written once to ``path`` and checked there.

    What is checked is what later steps join, even if the store changes meanwhile. All doubled
    keys go to ``log``, and the map is refused if there are any. Rows with a NULL key match
    nothing and are left out. Whether the map is broadcast is Spark's choice, by its size.
    """
    keys = list(keys)
    staged = write(df.dropna(subset=keys), path)
    write_csv(duplicate_keys(staged, keys), log)
    doubled = staged.sparkSession.read.option("header", True).csv(log)
    if not doubled.isEmpty():
        raise DuplicateKeys(f"{name}: several rows for one key", log)
    return staged
