"""Row rules as SQL expressions: one pass, no UDF, readable error texts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import fixed

# A check is the condition under which column {c} fails, and the message for it.
Check = tuple[str, str]

REQUIRED_TEXT: Check = ("{c} IS NULL OR {c} = ''", fixed.BLANK)
REQUIRED_NUMBER: Check = ("{c} IS NULL OR {c} = 0", fixed.BLANK)
REQUIRED_DATE: Check = ("{c} IS NULL", fixed.BLANK)


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def matches(pattern: str, message: str = fixed.WRONG_FORMAT) -> Check:
    # Braces are doubled for the later str.format of the column name.
    literal = _quoted(pattern).replace("{", "{{").replace("}", "}}")
    return (f"{{c}} <> '' AND NOT {{c}} RLIKE {literal}", message)


IS_INTEGER: Check = matches(fixed.INTEGER_FORMAT, fixed.NOT_AN_INTEGER)


def one_of(values: Iterable[str]) -> Check:
    allowed = ", ".join(_quoted(v) for v in values)
    return (f"{{c}} <> '' AND {{c}} NOT IN ({allowed})", fixed.NOT_ALLOWED)


@dataclass(frozen=True)
class Field:
    """Checks of one column, in order; the first that fails gives the message."""

    column: str
    checks: tuple[Check, ...]
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or self.column

    def failures(self) -> list[tuple[str, str]]:
        return [(bad.format(c=self.column), text) for bad, text in self.checks]

    def message(self) -> str:
        cases = [f"WHEN {bad} THEN '{self.name}: {text}'" for bad, text in self.failures()]
        return f"CASE {' '.join(cases)} END"


def error_text(fields: Iterable[Field]) -> Column:
    """``name: message; name: message.`` in name order, or NULL for a valid row."""
    ordered = sorted(fields, key=lambda f: f.name)
    joined = f"concat_ws('; ', {', '.join(f.message() for f in ordered)})"
    return F.expr(f"concat(nullif({joined}, ''), '.')")


def with_error(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    return df.withColumn("error", error_text(fields))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("error IS NULL").drop("error")


def invalid_rows(checked: DataFrame) -> DataFrame:
    return checked.where("error IS NOT NULL")
