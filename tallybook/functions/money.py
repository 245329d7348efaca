"""Money types and the commission split, as SQL expressions."""

from __future__ import annotations

from tallybook import fixed

MONEY = "decimal(18,4)"
# Wide enough for a sum over any number of rows, and exact, so order never matters.
MONEY_SUM = "decimal(38,4)"


def money_sum(expression: str, name: str) -> str:
    return f"CAST(sum({expression}) AS {MONEY_SUM}) AS {name}"


def commission_revenue(value: str) -> str:
    """Net commission of a gross value; linear, so it also applies to a sum of values."""
    return f"CAST({value} AS double) * -1 * {fixed.NET_PERCENT} / {fixed.GROSS_PERCENT}"


def commission_vat(value: str) -> str:
    return f"{commission_revenue(value)} * {fixed.VAT_RATE}D"
