"""Money as whole cents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Below this size the product of two amounts fits a bigint.
_SMALL = 2 ** 31 - 1


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def from_cents(amount: Column) -> Column:
    return amount.cast("double") / F.lit(100.0)


def proportion(part: Column, whole: Column, of: Column) -> Column:
    """part * of / whole in whole cents, toward zero; NULL when whole is 0.

    The product of two large amounts leaves the bigint range, so those go
    through decimals; everyday amounts stay with plain integers.
    """
    divisor = F.nullif(whole, F.lit(0).cast("bigint"))
    small = (F.abs(part) <= _SMALL) & (F.abs(of) <= _SMALL)
    exact = F.call_function(
        "div", part.cast("decimal(19,0)") * of.cast("decimal(19,0)"),
        divisor.cast("decimal(19,0)"))
    return F.when(small, F.call_function("div", part * of, divisor)).otherwise(exact)
