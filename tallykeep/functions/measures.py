"""Money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A double amount of whole cents is this close to them, up to some 10 billion.
CENT_TOLERANCE = 1e-4


def _refuse(value: Column, what: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what}: not a whole number of units: "), value.cast("string")))


def whole(value: Column, name: str) -> Column:
    """A whole number as BIGINT; a fraction is an error, as sums would silently differ."""
    return F.when(value.isNull() | (value % 1 == 0), value.cast("bigint")).otherwise(_refuse(value, name))


def cents_of(amount: Column, name: str) -> Column:
    """A double amount as whole cents; a fraction of a cent is an error."""
    cents = F.rint(amount * 100)
    exact = amount.isNull() | (F.abs(amount * 100 - cents) < CENT_TOLERANCE)
    return F.when(exact, cents.cast("bigint")).otherwise(_refuse(amount, name))


def cents(amount: Column) -> Column:
    """Money that was whole cents before, as cents again."""
    return F.rint(amount * 100).cast("bigint")


def total_cents(cents: Column) -> Column:
    """Sum for a last aggregation level.

    Cents fit a BIGINT per invoice, customer or task, but a grand total over
    trillions of lines may not, so that level is summed as a decimal.
    """
    return F.sum(cents.cast("decimal(19,0)"))


def money(cents: Column) -> Column:
    """Cents as a double amount."""
    return cents.cast("double") / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL when the denominator is zero or either side is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
