"""Invoice filters: optional country, genre, artist and month-rounded dates."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, within


def _names(values: Sequence[str] | str | None) -> tuple[str, ...]:
    if values is None:
        return ()
    return (values,) if isinstance(values, str) else tuple(values)


@dataclass(frozen=True)
class SalesFilter:
    """Values to keep; an empty list or None means no restriction.

    Values are compared as typed literals, never pasted into SQL text.
    """

    country: Sequence[str] | str | None = field(default=())
    genre: Sequence[str] | str | None = field(default=())
    artist: Sequence[str] | str | None = field(default=())
    date_range: DateRange | None = None

    def invoice_predicates(self) -> list[Column]:
        """Conditions on the invoice itself."""
        found = []
        if self.date_range is not None:
            found.append(within(F.col("dt"), self.date_range, rounded=True))
        if _names(self.country):
            found.append(F.col("country").isin(*_names(self.country)))
        return found

    def line_predicates(self) -> list[Column]:
        """Conditions that must hold together on one line of the invoice."""
        return [
            F.col(name).isin(*values)
            for name, values in (("genre", _names(self.genre)), ("artist", _names(self.artist)))
            if values
        ]

    @property
    def needs_country(self) -> bool:
        return bool(_names(self.country))


def keep_all(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    """Rows satisfying every predicate; all rows when there is none."""
    return df.filter(reduce(and_, predicates)) if predicates else df


def in_months(df: DataFrame, date_range: DateRange | None) -> DataFrame:
    """Rows whose ``dt`` lies in the whole months of the range; all when None."""
    return df if date_range is None else df.filter(within(F.col("dt"), date_range, rounded=True))


def in_days(df: DataFrame, date_range: DateRange | None) -> DataFrame:
    """Rows whose ``dt`` lies in the range as given; all when None."""
    return df if date_range is None else df.filter(within(F.col("dt"), date_range))
