"""Display strings for KPI values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallykeep.functions.countries import country_text

KINDS = ("dollar", "percent", "number", "float", "country")


def _digits(accuracy: float) -> int:
    return max(0, -math.floor(math.log10(accuracy)))


def _grouped(value: Column, accuracy: float) -> Column:
    """Round half-even to a multiple of ``accuracy``, with thousands commas."""
    nearest = F.rint(value / F.lit(accuracy)) * F.lit(accuracy)
    return F.format_number(nearest, _digits(accuracy))


def _signed(value: Column, body: Column) -> Column:
    return F.concat(F.when(value < 0, "-").otherwise(""), body)


def format_kpi(value: Column, kind: str = "number", accuracy: float = 0.01, prefix: str = "$") -> Column:
    """Text of a KPI; ``"NA"`` where a number is missing.

    ``country`` gives flag and name of a country, however it is spelled, and an empty
    text for an unknown one. ``number`` drops the decimals of whole values, ``float`` always shows them.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    if kind == "country":
        return country_text(value)
    x = value.cast("double")
    if kind == "dollar":
        text = _signed(x, F.concat(F.lit(prefix), _grouped(F.abs(x), accuracy)))
    elif kind == "percent":
        points = F.rint(x / F.lit(accuracy / 100)) * F.lit(accuracy / 100) * 100
        grouped = F.format_number(points, _digits(accuracy))
        text = F.concat(F.translate(grouped, ",", " "), F.lit("%"))
    elif kind == "float":
        text = _grouped(x, accuracy)
    else:
        text = F.when(x % 1 == 0, _grouped(x, 1)).otherwise(_grouped(x, accuracy))
    return F.when(x.isNull() | F.isnan(x), "NA").otherwise(text)


def month_label(day: Column) -> Column:
    """A date as ``Mar 2020``."""
    return F.date_format(day, "MMM yyyy")
