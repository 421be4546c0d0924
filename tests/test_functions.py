"""Display texts, dates, countries."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from store import dicts, keyed, only
from tallykeep.functions import dates
from tallykeep.functions.countries import country_dimension, country_text, with_flag, with_iso3
from tallykeep.functions.display import format_kpi, month_label
from tallykeep.functions.measures import cents_of, money, ratio, whole


@pytest.mark.parametrize(
    "value, kind, text",
    [
        (1500.0, "dollar", "$1,500.00"),
        (-1500.5, "dollar", "-$1,500.50"),
        (0.42, "percent", "42.00%"),
        (12.5, "percent", "1 250.00%"),
        (1500.0, "number", "1,500"),
        (1500.5, "number", "1,500.50"),
        (1500.5, "float", "1,500.50"),
        (1500.0, "float", "1,500.00"),
        (0.125, "float", "0.12"),
        (None, "dollar", "NA"),
        (None, "number", "NA"),
        (float("nan"), "percent", "NA"),
    ],
)
def test_format_kpi(spark, value, kind, text):
    frame = spark.createDataFrame([(value,)], "x double")
    assert only(frame.select(format_kpi(F.col("x"), kind).alias("t")))["t"] == text


def test_format_kpi_options(spark):
    frame = spark.createDataFrame([(1234.567,)], "x double")
    shown = only(
        frame.select(
            format_kpi(F.col("x"), "dollar", prefix="€").alias("euro"),
            format_kpi(F.col("x"), "float", accuracy=0.1).alias("tenth"),
            format_kpi(F.col("x"), "float", accuracy=1).alias("whole"),
        )
    )
    assert shown == {"euro": "€1,234.57", "tenth": "1,234.6", "whole": "1,235"}
    with pytest.raises(ValueError):
        format_kpi(F.col("x"), "euro")


def test_date_ranges():
    assert dates.whole_months(("2020-02-29", "2020-01-15")) == (date(2020, 1, 1), date(2020, 2, 29))
    # the first of a month belongs to that month
    assert dates.whole_months(("2014-01-01", "2014-01-01")) == (date(2014, 1, 1), date(2014, 1, 31))
    assert dates.elapsed_months_of(("2020-01-01", "2020-03-01")) == 2
    assert dates.elapsed_months_of(("2020-01-31", "2020-02-28")) == 0
    for wrong in (("2020-01-01",), "2020-01-01", ("a", "b", "c")):
        with pytest.raises(ValueError):
            dates.bounds(wrong)


def test_month_arithmetic(spark):
    rows = [(date(2020, 1, 31), date(2020, 2, 1)), (date(2019, 12, 15), date(2021, 1, 15)), (None, date(2020, 1, 1))]
    frame = spark.createDataFrame(rows, "a date, b date").select(
        dates.months_between_calendar(F.col("a"), F.col("b")).alias("calendar"),
        dates.elapsed_months(F.col("a"), F.col("b")).alias("elapsed"),
        dates.month_start(dates.month_index(F.col("b"))).alias("start"),
    )
    assert [tuple(row.values()) for row in dicts(frame)] == [
        (1, 0, date(2020, 2, 1)),
        (13, 13, date(2021, 1, 1)),
        (None, None, date(2020, 1, 1)),
    ]


def test_month_label(spark):
    frame = spark.createDataFrame([(date(2020, 3, 9),)], "d date")
    assert only(frame.select(month_label(F.col("d")).alias("t")))["t"] == "Mar 2020"


def test_measures(spark):
    frame = spark.createDataFrame([(19.99, 0), (0.29, 4)], "x double, n int")
    rows = dicts(
        frame.select(
            cents_of(F.col("x"), "x").alias("cents"),
            money(cents_of(F.col("x"), "x")).alias("back"),
            ratio(F.col("x"), F.col("n")).alias("ratio"),
        )
    )
    assert [r["cents"] for r in rows] == [1999, 29]
    assert [r["back"] for r in rows] == [19.99, 0.29]
    assert rows[0]["ratio"] is None


@pytest.mark.parametrize("value, read", [(2.7, whole), (0.5, whole), (0.999, cents_of), (1234.5678, cents_of)])
def test_fractions_are_refused(spark, value, read):
    frame = spark.createDataFrame([(value,)], "x double")
    with pytest.raises(Exception, match="not a whole number of units"):
        frame.select(read(F.col("x"), "x")).collect()


def test_whole_numbers_pass(spark):
    frame = spark.createDataFrame([(3.0, 1e9 + 0.99), (None, None)], "q double, x double")
    rows = dicts(frame.select(whole(F.col("q"), "q").alias("q"), cents_of(F.col("x"), "x").alias("x")))
    assert [tuple(row.values()) for row in rows] == [(3, 100_000_000_099), (None, None)]


COUNTRIES = {
    # input: (iso3, flag, labelled by name, labelled by iso3)
    "United States": ("USA", "🇺🇸", "🇺🇸 United States", "🇺🇸 USA"),
    "USA": ("USA", "🇺🇸", "🇺🇸 United States", "🇺🇸 USA"),
    "united kingdom": ("GBR", "🇬🇧", "🇬🇧 United Kingdom", "🇬🇧 GBR"),
    "UK": ("GBR", "🇬🇧", "🇬🇧 United Kingdom", "🇬🇧 GBR"),
    "us": ("USA", "🇺🇸", "🇺🇸 United States", "🇺🇸 USA"),
    # alpha-3 codes are known to the flags only
    "GBR": (None, "🇬🇧", "🇬🇧 United Kingdom", "🇬🇧 GBR"),
    "Czech Republic": ("CZE", "🇨🇿", "🇨🇿 Czechia", "🇨🇿 CZE"),
    "Atlantis": (None, "", "", ""),
    "XX": (None, "🇽🇽", "🇽🇽 NA", "🇽🇽 NA"),
    "": (None, "", "", ""),
}


def test_countries(spark):
    known = country_dimension(spark)
    frame = spark.createDataFrame([(name,) for name in COUNTRIES], "place string")
    frame = with_iso3(frame, "place", known)
    frame = with_flag(frame, "place", known)
    frame = with_flag(frame, "place", known, "named", label=True)
    frame = with_flag(frame, "place", known, "coded", label=True, label_type="iso3")
    frame = frame.withColumn("shown", format_kpi(F.col("place"), "country"))
    frame = frame.withColumn("bare", country_text(F.col("place"), label=False))
    frame = frame.withColumn("short", country_text(F.col("place"), label_type="iso3"))
    rows = keyed(frame, "place")
    assert {
        place: (row["iso3"], row["flag"], row["named"], row["coded"]) for place, row in rows.items()
    } == COUNTRIES
    for row in rows.values():
        assert (row["bare"], row["shown"], row["short"]) == (row["flag"], row["named"], row["coded"])
    with pytest.raises(ValueError):
        with_flag(frame, "place", known, label_type="iso2")


def test_country_dimension_resolves_each_alias_once(spark):
    known = country_dimension(spark)
    assert known.filter("kind = 'iso2'").count() > 200
    assert known.groupBy("alias", "kind").count().filter("count > 1").count() == 0
