"""One row per customer: the days with purchases, their counts, and a bitmap of months.

The summary is made once from the invoices and answers any window after that: bounds and
behaviour read the day arrays, cohort reports the month bitmaps, and neither needs an
invoice, a shuffle by customer or a window. Summaries merge, so new invoices are summarised
on their own and added. A row is at most as long as the days of the history.

Purchases without a customer id are nobody's and have no row; their dates count for the
span of the scope. Undated purchases count in a customer's total only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, bounds, elapsed_months, month_index, month_start
from tallykeep.functions.measures import ratio
from tallykeep.operators.scope import Scope

# Months of one word of a bitmap.
WORD = 64

ROWS = "CustomerId bigint, cohort int, undated bigint, days array<struct<dt: date, n: bigint>>, months array<struct<word: int, bits: bigint>>"
SPAN = "scope_from date, scope_to date"


@dataclass(frozen=True)
class History:
    """``rows``  CustomerId, cohort (month index of the first purchase in the full data), undated
    (purchases without a date), days (dt, n; in order), months (word, bits; in order).
    A customer of the full data without a purchase in the scope has empty arrays.

    ``span``  scope_from, scope_to: the dates of all purchases of the scope, in one row.
    """

    rows: DataFrame
    span: DataFrame


def _months_of(days: Column) -> Column:
    """The bitmap of the months of some days: bit m of word w is month 64 w + m."""
    indexes = F.array_distinct(F.transform(days, lambda day: month_index(day["dt"]).cast("int")))
    words = F.array_sort(F.array_distinct(F.transform(indexes, lambda month: F.floor(month / WORD).cast("int"))))

    def bits(word: Column) -> Column:
        here = F.filter(indexes, lambda month: F.floor(month / WORD) == word)
        return F.aggregate(here, F.lit(0).cast("bigint"), lambda held, month: held.bitwiseOR(_bit(month % WORD)))

    return F.transform(words, lambda word: F.struct(word.alias("word"), bits(word).alias("bits")))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def summarise(scope: Scope) -> History:
    """The history of a scope; cohorts come from the full data, whatever the filter."""
    everything = scope.model.invoices().filter(F.col("CustomerId").isNotNull())
    known = scope.invoices().filter(F.col("CustomerId").isNotNull())
    dated = F.col("dt").isNotNull()
    rows = (
        known.groupBy("CustomerId", "dt")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("CustomerId")
        .agg(
            F.coalesce(F.sum(F.when(~dated, F.col("n"))), F.lit(0)).alias("undated"),
            F.array_sort(F.collect_list(F.when(dated, F.struct("dt", "n")))).alias("days"),
        )
    )
    if scope.flt is None:
        rows = rows.withColumn("cohort", month_index(F.get("days", F.lit(0))["dt"]).cast("int"))
    else:
        cohorts = everything.groupBy("CustomerId").agg(F.min(month_index(F.col("dt"))).cast("int").alias("cohort"))
        rows = cohorts.join(rows, "CustomerId", "left")
    return History(_completed(rows), scope.invoices().agg(F.min("dt").alias("scope_from"), F.max("dt").alias("scope_to")))


def _completed(rows: DataFrame) -> DataFrame:
    days = F.coalesce("days", F.array().cast("array<struct<dt: date, n: bigint>>"))
    filled = rows.withColumn("days", days).withColumn("undated", F.coalesce("undated", F.lit(0)).cast("bigint"))
    return filled.withColumn("months", _months_of(F.col("days"))).select("CustomerId", "cohort", "undated", "days", "months")


def merged(one: History, other: History) -> History:
    """The history of both sets of invoices; no invoice may be in both."""
    a, b = one.rows.alias("a"), other.rows.alias("b")
    counts = [F.map_from_entries(F.coalesce(F.col(f"{side}.days"), F.array().cast("array<struct<dt: date, n: bigint>>"))) for side in "ab"]
    both = F.map_zip_with(*counts, lambda day, n, m: F.coalesce(n, F.lit(0)) + F.coalesce(m, F.lit(0)))
    day = F.transform(F.map_entries(both), lambda entry: F.struct(entry["key"].alias("dt"), entry["value"].alias("n")))
    joined = a.join(b, F.col("a.CustomerId") == F.col("b.CustomerId"), "full").select(
        F.coalesce("a.CustomerId", "b.CustomerId").alias("CustomerId"),
        F.least("a.cohort", "b.cohort").alias("cohort"),
        (F.coalesce("a.undated", F.lit(0)) + F.coalesce("b.undated", F.lit(0))).alias("undated"),
        F.array_sort(day).alias("days"),
    )
    span = one.span.unionByName(other.span).agg(F.min("scope_from").alias("scope_from"), F.max("scope_to").alias("scope_to"))
    return History(_completed(joined), span)


def write_history(history: History, folder: str) -> None:
    """Store a history below ``folder``, replacing what is there."""
    history.rows.write.mode("overwrite").parquet(f"{folder}/customers")
    history.span.write.mode("overwrite").parquet(f"{folder}/span")


def read_history(spark: SparkSession, folder: str) -> History:
    return History(
        spark.read.schema(ROWS).parquet(f"{folder}/customers"), spark.read.schema(SPAN).parquet(f"{folder}/span")
    )


def _ends(history: History, date_range: DateRange | None) -> tuple[Column, Column]:
    if date_range is None:
        return history.span.select("scope_from").scalar(), history.span.select("scope_to").scalar()
    start, end = bounds(date_range)
    return F.lit(start), F.lit(end)


def window_ends(history: History, date_range: DateRange | None) -> tuple[Column, Column]:
    """First and last day of the window, by default of the scope."""
    return _ends(history, date_range)


def customer_bounds(history: History, date_range: DateRange | None = None) -> DataFrame:
    """Like :func:`tallykeep.operators.behaviour.customer_bounds`, read off the day arrays."""
    start, end = _ends(history, date_range)
    rows = history.rows.select("CustomerId", "undated", "days", start.alias("start"), end.alias("end"))
    start, end = F.col("start"), F.col("end")
    rows = rows.withColumns(
        {
            "inside": F.filter("days", lambda day: day["dt"].between(start, end)),
            "before": F.filter("days", lambda day: day["dt"] < start),
            "after": F.filter("days", lambda day: day["dt"] > end),
        }
    )

    def counted(days: str) -> Column:
        return F.aggregate(days, F.lit(0).cast("bigint"), lambda total, day: total + day["n"])

    def first(days: str) -> Column:
        return F.get(days, F.lit(0))["dt"]

    def last(days: str) -> Column:
        return F.try_element_at(days, F.lit(-1))["dt"]

    def second(days: str) -> Column:
        return F.when(F.get(days, F.lit(0))["n"] > 1, first(days)).otherwise(F.get(days, F.lit(1))["dt"])

    return rows.filter(F.size("inside") > 0).select(
        "CustomerId",
        first("days").alias("first_date"),
        second("days").alias("second_date"),
        last("days").alias("last_date"),
        (F.col("undated") + counted("days")).alias("total_purchases"),
        first("inside").alias("first_in_window"),
        second("inside").alias("second_in_window"),
        last("inside").alias("last_in_window"),
        counted("inside").alias("num_in_window"),
        last("before").alias("last_before_window"),
        first("after").alias("first_after_window"),
    )


def _active(history: History, date_range: DateRange | None) -> DataFrame:
    """CustomerId, cohort, words: the months with a purchase in the range.

    Months in the middle of the range are cut out of the bitmap by a mask; a month that the range
    cuts counts if one of its days lies in the range.
    """
    rows = history.rows.filter(F.col("cohort").isNotNull())
    if date_range is None:
        return rows.select("CustomerId", "cohort", F.col("months").alias("words"))
    start, end = bounds(date_range)
    first, last = (day.year * 12 + day.month - 1 for day in (start, end))
    ends = sorted({first, last})

    def bought_in(month: int) -> Column:
        return F.exists("days", lambda day: day["dt"].between(F.lit(start), F.lit(end)) & (month_index(day["dt"]) == month))

    def cut(one: Column) -> Column:
        low = F.greatest(F.lit(first + 1) - one["word"] * WORD, F.lit(0))
        high = F.least(F.lit(last - 1) - one["word"] * WORD, F.lit(WORD - 1))
        # ones from place low to place high
        as_many = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), (WORD - 1 - (high - low)).cast("int"))
        ones = F.call_function("shiftleft", as_many, low.cast("int"))
        bits = one["bits"].bitwiseAND(F.when(low <= high, ones).otherwise(F.lit(0).cast("bigint")))
        for month in ends:
            here = bought_in(month) & (one["word"] == month // WORD)
            bits = bits.bitwiseOR(F.when(here, _bit(F.lit(month % WORD))).otherwise(F.lit(0).cast("bigint")))
        return F.struct(one["word"].alias("word"), bits.alias("bits"))

    return rows.select("CustomerId", "cohort", F.filter(F.transform("months", cut), lambda one: one["bits"] != 0).alias("words"))


def _limit(history: History, max_offset: int | None) -> Column:
    if max_offset is not None:
        return F.lit(max_offset)
    return history.span.select(elapsed_months(F.col("scope_from"), F.col("scope_to"))).scalar()


def _active_by_month(active: DataFrame) -> DataFrame:
    """cohort, month_offset, n: customers of a cohort active so many months after it.

    The 64 months of a word are counted side by side, so no row is made per month.
    """
    words = active.select("cohort", F.inline("words"))
    places = [F.sum(F.shiftrightunsigned("bits", i).bitwiseAND(F.lit(1))) for i in range(WORD)]
    counts = words.groupBy("cohort", "word").agg(*[one.alias(f"m{i}") for i, one in enumerate(places)])
    months = counts.select("cohort", "word", F.posexplode(F.array(*[f"m{i}" for i in range(WORD)])).alias("place", "n"))
    offset = F.col("word") * WORD + F.col("place") - F.col("cohort")
    return months.filter("n > 0").select("cohort", offset.alias("month_offset"), "n")


def cohort_retention(history: History, date_range: DateRange | None, max_offset: int | None = None) -> DataFrame:
    """Like :func:`tallykeep.operators.cohorts.cohort_retention`, by counting bits."""
    sizes = history.rows.filter(F.col("cohort").isNotNull()).groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    counted = _active_by_month(_active(history, date_range))
    within_limit = (F.col("month_offset") > 0) & (F.col("month_offset") <= _limit(history, max_offset))
    return (
        counted.filter(within_limit)
        .join(sizes, "cohort")
        .select(
            month_start(F.col("cohort")).alias("cohort_month"),
            "month_offset",
            F.col("n").alias("num_active_customers"),
            "cohort_size",
            ratio(F.col("n"), F.col("cohort_size")).alias("retention_pct"),
        )
    )


def retention_decay(history: History, date_range: DateRange | None, max_offset: int | None = None) -> DataFrame:
    """Like :func:`tallykeep.operators.cohorts.retention_decay`, by counting bits.

    The lowest set bit of a customer's first word is the month that counts them in.
    """
    active = _active(history, date_range)
    limit = _limit(history, max_offset)
    first = F.get("words", F.lit(0))
    # the ones below the lowest set bit are as many as its place; the top bit alone has no negative
    below = first["bits"].bitwiseAND(-first["bits"]) - F.lit(1)
    place = F.when(first["bits"] == F.lit(-(1 << 63)), F.lit(WORD - 1)).otherwise(F.bit_count(below))
    lowest = first["word"] * WORD + place
    entered = active.filter(F.size("words") > 0).filter(lowest - F.col("cohort") <= limit)
    base = entered.agg(F.count(F.lit(1)).alias("num_customers")).scalar()
    by_offset = _active_by_month(active).groupBy("month_offset").agg(F.sum("n").alias("num_retained"))
    return (
        by_offset.filter((F.col("month_offset") > 0) & (F.col("month_offset") <= limit))
        .withColumn("num_customers", base)
        .withColumn("retention_rate", ratio(F.col("num_retained"), F.col("num_customers")))
    )
