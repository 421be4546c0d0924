"""One-row KPI blocks: revenue, purchases, customers, diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, within
from tallykeep.functions.measures import money, ratio, total_cents
from tallykeep.operators.filters import in_months
from tallykeep.operators.scope import Scope

def sold_invoices(scope: Scope, date_range: DateRange | None = None, country: bool = False) -> DataFrame:
    """Invoices with lines in the whole months of the range, with their totals."""
    rows = scope.limited(date_range).invoices(country=country, totals=True).filter(F.col("num_lines").isNotNull())
    return in_months(rows, date_range)


def _in_range(date_range: DateRange | None, rounded: bool) -> Column:
    return F.lit(True) if date_range is None else within(F.col("dt"), date_range, rounded)


def revenue_kpis(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """total_revenue; no row when nothing was sold."""
    return (
        sold_invoices(scope, date_range)
        .agg(money(total_cents(F.col("cents"))).alias("total_revenue"))
        .filter(F.col("total_revenue").isNotNull())
    )


def purchase_kpis(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """total_orders, avg_rev_per_order, total_tracks, avg_tracks_per_order.

    Orders count invoices with lines; zero of them leaves the rest NULL.
    """
    totals = sold_invoices(scope, date_range).agg(
        F.count(F.lit(1)).alias("orders"),
        total_cents(F.col("cents")).alias("cents"),
        F.sum("qty").alias("tracks"),
    )
    return totals.select(*purchase_columns())


def purchase_columns() -> list[Column]:
    """The purchase block from columns orders, cents, tracks."""
    return [
        F.col("orders").alias("total_orders"),
        ratio(money(F.col("cents")), F.col("orders")).alias("avg_rev_per_order"),
        F.col("tracks").alias("total_tracks"),
        ratio(F.col("tracks"), F.col("orders")).alias("avg_tracks_per_order"),
    ]


def customer_columns() -> list[Column]:
    """The customer block from columns customers, new_customers."""
    share = ratio(F.col("new_customers"), F.col("customers"))
    return [
        F.col("customers").alias("total_customers"),
        F.when(F.col("customers") == 0, 0.0).otherwise(share).alias("pct_new_customers"),
    ]


def customer_kpis(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """total_customers, pct_new_customers, on the dates as given.

    New are those whose first purchase in the whole scope lies in the range. Purchases
    without a customer id are nobody's.
    """
    active = _in_range(date_range, rounded=False)
    firsts = scope.first_dates()
    if firsts is not None and date_range is not None:
        here = scope.limited(date_range).invoices().filter(active).select("CustomerId").distinct()
        arrived = F.count_if(within(F.col("first_dt"), date_range)).alias("new_customers")
        return here.join(firsts, "CustomerId").agg(F.count(F.lit(1)).alias("customers"), arrived).select(*customer_columns())
    known = scope.invoices().filter(F.col("CustomerId").isNotNull())
    per_customer = known.groupBy("CustomerId").agg(
        F.min("dt").alias("dt"), F.max(active).alias("active")
    )
    return (
        per_customer.filter("active")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if(_in_range(date_range, rounded=False)).alias("new_customers"),
        )
        .select(*customer_columns())
    )


def subset_metadata(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """num_genre, num_artist, num_billingcountry among the lines sold.

    The facts collapse to distinct (genre, artist, country) combinations first; names
    are counted on that small frame.
    """
    scope = scope.limited(date_range)
    invoices = in_months(scope.invoices_for_lines(country=True), date_range)
    usable = scope.model.lines_of(invoices).filter(
        F.col("genre").isNotNull() & F.col("artist").isNotNull()
    )
    combinations = usable.select("genre", "artist", "country").distinct()
    names = combinations.select(F.explode(names_of("genre", "artist", "country")).alias("name"))
    known = names.filter(F.col("name.value").isNotNull()).distinct()
    return known.agg(
        F.count_if(F.col("name.kind") == "genre").alias("num_genre"),
        F.count_if(F.col("name.kind") == "artist").alias("num_artist"),
        F.count_if(F.col("name.kind") == "country").alias("num_billingcountry"),
    )


def names_of(*columns: str) -> Column:
    """Array of (kind, value), one entry per column."""
    return F.array(
        *[F.struct(F.lit(name).alias("kind"), F.col(name).alias("value")) for name in columns]
    )


def core_kpis(scope: Scope, date_range: DateRange | None = None) -> DataFrame:
    """Revenue, customer and purchase block in one row from one pass.

    Equal to the three operators above side by side: money and orders on whole
    months, customers on the dates as given. Purchases without a customer id count as
    money and orders only. No row when nothing was sold.
    """
    sold = F.col("num_lines").isNotNull() & _in_range(date_range, rounded=True)
    firsts = scope.first_dates() if date_range is not None else None
    rows = scope.invoices(totals=True) if firsts is None else scope.limited(date_range).invoices(totals=True)
    per_customer = rows.groupBy("CustomerId").agg(
        F.min("dt").alias("dt"),
        F.max(_in_range(date_range, rounded=False)).alias("active"),
        F.count_if(sold).alias("orders"),
        F.sum(F.when(sold, F.col("qty"))).alias("tracks"),
        F.sum(F.when(sold, F.col("cents"))).alias("cents"),
    )
    if firsts is not None:
        per_customer = per_customer.join(firsts, "CustomerId", "left").withColumn("dt", F.col("first_dt"))
    someone = F.col("active") & F.col("CustomerId").isNotNull()
    totals = per_customer.agg(
        F.count_if(someone).alias("customers"),
        F.count_if(someone & _in_range(date_range, rounded=False)).alias("new_customers"),
        F.sum("orders").alias("orders"),
        F.sum("tracks").alias("tracks"),
        total_cents(F.col("cents")).alias("cents"),
    )
    return totals.filter(F.col("cents").isNotNull()).select(
        money(F.col("cents")).alias("total_revenue"), *customer_columns(), *purchase_columns()
    )
