"""KPIs by genre, artist or billing country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange
from tallykeep.functions.measures import money, total_cents
from tallykeep.operators.core import sold_invoices
from tallykeep.operators.filters import in_months
from tallykeep.operators.scope import Scope

GENRE, ARTIST, COUNTRY = "Genre", "Artist", "BillingCountry"
GROUPS = (GENRE, ARTIST, COUNTRY)
TRACK_GROUPS = (GENRE, ARTIST)


def check_group(group: str, allowed: tuple[str, ...] = GROUPS) -> str:
    if group not in allowed:
        raise ValueError(f"group must be one of {allowed}, not {group!r}")
    return group


def group_column(group: str) -> str:
    """Column of the described lines that holds a track group."""
    return check_group(group, TRACK_GROUPS).lower()


def grouped_lines(scope: Scope, group: str, date_range: DateRange | None) -> DataFrame:
    """One row per invoice and group: InvoiceId, CustomerId, dt, group_val, qty, cents."""
    scope = scope.limited(date_range)
    invoices = in_months(scope.invoices_for_lines(), date_range)
    lines = scope.model.lines_of(invoices).withColumn("group_val", F.col(group_column(group)))
    return (
        lines.filter(F.col("group_val").isNotNull())
        .groupBy("InvoiceId", "group_val")
        .agg(
            # one customer and date per invoice: kept out of the key, which is hashed per line
            F.min("CustomerId").alias("CustomerId"),
            F.min("dt").alias("dt"),
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
        )
    )


def group_kpis(scope: Scope, group: str, date_range: DateRange | None = None) -> DataFrame:
    """group_val, num_customers, num_purchases, tracks_sold, revenue, first_time_customers.

    First-time customers bought from the group on their first day in the range,
    whatever else they bought that day.

    Purchases without a customer id count as purchases, tracks and revenue only.

    Sums shrink the facts step by step (invoice, customer, group), so no step counts
    distinct values over lines and a hot group or customer is combined before each
    shuffle. The window sees one row per customer and group.
    """
    if check_group(group) == COUNTRY:
        per_invoice = sold_invoices(scope, date_range, country=True).withColumnRenamed("country", "group_val")
    else:
        per_invoice = grouped_lines(scope, group, date_range)
    per_customer = per_invoice.groupBy("group_val", "CustomerId").agg(
        F.count(F.lit(1)).alias("purchases"),
        F.sum("qty").alias("qty"),
        F.sum("cents").alias("cents"),
        F.min("dt").alias("first_here"),
    )
    # the rows without an id have no order among them, so they need not meet in one task
    apart = F.when(F.col("CustomerId").isNull(), F.col("group_val"))
    first_anywhere = F.min("first_here").over(Window.partitionBy("CustomerId", apart))
    first_time = F.col("CustomerId").isNotNull() & (F.col("first_here") == first_anywhere)
    return (
        per_customer.withColumn("first_time", first_time)
        .groupBy("group_val")
        .agg(
            F.count("CustomerId").alias("num_customers"),
            F.sum("purchases").alias("num_purchases"),
            F.sum("qty").alias("tracks_sold"),
            money(total_cents(F.col("cents"))).alias("revenue"),
            F.count_if("first_time").alias("first_time_customers"),
        )
    )
