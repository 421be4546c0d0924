"""All data and a filtered view from one pass over the facts.

Every invoice carries a tag that says whether the filter keeps it; each KPI block is then
aggregated under both conditions at once. The lines are read and shuffled once: they
shrink to one row per invoice, genre and artist, and a window over an invoice's few rows
adds its totals and whether one of them satisfies the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange, elapsed_months, month_index, month_start, within
from tallykeep.functions.measures import money, ratio, total_cents
from tallykeep.model import SalesModel
from tallykeep.operators.cohorts import best_cohorts
from tallykeep.operators.core import customer_columns, names_of, purchase_columns
from tallykeep.operators.filters import SalesFilter
from tallykeep.plans.insights import TOP_MARKETS, entries, leaders, side_by_side

SIDES = ("overall", "filtered")


@dataclass(frozen=True)
class TaggedFacts:
    """``rows``: InvoiceId, CustomerId, dt, country, genre, artist, cents of that genre and
    artist, ``chosen``, and on the one ``lead`` row of an invoice num_lines, qty and all its cents
    (``total``); num_lines is NULL for an invoice without lines.
    """

    rows: DataFrame

    @contextmanager
    def held(self) -> Iterator["TaggedFacts"]:
        """Keep the rows in executor memory, spilling to disk, while a block computes its reports."""
        kept = self.rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield replace(self, rows=kept)
        finally:
            kept.unpersist()


def tagged(model: SalesModel, flt: SalesFilter) -> TaggedFacts:
    """The facts with the tag of a filter; nothing is computed yet."""
    sold = model.described_lines().groupBy("InvoiceId", "genre", "artist").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("q"), F.sum("cents").alias("cents")
    )
    usable = [F.col("genre").isNotNull(), F.col("artist").isNotNull()]
    matches: Column = reduce(and_, usable + flt.line_predicates())
    # any row may lead; one window serves both, so the rows are sorted once
    together = Window.partitionBy("InvoiceId").orderBy(F.lit(1))
    invoice = together.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(together) == 1
    totals = sold.withColumns(
        {
            "kept": F.max(F.coalesce(matches, F.lit(False))).over(invoice),
            "num_lines": F.sum("n").over(invoice),
            "qty": F.sum("q").over(invoice),
            "total": F.sum("cents").over(invoice),
            "lead": first,
        }
    ).drop("n", "q")
    billed = model.invoices(country=True)
    chosen = reduce(and_, flt.invoice_predicates(), F.coalesce("kept", F.lit(False)))
    rows = billed.join(totals, "InvoiceId", "left")
    return TaggedFacts(
        rows.withColumn("chosen", F.coalesce(chosen, F.lit(False))).withColumn("lead", F.coalesce("lead", F.lit(True))).drop("kept")
    )


def _conditions(date_range: DateRange) -> dict[str, tuple[Column, Column, Column]]:
    """Per side: whether an invoice belongs to it, is in its months, and in its days."""
    everything, chosen = F.lit(True), F.col("chosen")
    months = F.coalesce(within(F.col("dt"), date_range, rounded=True), F.lit(False))
    days = F.coalesce(within(F.col("dt"), date_range), F.lit(False))
    return {"overall": (everything, everything, everything), "filtered": (chosen, chosen & months, chosen & days)}


def _by_side(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Columns ``<name>_<side>`` as a row per side: scope and the names."""
    rows = [F.struct(F.lit(side).alias("scope"), *[F.col(f"{name}_{side}").alias(name) for name in columns]) for side in SIDES]
    others = [name for name in frame.columns if not name.endswith(tuple(f"_{side}" for side in SIDES))]
    return frame.select(*others, F.explode(F.array(*rows)).alias("row")).select(*others, "row.*")


def core_kpis(facts: TaggedFacts, date_range: DateRange) -> DataFrame:
    """scope and the columns of :func:`tallykeep.operators.core.core_kpis`; no row for a side without sales."""
    per_customer, sums = [], []
    for side, (held, months, days) in _conditions(date_range).items():
        sold = months & F.col("num_lines").isNotNull()
        first, active = F.col(f"first_{side}"), F.col(f"active_{side}")
        per_customer += [
            F.min(F.when(held, F.col("dt"))).alias(f"first_{side}"),
            F.max(days).alias(f"active_{side}"),
            F.count_if(sold).alias(f"orders_{side}"),
            F.sum(F.when(sold, F.col("qty"))).alias(f"tracks_{side}"),
            F.sum(F.when(sold, F.col("total"))).alias(f"cents_{side}"),
        ]
        here = F.col("CustomerId").isNotNull() & active
        new = here if side == "overall" else here & within(first, date_range)
        sums += [
            F.count_if(here).alias(f"customers_{side}"),
            F.count_if(new).alias(f"new_customers_{side}"),
            F.sum(f"orders_{side}").alias(f"orders_{side}"),
            F.sum(f"tracks_{side}").alias(f"tracks_{side}"),
            total_cents(F.col(f"cents_{side}")).alias(f"cents_{side}"),
        ]
    totals = facts.rows.filter("lead").groupBy("CustomerId").agg(*per_customer).agg(*sums)
    blocks = _by_side(totals, ["customers", "new_customers", "orders", "tracks", "cents"])
    return blocks.filter(F.col("cents").isNotNull()).select(
        "scope", money(F.col("cents")).alias("total_revenue"), *customer_columns(), *purchase_columns()
    )


def best_sellers(facts: TaggedFacts, date_range: DateRange) -> DataFrame:
    """scope, kind, rank, group_val, revenue: the best three countries, genres and artists of each side."""
    sums = []
    for side, (_, months, _) in _conditions(date_range).items():
        sold = months & F.col("num_lines").isNotNull()
        sums += [F.sum(F.when(sold, F.col("cents"))).alias(f"cents_{side}"), F.count_if(sold).alias(f"n_{side}")]
    groups = _by_side(facts.rows.groupBy("country", "genre", "artist").agg(*sums), ["cents", "n"]).filter("n > 0")
    per_name = (
        groups.withColumn("name", F.explode(names_of("country", "genre", "artist")))
        .groupBy("scope", "name.kind", F.col("name.value").alias("group_val"))
        .agg(money(total_cents(F.col("cents"))).alias("revenue"))
        .filter(F.col("group_val").isNotNull())
    )
    ranked = Window.partitionBy("scope", "kind").orderBy(F.desc("revenue"), "group_val")
    return per_name.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= TOP_MARKETS)


def cohort_retention(facts: TaggedFacts, date_range: DateRange) -> DataFrame:
    """scope, cohort_month, month_offset, num_active_customers, cohort_size, retention_pct."""
    someone = F.col("CustomerId").isNotNull()
    monthly, counts = [], []
    for side, (held, _, days) in _conditions(date_range).items():
        held = held & F.col("dt").isNotNull()
        active = F.lit(True) if side == "overall" else days
        monthly += [
            F.max(F.coalesce(someone & held & active, F.lit(False))).alias(f"active_{side}"),
            F.min(F.when(held, F.col("dt"))).alias(f"from_{side}"),
            F.max(F.when(held, F.col("dt"))).alias(f"to_{side}"),
        ]
        counts += [
            F.count_if(f"active_{side}").alias(f"num_{side}"),
            F.min(f"from_{side}").alias(f"from_{side}"),
            F.max(f"to_{side}").alias(f"to_{side}"),
        ]
    months = facts.rows.filter("lead").groupBy("CustomerId", month_index(F.col("dt")).alias("month")).agg(*monthly)
    cohort = F.when(F.col("CustomerId").isNotNull(), F.min("month").over(Window.partitionBy("CustomerId")))
    report = (
        months.withColumn("cohort", cohort)
        .groupBy("cohort", (F.col("month") - F.col("cohort")).alias("month_offset"))
        .agg(F.count("CustomerId").alias("customers"), *counts)
    )
    # from here on the report: at most a row per cohort, offset and side
    rows = _by_side(report, ["num", "from", "to"])
    one_side, one_cohort = Window.partitionBy("scope"), Window.partitionBy("scope", "cohort")
    limit = elapsed_months(F.min("from").over(one_side), F.max("to").over(one_side))
    size = F.max(F.when(F.col("month_offset") == 0, F.col("customers"))).over(one_cohort)
    return (
        rows.withColumns({"limit": limit, "cohort_size": size})
        .filter("month_offset > 0 AND num > 0 AND month_offset <= limit")
        .select(
            "scope",
            month_start(F.col("cohort")).alias("cohort_month"),
            "month_offset",
            F.col("num").alias("num_active_customers"),
            "cohort_size",
            ratio(F.col("num"), F.col("cohort_size")).alias("retention_pct"),
        )
    )


def compare(facts: TaggedFacts, date_range: DateRange) -> DataFrame:
    """category, position, kpi, overall, filtered; like :func:`tallykeep.plans.insights.compare`."""
    best = best_cohorts(cohort_retention(facts, date_range), (3, 6), "scope")
    blocks = core_kpis(facts, date_range).join(leaders(best_sellers(facts, date_range), "scope"), "scope", "left")
    return side_by_side(entries(blocks.join(best, "scope", "left"), "scope"))
