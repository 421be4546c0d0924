"""Plans meant for large data: what is shuffled, joined and kept in one task."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from store import dicts, store
from tallykeep.operators import behaviour, cohorts, core, groups, timeseries, topn, yearly
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set
from tallykeep.plans import insights
from tallykeep.registry.queries import queries
from tallykeep.session import tune
from tallykeep.sources.star import read_star

FOLDER = "/root/testdata/sf0.001"
YEAR = ("1997-01-01", "1997-12-31")


@pytest.fixture
def large(spark):
    """Plan as for tables too large to broadcast, before any runtime change."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield read_star(spark, FOLDER)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join_or_python(spark, large, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "Pandas"):
        assert operator not in plan


def test_scan_reads_needed_columns_and_pushes_dates(large):
    plan = plan_of(groups.group_kpis(working_set(large), "Genre", YEAR))
    lines, invoices = (
        next(line for line in plan.splitlines() if "FileScan" in line and key in line)
        for key in ("l_orderkey", "o_orderkey")
    )
    assert re.search(r"\[l_orderkey#\d+L,l_partkey#\d+L,l_quantity#\d+,l_extendedprice#\d+\]", lines)
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan
    assert "c_custkey" not in plan, "no country, no customer join"


def test_totals_are_not_computed_when_unused(large):
    plan = plan_of(core.customer_kpis(all_invoices(large), YEAR))
    assert "l_orderkey" not in plan and "Join" not in plan


def test_unfiltered_groups_visit_the_lines_once(large):
    plan = plan_of(groups.group_kpis(working_set(large), "Artist", YEAR))
    assert plan.count("FileScan parquet [l_orderkey") == 1


@pytest.mark.parametrize(
    "build",
    [
        lambda s: groups.group_kpis(s, "Genre", YEAR),
        lambda s: groups.group_kpis(s, "BillingCountry", YEAR),
        lambda s: timeseries.monthly_summary(s, YEAR),
        lambda s: yearly.yearly_summary(s, "Artist", YEAR),
        lambda s: cohorts.cohort_retention(s, YEAR),
        lambda s: behaviour.customer_bounds(s, YEAR),
    ],
)
def test_windows_see_aggregated_rows_only(large, build):
    """Below every window's shuffle there is an aggregation: no raw rows per customer."""
    lines = plan_of(build(working_set(large))).splitlines()
    windows = [i for i, line in enumerate(lines) if re.search(r"\bWindow \[", line)]
    assert windows
    for i in windows:
        below = next(j for j in range(i, len(lines)) if "Exchange " in lines[j])
        assert "HashAggregate" in lines[below + 1]


@pytest.mark.parametrize(
    "build",
    [
        lambda s: topn.top_groups_by_metric(groups.group_kpis(s, "Artist", YEAR)),
        lambda s: insights.best_sellers(s, YEAR),
    ],
)
def test_rankings_are_cut_before_the_shuffle(large, build):
    assert re.search(r"WindowGroupLimit .* Partial", plan_of(build(working_set(large))))


def _hot_store(spark):
    """One invoice, one customer and one track hold most of the rows, written by many tasks."""
    invoices = [(i, 1 if i < 400 else 2 + i % 50, f"20{18 + i % 3}-0{1 + i % 9}-{10 + i % 18}", "USA") for i in range(900)]
    lines = [(1 if k < 4000 else k % 900, 1 if k % 2 else 1 + k % 5, 1 + k % 3) for k in range(9000)]
    model = store(spark, invoices, lines)
    return replace(model, lines=model.lines.repartition(8))


def test_results_hold_when_skewed_joins_are_split(spark):
    window = ("2018-01-01", "2020-12-31")
    tune(spark)

    def results():
        scope = working_set(_hot_store(spark), SalesFilter(genre="Rock"))
        return [
            dicts(frame)
            for frame in (
                groups.group_kpis(scope, "Artist", window).orderBy("group_val"),
                yearly.yearly_summary(scope, "Genre", window).orderBy("year", "genre"),
                core.core_kpis(scope, window),
                behaviour.customer_bounds(scope, window).orderBy("CustomerId"),
            )
        ]

    expected = results()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert results() == expected
        scope = working_set(_hot_store(spark))
        frame = groups.grouped_lines(scope, "Artist", window)
        frame.collect()
        assert "skew=true" in plan_of(frame)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_large_totals_do_not_overflow(spark):
    from tallykeep.functions.measures import money, total_cents

    huge = spark.range(4).select(F.lit(9 * 10**18).alias("cents"))
    assert huge.agg(money(total_cents(F.col("cents"))).alias("t")).first()["t"] == 3.6e17
