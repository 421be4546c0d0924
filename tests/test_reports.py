"""Pipeline, insights, sinks, stored layout."""

import csv
import glob
import os

import pytest

from store import dicts, keyed, only, store
from tallykeep import session
from tallykeep.operators import cohorts, core, geo, groups, timeseries, yearly
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set
from tallykeep.plans import insights, metadata, pipeline
from tallykeep.sources import layout, native, sinks

INVOICES = [
    (1, 10, "2020-01-05", "USA"),
    (2, 10, "2020-04-05", "USA"),
    (3, 11, "2020-01-07", "Peru"),
    (4, 11, "2020-02-07", "Peru"),
    (5, 12, "2020-02-09", "Chile"),
]
LINES = [(1, 1, 2), (1, 3, 1), (2, 2, 1), (3, 3, 4), (4, 5, 1), (5, 4, 9)]
YEAR = ("2020-01-01", "2020-12-31")


@pytest.fixture
def model(spark):
    return store(spark, INVOICES, LINES)


def shared(scope, window, **options):
    return pipeline.shared_kpis(scope, cohorts.cohort_retention(scope, window, 12), window, **options)


def test_shared_kpis(model):
    scope = working_set(model, SalesFilter(country=["USA", "Peru"]))
    kpis = shared(scope, YEAR, top_n=1)
    row = only(kpis.one_row())
    assert row["total_revenue"] == pytest.approx(9 * 0.99)
    assert (row["total_orders"], row["total_customers"], row["num_genre"]) == (4, 2, 2)
    genre = keyed(kpis.topn["Genre"], "metric")["revenue"]
    assert (genre["group_val"], genre["revenue_fmt"], genre["revenue_share_fmt"]) == ("Jazz", "$4.95", "55.56%")
    assert genre["pct_catalog_sold_fmt"] == "50.00%"
    country = keyed(kpis.topn["BillingCountry"], "metric")["tracks_sold"]
    assert (country["group_val"], country["group_label"]) == ("Peru", "🇵🇪 Peru")
    assert "pct_catalog_sold" not in country
    assert only(kpis.retention)["top_cohort_month_3"] == "Jan 2020"
    assert {row["group"]: row["num_vals"] for row in dicts(kpis.num_vals)} == {"Genre": "2", "Artist": "3", "BillingCountry": "2"}
    assert timeseries.overview(kpis.core, YEAR).collect()[0]["avg_rev"] == "$0.74"


def test_shared_kpis_without_sales(model):
    kpis = shared(working_set(model), ("2014-01-01", "2014-01-01"))
    assert dicts(kpis.one_row()) == []
    assert all(dicts(frame) == [] for frame in kpis.topn.values())
    assert dicts(kpis.retention) == []


def test_insights(model):
    chosen = working_set(model, SalesFilter(country="Peru"))
    rows = keyed(insights.compare(all_invoices(model), chosen, YEAR), "kpi")
    assert {kpi: (row["overall"], row["filtered"]) for kpi, row in rows.items()} == {
        "Total Revenue": ("$17.82", "$4.95"),
        "Top Market 1": ("🇨🇱 Chile ($8.91)", "🇵🇪 Peru ($4.95)"),
        "Top Market 2": ("🇵🇪 Peru ($4.95)", None),
        "Top Market 3": ("🇺🇸 United States ($3.96)", None),
        "Top Genre": ("Jazz ($13.86)", "Jazz ($3.96)"),
        "Top Artist": ("Bob ($13.86)", "Bob ($3.96)"),
        "Total Orders": ("5", "2"),
        "Avg Revenue per Order": ("$3.56", "$2.48"),
        "Total Tracks Sold": ("18", "5"),
        "Avg Tracks per Order": ("3.60", "2.50"),
        "Total Customers": ("3", "1"),
        "% New Customers": ("100.00%", "100.00%"),
        "Avg Revenue per Customer": ("$5.94", "$4.95"),
        "Top 3-Month Retention": ("Jan 2020 (50.00%)", "NA (NA)"),
        "Top 6-Month Retention": ("NA (NA)", "NA (NA)"),
    }


REPORTS = {
    "monthly": (lambda scope: timeseries.monthly_summary(scope, YEAR), ["month"]),
    "geo": (lambda scope: geo.geo_metrics(scope, YEAR, "both"), ["year", "country"]),
    "groups": (lambda scope: groups.group_kpis(scope, "Artist", YEAR), ["group_val"]),
    "yearly_genre": (lambda scope: yearly.yearly_summary(scope, "Genre", YEAR), ["year", "genre"]),
    "yearly_artist": (lambda scope: yearly.yearly_summary(scope, "Artist", YEAR), ["year", "artist"]),
    "cohorts": (lambda scope: cohorts.cohort_retention(scope, YEAR, 12), ["cohort_month", "month_offset"]),
    "decay": (lambda scope: cohorts.retention_decay(scope, YEAR, 12), ["month_offset"]),
    "choices": (lambda scope: metadata.filter_choices(scope.model), ["kind", "value"]),
}


@pytest.mark.parametrize("report", REPORTS)
def test_reports_are_ordered_where_they_leave(model, report):
    build, keys = REPORTS[report]
    table = build(working_set(model))
    rows = [tuple(row[key] for key in keys) for row in sinks.ordered(table.repartition(5), report).collect()]
    assert len(rows) > 1 and rows == sorted(rows)


def test_bars_are_ordered_by_total(model):
    bars = yearly.top_group_bars(yearly.yearly_summary(working_set(model), "Artist", YEAR), "Artist", "revenue", 3)
    totals = [row["total_metric"] for row in sinks.ordered(bars.repartition(5), "bars").collect()]
    assert totals == sorted(totals, reverse=True)


@pytest.mark.parametrize("report", sinks.EXPORTS)
def test_exported_reports(model, tmp_path, report):
    build, keys = REPORTS[report]
    table = build(working_set(model))
    for _ in range(2):
        path = sinks.export_report(table, report, str(tmp_path))
    (part,) = glob.glob(os.path.join(path, "*.csv"))
    with open(part, newline="") as handle:
        header, *rows = list(csv.reader(handle))
    assert header == table.columns and len(rows) == table.count()
    if report == "monthly":
        assert [row[0] for row in rows] == ["2020-01", "2020-02", "2020-04"]
    with pytest.raises(ValueError):
        sinks.export_report(table, "choices", str(tmp_path))


def test_published_view(spark, model):
    sinks.publish_view(working_set(model, SalesFilter(country="USA")).events(), "filtered_invoices")
    assert spark.sql("SELECT count(*) FROM filtered_invoices").first()[0] == 2
    sinks.publish_view(working_set(model).events(), "filtered_invoices")
    assert spark.table("filtered_invoices").count() == 5


def test_read_native_tables(spark, tmp_path):
    from datetime import datetime
    from decimal import Decimal

    frames = {
        "Invoice": ([(1, 10, datetime(2020, 1, 5, 23, 59), "USA")], "InvoiceId int, CustomerId int, InvoiceDate timestamp, BillingCountry string"),
        "InvoiceLine": ([(1, 1, Decimal("0.99"), 3)], "InvoiceId int, TrackId int, UnitPrice decimal(10,2), Quantity int"),
        "Track": ([(1, 1, 1)], "TrackId int, AlbumId int, GenreId int"),
        "Album": ([(1, 1)], "AlbumId int, ArtistId int"),
        "Artist": ([(1, "Ann")], "ArtistId int, Name string"),
        "Genre": ([(1, "Rock")], "GenreId int, Name string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    scope = working_set(native.read_native(spark, str(tmp_path)))
    assert only(core.revenue_kpis(scope, ("2020-01-05", "2020-01-05")))["total_revenue"] == pytest.approx(2.97)
    # a time of day does not push the last day out of the range
    assert only(core.customer_kpis(scope, ("2020-01-05", "2020-01-05")))["total_customers"] == 1


@pytest.fixture
def stored(spark, model):
    layout.write_layout(model, "store", buckets=4)
    yield layout.read_layout(spark, "store")
    layout.drop_layout(spark, "store")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_layout_gives_the_same_results(model, stored):
    for flt in (None, SalesFilter(genre="Rock")):
        plain, bucketed = working_set(model, flt), working_set(stored, flt)
        for build in (
            lambda s: groups.group_kpis(s, "Genre", YEAR).orderBy("group_val"),
            lambda s: yearly.yearly_summary(s, "Artist", YEAR).orderBy("artist"),
            lambda s: core.core_kpis(s, YEAR),
            lambda s: core.subset_metadata(s, YEAR),
            lambda s: timeseries.monthly_summary(s, YEAR).orderBy("month"),
            lambda s: geo.geo_metrics(s, YEAR, "both").orderBy("year", "country"),
            lambda s: cohorts.cohort_retention(s, YEAR, 12).orderBy("cohort_month", "month_offset"),
        ):
            assert dicts(build(plain)) == dicts(build(bucketed))


def test_rollup_spares_the_lines(stored):
    scope = working_set(stored)
    for report in (
        core.core_kpis(scope, YEAR),
        timeseries.monthly_summary(scope, YEAR),
        geo.geo_metrics(scope, YEAR),
        cohorts.cohort_retention(scope, YEAR),
        cohorts.retention_decay(scope, YEAR),
    ):
        assert "store_lines" not in _plan(report) and "store_rollup" in _plan(report)
    filtered = timeseries.monthly_summary(working_set(stored, SalesFilter(genre="Rock")), YEAR)
    assert "store_lines" in _plan(filtered)


def test_layout_spares_the_shuffle_of_lines(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(working_set(stored).invoices(totals=True))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        grouped = _plan(groups.grouped_lines(working_set(stored), "Genre", YEAR))
        assert "SortMergeJoin" in grouped and "Exchange" not in grouped
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tune_follows_the_data_without_a_limit(spark):
    initial = session._INITIAL_PARTITIONS
    fresh = spark.newSession()
    session.tune(fresh, 10 * session.BYTES_PER_SHUFFLE_PARTITION)
    assert fresh.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert fresh.conf.get(initial) == "10"
    session.tune(fresh, 100 * 1024**4)
    assert fresh.conf.get(initial) == str(100 * 1024**4 // session.BYTES_PER_SHUFFLE_PARTITION)


def test_a_small_model_leaves_the_large_one_its_partitions(spark):
    fresh = spark.newSession()
    session.tune(fresh, 10**15)
    large = fresh.conf.get(session._INITIAL_PARTITIONS)
    session.tune(fresh, 10**6)
    assert fresh.conf.get(session._INITIAL_PARTITIONS) == large


def test_tune_bounds_what_a_task_reads_and_merges(spark):
    fresh = spark.newSession()
    session.tune(fresh, 6 * 1024**3)
    bounds = [fresh.conf.get(f"spark.sql.{key}") for key in ("files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes")]
    assert bounds == [str(session.BYTES_PER_SCAN), str(session.BYTES_PER_MERGED_PARTITION)]
    assert int(fresh.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 6 * 1024 // 16


def test_tune_keeps_user_settings(spark):
    chosen = {
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        session._INITIAL_PARTITIONS: "33",
        session._HASH_JOIN_BYTES: "1000000",
    }
    own = spark.newSession()
    for key, value in chosen.items():
        own.conf.set(key, value)
    session.tune(own, 100 * 1024**4, hash_join_bytes=5)
    assert {key: own.conf.get(key) for key in chosen} == chosen


def test_building_a_query_runs_no_job_and_stores_nothing(spark, tmp_path):
    from tallykeep.registry import queries

    def folders():
        root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
        return sorted(os.listdir(root)) if os.path.isdir(root) else []

    tracker = spark.sparkContext.statusTracker()
    before = folders(), tracker.getJobIdsForGroup(None)
    for name in ("shared_kpis", "shared_kpis_topn_artist", "insights_comparison"):
        queries.queries()[name](spark, "/root/testdata/sf0.001")
    assert (folders(), tracker.getJobIdsForGroup(None)) == before


def test_shared_folder_is_below_the_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_folder(spark), session.shared_folder(spark)
    assert first.startswith(root + "/") and first != second


def test_only_own_folders_are_removed(spark, tmp_path):
    with pytest.raises(ValueError):
        session.remove_folder(spark, str(tmp_path))
