"""Catalog, top-N, yearly groups, geography."""

import pytest

from store import GENRES, dicts, keyed, one_line_each, only, store
from tallykeep.functions.countries import country_dimension
from tallykeep.operators import catalog, geo, topn, yearly
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set
from tallykeep.plans import metadata, pipeline

ALL_TIME = ("2019-01-01", "2022-12-31")


def test_catalog_merges_groups_of_one_name(spark):
    model = store(spark, [], [])
    assert len([g for g in GENRES.values() if g == "Rock"]) == 2
    genres = keyed(catalog.catalog(model, "Genre"), "genre")
    # tracks 1, 2 and 6 of the first Rock, 5 of the second; Opera has none
    assert {name: row["num_tracks"] for name, row in genres.items()} == {"Rock": 4, "Jazz": 2}
    artists = keyed(catalog.catalog(model, "Artist"), "artist")
    assert {name: row["num_tracks"] for name, row in artists.items()} == {"Ann": 2, "Bob": 2, "Cid": 2}


def test_catalog_views(spark):
    for view in catalog.CATALOG_VIEWS.values():
        spark.catalog.dropTempView(view)
    assert not catalog.catalogs_exist(spark)
    model = store(spark, [], [])
    catalog.create_catalogs(model)
    catalog.create_catalogs(model)
    assert catalog.catalogs_exist(spark)
    assert spark.table("genre_catalog").count() == 2


def test_catalog_coverage(spark):
    invoices = [(1, 10, "2020-01-05", "USA"), (2, 10, "2020-02-05", "USA"), (3, 11, "2020-02-06", "USA")]
    model = store(spark, invoices, [(1, 1, 1), (1, 1, 1), (2, 5, 1), (3, 3, 1)])
    table = keyed(catalog.catalog_sales(working_set(model), "Genre", ("2020-01-01", "2020-02-28")), "group_val")
    assert table["Rock"] == {
        "group_val": "Rock",
        "unique_tracks_sold": 2,
        "catalog_size": 4,
        "pct_catalog_sold": 0.5,
    }
    january = only(catalog.catalog_sales(working_set(model), "Genre", ("2020-01-10", "2020-01-20")))
    assert january["pct_catalog_sold"] == 0.25
    with pytest.raises(ValueError):
        catalog.catalog_sales(working_set(model), "BillingCountry")


@pytest.fixture
def table(spark):
    rows = [("C", 100.0, 1, 4, 10, 0), ("A", 300.0, 2, 0, 30, 0), ("B", 300.0, 2, 2, 20, 1), ("D", None, 1, 1, 1, 1)]
    return spark.createDataFrame(
        rows,
        "group_val string, revenue double, num_customers long, num_purchases long, tracks_sold long, "
        "first_time_customers long",
    )


def test_top_groups_breaks_ties_by_name(table):
    assert [r["group_val"] for r in dicts(topn.top_groups(table, "revenue", 2))] == ["A", "B"]
    assert [r["group_val"] for r in dicts(topn.top_groups(table, "revenue", 9))] == ["A", "B", "C"]


def test_top_groups_by_metric_equals_single_tables(table):
    long = keyed(topn.top_groups_by_metric(table, n=2), "metric", "rank")
    for metric in topn.metric_definitions():
        single = dicts(topn.top_groups(table, metric.name, 2))
        assert [long[metric.name, i + 1]["group_val"] for i in range(2)] == [r["group_val"] for r in single]


def test_metric_definitions():
    extra = topn.Metric("revenue_share", "Share")
    assert [m.name for m in topn.metric_definitions([extra])] == [
        "revenue",
        "num_customers",
        "first_time_customers",
        "num_purchases",
        "tracks_sold",
        "revenue_share",
    ]


def test_revenue_share_of_rows_or_total(table):
    top = topn.top_groups(table, "revenue", 2)
    assert [r["revenue_share"] for r in dicts(topn.with_ratios(top))] == [0.5, 0.5]
    assert [r["revenue_share"] for r in dicts(topn.with_ratios(top, 1200.0))] == [0.25, 0.25]
    # no purchases: no average
    assert keyed(topn.with_ratios(top), "group_val")["A"]["avg_revenue_per_purchase"] is None


def test_display_kind_by_column_name():
    kinds = {
        "pct_catalog_sold": "percent",
        "revenue_share": "percent",
        "avg_revenue_per_cust": "dollar",
        "avg_tracks_per_purchase": "float",
        "unique_tracks_sold": "number",
        "catalog_size": "number",
        "lifespan": "float",
    }
    assert {name: topn.display_kind(name) for name in kinds} == kinds


def test_country_labels(spark, table):
    rows = table.replace({"A": "USA", "B": "Atlantis"}, subset="group_val")
    shown = keyed(topn.format_top_groups(rows.filter("revenue = 300"), "BillingCountry"), "group_val")
    assert shown["USA"]["group_label"] == "🇺🇸 United States"
    assert shown["Atlantis"]["group_label"] == ""
    assert shown["USA"]["revenue_fmt"] == "$300.00"
    assert shown["USA"]["avg_revenue_per_purchase_fmt"] == "NA"


YEARS = [
    (1, 10, "2019-05-05", "USA"),
    (2, 10, "2020-03-05", "Peru"),
    (3, 11, "2020-03-06", "USA"),
    (4, 11, "2021-07-01", "USA"),
]
YEAR_LINES = [(1, 1, 1), (2, 1, 2), (2, 3, 1), (3, 3, 1), (4, 2, 5), (4, 2, 1)]


def test_yearly_summary(spark):
    scope = working_set(store(spark, YEARS, YEAR_LINES))
    rows = keyed(yearly.yearly_summary(scope, "Genre", ALL_TIME), "year", "genre")
    assert set(rows) == {("2019", "Rock"), ("2020", "Rock"), ("2020", "Jazz"), ("2021", "Rock")}
    jazz = rows["2020", "Jazz"]
    # 10 was a customer in 2019 already, though not of Jazz; track 3 is new
    assert (jazz["num_customers"], jazz["first_time_customers"]) == (2, 1)
    assert (jazz["unique_tracks_sold"], jazz["first_tracks_sold"]) == (1, 1)
    assert (jazz["num_countries"], jazz["num_purchases"], jazz["tracks_sold"]) == (2, 2, 2)
    rock = rows["2020", "Rock"]
    assert (rock["first_time_customers"], rock["first_tracks_sold"], rock["catalog_size"]) == (0, 0, 4)
    # with a later start, 2020 becomes everyone's first year
    later = keyed(yearly.yearly_summary(scope, "Genre", ("2020-01-01", "2021-12-31")), "year", "genre")
    assert later["2020", "Rock"]["first_time_customers"] == 1
    assert later["2020", "Rock"]["first_tracks_sold"] == 1


def test_yearly_customer_with_several_countries_counts_once(spark):
    invoices = [(1, 10, "2020-05-05", "USA"), (2, 10, "2020-06-05", "Peru"), (3, 10, "2020-07-05", None)]
    scope = working_set(store(spark, invoices, one_line_each(invoices)))
    row = only(yearly.yearly_summary(scope, "Artist", ALL_TIME))
    assert (row["num_customers"], row["first_time_customers"], row["num_countries"]) == (1, 1, 2)


def test_bars_break_ties_by_first_year_then_name(spark):
    columns = "year string, genre string, revenue double, unique_tracks_sold long, catalog_size long"
    rows = [("2020", "B", 5.0, 1, 2), ("2021", "B", 5.0, 1, 2), ("2021", "A", 10.0, 1, 0), ("2020", "C", 10.0, 2, 2)]
    frame = spark.createDataFrame(rows, columns)
    top = keyed(yearly.top_group_bars(frame, "Genre", "revenue", 2), "genre", "year")
    assert set(top) == {("B", "2020"), ("B", "2021"), ("C", "2020")}
    assert top["B", "2020"]["total_metric"] == 10.0
    assert top["C", "2020"]["pct_catalog_sold"] == 1.0
    everything = keyed(yearly.top_group_bars(frame, "Genre", "revenue", 9), "genre", "year")
    assert everything["A", "2021"]["revenue_per_catalog_track"] is None


def test_geo_modes(spark):
    scope = working_set(store(spark, YEARS, YEAR_LINES))
    both = keyed(geo.geo_metrics(scope, ALL_TIME, "both"), "year", "country")
    single = {
        **keyed(geo.geo_metrics(scope, ALL_TIME, "yearly"), "year", "country"),
        **keyed(geo.geo_metrics(scope, ALL_TIME, "aggregate"), "year", "country"),
    }
    assert both == single
    usa = both["All", "USA"]
    assert (usa["num_customers"], usa["num_purchases"], usa["first_time_customers"]) == (2, 3, 2)
    assert usa["num_months"] is None
    # customer 10 started in the USA the year before
    assert both["2020", "Peru"]["first_time_customers"] == 0
    with pytest.raises(ValueError):
        geo.geo_metrics(scope, ALL_TIME, "monthly")


@pytest.mark.parametrize(
    "window, months",
    [
        (("2020-03-05", "2020-03-06"), {"2020": 10}),
        (("2019-05-01", "2021-07-31"), {"2019": 8, "2020": 12, "2021": 7}),
    ],
)
def test_geo_months_of_year(spark, window, months):
    scope = working_set(store(spark, YEARS, YEAR_LINES))
    rows = dicts(geo.geo_metrics(scope, window))
    assert {row["year"]: row["num_months"] for row in rows} == months


def test_map_frames_drop_unknown_countries(spark):
    invoices = [(1, 10, "2020-01-05", "USA"), (2, 11, "2020-01-06", "Atlantis"), (3, 12, "2020-01-06", "Czech Republic")]
    scope = working_set(store(spark, invoices, one_line_each(invoices)))
    rows = keyed(geo.map_frames(scope, ALL_TIME, country_dimension(spark)), "year", "iso_alpha")
    assert set(rows) == {(y, c) for y in ("2020", "All") for c in ("USA", "CZE")}
    assert rows["All", "USA"]["revenue_per_customer"] == pytest.approx(0.99)


def test_filter_meta_lists_unsold_names(spark):
    model = store(spark, YEARS, YEAR_LINES)
    rows = dicts(metadata.filter_meta(model))
    values = {}
    for row in rows:
        values.setdefault(row["kind"], set()).add(row["value"])
    assert values["genre"] == {"Rock", "Jazz", "Opera"}
    assert values["artist"] == {"Ann", "Bob", "Cid", "Dee"}
    assert values["country"] == {"USA", "Peru"}
    assert values["min_date"] == {"2019-05-05"} and values["max_date"] == {"2021-07-01"}


def test_dataset_overview(spark):
    rows = keyed(metadata.dataset_overview(store(spark, YEARS, YEAR_LINES)), "metric")
    assert {name: row["value"] for name, row in rows.items()} == {
        "Date Range": "May 2019 – Jul 2021",
        "Number of Purchases": "4",
        "Number of Customers": "2",
        "Tracks Sold": "11",
        "Revenue (USD$)": "$10.89",
        "Number of Genres": "3",
        "Number of Artists": "4",
        "Number of Countries": "2",
    }


def test_dataset_overview_without_sales(spark):
    row = only(metadata.dataset_overview(store(spark, YEARS, [])))
    assert (row["metric"], row["value"]) == ("Summary", "No data available")


def test_enriched_table_keeps_every_group(spark):
    scope = all_invoices(store(spark, YEARS, YEAR_LINES))
    rows = keyed(pipeline.full_group_table(scope, "Artist", None), "group_val")
    assert set(rows) == {"Ann", "Bob"}
    assert rows["Ann"]["pct_catalog_sold"] == 1.0
    filtered = working_set(store(spark, YEARS, YEAR_LINES), SalesFilter(country="Peru"))
    assert set(keyed(pipeline.full_group_table(filtered, "BillingCountry", None), "group_val")) == {"Peru"}
