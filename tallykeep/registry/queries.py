"""Every operator as a named query over the star-schema tables of a folder."""

from __future__ import annotations

from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.countries import SCHEMA, country_dimension, listed, with_flag, with_iso3
from tallykeep.functions.display import format_kpi
from tallykeep.model import SalesModel
from tallykeep.operators import behaviour, catalog, cohorts, core, geo, groups, history, medians, members, timeseries, topn, yearly
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.groups import ARTIST, COUNTRY, GENRE
from tallykeep.operators.scope import Scope, all_invoices, working_set
from tallykeep.plans import metadata, pipeline, tagged
from tallykeep.session import MEGABYTE, shared_folder, stamp, stored_bytes
from tallykeep.sources import dated
from tallykeep.sources.sinks import read_ordered, settled, write_ordered
from tallykeep.sources.star import SCHEMAS, read_star

Query = Callable[[SparkSession, str], DataFrame]

YEAR = ("1997-01-01", "1997-12-31")
MID_MONTH = ("1997-02-10", "1997-04-05")
LONG = ("1996-03-01", "1998-09-30")
CENTURY = ("1950-01-01", "2049-12-31")
EMPTY = ("2014-01-01", "2014-01-01")

BY_COUNTRY = SalesFilter(country=["NATION_1", "NATION_7"])
BY_GENRE = SalesFilter(genre=["ECONOMY"])
BY_ARTIST = SalesFilter(artist=["Brand#1"])
COMBINED = SalesFilter(country=["NATION_1", "NATION_7"], genre=["ECONOMY"], artist=["Brand#1"])

# Stand-ins for real names, as the test nations are called NATION_n.
NATION_CODES = [
    ("NATION_1", "name", "US", "USA", "United States"),
    ("NATION_3", "name", "GB", "GBR", "United Kingdom"),
    ("NATION_7", "name", "BR", "BRA", "Brazil"),
    ("NATION_11", "name", "DE", "DEU", "Germany"),
    ("NATION_19", "name", "IN", "IND", "India"),
]

# Ranges of lines in the dated layout of the given tables, at least.
LINE_FILES = 8

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _model(spark: SparkSession, folder: str) -> SalesModel:
    return read_star(spark, folder)


def _everything(spark: SparkSession, folder: str) -> Scope:
    return all_invoices(_model(spark, folder))


def _set(spark: SparkSession, folder: str, flt: SalesFilter | None = None) -> Scope:
    return working_set(_model(spark, folder), flt)


def _nation_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NATION_CODES, SCHEMA)


# Working set


@_query
def events_all(spark, folder):
    return _set(spark, folder).events()


@_query
def events_country(spark, folder):
    return _set(spark, folder, BY_COUNTRY).events()


@_query
def events_genre(spark, folder):
    return _set(spark, folder, BY_GENRE).events()


@_query
def events_artist(spark, folder):
    return _set(spark, folder, BY_ARTIST).events()


@_query
def events_combined(spark, folder):
    return _set(spark, folder, COMBINED).events()


@_query
def events_month_rounded(spark, folder):
    return _set(spark, folder, SalesFilter(date_range=MID_MONTH)).events()


# Core KPIs


@_query
def subset_metadata(spark, folder):
    return core.subset_metadata(_set(spark, folder), YEAR)


@_query
def subset_metadata_filtered(spark, folder):
    return core.subset_metadata(_set(spark, folder, COMBINED), None)


@_query
def subset_metadata_empty(spark, folder):
    return core.subset_metadata(_everything(spark, folder), EMPTY)


@_query
def revenue_kpis(spark, folder):
    return core.revenue_kpis(_everything(spark, folder), YEAR)


@_query
def revenue_kpis_genre(spark, folder):
    return core.revenue_kpis(_set(spark, folder, BY_GENRE), MID_MONTH)


@_query
def revenue_kpis_empty(spark, folder):
    return core.revenue_kpis(_everything(spark, folder), EMPTY)


@_query
def customer_kpis(spark, folder):
    return core.customer_kpis(_set(spark, folder), YEAR)


@_query
def customer_kpis_invoice_table(spark, folder):
    return core.customer_kpis(_everything(spark, folder), MID_MONTH)


@_query
def customer_kpis_empty(spark, folder):
    return core.customer_kpis(_everything(spark, folder), EMPTY)


@_query
def purchase_kpis(spark, folder):
    return core.purchase_kpis(_set(spark, folder), YEAR)


@_query
def purchase_kpis_genre(spark, folder):
    return core.purchase_kpis(_set(spark, folder, BY_GENRE), YEAR)


@_query
def purchase_kpis_empty(spark, folder):
    return core.purchase_kpis(_everything(spark, folder), EMPTY)


# Groups, catalog, top-N


@_query
def group_kpis_genre(spark, folder):
    return groups.group_kpis(_set(spark, folder), GENRE, YEAR)


@_query
def group_kpis_genre_filtered(spark, folder):
    return groups.group_kpis(_set(spark, folder, BY_GENRE), GENRE, MID_MONTH)


@_query
def group_kpis_artist(spark, folder):
    return groups.group_kpis(_everything(spark, folder), ARTIST, YEAR)


@_query
def group_kpis_country(spark, folder):
    return groups.group_kpis(_set(spark, folder), COUNTRY, YEAR)


@_query
def catalog_genre(spark, folder):
    return catalog.catalog(_model(spark, folder), GENRE)


@_query
def catalog_artist(spark, folder):
    return catalog.catalog(_model(spark, folder), ARTIST)


@_query
def catalog_sales_genre(spark, folder):
    return catalog.catalog_sales(_set(spark, folder, BY_COUNTRY), GENRE, MID_MONTH)


@_query
def catalog_sales_artist(spark, folder):
    return catalog.catalog_sales(_everything(spark, folder), ARTIST, YEAR)


@_query
def group_kpis_genre_enriched(spark, folder):
    return pipeline.full_group_table(_set(spark, folder), GENRE, YEAR)


@_query
def group_kpis_artist_enriched(spark, folder):
    return pipeline.full_group_table(_set(spark, folder, BY_COUNTRY), ARTIST, YEAR)


_TOP_COLUMNS = ("metric", "rank", "group_val", "value")


@_query
def topn_genre(spark, folder):
    table = groups.group_kpis(_set(spark, folder), GENRE, YEAR)
    return topn.top_groups_by_metric(table).select(*_TOP_COLUMNS)


@_query
def topn_artist(spark, folder):
    table = groups.group_kpis(_set(spark, folder), ARTIST, YEAR)
    return topn.top_groups_by_metric(table).select(*_TOP_COLUMNS)


@_query
def topn_country(spark, folder):
    table = groups.group_kpis(_set(spark, folder), COUNTRY, YEAR)
    return topn.top_groups_by_metric(table).select(*_TOP_COLUMNS)


@_query
def topn_revenue_artist(spark, folder):
    table = groups.group_kpis(_set(spark, folder), ARTIST, YEAR)
    return topn.top_groups(table, "revenue", 5)


@_query
def topn_display_genre(spark, folder):
    scope = _set(spark, folder)
    table = pipeline.full_group_table(scope, GENRE, YEAR)
    best = topn.top_groups_by_metric(table)
    total = core.revenue_kpis(scope, YEAR).scalar()
    return topn.format_top_groups(best, GENRE, total)


@_query
def topn_display_country(spark, folder):
    table = groups.group_kpis(_set(spark, folder), COUNTRY, YEAR)
    best = topn.top_groups(table, "revenue", 5)
    return topn.format_top_groups(best, COUNTRY, None, _nation_codes(spark))


# Trend, geography, yearly groups


@_query
def ts_monthly(spark, folder):
    return timeseries.monthly_summary(_set(spark, folder), YEAR)


@_query
def ts_monthly_genre(spark, folder):
    return timeseries.monthly_summary(_set(spark, folder, BY_GENRE), MID_MONTH)


@_query
def ts_overview(spark, folder):
    return timeseries.overview(core.core_kpis(_set(spark, folder), YEAR), YEAR)


@_query
def geo_yearly(spark, folder):
    return geo.geo_metrics(_set(spark, folder), LONG, "yearly")


@_query
def geo_aggregate(spark, folder):
    return geo.geo_metrics(_set(spark, folder), LONG, "aggregate")


@_query
def geo_one_year(spark, folder):
    return geo.geo_metrics(_set(spark, folder, BY_ARTIST), MID_MONTH, "yearly")


@_query
def geo_frames(spark, folder):
    return geo.map_frames(_set(spark, folder), LONG, _nation_codes(spark))


@_query
def country_enriched(spark, folder):
    table = groups.group_kpis(_set(spark, folder), COUNTRY, YEAR).select("group_val", "revenue")
    known = _nation_codes(spark)
    coded = with_iso3(table, "group_val", known)
    flagged = with_flag(coded, "group_val", known, "flag")
    return with_flag(flagged, "group_val", known, "labelled", label=True)


# Nations take the names of listed countries so many places apart.
COUNTRY_STEP = 9


@_query
def country_names(spark, folder):
    """Codes and flags from the whole country list, for nations under listed names."""
    names = [name for _, _, name in listed()][::COUNTRY_STEP]
    spelled = F.get(F.array(*[F.lit(name) for name in names]), F.col("n_nationkey"))
    table = spark.read.parquet(f"{folder}/nation.parquet").select("n_name", spelled.alias("country"))
    known = country_dimension(spark)
    flagged = with_flag(with_iso3(table, "country", known), "country", known, "flag")
    return flagged.withColumn("labelled", format_kpi(F.col("country"), "country"))


@_query
def group_yearly_genre(spark, folder):
    return yearly.yearly_summary(_set(spark, folder), GENRE, LONG)


@_query
def group_yearly_artist(spark, folder):
    return yearly.yearly_summary(_set(spark, folder), ARTIST, LONG)


@_query
def group_yearly_genre_filtered(spark, folder):
    return yearly.yearly_summary(_set(spark, folder, BY_ARTIST), GENRE, MID_MONTH)


@_query
def group_bar_artist(spark, folder):
    return yearly.top_group_bars(group_yearly_artist(spark, folder), ARTIST, "revenue", 15)


@_query
def group_bar_genre_customers(spark, folder):
    return yearly.top_group_bars(group_yearly_genre(spark, folder), GENRE, "first_time_customers", 3)


# Retention


@_query
def cohort_matrix(spark, folder):
    return cohorts.cohort_retention(_set(spark, folder), YEAR)


@_query
def cohort_matrix_invoice_table(spark, folder):
    return cohorts.cohort_retention(_everything(spark, folder), LONG)


@_query
def cohort_matrix_genre(spark, folder):
    return cohorts.cohort_retention(_set(spark, folder, BY_GENRE), LONG, 12)


@_query
def cohort_grid(spark, folder):
    return cohorts.cohort_grid(cohorts.cohort_retention(_set(spark, folder), MID_MONTH))


@_query
def retention_decay(spark, folder):
    return cohorts.retention_decay(_set(spark, folder), YEAR)


@_query
def retention_decay_filtered(spark, folder):
    return cohorts.retention_decay(_set(spark, folder, COMBINED), LONG)


@_query
def retention_decay_limited(spark, folder):
    return cohorts.retention_decay(_everything(spark, folder), LONG, 6)


@_query
def customer_bounds(spark, folder):
    return behaviour.customer_bounds(_set(spark, folder), YEAR)


_EXACT = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, _EXACT) for name in columns})


_AVERAGE_GAPS = ("avg_gap_life", "avg_gap_window", "avg_gap_bound")
_AVERAGES = ("avg_life_mo_tot", "avg_life_mo_win", *_AVERAGE_GAPS)


@_query
def customer_behaviour(spark, folder):
    return _rounded(behaviour.behaviour_of(_set(spark, folder), YEAR), *_AVERAGE_GAPS)


@_query
def customer_behaviour_all_time(spark, folder):
    return _rounded(behaviour.behaviour_of(_everything(spark, folder)), *_AVERAGE_GAPS)


@_query
def retention_summary(spark, folder):
    summary = behaviour.behaviour_summary(behaviour.behaviour_of(_set(spark, folder), YEAR))
    return _rounded(summary, *_AVERAGES)


@_query
def retention_kpis(spark, folder):
    scope = _set(spark, folder)
    return behaviour.retention_kpis(scope, YEAR, cohorts.cohort_retention(scope, YEAR))


@_query
def retention_kpis_empty(spark, folder):
    scope = _set(spark, folder)
    return behaviour.retention_kpis(scope, EMPTY, cohorts.cohort_retention(scope, EMPTY))


@_query
def top_cohorts(spark, folder):
    return cohorts.best_cohorts(cohorts.cohort_retention(_everything(spark, folder), LONG))


# Reports


def _shared(spark: SparkSession, folder: str, block: Callable[[pipeline.SharedKpis], DataFrame]) -> DataFrame:
    """A block of one filtered scope, which is held while the block is computed."""
    with _set(spark, folder, BY_GENRE).held() as scope:
        return settled(block(pipeline.shared_kpis(scope, cohorts.cohort_retention(scope, YEAR), YEAR)))


@_query
def shared_kpis(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.one_row())


@_query
def shared_kpis_topn_genre(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.topn[GENRE])


@_query
def shared_kpis_topn_artist(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.topn[ARTIST])


@_query
def shared_kpis_topn_country(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.topn[COUNTRY])


@_query
def shared_kpis_num_vals(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.num_vals)


@_query
def shared_kpis_retention(spark, folder):
    return _shared(spark, folder, lambda kpis: kpis.retention)


@_query
def filter_meta(spark, folder):
    return metadata.filter_meta(_model(spark, folder))


@_query
def dataset_overview(spark, folder):
    return metadata.dataset_overview(_model(spark, folder))


@_query
def insights_comparison(spark, folder):
    with tagged.tagged(_model(spark, folder), BY_GENRE).held() as facts:
        return settled(tagged.compare(facts, YEAR))


@_query
def insights_comparison_combined(spark, folder):
    with tagged.tagged(_model(spark, folder), COMBINED).held() as facts:
        return settled(tagged.compare(facts, MID_MONTH))


# Through the dated layout, which is written from the given tables once per session


_STORES: dict[tuple, str] = {}


def _stored_once(spark: SparkSession, folder: str, kind: str, write: Callable[[str], None]) -> str:
    """The folder of something written from the given tables; written anew when these change."""
    stamps = (stamp(spark, f"{folder.rstrip('/')}/{name}.parquet") for name in SCHEMAS)
    key = (spark.sparkContext.applicationId, kind, folder, *stamps)
    if key not in _STORES:
        path = shared_folder(spark)
        write(path)
        _STORES[key] = path
    return _STORES[key]


def _dated(spark: SparkSession, folder: str) -> SalesModel:
    """The given tables in the dated layout; written anew when their files have changed."""
    def write(path: str) -> None:
        ranges = dated.line_ranges(stored_bytes(spark, f"{folder.rstrip('/')}/lineitem.parquet"), LINE_FILES)
        dated.write_dated(_model(spark, folder), path, line_files=ranges, group_bytes=MEGABYTE)

    return dated.read_dated(spark, _stored_once(spark, folder, "dated", write), paired_dimensions=True)


def _dated_set(spark: SparkSession, folder: str, flt: SalesFilter | None = None) -> Scope:
    return working_set(_dated(spark, folder), flt)


@_query
def dated_ts_monthly(spark, folder):
    return timeseries.monthly_summary(_dated_set(spark, folder), YEAR)


@_query
def dated_purchase_kpis(spark, folder):
    return core.purchase_kpis(_dated_set(spark, folder), YEAR)


@_query
def dated_customer_kpis(spark, folder):
    return core.customer_kpis(_dated_set(spark, folder), YEAR)


@_query
def dated_ts_overview(spark, folder):
    return timeseries.overview(core.core_kpis(_dated_set(spark, folder), YEAR), YEAR)


@_query
def dated_group_kpis_genre(spark, folder):
    return groups.group_kpis(_dated_set(spark, folder), GENRE, YEAR)


@_query
def dated_group_kpis_artist(spark, folder):
    return groups.group_kpis(all_invoices(_dated(spark, folder)), ARTIST, YEAR)


@_query
def dated_group_kpis_country(spark, folder):
    return groups.group_kpis(_dated_set(spark, folder), COUNTRY, YEAR)


@_query
def dated_geo_yearly(spark, folder):
    return geo.geo_metrics(_dated_set(spark, folder), LONG, "yearly")


@_query
def dated_group_yearly_genre(spark, folder):
    return yearly.yearly_summary(_dated_set(spark, folder), GENRE, LONG)


@_query
def dated_events_genre(spark, folder):
    return _dated_set(spark, folder, BY_GENRE).events()


@_query
def dated_events_artist(spark, folder):
    return _dated_set(spark, folder, BY_ARTIST).events()


@_query
def dated_events_month_rounded(spark, folder):
    return _dated_set(spark, folder, SalesFilter(date_range=MID_MONTH)).events()


# From the stored history of customers, which is written from the given tables once per session


def _history(spark: SparkSession, folder: str, scope: Callable[[SparkSession, str], Scope] = _set) -> history.History:
    def write(path: str) -> None:
        history.write_history(history.summarise(scope(spark, folder)), path)

    return history.read_history(spark, _stored_once(spark, folder, f"history of {scope.__name__}", write))


# The day on which the appended history is cut in two.
CUT = "1997-05-20"


def _appended_history(spark: SparkSession, folder: str) -> history.History:
    """The same history from that of the invoices before a day and that of the others."""

    def write(path: str) -> None:
        model = _model(spark, folder)
        before = F.coalesce(F.col("dt") < F.lit(CUT).cast("date"), F.lit(False))
        halves = [
            history.summarise(all_invoices(replace(model, headers=model.headers.filter(part), billed=model.billed.filter(part))))
            for part in (before, ~before)
        ]
        history.write_history(history.merged(*halves), path)

    return history.read_history(spark, _stored_once(spark, folder, "appended history", write))


@_query
def history_customer_bounds(spark, folder):
    return history.customer_bounds(_history(spark, folder), YEAR)


def _history_behaviour(known: history.History, dates) -> DataFrame:
    start, end = history.window_ends(known, dates)
    return behaviour.customer_behaviour(history.customer_bounds(known, dates), start, end)


@_query
def history_customer_behaviour(spark, folder):
    return _rounded(_history_behaviour(_history(spark, folder), YEAR), *_AVERAGE_GAPS)


@_query
def history_customer_behaviour_all_time(spark, folder):
    return _rounded(_history_behaviour(_history(spark, folder, _everything), None), *_AVERAGE_GAPS)


@_query
def history_appended_behaviour(spark, folder):
    return _rounded(_history_behaviour(_appended_history(spark, folder), None), *_AVERAGE_GAPS)


@_query
def history_retention_summary(spark, folder):
    return _rounded(behaviour.behaviour_summary(_history_behaviour(_history(spark, folder), YEAR)), *_AVERAGES)


@_query
def history_cohort_matrix(spark, folder):
    return history.cohort_retention(_history(spark, folder), YEAR)


@_query
def history_cohort_matrix_part_months(spark, folder):
    return history.cohort_retention(_history(spark, folder), MID_MONTH)


@_query
def history_cohort_matrix_century(spark, folder):
    return history.cohort_retention(_history(spark, folder), CENTURY)


@_query
def history_appended_cohort_matrix(spark, folder):
    return history.cohort_retention(_appended_history(spark, folder), LONG)


@_query
def history_retention_decay(spark, folder):
    return history.retention_decay(_history(spark, folder), YEAR)


@_query
def history_retention_decay_limited(spark, folder):
    return history.retention_decay(_history(spark, folder, _everything), LONG, 6)


# From the stored bitmaps of months and groups, which are written from the given tables once per session


def _members(spark: SparkSession, folder: str, group: str) -> DataFrame:
    def write(path: str) -> None:
        members.write_members(members.summarise(_set(spark, folder), group), path)

    return members.read_members(spark, _stored_once(spark, folder, f"members of {group}", write))


def _appended_members(spark: SparkSession, folder: str, group: str) -> DataFrame:
    """The same summary from that of some lines and that of the others; invoices are in both."""

    def write(path: str) -> None:
        model = _model(spark, folder)
        odd = F.coalesce(F.col("TrackId") % 2 == 1, F.lit(False))
        halves = [members.summarise(working_set(replace(model, lines=model.lines.filter(part))), group) for part in (odd, ~odd)]
        members.write_members(members.merged(*halves), path)

    return members.read_members(spark, _stored_once(spark, folder, f"appended members of {group}", write))


def _members_yearly(spark: SparkSession, folder: str, known: DataFrame, group: str, dates) -> DataFrame:
    return members.yearly_summary(known, members.sizes_of(_everything(spark, folder), group), group, dates)


@_query
def members_group_yearly_genre(spark, folder):
    return _members_yearly(spark, folder, _members(spark, folder, GENRE), GENRE, LONG)


@_query
def members_group_yearly_artist(spark, folder):
    return _members_yearly(spark, folder, _members(spark, folder, ARTIST), ARTIST, LONG)


@_query
def members_group_yearly_artist_one_year(spark, folder):
    return _members_yearly(spark, folder, _members(spark, folder, ARTIST), ARTIST, YEAR)


@_query
def members_appended_group_yearly_genre(spark, folder):
    return _members_yearly(spark, folder, _appended_members(spark, folder, GENRE), GENRE, LONG)


# Exact medians


# Small enough that the given tables take rounds as large ones do.
MEDIAN_SORTABLE = 500


def _in_money(found: DataFrame) -> DataFrame:
    return found.withColumn("median", F.col("median") / 100.0)


@_query
def median_line_revenue_genre(spark, folder):
    lines = _model(spark, folder).described_lines().filter(F.col("genre").isNotNull())
    return _in_money(medians.exact_median(lines, ["genre"], "cents", MEDIAN_SORTABLE))


@_query
def median_purchase_country(spark, folder):
    sold = core.sold_invoices(_set(spark, folder), LONG, country=True)
    return _in_money(medians.exact_median(sold, ["country"], "cents", MEDIAN_SORTABLE))


@_query
def median_purchase(spark, folder):
    return _in_money(medians.exact_median(core.sold_invoices(_set(spark, folder), LONG), [], "cents", MEDIAN_SORTABLE))


@_query
def median_gaps(spark, folder):
    """The median gaps of the retention summary, all from one table of values."""
    customers = behaviour.behaviour_of(_set(spark, folder), YEAR)
    names = ("gap_life", "gap_window", "gap_winback", "gap_retention")
    gaps = customers.select(F.inline(F.array(*[F.struct(F.lit(name).alias("gap"), F.col(name).alias("days")) for name in names])))
    return medians.exact_median(gaps, ["gap"], "days", MEDIAN_SORTABLE)


# Reports in their documented order, stored by ranges, with the position of every row

# Query, and the report whose order it has.
ORDERED = {
    "events_all": "events",
    "ts_monthly": "monthly",
    "geo_yearly": "geo",
    "group_kpis_artist": "groups",
    "group_kpis_country": "groups",
    "group_yearly_genre": "yearly_genre",
    "group_yearly_artist": "yearly_artist",
    "cohort_matrix": "cohorts",
    "retention_decay": "decay",
    "topn_artist": "top",
    "group_bar_artist": "bars",
}


def _positions(name: str, report: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        def write(path: str) -> None:
            write_ordered(_QUERIES[name](spark, folder), report, path)

        return read_ordered(spark, _stored_once(spark, folder, f"ordered {name}", write))

    return run


_QUERIES.update({f"ordered_{name}": _positions(name, report) for name, report in ORDERED.items()})


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
