"""Purchases without a customer id: money and orders of nobody."""

import pytest

from store import dicts, keyed, one_line_each, only, store
from tallykeep.functions.countries import country_dimension
from tallykeep.operators import behaviour, cohorts, core, geo, groups, timeseries, yearly
from tallykeep.operators.scope import all_invoices, working_set

YEAR = ("2020-01-01", "2020-12-31")
INVOICES = [
    (1, 10, "2020-01-05", "USA"),
    (2, 10, "2020-03-05", "USA"),
    (3, None, "2019-11-07", "Peru"),
    (4, None, "2020-02-07", "Peru"),
    (5, None, "2020-04-07", "USA"),
]


@pytest.fixture(params=[working_set, all_invoices])
def scope(spark, request):
    return request.param(store(spark, INVOICES, one_line_each(INVOICES)))


def test_customers_are_counted_without_guests(scope):
    assert only(core.customer_kpis(scope, YEAR)) == {"total_customers": 1, "pct_new_customers": 1.0}


def test_core_keeps_the_guests_money_and_orders(scope):
    row = only(core.core_kpis(scope, YEAR))
    assert (row["total_customers"], row["pct_new_customers"], row["total_orders"]) == (1, 1.0, 4)
    assert row["total_revenue"] == pytest.approx(4 * 0.99)
    assert only(core.purchase_kpis(scope, YEAR))["total_orders"] == 4


def test_groups_keep_the_guests_purchases(scope):
    row = keyed(groups.group_kpis(scope, "Genre", YEAR), "group_val")["Rock"]
    assert (row["num_customers"], row["first_time_customers"]) == (1, 1)
    assert (row["num_purchases"], row["tracks_sold"]) == (4, 4)
    peru = keyed(groups.group_kpis(scope, "BillingCountry", YEAR), "group_val")["Peru"]
    assert (peru["num_customers"], peru["num_purchases"], peru["first_time_customers"]) == (0, 1, 0)


def test_yearly_groups_keep_the_guests_purchases(scope):
    rows = keyed(yearly.yearly_summary(scope, "Genre", ("2019-01-01", "2020-12-31")), "year")
    assert {year: (r["num_customers"], r["num_purchases"], r["first_time_customers"]) for year, r in rows.items()} == {
        "2019": (0, 1, 0),
        "2020": (1, 4, 1),
    }


def test_months_and_countries_leave_guests_out(scope):
    rows = keyed(timeseries.monthly_summary(scope, YEAR), "month")
    assert {month: (r["num_purchases"], r["num_customers"]) for month, r in rows.items()} == {
        "2020-01": (1, 1),
        "2020-03": (1, 1),
    }
    assert [r["country"] for r in dicts(geo.geo_metrics(scope, YEAR, "aggregate"))] == ["USA"]
    maps = geo.map_frames(scope, YEAR, country_dimension(scope.model.spark))
    assert {r["iso_alpha"] for r in dicts(maps)} == {"USA"}


def test_retention_knows_customers_only(scope):
    assert [r["CustomerId"] for r in dicts(behaviour.customer_bounds(scope, YEAR))] == [10]
    assert only(behaviour.behaviour_summary(behaviour.behaviour_of(scope, YEAR)))["num_cust"] == 1
    (row,) = dicts(cohorts.cohort_retention(scope, YEAR, 12))
    assert (row["month_offset"], row["cohort_size"], row["num_active_customers"]) == (2, 1, 1)
    (decay,) = dicts(cohorts.retention_decay(scope, YEAR, 12))
    assert (decay["month_offset"], decay["num_retained"], decay["num_customers"]) == (2, 1, 1)


def test_guests_dates_count_for_the_months_a_scope_spans(spark):
    invoices = [(1, 10, "2020-01-05", "USA"), (2, 10, "2020-06-05", "USA")]
    guest = (3, None, "2020-09-05", "USA")

    def offsets(rows):
        scope = working_set(store(spark, rows, one_line_each(rows)))
        return [r["month_offset"] for r in dicts(cohorts.cohort_retention(scope, ("2020-01-01", "2020-12-31")))]

    # without the guest the scope spans five months, which includes the offset as well
    assert offsets(invoices) == offsets([*invoices, guest]) == [5]


def test_only_guests(spark):
    rows = INVOICES[2:]
    scope = working_set(store(spark, rows, one_line_each(rows)))
    assert only(core.customer_kpis(scope, YEAR)) == {"total_customers": 0, "pct_new_customers": 0.0}
    for report in (
        behaviour.customer_bounds(scope, YEAR),
        cohorts.cohort_retention(scope, YEAR),
        cohorts.retention_decay(scope, YEAR),
        timeseries.monthly_summary(scope, YEAR),
    ):
        assert dicts(report) == []
