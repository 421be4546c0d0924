"""Which invoices are looked at, and over which dates."""

import os
from datetime import date

import pytest

from store import dicts, keyed, one_line_each, only, store
from tallykeep.operators import core, groups, timeseries
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set

MIXED = [(1, 10, "2020-01-05", "USA"), (2, 11, "2020-01-06", "USA"), (3, 10, "2020-02-01", "Peru")]
MIXED_LINES = [(1, 1, 2), (1, 3, 1), (2, 3, 4), (3, 2, 1)]


def ids(scope):
    return sorted(row["InvoiceId"] for row in dicts(scope.events()))


def test_filter_keeps_whole_invoices(spark):
    model = store(spark, MIXED, MIXED_LINES)
    scope = working_set(model, SalesFilter(genre=["Rock"], country=["USA"]))
    assert ids(scope) == [1]
    # the Jazz line of the invoice still counts
    assert only(core.revenue_kpis(scope))["total_revenue"] == pytest.approx(3 * 0.99)
    assert set(keyed(groups.group_kpis(scope, "Genre"), "group_val")) == {"Rock", "Jazz"}


def test_genre_and_artist_must_meet_on_one_line(spark):
    model = store(spark, MIXED, MIXED_LINES)
    # invoice 1 has a Rock line (Ann) and a Jazz line (Bob), but no Rock line by Bob
    assert ids(working_set(model, SalesFilter(genre=["Rock"], artist=["Bob"]))) == []
    assert ids(working_set(model, SalesFilter(genre=["Jazz"], artist=["Bob"]))) == [1, 2]


def test_empty_filter_means_no_restriction(spark):
    model = store(spark, MIXED, MIXED_LINES)
    assert ids(working_set(model, SalesFilter(country=[], genre=None, artist=()))) == [1, 2, 3]
    assert ids(working_set(model, SalesFilter(country="Peru"))) == [3]
    assert ids(working_set(model, SalesFilter(country=["x' OR '1'='1"]))) == []


def test_date_filter_is_rounded_to_months(spark):
    model = store(spark, MIXED, MIXED_LINES)
    assert ids(working_set(model, SalesFilter(date_range=("2020-01-31", "2020-01-31")))) == [1, 2]


def test_invoices_without_usable_line(spark):
    """Line-less invoices and lines without genre or artist: in the full data only."""
    invoices = [
        (1, 10, "2020-01-05", "USA"),  # no line
        (2, 10, "2020-02-05", "USA"),  # track without album, so without artist
        (3, 10, "2020-03-05", "USA"),  # track without genre
        (4, 10, "2020-04-05", "USA"),
    ]
    model = store(spark, invoices, [(2, 6, 1), (3, 7, 1), (4, 1, 1)])
    everything, chosen = all_invoices(model), working_set(model)
    assert ids(everything) == [1, 2, 3, 4]
    assert ids(chosen) == [4]
    # orders count invoices with lines
    assert only(core.purchase_kpis(everything))["total_orders"] == 3
    # by genre, the track without artist counts; by artist, the one without genre
    assert only(groups.group_kpis(everything, "Genre"))["num_purchases"] == 2
    artists = keyed(groups.group_kpis(everything, "Artist"), "group_val")
    assert {name: row["num_purchases"] for name, row in artists.items()} == {"Ann": 1, "Cid": 1}
    # new in April as far as the working set knows, in January for all invoices
    april = ("2020-04-01", "2020-04-30")
    assert only(core.customer_kpis(chosen, april))["pct_new_customers"] == 1.0
    assert only(core.customer_kpis(everything, april))["pct_new_customers"] == 0.0


def test_three_date_policies(spark):
    invoices = [(1, 10, "2020-01-02", "USA"), (2, 11, "2020-01-20", "USA"), (3, 12, "2020-02-28", "USA")]
    scope = working_set(store(spark, invoices, one_line_each(invoices)))
    window = ("2020-01-10", "2020-02-10")
    # money and orders: whole months
    assert only(core.purchase_kpis(scope, window))["total_orders"] == 3
    # customers and months: as given
    assert only(core.customer_kpis(scope, window))["total_customers"] == 1
    assert [row["month"] for row in dicts(timeseries.monthly_summary(scope, window))] == ["2020-01"]
    # the order of the two ends does not matter
    assert only(core.purchase_kpis(scope, window[::-1]))["total_orders"] == 3


def test_first_time_definitions_differ(spark):
    invoices = [
        (1, 10, "2019-12-01", "USA"),
        (2, 10, "2020-01-10", "USA"),
        (3, 10, "2020-01-20", "USA"),
        (4, 11, "2020-01-15", "USA"),
    ]
    lines = [(1, 1, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1)]
    scope = working_set(store(spark, invoices, lines))
    january = ("2020-01-01", "2020-01-31")
    # first purchase ever in the range: only customer 11
    assert only(core.customer_kpis(scope, january)) == {"total_customers": 2, "pct_new_customers": 0.5}
    # first day within the range: customer 10 for Rock, 11 for Jazz
    table = keyed(groups.group_kpis(scope, "Genre", january), "group_val")
    assert table["Rock"]["first_time_customers"] == 1
    assert table["Jazz"]["first_time_customers"] == 1
    assert table["Jazz"]["num_customers"] == 2
    # month of the first purchase of the whole working set
    assert only(timeseries.monthly_summary(scope, january))["first_time_customers"] == 1


def test_first_month_counts_although_the_first_day_is_outside(spark):
    invoices = [(1, 10, "2020-01-05", "USA"), (2, 10, "2020-01-15", "USA")]
    scope = working_set(store(spark, invoices, one_line_each(invoices)))
    row = only(timeseries.monthly_summary(scope, ("2020-01-10", "2020-01-31")))
    assert (row["num_purchases"], row["first_time_customers"]) == (1, 1)


def test_empty_range(spark):
    model = store(spark, MIXED, MIXED_LINES)
    never = ("2014-01-01", "2014-01-01")
    for scope in (all_invoices(model), working_set(model)):
        assert dicts(core.revenue_kpis(scope, never)) == []
        assert only(core.customer_kpis(scope, never)) == {"total_customers": 0, "pct_new_customers": 0.0}
        assert only(core.purchase_kpis(scope, never)) == {
            "total_orders": 0,
            "avg_rev_per_order": None,
            "total_tracks": None,
            "avg_tracks_per_order": None,
        }
        assert set(only(core.subset_metadata(scope, never)).values()) == {0}
        assert dicts(groups.group_kpis(scope, "Genre", never)) == []
        assert dicts(core.core_kpis(scope, never)) == []


def test_core_kpis_equal_their_blocks(spark):
    invoices = [(i, i % 4, f"2020-0{1 + i % 6}-{10 + i}", "USA") for i in range(12)]
    lines = [(i, 1 + (i + k) % 5, 1 + k) for i in range(10) for k in range(1 + i % 3)]
    model = store(spark, invoices, lines)
    for scope in (all_invoices(model), working_set(model, SalesFilter(genre=["Jazz"]))):
        for window in (None, ("2020-02-14", "2020-05-03")):
            expected = {
                **only(core.revenue_kpis(scope, window)),
                **only(core.customer_kpis(scope, window)),
                **only(core.purchase_kpis(scope, window)),
            }
            assert only(core.core_kpis(scope, window)) == expected


@pytest.mark.parametrize("keep", ["persist", "stage"])
def test_materialised_scope_gives_the_same(spark, keep):
    model = store(spark, MIXED, MIXED_LINES)
    lazy = working_set(model, SalesFilter(genre=["Rock"]))
    kept = getattr(lazy, keep)()
    assert ids(kept) == ids(lazy)
    assert dicts(groups.group_kpis(kept, "BillingCountry").orderBy("group_val")) == dicts(
        groups.group_kpis(lazy, "BillingCountry").orderBy("group_val")
    )
    assert getattr(kept, keep)() is kept
    kept.release()
    if keep == "persist":
        assert not kept.stored.is_cached
    else:
        assert not os.path.exists(kept.folder)
    lazy.release()


def test_events_columns(spark):
    scope = working_set(store(spark, MIXED, MIXED_LINES))
    assert scope.events().columns == ["CustomerId", "dt", "InvoiceId"]
    assert dicts(scope.events().filter("InvoiceId = 3"))[0]["dt"] == date(2020, 2, 1)


def test_unknown_group_is_refused(spark):
    scope = working_set(store(spark, MIXED, MIXED_LINES))
    with pytest.raises(ValueError):
        groups.group_kpis(scope, "Album")
    with pytest.raises(ValueError):
        timeseries.monthly_summary(scope, ("2020-01-01",))
