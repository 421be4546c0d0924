"""Cohorts, decay and customer behaviour."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from store import day, dicts, keyed, one_line_each, only, store
from tallykeep.operators import behaviour, cohorts
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set

WINDOW = ("2020-03-10", "2020-05-20")


def scope_of(spark, purchases, **flt):
    """``purchases``: customer -> dates; every invoice has one Rock line."""
    invoices = [
        (number, customer, text, "USA")
        for number, (customer, text) in enumerate(
            ((c, text) for c, texts in purchases.items() for text in texts), start=1
        )
    ]
    model = store(spark, invoices, one_line_each(invoices))
    return working_set(model, SalesFilter(**flt)) if flt else working_set(model)


def test_offsets_count_month_boundaries(spark):
    scope = scope_of(spark, {1: ["2020-01-31", "2020-02-01", "2020-04-30"]})
    rows = keyed(cohorts.cohort_retention(scope, None), "month_offset")
    # the scope spans two whole months (31 January to 30 April), so offset 3 is cut
    assert set(rows) == {1}
    assert set(keyed(cohorts.cohort_retention(scope, None, 12), "month_offset")) == {1, 3}
    assert rows[1]["cohort_month"] == date(2020, 1, 1)


def test_cohorts_come_from_all_invoices(spark):
    invoices = [
        (1, 10, "2020-01-05", "USA"),  # no line, yet it starts the cohort
        (2, 10, "2020-02-05", "USA"),
        (3, 11, "2020-01-07", "Peru"),
        (4, 11, "2020-03-07", "USA"),
        (5, 12, "2020-01-09", "Peru"),
    ]
    model = store(spark, invoices, one_line_each(invoices[1:]))
    scope = working_set(model, SalesFilter(country="USA"))
    rows = keyed(cohorts.cohort_retention(scope, ("2020-01-01", "2020-12-31"), 12), "month_offset")
    assert {k: (r["num_active_customers"], r["cohort_size"]) for k, r in rows.items()} == {1: (1, 3), 2: (1, 3)}
    # range limits are taken as given
    late = cohorts.cohort_retention(scope, ("2020-02-06", "2020-12-31"), 12)
    assert set(keyed(late, "month_offset")) == {2}


def test_decay_base_is_the_active_customers(spark):
    scope = scope_of(spark, {1: ["2020-01-05", "2020-02-05"], 2: ["2020-01-05"], 3: ["2020-02-10", "2020-04-10"]})
    rows = keyed(cohorts.retention_decay(scope, None), "month_offset")
    assert {k: (r["num_retained"], r["num_customers"]) for k, r in rows.items()} == {1: (1, 3), 2: (1, 3)}
    window = keyed(cohorts.retention_decay(scope, ("2020-02-01", "2020-02-28")), "month_offset")
    assert {k: (r["num_retained"], r["num_customers"]) for k, r in window.items()} == {1: (1, 2)}


def test_decay_base_ignores_offsets_beyond_the_limit(spark):
    scope = scope_of(spark, {1: ["2020-01-05", "2020-06-05"], 2: ["2020-01-05", "2020-02-05", "2020-06-05"]})
    window = ("2020-02-01", "2020-12-31")
    # customer 1 is active at offset 5 only
    assert only(cohorts.retention_decay(scope, window, 2))["num_customers"] == 1
    assert {r["num_customers"] for r in dicts(cohorts.retention_decay(scope, window, 5))} == {2}


def test_empty_scope_has_no_cohort_rows(spark):
    scope = scope_of(spark, {1: ["2020-01-05", "2020-02-05"]}, country="Peru")
    assert dicts(cohorts.cohort_retention(scope, None)) == []
    assert dicts(cohorts.retention_decay(scope, None)) == []
    assert dicts(cohorts.cohort_grid(cohorts.cohort_retention(scope, None))) == []
    assert set(only(cohorts.best_cohorts(cohorts.cohort_retention(scope, None))).values()) == {None}


COHORT_SCHEMA = "cohort_month date, month_offset int, num_active_customers long, cohort_size long, retention_pct double"


def test_grid_fills_months_and_offsets(spark):
    rows = [(day("2020-01-01"), 2, 1, 4, 0.25), (day("2020-04-01"), 4, 1, 2, 0.5)]
    grid = keyed(cohorts.cohort_grid(spark.createDataFrame(rows, COHORT_SCHEMA)), "cohort_month", "month_offset")
    assert set(grid) == {(date(2020, m, 1), k) for m in (1, 2, 3, 4) for k in (2, 3, 4)}
    assert grid[date(2020, 4, 1), 4]["retention_pct"] == 0.5
    assert grid[date(2020, 2, 1), 3]["cohort_size"] is None


def test_best_cohort_prefers_the_earlier_of_equals(spark):
    rows = [
        (day("2020-05-01"), 3, 1, 2, 0.5),
        (day("2020-02-01"), 3, 2, 4, 0.5),
        (day("2020-01-01"), 3, 1, 4, 0.25),
        (day("2020-01-01"), 6, 1, 3, 1 / 3),
    ]
    best = only(cohorts.best_cohorts(spark.createDataFrame(rows, COHORT_SCHEMA)))
    assert best == {
        "top_cohort_month_3": "Feb 2020",
        "top_cohort_retention_3": "50.00%",
        "top_cohort_month_6": "Jan 2020",
        "top_cohort_retention_6": "33.33%",
        "top_cohort_month_9": None,
        "top_cohort_retention_9": None,
    }


# customer: purchases outside the window (none, before, after, both), one or two inside
FOUR_TIMES_TWO = {
    1: ["2020-03-20"],
    2: ["2020-03-20", "2020-05-01"],
    3: ["2020-01-20", "2020-03-20"],
    4: ["2020-01-20", "2020-03-20", "2020-05-01"],
    5: ["2020-03-20", "2020-06-28"],
    6: ["2020-03-20", "2020-05-01", "2020-06-28"],
    7: ["2020-01-20", "2020-03-20", "2020-06-28"],
    8: ["2020-01-20", "2020-03-20", "2020-05-01", "2020-06-28"],
}
DERIVED = {
    # new, conv, window, life_total, life_window, gap_window, winback, retention, gap_life, bound
    1: (True, True, False, None, None, None, None, None, None, None),
    2: (True, True, True, 2, 2, 42, None, None, 42.0, 42.0),
    3: (False, False, False, 2, 0, None, 60, None, 60.0, 60.0),
    4: (False, False, True, 4, 2, 42, 60, None, 51.0, 51.0),
    5: (True, False, False, 3, 2, None, None, 100, 100.0, 100.0),
    6: (True, True, True, 3, 2, 42, None, 58, 50.0, 50.0),
    7: (False, False, False, 5, 2, None, 60, 100, 80.0, 80.0),
    8: (False, False, True, 5, 2, 42, 60, 58, 160 / 3, 160 / 3),
}


def test_behaviour_for_all_surroundings(spark):
    rows = keyed(behaviour.behaviour_of(scope_of(spark, FOUR_TIMES_TWO), WINDOW), "CustomerId")
    found = {
        customer: (
            row["cust_new"],
            row["repeat_conv"],
            row["repeat_window"],
            row["lifespan_mo_total"],
            row["lifespan_mo_window"],
            row["gap_window"],
            row["gap_winback"],
            row["gap_retention"],
            row["avg_gap_life"],
            row["avg_gap_bound"],
        )
        for customer, row in rows.items()
    }
    assert found == DERIVED
    assert {c: row["repeat_ret"] for c, row in rows.items()} == {c: not d[0] for c, d in DERIVED.items()}
    assert {c: row["repeat_any"] for c, row in rows.items()} == {c: c != 1 for c in DERIVED}


def test_summary(spark):
    summary = only(behaviour.behaviour_summary(behaviour.behaviour_of(scope_of(spark, FOUR_TIMES_TWO), WINDOW)))
    assert (summary["num_cust"], summary["num_new"], summary["pct_new"]) == (8, 4, 0.5)
    assert (summary["ret_n_any"], summary["ret_n_return"], summary["ret_rate_return"]) == (7, 4, 1.0)
    assert (summary["ret_n_conv"], summary["ret_rate_conv"]) == (3, 0.75)
    assert (summary["ret_n_window"], summary["ret_rate_window"]) == (4, 0.5)
    assert summary["med_gap_winback"] == 60.0
    assert summary["med_gap_ret"] == 79.0
    assert summary["avg_life_mo_tot"] == pytest.approx(24 / 7)
    assert summary["avg_life_mo_win"] == pytest.approx(12 / 7)
    assert summary["avg_gap_window"] == 42.0


def test_several_purchases_on_one_day(spark):
    scope = scope_of(
        spark, {1: ["2020-01-01", "2020-01-01", "2020-04-01"], 2: ["2020-02-01", "2020-04-01", "2020-04-01", "2020-06-01"]}
    )
    rows = keyed(behaviour.customer_bounds(scope, WINDOW), "CustomerId")
    assert rows[1]["second_date"] == date(2020, 1, 1)
    assert rows[1]["second_in_window"] is None
    assert rows[2]["second_date"] == date(2020, 4, 1)
    assert rows[2]["second_in_window"] == date(2020, 4, 1)
    assert (rows[2]["num_in_window"], rows[2]["total_purchases"]) == (2, 4)


def test_window_defaults_to_the_scope(spark):
    scope = scope_of(spark, FOUR_TIMES_TWO)
    summary = only(behaviour.behaviour_summary(behaviour.behaviour_of(scope)))
    assert summary["num_cust"] == summary["num_new"] == summary["ret_n_conv"] == 8
    # nobody to return, nothing around the window
    assert summary["ret_rate_return"] is None and summary["med_gap_winback"] is None
    assert summary["avg_gap_bound"] == summary["avg_gap_window"] == summary["avg_gap_life"]


def test_retention_card(spark):
    scope = scope_of(spark, FOUR_TIMES_TWO)
    card = only(behaviour.retention_kpis(scope, WINDOW, cohorts.cohort_retention(scope, WINDOW)))
    assert len(card) == 26
    assert card["num_cust"] == "8" and card["pct_new"] == "50.00%" and card["med_gap_ret"] == "79.00"
    # of the January cohort (3, 4, 7, 8) two bought in May, but offset 4 has no column
    assert card["top_cohort_month_3"] is None
    other = behaviour.retention_kpis(scope, WINDOW, cohorts.cohort_retention(scope, WINDOW), offsets=(2, 4))
    assert only(other)["top_cohort_month_4"] == "Jan 2020"
    assert only(other)["top_cohort_retention_4"] == "50.00%"


def test_retention_card_without_customers(spark):
    scope = scope_of(spark, FOUR_TIMES_TWO)
    window = ("2014-01-01", "2014-04-01")
    assert dicts(behaviour.retention_kpis(scope, window, cohorts.cohort_retention(scope, window))) == []


def test_line_less_invoices_shape_full_data_only(spark):
    invoices = [(1, 10, "2020-01-05", "USA"), (2, 10, "2020-04-05", "USA")]
    model = store(spark, invoices, [(2, 1, 1)])
    full = only(behaviour.customer_bounds(all_invoices(model), WINDOW))
    chosen = only(behaviour.customer_bounds(working_set(model), WINDOW))
    assert (full["total_purchases"], full["last_before_window"]) == (2, date(2020, 1, 5))
    assert (chosen["total_purchases"], chosen["last_before_window"]) == (1, None)


def test_beside_keeps_one_row(spark):
    left, right = spark.range(1).select(F.lit(1).alias("a")), spark.range(0).select(F.lit(2).alias("b"))
    assert only(behaviour.beside(left, right)) == {"a": 1, "b": None}
