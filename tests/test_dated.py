"""The layout by month: what its plans read, and that it gives the same results."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from store import dicts, one_line_each, store
from tallykeep.operators import core, groups, timeseries
from tallykeep.operators.filters import SalesFilter
from tallykeep.operators.scope import all_invoices, working_set
from tallykeep.sources import dated
from tallykeep.sources.star import read_star

FOLDER = "/root/testdata/sf0.01"
YEAR = ("1997-01-01", "1997-12-31")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dated"))
    dated.write_dated(read_star(spark, FOLDER), path, line_files=24, group_bytes=1 << 16)
    return dated.read_dated(spark, path, paired_dimensions=True)


def scans(frame):
    """Per scanned folder the partition filters of a plan."""
    text = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    found = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/(\w+)\].*?(?=\n\n|\Z)", text, re.S)
    blocks = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/(\w+)\](.*?)ReadSchema", text, re.S)
    assert len(found) >= len(blocks) > 0
    return [(name, "PartitionFilters: [isnotnull(month" in rest) for name, rest in blocks]


@pytest.mark.parametrize(
    "report",
    [
        lambda s: timeseries.monthly_summary(s, YEAR),
        lambda s: core.purchase_kpis(s, YEAR),
        lambda s: core.customer_kpis(s, YEAR),
        lambda s: core.core_kpis(s, YEAR),
        lambda s: groups.group_kpis(s, "Genre", YEAR),
        lambda s: groups.group_kpis(s, "Artist", YEAR),
        lambda s: groups.group_kpis(s, "BillingCountry", YEAR),
    ],
)
@pytest.mark.parametrize("scope", [working_set, all_invoices])
def test_facts_are_read_by_their_months_only(stored, report, scope):
    facts = [(name, pruned) for name, pruned in scans(report(scope(stored))) if name in ("invoices", "lines")]
    assert facts and all(pruned for _, pruned in facts)


def test_reports_of_invoices_read_no_lines(stored):
    for report in (timeseries.monthly_summary, core.purchase_kpis, core.customer_kpis, core.core_kpis):
        assert "lines" not in {name for name, _ in scans(report(working_set(stored), YEAR))}


def test_a_filter_by_date_prunes_the_working_set(stored):
    events = working_set(stored, SalesFilter(genre=["ECONOMY"], date_range=YEAR)).events()
    assert {name: pruned for name, pruned in scans(events)} == {"invoices": True, "lines": True}


def rows_read(frame):
    """Rows the only scan of a plan handed on; row groups that were skipped are not among them."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_row_groups_without_the_artist_are_skipped(spark, tmp_path):
    """A month with many row groups, as it has at scale: a filter reads little but its own lines."""
    model = read_star(spark, FOLDER)
    one_month = F.lit("1997-05-10").cast("date").alias("dt")
    headers = model.headers.select("InvoiceId", "CustomerId", one_month)
    model = replace(model, headers=headers, billed=headers.withColumn("country", F.lit("Peru")))
    dated.write_dated(model, str(tmp_path), line_files=4, group_bytes=8192)
    lines = dated.read_dated(spark, str(tmp_path)).described
    everything = lines.count()
    for name, value in (("artist", "Brand#1"), ("genre", "ECONOMY")):
        wanted = lines.filter(F.col(name) == value).select("InvoiceId")
        assert wanted.count() <= rows_read(wanted) < wanted.count() + everything / 10, name


def test_undated_and_empty_stores(spark, tmp_path):
    sales = [(1, 1, "2020-01-05", "Peru"), (2, 1, "2020-03-05", "Peru"), (3, None, "2020-03-09", "Chile"), (4, 2, "2020-03-09", None)]
    for number, invoices in enumerate((sales, [])):
        model = store(spark, invoices, one_line_each(invoices[:3]))
        path = str(tmp_path / str(number))
        dated.write_dated(model, path)
        again = dated.read_dated(spark, path)
        march = ("2020-03-01", "2020-03-31")
        for scope in (working_set, all_invoices):
            for report in (timeseries.monthly_summary, core.purchase_kpis, core.customer_kpis, core.core_kpis):
                assert dicts(report(scope(again), march)) == dicts(report(scope(model), march))


def test_ranges_of_lines_follow_their_stored_size(spark, tmp_path, monkeypatch):
    """What a task sorts must not grow with the tables that a query is given."""
    from tallykeep.registry import queries

    asked = {}
    monkeypatch.setattr(queries.dated, "write_dated", lambda model, path, **given: asked.update(given))
    monkeypatch.setattr(queries.dated, "read_dated", lambda *_, **__: None)
    monkeypatch.setattr(queries, "_STORES", {})
    monkeypatch.setattr(dated, "FILE_BYTES", 10_000)
    queries._dated(spark, FOLDER)
    assert asked["line_files"] > 50


def test_a_month_of_invoices_is_one_file_until_it_is_large(spark, tmp_path):
    import os

    model = read_star(spark, FOLDER)
    dated.write_dated(model, str(tmp_path), line_files=64)
    months = [m for m in os.listdir(tmp_path / "invoices") if m.startswith("month=")]
    assert len(months) > 12
    assert all(len([f for f in os.listdir(tmp_path / "invoices" / m) if f.endswith(".parquet")]) == 1 for m in months)
