"""The shared KPI pipeline: every block of the dashboard for one scope."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange
from tallykeep.functions.display import format_kpi
from tallykeep.operators.behaviour import beside, retention_kpis
from tallykeep.operators.catalog import catalog_sales, enrich_with_catalog
from tallykeep.operators.core import core_kpis, subset_metadata
from tallykeep.operators.groups import GROUPS, TRACK_GROUPS, group_kpis
from tallykeep.operators.scope import Scope
from tallykeep.operators.topn import METRICS, Metric, format_top_groups, top_groups_by_metric


@dataclass(frozen=True)
class SharedKpis:
    """Every KPI block of one scope; a block's plan is made when it is asked for.

    ``core`` and ``metadata`` hold one row, ``topn`` one long frame per group.
    ``num_vals`` is (group, num_vals): the number of genres, artists and countries sold,
    as text. All are empty, or zero for metadata, when the scope sold nothing in the range.
    """

    scope: Scope
    cohorts: DataFrame
    date_range: DateRange | None = None
    metrics: Sequence[Metric] = METRICS
    top_n: int = 5
    offsets: Sequence[int] = (3, 6, 9)

    @cached_property
    def core(self) -> DataFrame:
        return core_kpis(self.scope, self.date_range)

    @cached_property
    def metadata(self) -> DataFrame:
        return subset_metadata(self.scope, self.date_range)

    @cached_property
    def topn(self) -> dict[str, DataFrame]:
        revenue = self.core.select("total_revenue")
        found = {}
        for group in GROUPS:
            table = full_group_table(self.scope, group, self.date_range)
            best = top_groups_by_metric(table, self.metrics, self.top_n)
            found[group] = format_top_groups(best, group, revenue.scalar())
        return found

    @cached_property
    def num_vals(self) -> DataFrame:
        return possible_values(self.metadata)

    @cached_property
    def retention(self) -> DataFrame:
        return retention_kpis(self.scope, self.date_range, self.cohorts, self.offsets)

    def one_row(self) -> DataFrame:
        """Core and metadata next to each other; no row when nothing was sold."""
        return beside(self.core, self.metadata).filter(F.col("total_revenue").isNotNull())


def full_group_table(scope: Scope, group: str, date_range: DateRange | None) -> DataFrame:
    """All groups with their KPIs, and catalog coverage for genre and artist."""
    table = group_kpis(scope, group, date_range)
    if group in TRACK_GROUPS:
        table = enrich_with_catalog(table, catalog_sales(scope, group, date_range))
    return table


def possible_values(metadata: DataFrame) -> DataFrame:
    """(group, num_vals) from :func:`subset_metadata`: a display text per dimension."""
    rows = [
        F.struct(F.lit(group).alias("group"), format_kpi(F.col(f"num_{group.lower()}")).alias("num_vals"))
        for group in GROUPS
    ]
    return metadata.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def shared_kpis(
    scope: Scope,
    cohorts: DataFrame,
    date_range: DateRange | None = None,
    metrics: Sequence[Metric] = METRICS,
    top_n: int = 5,
    offsets: Sequence[int] = (3, 6, 9),
) -> SharedKpis:
    """Lazy frames of every KPI block. A staged or persisted scope is read many times
    but computed once."""
    return SharedKpis(scope, cohorts, date_range, metrics, top_n, offsets)
