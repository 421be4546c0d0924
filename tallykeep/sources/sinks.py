"""Result sinks: ordered reports, reports with positions, CSV export and temporary views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns each report is sorted by. Operators leave their rows unsorted; only what
# leaves the engine is put in order, missing values last.
ORDER = {
    "monthly": ("month",),
    "geo": ("year", "country"),
    "groups": ("group_val",),
    "yearly_genre": ("year", "genre"),
    "yearly_artist": ("year", "artist"),
    "cohorts": ("cohort_month", "month_offset"),
    "decay": ("month_offset",),
    "choices": ("kind", "value"),
    "top": ("metric", "rank"),
    "bars": ("-total_metric", "year", "genre", "artist"),
    "events": ("dt", "InvoiceId"),
}

# The reports offered as files.
EXPORTS = ("monthly", "geo", "yearly_genre", "yearly_artist", "cohorts", "decay")


def sort_keys(df: DataFrame, report: str) -> list[Column]:
    """The documented order of a report; a leading minus sorts downwards."""
    keys = []
    for name in ORDER[report]:
        if name.lstrip("-") in df.columns:
            column = F.col(name.lstrip("-"))
            keys.append(column.desc_nulls_last() if name.startswith("-") else column.asc_nulls_last())
    return keys


def ordered(df: DataFrame, report: str) -> DataFrame:
    """The rows of a report in its documented order."""
    return df.orderBy(*sort_keys(df, report))


# Where a stored row stands: its range, and its place in there.
_RANGE, _PLACE = "_range", "_place"
# The bits of a generated id that number the rows of one task.
_ROW_BITS = 33


def write_ordered(df: DataFrame, report: str, path: str) -> None:
    """Store a report of any size in its order, replacing ``path``; :func:`read_ordered` numbers the rows.

    The rows are dealt by ranges of the sort keys and sorted within a range; every range is
    written by a task of its own, with the place of each row in it. No task sees all rows.
    """
    keys = sort_keys(df, report)
    sorted_ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    placed = sorted_ranges.withColumns(
        {_RANGE: F.shiftright(number, _ROW_BITS), _PLACE: number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}
    )
    placed.write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A report of :func:`write_ordered` with ``position``, counted from 1 over all rows.

    The rows before a range come from one count per range, the only rows that meet in one
    task. A page is ``position BETWEEN``; rows of equal keys have some order of their own.
    """
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(_RANGE, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    position = (F.col("before") + F.col(_PLACE) + 1).alias("position")
    return rows.join(before, _RANGE).select(*[name for name in rows.columns if name not in (_RANGE, _PLACE)], position)


def settled(report: DataFrame) -> DataFrame:
    """A report computed now, free of what it was read from.

    For results of bounded size only (KPI blocks, top-N tables): their rows pass through the driver.
    """
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header line and no row names, replacing ``path``.

    ``single_file`` is for report-sized results (months, cohorts, countries).
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def export_report(df: DataFrame, report: str, folder: str) -> str:
    """Write one of ``EXPORTS`` as a sorted CSV file in ``<folder>/<report>``; returns that path."""
    if report not in EXPORTS:
        raise ValueError(f"report must be one of {EXPORTS}, not {report!r}")
    path = f"{folder.rstrip('/')}/{report}"
    export_csv(ordered(df, report), path, single_file=True)
    return path


def publish_view(df: DataFrame, name: str) -> None:
    """Make a frame queryable by name, replacing an earlier one."""
    df.createOrReplaceTempView(name)
