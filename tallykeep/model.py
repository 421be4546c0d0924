"""The four frames all operators are written against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange


def rolled_up(described: DataFrame) -> DataFrame:
    """InvoiceId, num_lines, qty, cents, and whether a line has both genre and artist."""
    usable = F.col("genre").isNotNull() & F.col("artist").isNotNull()
    return described.groupBy("InvoiceId").agg(
        F.count(F.lit(1)).alias("num_lines"),
        F.sum("qty").alias("qty"),
        F.sum("cents").alias("cents"),
        F.max(usable).alias("usable"),
    )


@dataclass(frozen=True)
class SalesModel:
    """Invoices, their lines and the track dimension, all lazy.

    ``headers``   InvoiceId, CustomerId, dt (DATE); one row per invoice
    ``billed``    the same rows plus country (NULL when unknown)
    ``lines``     InvoiceId, TrackId, qty BIGINT, cents BIGINT
    ``tracks``    TrackId, genre, artist; one row per track, NULL where unknown
    ``genres``    genre; every genre name, sold or not
    ``artists``   artist; every artist name, sold or not
    ``countries`` country; every country an invoice was billed to

    ``headers`` exists next to ``billed`` because the country may cost a join that
    most operators have no use for. Money is kept in whole cents: BIGINT sums are
    exact and stay in generated code.

    ``paired_dimensions`` states that a track has a genre exactly when it has an
    artist, so a line with either is a usable line.

    ``described`` optionally holds ``lines`` with genre and artist already attached
    (see :mod:`tallykeep.sources.layout`), and ``rollup`` what :func:`rolled_up` makes of
    them: results that need no more than that of the lines then read no line.

    ``summed`` optionally holds ``billed`` with those totals, an invoice without lines with
    NULLs; ``firsts`` CustomerId, first_any, first_usable: the first dates of a customer among all
    invoices and among those with a usable line; ``limit`` the same model with no facts
    outside the whole months of a range (see :mod:`tallykeep.sources.dated`).
    """

    spark: SparkSession
    headers: DataFrame
    billed: DataFrame
    lines: DataFrame
    tracks: DataFrame
    genres: DataFrame
    artists: DataFrame
    countries: DataFrame
    paired_dimensions: bool = False
    described: DataFrame | None = None
    rollup: DataFrame | None = None
    summed: DataFrame | None = None
    firsts: DataFrame | None = None
    limit: Callable[[DateRange], "SalesModel"] | None = None

    def invoices(self, country: bool = False) -> DataFrame:
        return self.billed if country else self.headers

    def described_lines(self) -> DataFrame:
        """Lines with genre and artist; a line of an unknown track keeps NULLs.

        No broadcast hint: the track dimension grows with the catalog, so the
        choice is left to the size check of Catalyst and AQE.
        """
        if self.described is not None:
            return self.described
        return self.lines.join(self.tracks, "TrackId", "left")

    def lines_of(self, invoices: DataFrame) -> DataFrame:
        """Described lines of the given invoices, with the invoices' columns.

        On raw tables the invoices come first: a date range or filter on them spares
        most lines the search for their track.
        """
        if self.described is not None:
            return self.described.join(invoices, "InvoiceId")
        return self.lines.join(invoices, "InvoiceId").join(self.tracks, "TrackId", "left")

    def line_totals(self) -> DataFrame:
        """InvoiceId, num_lines, qty, cents over all lines of each invoice."""
        if self.rollup is not None:
            return self.rollup.drop("usable")
        if self.summed is not None:
            return self.summed.filter("num_lines IS NOT NULL").select("InvoiceId", "num_lines", "qty", "cents")
        return self.lines.groupBy("InvoiceId").agg(
            F.count(F.lit(1)).alias("num_lines"),
            F.sum("qty").alias("qty"),
            F.sum("cents").alias("cents"),
        )
