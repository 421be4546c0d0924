"""The invoice set an operator looks at: all invoices, or a filtered working set.

Filters pick whole invoices: an invoice with one matching line keeps all its lines
in every later measure. An invoice without a usable line (one whose track has both
a genre and an artist) is in the full set but never in a working set.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.functions.dates import DateRange
from tallykeep.model import SalesModel
from tallykeep.operators.filters import SalesFilter, keep_all
from tallykeep.session import remove_folder, shared_folder

TOTALS = ("num_lines", "qty", "cents")


@dataclass(frozen=True)
class Scope:
    """``flt`` None means every invoice. ``stored`` holds a materialised working set.

    ``folder`` is where :meth:`stage` wrote it.
    """

    model: SalesModel
    flt: SalesFilter | None = None
    stored: DataFrame | None = None
    folder: str | None = None

    def invoices(self, country: bool = False, totals: bool = False) -> DataFrame:
        """InvoiceId, CustomerId, dt and, on request, country and line totals.

        Totals (num_lines, qty, cents) cover all lines of the invoice and are NULL
        for an invoice without lines.
        """
        wanted = ["InvoiceId", "CustomerId", "dt"]
        wanted += ["country"] if country else []
        wanted += list(TOTALS) if totals else []
        if self.stored is not None:
            return self.stored.select(*wanted)
        if self._facts.summed is not None:
            found = self._summed()
        elif self.flt is None:
            found = self.model.invoices(country)
            if totals:
                found = found.join(self.model.line_totals(), "InvoiceId", "left")
        else:
            found = self._candidates(country).join(self._kept(totals), "InvoiceId")
        return found.select(*wanted)

    def invoices_for_lines(self, country: bool = False) -> DataFrame:
        """Invoices for a result made of lines of known genre or artist only.

        Where such a line is itself proof that the invoice belongs to the working
        set, the pass over the lines that looks for one is left out.
        """
        implied = (
            self.stored is None
            and self.flt is not None
            and self.model.paired_dimensions
            and not self.flt.line_predicates()
        )
        if not implied:
            return self.invoices(country)
        wanted = ["InvoiceId", "CustomerId", "dt"] + (["country"] if country else [])
        return self._candidates(country).select(*wanted)

    def limited(self, date_range: DateRange | None) -> "Scope":
        """This scope with no invoice or line outside the whole months of a range, where the
        store can leave them unread; else, and without a range, the scope itself."""
        if date_range is None or self.stored is not None or self.model.limit is None:
            return self
        return replace(self, model=self.model.limit(date_range))

    def first_dates(self) -> DataFrame | None:
        """CustomerId, first_dt: everyone's first purchase in the scope, where the store knows it."""
        if self.stored is not None or self.model.firsts is None:
            return None
        if self.flt is None:
            return self.model.firsts.select("CustomerId", F.col("first_any").alias("first_dt"))
        if self.flt.invoice_predicates() or self.flt.line_predicates():
            return None
        usable = self.model.firsts.filter(F.col("first_usable").isNotNull())
        return usable.select("CustomerId", F.col("first_usable").alias("first_dt"))

    def events(self) -> DataFrame:
        """The working set as (CustomerId, dt, InvoiceId), one row per invoice."""
        return self.invoices().select("CustomerId", "dt", "InvoiceId")

    def persist(self) -> "Scope":
        """Keep the set in executor memory, spilling to disk; lost blocks are recomputed."""
        if self.stored is not None:
            return self
        rows = self.invoices(country=True, totals=True)
        return replace(self, stored=rows.persist(StorageLevel.MEMORY_AND_DISK))

    def stage(self) -> "Scope":
        """Write the set to the shared folder and read it back.

        For reports that use one working set many times: the lines are visited
        once, the files outlive lost executors and are read column by column.
        """
        if self.stored is not None:
            return self
        spark = self.model.spark
        path = shared_folder(spark)
        self.invoices(country=True, totals=True).write.parquet(path)
        return replace(self, stored=spark.read.parquet(path), folder=path)

    def release(self) -> None:
        """Give back what :meth:`persist` or :meth:`stage` holds, once no result needs it."""
        if self.folder is not None:
            remove_folder(self.model.spark, self.folder)
        elif self.stored is not None:
            self.stored.unpersist()

    @contextmanager
    def held(self, on_disk: bool = False) -> Iterator["Scope"]:
        """The set kept by :meth:`persist` (or :meth:`stage`) for a block, and given back at its end.

        What the block returns must no longer depend on it: written, or a report that
        :func:`tallykeep.sources.sinks.settled` holds.
        """
        kept = self.stage() if on_disk else self.persist()
        try:
            yield kept
        finally:
            if self.stored is None:
                kept.release()

    @property
    def _facts(self) -> SalesModel:
        """The model, without months that the filter leaves out."""
        dated = self.flt is not None and self.flt.date_range is not None and self.model.limit is not None
        return self.model.limit(self.flt.date_range) if dated else self.model

    def _summed(self) -> DataFrame:
        """Invoices with their totals from the store; lines are read for genre and artist only."""
        found = self._facts.summed
        if self.flt is None:
            return found
        found = keep_all(found, self.flt.invoice_predicates()).filter("usable")
        if not self.flt.line_predicates():
            return found
        return found.join(self._matching().select("InvoiceId"), "InvoiceId", "left_semi")

    def _matching(self) -> DataFrame:
        """Lines that prove an invoice to be in the working set."""
        usable = [F.col("genre").isNotNull(), F.col("artist").isNotNull()]
        return self._facts.described_lines().filter(reduce(and_, usable + self.flt.line_predicates()))

    def _candidates(self, country: bool) -> DataFrame:
        source = self._facts.invoices(country or self.flt.needs_country)
        return keep_all(source, self.flt.invoice_predicates())

    def _kept(self, totals: bool) -> DataFrame:
        """InvoiceId (and totals) of the invoices with a line that satisfies the filter.

        Both forms aggregate per invoice before anything is shuffled, so an invoice
        with very many lines arrives as one row per task.
        """
        if self.model.rollup is not None and not self.flt.line_predicates():
            found = self.model.rollup.filter("usable").drop("usable")
            return found if totals else found.select("InvoiceId")
        usable = [F.col("genre").isNotNull(), F.col("artist").isNotNull()]
        matches: Column = reduce(and_, usable + self.flt.line_predicates())
        lines = self.model.described_lines()
        if not totals:
            return lines.filter(matches).select("InvoiceId").distinct()
        return (
            lines.groupBy("InvoiceId")
            .agg(
                F.count(F.lit(1)).alias("num_lines"),
                F.sum("qty").alias("qty"),
                F.sum("cents").alias("cents"),
                F.max(F.coalesce(matches, F.lit(False))).alias("kept"),
            )
            .filter("kept")
            .drop("kept")
        )


def all_invoices(model: SalesModel) -> Scope:
    """Every invoice, with or without lines."""
    return Scope(model)


def working_set(model: SalesModel, flt: SalesFilter | None = None) -> Scope:
    """The invoices with at least one usable line that satisfies the filter."""
    return Scope(model, flt or SalesFilter())
