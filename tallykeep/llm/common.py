"""What the operators share: tables, free column names, materialised frames."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallykeep.llm.words import digest

# Rows of one Arrow batch. Texts are long, so Spark's default of 10,000 rows could
# make a batch of gigabytes.
ARROW_ROWS = "400"
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ARROW_DEFAULT = "10000"

# The white space that separates words: space, tab, line feed, vertical tab, form feed
# and carriage return, as characters of a Java regular expression class.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; reads with Spark only, so any store that Spark knows will do."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Prepare for Python workers: small Arrow batches, unless the user has chosen a size."""
    importable(spark)
    if spark.conf.get(_ARROW_KEY, _ARROW_DEFAULT) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_KEY, ARROW_ROWS)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    Where executors do not see that folder, ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallykeep-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder and cut its lineage."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(frame.sparkSession))
    return frame.checkpoint(eager=True)


def free_name(frame: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until no column has that name."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def only(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever else the frame holds."""
    return frame.select(*[F.col(f"`{name}`") for name in names])


def plain_text(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def split_words(text: Column) -> Column:
    """Words of a text: runs of anything but the six ASCII white space characters."""
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda word: word != "")


def with_digest(frame: DataFrame, low: str, high: str) -> DataFrame:
    """``frame`` with the two halves of a digest of the words of its column ``text``."""
    bounded_batches(frame.sparkSession)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = [digest(text) for text in texts]
            arrays = [pa.array([one[k] for one in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, low, high])

    return frame.mapInArrow(marked, StructType([*frame.schema.fields, StructField(low, LongType()), StructField(high, LongType())]))
