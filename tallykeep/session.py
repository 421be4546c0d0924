"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

MEGABYTE = 1024 * 1024

# Stored bytes behind one shuffle partition. Only the columns in use are shuffled, a
# fraction of that; AQE merges what still turns out small.
BYTES_PER_SHUFFLE_PARTITION = 16 * MEGABYTE
# Stored bytes one task reads, and shuffled ones AQE merges for it. Columns with few values are
# stored and shuffled packed: as rows of an aggregation or sort they take twenty times that or more.
BYTES_PER_SCAN = 32 * MEGABYTE
BYTES_PER_MERGED_PARTITION = 16 * MEGABYTE

_SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
_MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_HASH_JOIN_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
# Lets AQE split a hot join key even where an aggregation on the same key follows the
# join; without it the skewed partition would stay in one task.
_SPLIT_SKEWED = "spark.sql.adaptive.forceOptimizeSkewedJoin"


def _set(spark: SparkSession, key: str, value: str) -> None:
    """Set a value unless the user has; what was set here earlier is remembered."""
    mark = f"spark.tallykeep.{key.removeprefix('spark.')}"
    if spark.conf.get(key, None) == spark.conf.get(mark, None):
        spark.conf.set(key, value)
        spark.conf.set(mark, value)


def _raise_to(spark: SparkSession, key: str, value: int) -> None:
    """Like :func:`_set`, but never below what was set here for an earlier model."""
    _set(spark, key, str(max(value, int(spark.conf.get(f"spark.tallykeep.{key.removeprefix('spark.')}", "0")))))


def tune(
    spark: SparkSession,
    input_bytes: int | None = None,
    bytes_per_partition: int = BYTES_PER_SHUFFLE_PARTITION,
    hash_join_bytes: int | None = None,
) -> SparkSession:
    """Apply the runtime settings, leaving alone whatever the user has set.

    What one task reads or merges is bounded, so its memory does not grow with the data.
    With ``input_bytes``, the number of shuffle partitions grows with the data, without
    a limit. Settings act when a query runs, so they are only ever raised: reading a
    small model leaves a large one, read before, with the partitions it needs.

    ``hash_join_bytes`` lets AQE hash-join where every partition of one side is measured
    to be no larger; by default that is left to Spark.
    """
    _set(spark, _SPLIT_SKEWED, "true")
    _set(spark, _SCAN_BYTES, str(BYTES_PER_SCAN))
    _set(spark, _MERGED_BYTES, str(BYTES_PER_MERGED_PARTITION))
    if hash_join_bytes is not None:
        _set(spark, _HASH_JOIN_BYTES, str(hash_join_bytes))
    if input_bytes is not None:
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _raise_to(spark, _INITIAL_PARTITIONS, max(base, math.ceil(input_bytes / bytes_per_partition)))
    return spark


def _located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of everything below ``path``, from the file system's own summary."""
    file_system, hadoop_path = _located(spark, path)
    return int(file_system.getContentSummary(hadoop_path).getLength())


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and last change of a file or folder, which tell whether it is still the same."""
    file_system, hadoop_path = _located(spark, path)
    changed = file_system.getFileStatus(hadoop_path).getModificationTime()
    return stored_bytes(spark, path), int(changed)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder handed out by :func:`shared_folder`."""
    if "/tallykeep-" not in path:
        raise ValueError(f"not a folder made here: {path}")
    file_system, hadoop_path = _located(spark, path)
    file_system.delete(hadoop_path, True)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors have to reach.

    Only a local session may leave that unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallykeep-local-")  # one machine, as in tests
    return f"{root.rstrip('/')}/tallykeep-{uuid.uuid4().hex}"
