"""Medians by ranges equal Spark's own; positions number whole reports."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallykeep.operators.medians import exact_median
from tallykeep.sources.sinks import read_ordered, write_ordered


def expected(values):
    groups = {}
    for key, value in values:
        if value is not None and not math.isnan(value):
            groups.setdefault(key, []).append(value)
    return {key: (len(held), statistics.median(held)) for key, held in groups.items()}


def found(frame):
    rows = frame.collect()
    assert len({row["k"] for row in rows}) == len(rows)
    return {row["k"]: (row["n"], row["median"]) for row in rows}


def test_random_groups(spark):
    rng = random.Random(5)
    values = [(rng.choice([None, "a", "b"]), rng.choice([None, math.nan, -0.5, rng.randint(-400, 400) / 4])) for _ in range(3000)]
    values += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None)] + [("hot", 7.0)] * 2000 + [("hot", float(n)) for n in range(300)]
    values += [("ends", -math.inf), ("ends", 0.0), ("ends", math.inf)]
    rows = spark.createDataFrame(values, "k string, v double")
    for sortable, ranges in ((8, 4), (64, 8), (100_000, 64)):
        assert found(exact_median(rows, ["k"], "v", sortable, ranges)) == expected(values)


def test_two_middles_at_the_cut_of_ranges(spark):
    for size in (8, 16, 17, 64, 128):
        rows = spark.range(size).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
        assert found(exact_median(rows, ["k"], "v", 4, 4)) == {"k": (size, (size - 1) / 2)}


def test_many_distinct_values(spark):
    """Two million distinct doubles, no more than 10,000 of which one task may sort."""
    rows = spark.range(2_000_000).select((F.col("id") % 2).alias("k"), F.sqrt(F.col("id") + 0.25).alias("v"))
    own = {row["k"]: row["m"] for row in rows.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert {key: median for key, (_, median) in found(exact_median(rows, ["k"], "v", 10_000)).items()} == own


def test_nothing_and_no_keys(spark):
    rows = spark.createDataFrame([(None,), (4,), (1,), (2,)], "v int")
    assert [tuple(row) for row in exact_median(rows, [], "v").collect()] == [(3, 2.0)]
    assert exact_median(rows.limit(0), [], "v").collect() == []
    with pytest.raises(ValueError, match="smaller"):
        exact_median(rows, [], "v", sortable=2)


def test_positions_over_many_ranges(spark, tmp_path):
    rng = random.Random(2)
    days = [None] + [f"2020-01-{day:02}" for day in range(1, 29)]
    events = [(rng.choice(days[-1:] * 10 + days), number) for number in range(5000)]
    rows = spark.createDataFrame(events, "dt string, InvoiceId int").repartition(7)
    with_settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_settings.items():
        spark.conf.set(key, value)
    try:
        write_ordered(rows, "events", str(tmp_path))
    finally:
        for key in with_settings:
            spark.conf.unset(key)
    stored = spark.read.parquet(str(tmp_path))
    assert stored.select("_range").distinct().count() > 1
    ranked = sorted(read_ordered(spark, str(tmp_path)).collect(), key=lambda row: row["position"])
    assert [row["position"] for row in ranked] == list(range(1, 5001))
    assert [(row["dt"], row["InvoiceId"]) for row in ranked] == sorted(events, key=lambda e: (e[0] is None, e))
    write_ordered(rows.limit(0), "events", str(tmp_path))
    assert read_ordered(spark, str(tmp_path)).collect() == []
