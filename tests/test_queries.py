"""Every named query equals its SQL counterpart, on the given and on skewed tables.

The optional training-data queries have tests of their own.
"""

import random

import pandas as pd
import pytest

import __spark_entry__ as contract
import compare
from tallykeep.registry import oracles, queries as registered

FOLDER = "/root/testdata/sf0.01"
QUERIES = registered.queries()
ORACLES = oracles.oracle_sql()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def given():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_given_tables(spark, given, name):
    assert compare.spark_rows(QUERIES[name](spark, FOLDER)) == compare.duck_rows(given, ORACLES[name])


def _skewed_tables(seed: int) -> dict[str, pd.DataFrame]:
    """A third of the orders from one customer, of the lines on one order, of them on one part.

    Some orders have no line, some lines name an unknown part. A tenth of the orders have
    no customer, and some no date.
    """
    rng = random.Random(seed)
    days = pd.date_range("1996-01-01", "1998-12-31")
    customers, parts, orders = 40, 60, 500

    def pick(size: int) -> int:
        return 0 if rng.random() < 1 / 3 else rng.randrange(size)

    part = [
        (p, f"Brand#{1 if p % 3 == 0 else p % 7}", ["ECONOMY", "PROMO", "SMALL"][0 if p % 3 == 0 else p % 3])
        for p in range(parts)
    ]
    order = [
        (
            o,
            None if rng.random() < 0.1 else pick(customers),
            None if rng.random() < 0.03 else days[0 if rng.random() < 0.1 else rng.randrange(len(days))],
        )
        for o in range(orders)
    ]
    line = [
        (
            pick(orders - 60),
            900 + rng.randrange(5) if rng.random() < 0.05 else pick(parts),
            float(rng.randint(1, 50)),
            rng.randint(100, 9_999_999) / 100,
        )
        for _ in range(1500)
    ]
    return {
        "part": pd.DataFrame(part, columns=["p_partkey", "p_brand", "p_type"]),
        "orders": pd.DataFrame(order, columns=["o_orderkey", "o_custkey", "o_orderdate"]).astype(
            {"o_custkey": "Int64", "o_orderdate": "datetime64[us]"}
        ),
        "lineitem": pd.DataFrame(line, columns=["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]),
        "customer": pd.DataFrame(
            [(c, 1 if c % 3 == 0 else c % 25) for c in range(customers)], columns=["c_custkey", "c_nationkey"]
        ).astype({"c_nationkey": "int32"}),
        "nation": pd.DataFrame(
            [(n, f"NATION_{n}") for n in range(25)], columns=["n_nationkey", "n_name"]
        ).astype({"n_nationkey": "int32"}),
    }


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    import duckdb

    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name, frame in _skewed_tables(seed=7).items():
        path = folder / f"{name}.parquet"
        frame.to_parquet(path, index=False)
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return str(folder), connection


@pytest.mark.parametrize("name", [name for name in QUERIES if not name.endswith("_empty")])
def test_skewed_tables(spark, skewed, name):
    folder, connection = skewed
    assert compare.spark_rows(QUERIES[name](spark, folder)) == compare.duck_rows(connection, ORACLES[name])


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
