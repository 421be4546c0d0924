"""Nothing a registered report keeps outlives it; one pass compares two scopes."""

import pytest

from tallykeep.operators.filters import SalesFilter
from tallykeep.plans import tagged
from tallykeep.registry import queries as registered
from tallykeep.sources.star import read_star

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["shared_kpis", "shared_kpis_topn_country", "shared_kpis_retention", "insights_comparison"])
def test_reports_give_back_what_they_hold(spark, name):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    registered.queries()[name](spark, FOLDER).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_the_comparison_reads_the_lines_once(spark):
    facts = tagged.tagged(read_star(spark, FOLDER), SalesFilter(genre=["ECONOMY"])).rows
    assert facts._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    with tagged.tagged(read_star(spark, FOLDER), SalesFilter(genre=["ECONOMY"])).held() as held:
        plan = tagged.compare(held, ("1997-01-01", "1997-12-31"))._jdf.queryExecution().withCachedData().toString()
        assert "InMemoryRelation" in plan and "lineitem.parquet" not in plan.split("InMemoryRelation")[0]


def test_the_library_works_without_its_optional_part(tmp_path):
    """An import that fails inside the optional part leaves the other queries."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(registered.__file__)))
    code = (
        "import sys; sys.modules['tokenizers'] = None; sys.modules['pyarrow.compute'] = None\n"
        "import __spark_entry__ as e; names = e.queries(); print(len(names), 'ts_monthly' in names, 'pipeline' in names)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(root), capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and " True " in done.stdout
