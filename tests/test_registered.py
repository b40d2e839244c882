import importlib
import sys

import pytest

import oracle
from tidelane.plans import catalog

entry = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.001"
# The corpus queries have their own tests, which go with their subpackage.
QUERIES, SQL = {n: q for n, q in entry.queries().items() if n in catalog.QUERIES}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, chunked, con, name):
    chunked(170)  # many chunks even on the small tables
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert oracle.compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["asof_align", "fill_secondary", "lag_diff", "find_gaps", "rolling_deviation", "log_rows", "flag_intervals_closed"])
def test_plans_stay_in_the_jvm_and_windows_are_chunked(spark, chunked, name):
    chunked(170)
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_core_queries_stay_without_a_dependency_of_the_others(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("tidelane.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)  # importing it is an ImportError now
    assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)
