"""Every registered query next to its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import compare, registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
QUERIES = {name: run for name, (run, _) in registry().items()}
SQL = {name: sql for name, (_, sql) in registry().items() if sql is not None}

# No exact SQL twin: learned models, and a manifest of names that SQL cannot write.
ROWS_ONLY = {"a06_manifest_names", "l03_tuned_model", "l06_predictions", "m16_train_workflows"}


@pytest.fixture(scope="module")
def con():
    return compare.engine(SF)


FORBIDDEN = [
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInArrow",
    "MapInPandas",
    "FlatMapGroups",
]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_and_stays_in_the_engine(spark, con, name):
    df = QUERIES[name](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    text = df._jdf.queryExecution().explainString(mode)
    assert not [word for word in FORBIDDEN if word in text]
    _, problem = compare.compare_frame(df, con, SQL.get(name))
    assert problem is None, problem


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()
