"""Plan shapes that must hold however large the tables are."""

import pytest

import __spark_entry__ as registry
from checks.oracle import ORACLE
from plan_text import plan_of

FOLDER = "/root/testdata/sf0.001"
SQL = ORACLE


@pytest.fixture()
def no_broadcast(spark):
    """Treat every table as large: only joins that ask for a broadcast get one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(n for n in SQL if "ridge" not in n and n != "score_table"))
def test_no_cross_joins_no_python_no_unpartitioned_windows(no_broadcast, name):
    plan = plan_of(registry.queries()[name](no_broadcast, FOLDER))
    for operator in ("Cartesian", "BroadcastNestedLoop", "EvalPython", "MapInPandas", "Window ["):
        assert operator not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("scan_priced", "IsNotNull(o_totalprice)"),
        ("sql_with_params", "GreaterThanOrEqual(o_totalprice,250000.0)"),
        ("price_psi", "LessThan(o_orderdate,1998-01-01T00:00)"),
        ("outlier_filter", "GreaterThanOrEqual(o_totalprice,100000.0)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in _formatted(spark, registry.queries()[name](spark, FOLDER))


def _formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
