"""Plan-shape guarantees: no cross joins, pushed-down filters, map-side limits."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from courtside.plans import registry
from courtside.operators.lastn import last_n
from tests.conftest import SF_SMALL

QUERIES = sorted(registry.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_last_n_limits_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = last_n(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # AQE prints the initial plan: Partial limit below the exchange, Final above.
    assert plan.count("WindowGroupLimit") >= 2
    assert "Partial" in plan and "Final" in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["head_to_head_recent5"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [In(n_name, [NATION_1,NATION_2]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_scale_conf_sizes_partitions():
    from courtside.session import TARGET_PARTITION_BYTES, scale_conf
    tb = 1024 ** 4
    conf = scale_conf(100 * tb, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * tb // TARGET_PARTITION_BYTES
    assert int(scale_conf(10 ** 6, cores=8)["spark.sql.shuffle.partitions"]) == 16
