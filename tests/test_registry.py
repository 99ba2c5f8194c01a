"""Every registered query against its SQL oracle, and what the plans must not contain."""

import re

import pytest

import __spark_entry__ as registry
from checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert not set(registry.customer_queries()) - set(registry.oracle_sql())
    assert not set(registry.oracle_sql()) - set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.customer_queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval", plan)
    if name in registry.oracle_sql():
        assert differences(df, con, name) == []


@pytest.mark.parametrize(
    "name",
    [
        "ltv_by_tier",
        "downgrades_after_tickets",
        "duplicate_accounts",
        "weekly_sessions",
        "upsell_targets_gated",
        "mrr_box_stats",
        "clean_tickets",
        "master_dataset",
    ],
)
def test_result_does_not_depend_on_partitions(spark, name):
    def result():
        df = registry.queries()[name](spark, SMALL)
        return sorted((tuple(r) for r in df.collect()), key=str)

    first = result()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert result() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for key in ("autoBroadcastJoinThreshold", "adaptive.enabled", "files.maxPartitionBytes"):
            spark.conf.unset(f"spark.sql.{key}")


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() == 5 and "plan_tier" in df.columns
