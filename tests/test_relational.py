import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from keepsight.operators.relational import (
    broadcast_below,
    first_row,
    last_row,
    match_keys,
    may_be_in,
    top_k,
)
from tests.helpers import rows


def test_first_and_last_row(table):
    df = table(
        [(1, 3, "c"), (1, 1, "a"), (1, 2, None), (2, None, "n"), (2, 5, "m")],
        "k int, o int, v string",
    )
    assert sorted(rows(first_row(df, ["k"], ["o"], "n"))) == [(1, 1, "a", 3), (2, None, "n", 2)]
    assert sorted(rows(last_row(df, ["k"], ["o"]))) == [(1, 3, "c"), (2, 5, "m")]


def test_column_order_is_kept(table):
    df = table([("x", 1, 9)], "v string, k int, o int")
    assert first_row(df, ["k"], ["o"]).columns == ["v", "k", "o"]


def test_match_keys_joins_null_to_null(table):
    left = table([(None, 1), ("a", 2)], "k string, v int")
    right = table([(None, 10), ("a", 20)], "k string, w int")
    got = rows(match_keys(left, right, ["k"], "inner"))
    assert sorted(got, key=str) == [("a", 2, 20), (None, 1, 10)]


def test_top_k(table):
    df = table([(i % 3, i) for i in range(9)], "a int, b int")
    assert rows(top_k(df, 2, F.desc("a"), F.col("b"))) == [(2, 2), (2, 5)]


def test_broadcast_only_below_the_limit(spark):
    df, big = spark.range(3), spark.range(100)

    def plan(small):
        return big.join(small, "id")._jdf.queryExecution().logical().toString()

    assert "broadcast" in plan(broadcast_below(df, 3))
    assert "broadcast" not in plan(broadcast_below(df, 2))


def test_ties_do_not_depend_on_partitions(table):
    df = table([(1, 5, "x"), (1, 5, "y"), (1, 5, None)], "k int, o int, v string")
    for parts in (1, 3):
        dealt = df.repartition(parts, "v")
        assert rows(first_row(dealt, ["k"], ["o"]), "v") == [(None,)]
        assert rows(last_row(dealt, ["k"], ["o"]), "v") == [("y",)]


def test_bloom_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).toDF("k")
    told = spark.range(80_000).select("id", may_be_in(F.col("id"), keys).alias("in"))
    got = told.groupBy((F.col("id") % 2 == 0) & (F.col("id") < 40_000)).agg(F.avg(F.col("in").cast("int")))
    shares = dict(rows(got))
    assert shares[True] == 1.0 and shares[False] < 0.001


def test_bloom_filter_of_no_keys_and_null_keys(table):
    df = table([(1,), (None,)], "id long")
    none = df.filter("false").toDF("k")
    assert rows(df.select(may_be_in(F.col("id"), none))) == [(False,), (None,)]
    assert rows(df.select(may_be_in(F.col("id"), df.toDF("k")))) == [(True,), (None,)]
