"""Joins and orders that split one key into blocks or ranges."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keepsight.operators.intervals import interval_join
from keepsight.operators.ordered import numbered, previous_value
from tests.helpers import rows


def joined(points, intervals, width):
    return interval_join(points, intervals, ["k"], F.col("at"), F.col("low"), F.col("high"), width)


@pytest.mark.parametrize("width", [1, 7, 90])
def test_interval_join_equals_all_pairs(table, width):
    rng = random.Random(width)
    points = [(rng.choice(["a", "b", None]), i, rng.randint(-100, 300)) for i in range(200)]
    spans = []
    for i in range(60):
        low = rng.randint(-100, 300)
        spans.append((rng.choice(["a", "b", None]), i, low, low + rng.randint(-5, 120)))
    spans += [("a", 60, None, 5), ("a", 61, 5, None), ("a", 62, 10, 10)]
    points += [("a", 200, None), ("a", 201, 10)]
    got = joined(
        table(points, "k string, p int, at int"), table(spans, "k string, i int, low int, high int"), width
    )
    want = [
        (k, p, i)
        for k, p, at in points
        for key, i, low, high in spans
        if k == key is not None and None not in (at, low, high) and low <= at <= high
    ]
    assert sorted(rows(got, "k", "p", "i")) == sorted(want)
    assert got.columns == ["k", "p", "at", "i", "low", "high"]


def test_interval_join_meets_on_key_and_block(table):
    points = table([("a", 1, 5)], "k string, p int, at int")
    spans = table([("a", 1, 0, 9)], "k string, i int, low int, high int")
    plan = joined(points, spans, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "k#" in plan and "_block" in plan.split("Join Inner")[1].splitlines()[0]


def test_interval_join_of_no_rows(table):
    none = table([], "k string, p int, at int")
    spans = table([("a", 1, 0, 9)], "k string, i int, low int, high int")
    assert rows(joined(none, spans, 5)) == []


@pytest.fixture
def hot(table):
    """One key holds most rows, one value of it half of them, with copies."""
    rng = random.Random(1)
    data = [("hot" if i % 5 else rng.choice("xyz"), 7 if i % 2 else rng.randint(0, 60), i, rng.choice([None, 1, 2]))
            for i in range(600)]
    data += [(None, i % 4, 1000 + i, i) for i in range(20)]
    return table(data, "k string, d int, id int, v int").repartition(5)


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_previous_value_equals_one_window(spark, hot, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(previous_value(hot, ["k"], ["d", "id"], "v", "prev"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plain = hot.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("d", "id")))
    assert sorted(got, key=str) == sorted(rows(plain), key=str)


def test_a_hot_key_is_split(spark, hot):
    """No task holds the key: its rows lie in several ranges of near equal size."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from keepsight.operators.ordered import in_ranges

        sizes = [r["count"] for r in in_ranges(hot, ["k"], ["d"]).groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 3 * sum(sizes) / 8


def test_numbered_equals_row_number(hot):
    got = rows(numbered(hot, ["k"], ["d", "id"], "n"))
    plain = hot.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("d", "id")) - 1)
    assert sorted(got, key=str) == sorted(rows(plain), key=str)
    every = rows(numbered(hot.select("id"), [], ["id"], "n"))
    assert [n for _, n in sorted(every)] == list(range(620))
