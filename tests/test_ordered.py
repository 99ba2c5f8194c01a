import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keepsight.operators import ordered
from keepsight.session import pin
from tests.helpers import by_key, rows


@pytest.fixture(autouse=True, params=[0, ordered.ONE_TASK_ROWS])
def one_task_rows(request, monkeypatch):
    """Run everything with cut ranges and as one range."""
    monkeypatch.setattr(ordered, "ONE_TASK_ROWS", request.param)


@pytest.fixture
def numbers(table):
    rng = random.Random(7)
    data = [
        (i, rng.choice("ab"), float(rng.choice([0, 0, 0, rng.randint(1, 40)])))
        for i in range(500)
    ]
    data.append((1000, None, 5.0))
    return table(data, "id int, g string, v double")


@pytest.mark.parametrize("ranges", [2, 5, 200])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_one_window(numbers, ranges, descending):
    got = ordered.rank_within(pin(numbers), ["g"], "v", "r", descending, {"m": F.avg("v")}, ranges)
    order = F.desc("v") if descending else F.asc("v")
    plain = numbers.withColumns(
        {
            "r": F.rank().over(Window.partitionBy("g").orderBy(order)),
            "m": F.avg("v").over(Window.partitionBy("g")),
        }
    )
    assert sorted(rows(got), key=str) == sorted(rows(plain), key=str)


@pytest.mark.parametrize("few", [0, 1000])
def test_rank_without_broadcast(numbers, monkeypatch, few):
    monkeypatch.setattr(ordered, "FEW_GROUPS", few)
    got = ordered.rank_within(numbers, ["g"], "v", "r", True, ranges=7)
    assert by_key(got.filter("v = 0").distinct(), "g", "r").keys() == {"a", "b"}
    assert got.count() == 501


@pytest.mark.parametrize("ranges", [2, 200])
def test_quantiles_equal_the_built_in(numbers, ranges):
    counts = ordered.value_counts(numbers, ["g"], "v")
    wanted = {"q10": 0.1, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    got = ordered.quantiles(counts, ["g"], "v", wanted, ranges=ranges)
    plain = numbers.groupBy("g").agg(
        F.count("v").alias("n"),
        *[F.percentile("v", F.lit(q)).alias(name) for name, q in wanted.items()],
    )
    left, right = by_key(got, "g", "n", *wanted), by_key(plain, "g", "n", *wanted)
    assert left.keys() == right.keys()
    for key in left:
        assert left[key] == pytest.approx(right[key])


def test_upper_median(table):
    df = table(
        [("even", 1.0), ("even", 4.0), ("odd", 1.0), ("odd", 2.0), ("odd", 9.0), ("none", None)],
        "g string, v double",
    )
    counts = ordered.value_counts(df, ["g"], "v")
    got = ordered.quantiles(counts, ["g"], "v", {"m": 0.5}, interpolate=False)
    assert by_key(got, "g", "m", "n") == {"even": (4.0, 2), "odd": (2.0, 3)}


def test_running_counts(table):
    df = table([("a", x) for x in (5, 1, 1, 3, 5, 5)], "g string, v int")
    counts = ordered.value_counts(df, ["g"], "v")
    got = ordered.running_counts(counts, ["g"], "v", ranges=3)
    assert sorted(rows(got, "v", "n", "before")) == [(1, 2, 0), (3, 1, 2), (5, 3, 3)]


def test_box_stats(table):
    df = table(
        [("many", x) for x in (1.0, 2.0, 3.0, 4.0, 100.0)]
        + [("one", 7.0), ("same", 2.0), ("same", 2.0), ("empty", None), (None, 5.0)],
        "g string, v double",
    )
    got = rows(ordered.box_stats(df, "v", "g"))
    assert got == [
        ("same", 2, 2.0, 2.0, 2.0, 2.0, 2.0),
        ("many", 5, 2.0, 3.0, 4.0, 1.0, 4.0),
        ("one", 1, 7.0, 7.0, 7.0, 7.0, 7.0),
        ("empty", 0, None, None, None, None, None),
    ]


def test_histogram_keeps_every_row(table):
    df = table(
        [("a", x) for x in (-0.1, 0.0, 0.09, 0.1, 0.99, 1.0, 1.1, None)], "g string, v double"
    )
    got = {r[1]: r[3] for r in rows(ordered.histogram_by(df, "v", "g", 0.0, 1.0, 10))}
    assert got == {0: 1, 1: 2, 2: 1, 10: 2, 11: 1}


def test_quartiles(table):
    df = table([(True, float(x)) for x in range(1, 10)], "g boolean, v double")
    assert rows(ordered.quartiles_by(df, "v", "g")) == [(True, 9, 3.0, 5.0, 7.0)]
    assert statistics.median(range(1, 10)) == 5
