import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keepsight import functions as K
from tests.helpers import rows


def values(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_rounding_and_ratio(spark):
    got = values(
        spark,
        K.half_up(F.lit(2.5), 0),
        K.half_even(F.lit(2.5), 0),
        K.half_up(F.lit(0.125), 2),
        K.half_even(F.lit(0.125), 2),
        K.ratio(F.lit(1), F.lit(0)),
        K.ratio(F.lit(1), F.lit(4)),
    )
    assert got == (3.0, 2.0, 0.13, 0.12, None, 0.25)


def test_steady_mean_of_ties(table):
    # as doubles, 0.1 + 0.2 + ... depends on the order; the exact mean is 0.25
    df = table([(0.1,), (0.2,), (0.3,), (0.4,), (math.nan,), (None,)], "v double")
    means = [df.orderBy(o).agg(K.steady_mean(F.col("v"))).first()[0] for o in ("v", F.desc("v"))]
    assert means == [0.25, 0.25]
    large = table([(1e25,), (1.0,)], "v double").agg(K.steady_mean(F.col("v"))).first()[0]
    small = table([(4e-7,), (4e-7,)], "v double").agg(K.steady_mean(F.col("v"))).first()[0]
    assert (large, small) == (5e24, 4e-7)
    assert table([], "v double").agg(K.steady_mean(F.col("v"))).first()[0] is None


def test_normal_tail(spark):
    got = values(spark, *[K.normal_upper_tail(F.lit(z)) for z in (0.0, 1.644854, -1.644854, 5.0)])
    assert got == pytest.approx((0.5, 0.05, 0.95, 2.8665e-7), abs=2e-7)


def test_time_parsing(table):
    texts = [
        ("2024-01-05", datetime(2024, 1, 5)),
        ("2024-01-05 10:11:12.5", datetime(2024, 1, 5, 10, 11, 12, 500000)),
        ("2024-01-05T10:00:00Z", datetime(2024, 1, 5, 10)),
        ("2024-01-05T10:00:00+02:00", datetime(2024, 1, 5, 8)),
        ("01/05/2024", None),
        ("2024", None),
        ("2024-13-05", None),
        (" 2024-01-05 ", datetime(2024, 1, 5)),
        ("2024-01-05 10:00:00 Europe/Paris", datetime(2024, 1, 5, 9)),
        ("2024-01-05x", None),
        ("2024-01-05 noon", None),
        ("abcd-ef-gh", None),
        ("2024-1-5", None),
        ("", None),
        (None, None),
    ]
    df = table([(t,) for t, _ in texts], "t string")
    got = [r[0] for r in rows(df.select(K.parse_wall_clock(F.col("t"))))]
    assert got == [want for _, want in texts]
    extra = df.select(K.parse_wall_clock(F.col("t"), ("MM/dd/yyyy",)))
    assert rows(extra)[4] == (datetime(2024, 1, 5),)


def test_time_parsing_ignores_the_session_zone(spark, table):
    df = table([("2024-01-05T10:00:00+02:00",), ("2024-01-05 10:00:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = rows(df.select(K.parse_wall_clock(F.col("t")).cast("string")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [("2024-01-05 08:00:00",), ("2024-01-05 10:00:00",)]


def test_weeks_months_and_days(spark):
    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    got = values(
        spark,
        K.iso_week_key(at("2024-12-30 00:00:00")),
        K.iso_week_key(at("2024-02-01 12:00:00")),
        K.iso_week(at("2025-01-05 23:00:00")),
        K.months_before(at("2001-08-31 10:00:00"), 6),
        K.month_of(at("2001-08-31 10:00:00")),
        K.days_between(at("2001-08-30 00:00:00"), at("2001-08-31 12:00:00")),
    )
    assert got == (
        "2025-W1",
        "2024-W5",
        datetime(2024, 12, 30).date(),
        datetime(2001, 2, 28, 10),
        datetime(2001, 8, 1).date(),
        1.5,
    )


def test_strip_and_domain(spark):
    got = values(
        spark,
        K.strip_whitespace(F.lit("\t a b \n")),
        K.email_domain(F.lit("x@A.com")),
        K.email_domain(F.lit("x@A.com@b")),
        K.email_domain(F.lit("none")),
    )
    assert got == ("a b", "a.com", "a.com", "")


def grams(text):
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)}


def test_trigram_similarity(table):
    rng = random.Random(5)
    alphabet = "abc é𐐷-. "
    pairs = [
        tuple("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in "ab")
        for _ in range(200)
    ]
    df = table(pairs, "a string, b string")
    got = df.select(K.jaccard(K.trigrams(F.col("a")), K.trigrams(F.col("b")))).collect()
    for (a, b), (score,) in zip(pairs, got, strict=True):
        one, two = grams(a), grams(b)
        want = len(one & two) / len(one | two) if one | two else 0.0
        assert score == pytest.approx(want), (a, b)


def test_similarity_of_null(table):
    df = table([(None, "a"), ("a", None), ("", "")], "a string, b string")
    got = rows(df.select(K.jaccard(K.trigrams(F.col("a")), K.trigrams(F.col("b")))))
    assert got == [(None,), (None,), (0.0,)]
