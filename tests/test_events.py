from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keepsight.operators import events
from tests.helpers import by_key, rows

EVENTS = (
    "event_id bigint, customer_id bigint, member_id bigint, ts timestamp_ntz, "
    "event_type string, feature string, session_duration_sec double"
)
START = datetime(2024, 1, 1, 12)


def event(i, day=0.0, customer=1, member=1, kind="view", feature="f", secs=60.0):
    at = None if day is None else START + timedelta(days=day)
    return (i, customer, member, at, kind, feature, secs)


def test_normalize(table):
    raw = table(
        [
            (1, "7", None, 5, None, datetime(2024, 1, 1), None, None, "view"),
            (2, None, "8", None, 6, None, "2024-01-02 03:04:05", "x", "view"),
            (3, "7", "8", 5, 6, datetime(2024, 1, 1), "2023-01-01", "x", "view"),
            (4, "abc", "8", None, None, None, "01/02/2024", None, "click"),
            (5, None, None, None, None, None, None, None, None),
        ],
        "event_id int, c1 string, c2 string, m1 bigint, m2 bigint, t1 timestamp_ntz, "
        "t2 string, feature string, event_type string",
    )
    got = events.normalize_events(raw, ["c1", "c2"], ["m1", "m2"], "t1", "t2", True)
    assert rows(got, "event_id", "customer_id", "member_id", "ts", "feature") == [
        (1, 7, 5, datetime(2024, 1, 1), "view"),
        (2, 8, 6, datetime(2024, 1, 2, 3, 4, 5), "x"),
        (3, 7, 5, datetime(2024, 1, 1), "x"),
        (4, None, None, None, "click"),
        (5, None, None, None, None),
    ]
    assert "c1" not in got.columns


def test_weekly_sessions(table):
    week = 7
    data = [event(i, 0, secs=None) for i in range(2)]  # one week without any duration
    data += [event(10 + i, week * i, secs=10.0 * i) for i in range(1, 4)]
    data += [event(20, 0, member=2, secs=100.0)]
    data += [event(30, None), event(31, 0, customer=None), event(32, 0, member=None)]
    data += [event(40, 0, customer=2, member=3, secs=5.0)]
    got = rows(events.weekly_sessions(table(data, EVENTS)))
    # member 1: weeks of 2, 1, 1, 1 events; durations NULL, 10, 20, 30
    assert got[0][0] == 1
    assert got[0][1:] == pytest.approx(((5 / 4 + 1) / 2, (10 + 100) / 2, (20 + 100) / 2, 65.0, 2))
    assert got[1] == (2, 1.0, 5.0, 5.0, 5.0, 1)
    assert len(rows(events.weekly_sessions(table(data, EVENTS), top=1))) == 1


def test_weekly_sessions_null_percentile(table):
    data = [event(1, 0, secs=None), event(2, 7, secs=30.0)]
    got = rows(events.weekly_sessions(table(data, EVENTS)))
    assert got == [(1, 1.0, None, 30.0, 30.0, 1)]


def test_weekly_sessions_with_tiers(table):
    tiers = table([(1, "free")], "customer_id bigint, plan_tier string")
    data = [event(1), event(2), event(3, customer=2)]
    got = rows(events.weekly_sessions(table(data, EVENTS), tiers=tiers), "customer_id", "plan_tier")
    assert got == [(1, "free"), (2, None)]


def test_feature_retention(table):
    data = [
        event(1, 0, member=1),
        event(2, 0.3, member=1),  # again on the first day
        event(3, 0, member=2),
        event(4, 7.4, member=2),  # seventh day, later hour
        event(5, 0, member=3),
        event(6, 8, member=3),
        event(7, 0, member=None),
        event(8, 0, feature=None),
        event(9, None),
        event(10, 0, customer=None, member=4, feature="g"),
        event(11, 1, customer=None, member=4, feature="g"),
    ]
    got = rows(events.feature_retention(table(data, EVENTS)))
    assert got == [("g", 1, 1, 2, 100.0, 0.1), ("f", 3, 1, 5, 33.33, 0.2)]


def test_funnel(table):
    def step(i, member, name, secs=1.0, completed=True, day=0):
        return (i, member, START + timedelta(days=day), name, completed, secs)

    data = [
        step(1, 1, "signup", 4.0),
        step(2, 1, "signup", 9.0, day=-1),  # the earliest one counts
        step(3, 2, "signup", 2.0),
        step(4, 3, "signup", None),
        step(5, 4, "signup", 7.0, completed=False),
        step(6, None, "signup", 7.0),
        step(7, 1, "first_login", None),
        step(8, 1, "unknown"),
        step(9, 1, "first_project", 3.0),
    ]
    df = table(
        data,
        "event_id bigint, member_id bigint, ts timestamp_ntz, step string, completed boolean, "
        "duration_seconds double",
    )
    stages = events.funnel_stages(df, "event_id")
    assert rows(stages) == [
        ("1_signup", 3, 9.0),
        ("2_first_login", 1, None),
        ("4_first_project", 1, 3.0),
    ]
    # nobody reached step 3, so it has no drop-off on either side
    assert rows(events.funnel_dropoff(stages)) == [("1_signup", "2_first_login", 66.7)]


def test_upsell_score_and_gate(table):
    data = [event(i, i, feature=f"f{i}", secs=1800.0) for i in range(3)]
    data += [event(10, 0, customer=2, member=2, feature=None, secs=None)]
    data += [event(20, 0, customer=3, member=3), event(21, 0.9, customer=3, member=3)]
    data += [event(30, 0, customer=None, member=4)]
    df = table(data, EVENTS)
    got = by_key(
        events.upsell_targets(df), "member_id", "engagement_score", "days_active", "feature_count"
    )
    assert got[1] == (round(0.4 * 3 / 2 + 0.3 * 0.3 + 0.3 * 0.5, 4), 3, 3)
    assert got[2] == (0.4, 1, 0)
    assert got[3] == (round(0.4 * 2 + 0.03 + 0.3 / 60, 4), 2, 1)  # two days within a day
    assert 4 in got
    ids = table([(1,), (2,), (2,)], "customer_id bigint")
    assert set(by_key(events.upsell_targets(df, ids), "member_id")) == {1, 2}
    fallback = events.normalize_events(df, feature_fallback=True)
    gated = events.upsell_targets(fallback, ids, gate=(2, 3, 2))
    assert set(by_key(gated, "member_id")) == {1}
    assert [r[1] for r in rows(events.upsell_targets(df, top=1))] == [1]


@pytest.mark.parametrize("gate", [(2, 9, 9), (9, 2, 9), (9, 9, 2)])
def test_each_gate_alone_is_enough(table, gate):
    data = [event(1, 0, feature="a"), event(2, 1, feature="b")]
    assert events.upsell_targets(table(data, EVENTS), gate=gate).count() == 1


def test_id_lists_of_any_length(spark, table):
    data = [event(i, i / 3, customer=i % 5, member=i % 7) for i in range(60)]
    data += [event(100 + i, i, customer=None, member=i) for i in range(3)]
    df, ids = table(data, EVENTS), table([(1,), (3,), (77,), (3,), (None,)], "customer_id bigint")
    short = rows(events.upsell_targets(df, ids, top=None))
    assert {r[0] for r in short} == {1, 3}
    many = spark.range(1000, 300_000).union(spark.createDataFrame([(1,), (3,)], "id long"))
    assert rows(events.upsell_targets(df, many.toDF("customer_id"), top=None)) == short
    plain = df.join(ids.dropna().distinct(), "customer_id", "left_semi")
    assert rows(events.upsell_targets(plain, top=None)) == short


def test_list_thins_the_events_before_they_are_shuffled(table):
    df, ids = table([event(1)], EVENTS), table([(1,)], "customer_id bigint")
    plan = events.upsell_targets(df, ids)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan[plan.index("RepartitionByExpression") :]


def test_empty_id_list(table):
    df, none = table([event(1)], EVENTS), table([], "customer_id bigint")
    assert rows(events.upsell_targets(df, none)) == []
    assert len(rows(events.upsell_targets(df, none, all_if_empty=True))) == 1
    nulls = table([(None,)], "customer_id bigint")
    assert len(rows(events.upsell_targets(df, nulls, all_if_empty=True))) == 1


def test_activity_by_member(table):
    data = [event(1, 0, secs=10.0), event(2, 1, secs=11.0), event(3, 0, customer=None)]
    got = rows(events.activity_by_member(table(data, EVENTS)))
    assert got == [(1, 1, 2, 2, 1, 10.0, START, START + timedelta(days=1))]


def test_diagnostics(table):
    df = table(
        [(1, "5", None, "b"), (2, None, "5", "a"), (3, "5", "6", "a"), (4, None, None, None)],
        "event_id int, c1 string, c2 string, event_type string",
    )
    assert rows(events.field_presence(df, ["c1", "c2"])) == [
        ("missing", "missing", 1),
        ("missing", "present", 1),
        ("present", "missing", 1),
        ("present", "present", 1),
    ]
    assert rows(events.distinct_values(df, "event_type")) == [("a",), ("b",)]
    assert rows(events.distinct_values(df, "event_type", 1)) == [("a",)]
    assert rows(events.distinct_count(df, "event_type")) == [(2,)]
    assert rows(events.heavy_users(df, "c1", "event_type", min_events=1, top=2)) == [
        ("5", "a", 1),
        ("5", "b", 1),
    ]
    assert rows(events.events_of(df, 5, ["c1"]), "event_id") == [(1,), (3,)]
    assert rows(events.events_of(df, 5, ["c1", "c2"]), "event_id") == [(1,), (2,), (3,)]
    assert rows(events.events_of(df, 3, ["event_id", "c1"]), "event_id") == [(3,)]
    assert len(rows(events.sample_rows(df, ["c1"], 2))) == 2


def test_id_coverage(table):
    seen = table([(1,), (1,), (2,), (None,)], "customer_id bigint")
    ids = table([(1,), (3,), (1,)], "customer_id bigint")
    assert rows(events.id_coverage(seen, ids)) == [(1,)]


def test_score_caps(table):
    df = table(
        [(START, START, 1, 25, 9999.0), (START, START, 1, 0, None)],
        "first_seen timestamp_ntz, last_seen timestamp_ntz, days_active int, feature_count int, "
        "secs double",
    )
    got = rows(df.select(events.engagement_score(F.col("secs"))))
    assert got == [(1.0,), (0.4,)]


def test_ids_are_taken_by_value(table):
    df = table([(7.0, "8"), (7.5, None), (None, "8"), (None, "8.5")], "c1 double, c2 string")
    found = events.normalize_events(df, ["c1", "c2"])
    assert sorted(r.customer_id or 0 for r in found.collect()) == [0, 7, 7, 8]
