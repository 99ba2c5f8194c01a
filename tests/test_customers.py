from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from keepsight.operators import customers, dashboard
from keepsight.operators.cleaning import clean_customers
from keepsight.sources.tables import schema_of
from tests.helpers import by_key, rows
from tests.test_cleaning import customer

LATEST = (
    "customer_id bigint, plan_tier string, plan_name string, mrr_usd double, status string, "
    "start_date date, end_date date, billing_cycle string, cancellation_reason string"
)
FACTS = (
    "customer_id bigint, is_churned boolean, plan_tier string, ticket_count bigint, "
    "engagement_score double, mrr_usd double, days_active bigint"
)


@pytest.fixture
def merged(table):
    people = table(
        [customer(1), customer(2, nps=None, active=None), customer(3, email=None, active=False)],
        schema_of("customers"),
    )
    latest = table(
        [(1, "free", "Free", 0.0, "active", date(2020, 1, 1), None, "monthly", None)], LATEST
    )
    loads = table(
        [(1, 4, 2.5, 1), (9, 1, 1.0, 0)],
        "customer_id bigint, ticket_count bigint, avg_satisfaction double, escalated_count bigint",
    )
    members = table(
        [(1, 10, 5, 2, 3, 10.0, 0.3), (1, 11, 7, 1, 4, None, 0.6)],
        "customer_id bigint, member_id bigint, total_events bigint, days_active bigint, "
        "feature_count bigint, avg_session_sec double, engagement_score double",
    )
    return customers.merge_sources(
        clean_customers(people, ["company_name"]),
        latest,
        loads,
        customers.customer_engagement(members),
    )


def test_merge(merged):
    got = by_key(
        merged,
        "customer_id",
        "plan_tier",
        "ticket_count",
        "avg_satisfaction",
        "escalated_count",
        "total_events",
        "days_active",
        "feature_count",
        "avg_session_sec",
        "engagement_score",
        "member_count",
    )
    empty = (None, 0, None, 0, 0, 0, 0, 0.0, 0.0, None)
    assert got == {1: ("free", 4, 2.5, 1, 12, 2, 4, 10.0, 0.6, 2), 2: empty, 3: empty}
    assert rows(customers.engagement_coverage(merged)) == [(3, 1, 2)]


def test_merges_are_counted_as_they_run(spark, table):
    people = clean_customers(table([customer(i) for i in range(1, 6)], schema_of("customers")), ["company_name"])
    plan = ("free", "Free", 0.0, "active", date(2020, 1, 1), None, "monthly", None)
    latest = table([(1, *plan), (2, *plan), (2, *plan), (9, *plan), (None, *plan)], LATEST)
    loads = "customer_id bigint, ticket_count bigint, avg_satisfaction double, escalated_count bigint"
    members = (
        "customer_id bigint, member_id bigint, total_events bigint, days_active bigint, "
        "feature_count bigint, avg_session_sec double, engagement_score double"
    )
    parts = (latest, table([(2, 4, 2.5, 1)], loads), customers.customer_engagement(table([], members)))
    counts = customers.MergeCounts()
    merged = customers.merge_sources(people, *parts, counts)
    assert merged.columns == customers.merge_sources(people, *parts).columns
    assert len(merged.collect()) == 6  # a part with two rows of a customer repeats them
    assert rows(counts.report(spark)) == [
        (1, "latest subscriptions", 5, 5, 6, 3),
        (2, "ticket summary", 1, 6, 6, 2),
        (3, "engagement", 0, 6, 6, 0),
    ]


def test_merges_of_no_customers_are_counted(spark, table):
    people = clean_customers(table([], schema_of("customers")), ["company_name"])
    loads = "customer_id bigint, ticket_count bigint, avg_satisfaction double, escalated_count bigint"
    members = (
        "customer_id bigint, member_id bigint, total_events bigint, days_active bigint, "
        "feature_count bigint, avg_session_sec double, engagement_score double"
    )
    counts = customers.MergeCounts()
    parts = (table([], LATEST), table([(2, 4, 2.5, 1)], loads), customers.customer_engagement(table([], members)))
    assert customers.merge_sources(people, *parts, counts).collect() == []
    got = rows(counts.report(spark), "rows_before", "rows_after", "rows_matched")
    assert got == [(0, 0, 0)] * 3


def test_master_has_all_columns(merged):
    master = customers.assign_segments(merged)
    assert len(master.columns) == 34
    assert len(dashboard.dashboard_clean(master).columns) == 35


SEGMENT_ROWS = [
    (1, True, "free", 4, 0.9, 500.0, 1),
    (2, True, None, 3, 0.9, 500.0, 1),
    (3, False, "free", 9, 0.5, 500.0, 1),
    (4, False, "free", 9, 0.4999, 500.0, 2),
    (5, False, "starter", 9, 0.0, 100.0, 2),
    (6, False, None, 4, 0.9, 99.99, 2),
    (7, False, None, 3, 0.9, None, 3),
    (8, False, "starter", 101, 0.9, None, 3),
    (9, False, "starter", 100, 0.9, 50.0, 3),
    (10, False, "starter", 0, 0.9, 50.0, 3),
    (11, False, "starter", 1, 0.9, 50.0, 3),
    (12, False, "starter", 6, 0.9, 50.0, 3),
    (13, False, "starter", 7, 0.9, 50.0, 3),
]


@pytest.fixture
def master(table):
    return customers.assign_segments(table(SEGMENT_ROWS, FACTS))


def test_segments_and_buckets(master):
    got = by_key(master, "customer_id", "segment_label", "ticket_bucket", "high_ticket")
    assert got == {
        1: ("Churned — High Friction", "4-6 tickets", True),
        2: ("Churned — Low Engagement", "2-3 tickets", False),
        3: ("Upsell Candidates", "7+ tickets", True),
        4: ("Inactive Free Tier", "7+ tickets", True),
        5: ("Champions", "7+ tickets", True),
        6: ("At-Risk Paid", "4-6 tickets", True),
        7: ("Stable Paid", "2-3 tickets", False),
        8: ("At-Risk Paid", None, True),
        9: ("At-Risk Paid", "7+ tickets", True),
        10: ("Stable Paid", "0 tickets", False),
        11: ("Stable Paid", "1 ticket", False),
        12: ("At-Risk Paid", "4-6 tickets", True),
        13: ("At-Risk Paid", "7+ tickets", True),
    }


def test_segments_partition_the_customers(master):
    sizes = rows(customers.segment_sizes(master))
    assert sum(n for _, n in sizes) == len(SEGMENT_ROWS)
    assert [n for _, n in sizes] == sorted(n for _, n in sizes)
    buckets = rows(customers.ticket_buckets(master))
    assert [b for b, _, _ in buckets] == [name for name, _ in customers.TICKET_BUCKETS]
    assert sum(n for _, n, _ in buckets) == len(SEGMENT_ROWS) - 1
    assert buckets[2] == ("2-3 tickets", 2, 0.5)


def test_segment_profile(master):
    got = rows(customers.segment_profile(master))
    assert got[0][0] == "Churned — High Friction"  # equal mean MRR: by name
    by_name = {r[0]: r[1:] for r in got}
    assert by_name["At-Risk Paid"] == (5, 0.0, 0.9, 62.498, 43.6, 2.8, 0.0)
    assert by_name["Stable Paid"][5] == 3.0
    assert by_name["Churned — Low Engagement"][-1] == 0.0  # unknown tier is not free


def test_segment_mrr_without_values(table):
    df = customers.assign_segments(table([(1, False, "starter", 0, 0.9, None, 3)], FACTS))
    assert rows(customers.segment_mrr(df)) == [("Stable Paid", 0.0)]
    assert rows(customers.segment_profile(df), "avg_mrr") == [(None,)]


def test_churn_by_and_kpis(master):
    assert rows(customers.churn_by(master, "plan_tier")) == [
        ("free", 3, pytest.approx(1 / 3)),
        ("starter", 7, 0.0),
    ]
    total = sum(r[5] or 0 for r in SEGMENT_ROWS)
    assert rows(customers.kpis(master)) == [
        (13, pytest.approx(2 / 13), pytest.approx(total / 13), 7)
    ]
    revenue = by_key(customers.engagement_vs_revenue(master), "plan_tier", "customers", "avg_mrr")
    assert revenue["starter"] == (7, pytest.approx(350 / 7))
    assert None in revenue


def test_dashboard_fills(merged):
    clean = dashboard.dashboard_clean(customers.assign_segments(merged))
    got = by_key(
        clean,
        "customer_id",
        "contact_email",
        "churn_reason",
        "cancellation_reason",
        "churned_at",
        "start_date",
        "end_date",
        "nps_score",
        "avg_satisfaction",
        "is_active",
        "is_churned",
        "member_count",
        "ticket_bucket_sort",
    )
    assert got[1] == (
        "a@b.c", "Not Churned", "Not Cancelled", "0", "2020-01-01", "0", 5.0, 2.5, 1, 0, 2, 4,
    )
    assert got[2] == (
        "a@b.c", "Not Churned", "Not Cancelled", "0", "", "0", 5.0, 0.0, None, 0, None, 1,
    )
    assert got[3][0] == "Unknown" and got[3][9] == 1


def test_null_profile(merged):
    master = customers.assign_segments(merged)
    profile = by_key(dashboard.null_profile(master), "column_name", "nulls_before", "nulls_after")
    assert profile["plan_tier"] == (2, 0)
    assert profile["nps_score"] == (1, 0)
    assert profile["member_count"] == (2, 2)
    assert profile["ticket_bucket_sort"] == (None, 0)
    assert len(profile) == 35
    before = sum(b for b, _ in profile.values() if b is not None)
    after = sum(a for _, a in profile.values())
    assert rows(dashboard.null_verdict(master)) == [(3, 34, 35, before, after, False)]


@pytest.mark.parametrize("approximate", [False, True])
def test_column_profile(table, approximate):
    df = table(
        [(1, "a", 1.234, None, True), (2, "a", None, None, False), (3, None, 2.346, None, True)],
        "i int, s string, d double, n string, b boolean",
    )
    got = rows(dashboard.column_profile(df, approximate))
    assert got == [
        (1, "i", "numeric", 1.0, 3.0, None),
        (2, "s", "other", None, None, 1),
        (3, "d", "numeric", 1.23, 2.35, None),
        (4, "n", "other", None, None, 0),
        (5, "b", "other", None, None, 2),
    ]


@pytest.mark.parametrize("approximate", [False, True])
def test_column_profile_without_rows(table, approximate):
    got = rows(dashboard.column_profile(table([], "i int, s string"), approximate))
    assert got == [(1, "i", "numeric", None, None, None), (2, "s", "other", None, None, 0)]


def test_median_from_customers(merged, table):
    master = customers.assign_segments(merged).withColumn("nps_score", F.lit(None).cast("int"))
    scores = table([(1,), (4,), (9,), (None,)], "nps_score int")
    assert {r[0] for r in rows(dashboard.dashboard_clean(master, scores), "nps_score")} == {4.0}
    left = by_key(dashboard.null_profile(master), "column_name", "nulls_before", "nulls_after")
    assert left["nps_score"] == (3, 3)


def test_signup_dates_survive(merged):
    assert {r[0] for r in rows(merged, "signup_date")} == {datetime(2020, 1, 2)}
