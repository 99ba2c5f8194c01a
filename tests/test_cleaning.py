from datetime import date, datetime

import pytest

from keepsight.operators import cleaning
from keepsight.sources.tables import schema_of
from tests.helpers import by_key, rows


def customer(i, email="a@b.c", signup="2020-01-02", active=True, nps=5, name="n"):
    return (i, name, None, None, None, None, None, email, signup, active, None, None, nps)


@pytest.fixture
def customers(table):
    return table(
        [
            customer(1, "\t A@B.Com "),
            customer(1, "later@copy.com", name="z"),
            customer(2, "no-at-sign", "bad-date", None, -1),
            customer(3, "a@b@c.d", None, False, 0),
            customer(4, None, "2020", True, 10),
            customer(5, "", "2020-01-02T10:00:00+01:00", True, 11),
            customer(6, nps=None),
        ],
        schema_of("customers"),
    )


def test_clean_customers(customers):
    got = by_key(
        cleaning.clean_customers(customers, ["company_name"]),
        "customer_id",
        "contact_email",
        "signup_date",
        "nps_score",
        "is_churned",
    )
    day = datetime(2020, 1, 2)
    assert got == {
        1: ("a@b.com", day, 5, False),
        2: (None, None, None, False),
        3: (None, None, 0, True),
        4: (None, None, 10, False),
        5: (None, datetime(2020, 1, 2, 9), None, False),
        6: ("a@b.c", day, None, False),
    }


def test_customer_report(customers):
    got = rows(cleaning.customer_report(customers, ["company_name"]))
    assert got == [
        ("customers", 1, "drop duplicates", 7, 6, 1, 0),
        ("customers", 2, "signup_date missing", 6, 6, 0, 3),
        ("customers", 3, "churned_at missing", 6, 6, 0, 6),
        ("customers", 4, "contact_email invalid", 6, 6, 0, 4),
        ("customers", 5, "nps_score out of range", 6, 6, 0, 2),
    ]


def test_report_of_nothing(customers):
    got = rows(cleaning.customer_report(customers.limit(0), ["company_name"]))
    assert {r[3:] for r in got} == {(0, 0, 0, 0)}


def sub(i, customer, start, end=None, mrr=1.0):
    return (i, customer, 1, "active", "monthly", start, end, mrr, None, None, None)


def test_subscriptions(table):
    day, next_day = date(2020, 1, 1), date(2020, 1, 2)
    df = table(
        [
            sub(1, 1, next_day, day, -1.0),
            sub(2, 1, day, day, 0.0),
            sub(2, 1, next_day, day, 0.0),
            sub(3, 2, None, day),
            sub(4, 3, None),
            sub(5, 3, day),
            sub(6, 3, day),
        ],
        schema_of("subscriptions"),
    )
    clean = cleaning.clean_subscriptions(df, ["start_date"])
    assert by_key(clean, "subscription_id", "end_date", "mrr_usd") == {
        1: (None, None),
        2: (day, 0.0),
        3: (day, 1.0),
        4: (None, 1.0),
        5: (None, 1.0),
        6: (None, 1.0),
    }
    latest = by_key(cleaning.latest_per_customer(clean), "customer_id", "subscription_id")
    assert latest == {1: (1,), 2: (3,), 3: (6,)}
    assert [r[5:] for r in rows(cleaning.subscription_report(df, ["start_date"]))] == [
        (1, 0),
        (0, 1),
        (0, 1),
    ]


@pytest.fixture
def tickets(table):
    made = datetime(2020, 1, 1, 12)

    def ticket(i, customer, created, resolved=None, score=None, escalated=False):
        return (i, customer, None, None, None, None, created, resolved, score, escalated)

    return table(
        [
            ticket(1, 1, made, datetime(2020, 1, 1, 13, 30), 4, True),
            ticket(1, 1, datetime(2020, 2, 1), None, 5),
            ticket(2, 1, made, datetime(2020, 1, 1, 11), None, True),
            ticket(3, 1, datetime(2019, 7, 1), None, 1),  # exactly at the cut-off
            ticket(4, 1, datetime(2019, 6, 30, 23), None, 1),
            ticket(5, 2, datetime(2030, 1, 1), None, 2),  # after the reference time
            ticket(6, None, made),
        ],
        schema_of("support_tickets"),
    )


def test_tickets(tickets):
    clean = cleaning.clean_tickets(tickets, ["created_at"])
    hours = by_key(clean, "ticket_id", "resolution_hours")
    assert hours == {1: (1.5,), 2: (None,), 3: (None,), 4: (None,), 5: (None,), 6: (None,)}
    assert by_key(
        cleaning.ticket_summary(clean, "2020-01-01"),
        "customer_id",
        "ticket_count",
        "avg_satisfaction",
        "escalated_count",
    ) == {1: (3, 2.5, 2), 2: (1, 2.0, 0)}
    assert [r[5:] for r in rows(cleaning.ticket_report(tickets, ["created_at"]))] == [
        (1, 0),
        (0, 1),
    ]


def test_member_engagement(table):
    start, end = datetime(2020, 1, 1), datetime(2020, 1, 5)
    df = table(
        [
            (1, 1, 9, 4, 2, 90_000.0, start, end),
            (1, 1, 9, 1, 1, 1.0, end, end),
            (1, 2, 1, 1, 20, None, start, start),
        ],
        "customer_id bigint, member_id bigint, total_events bigint, days_active bigint, "
        "feature_count bigint, avg_session_sec double, first_seen timestamp_ntz, "
        "last_seen timestamp_ntz",
    )
    got = by_key(
        cleaning.member_engagement(df),
        "member_id",
        "avg_session_sec",
        "tenure_days",
        "engagement_score",
    )
    assert got == {1: (86_400.0, 4.0, 0.4 + 0.06 + 0.3), 2: (None, 1.0, 0.7)}
    assert [r[5:] for r in rows(cleaning.activity_report(df))] == [(1, 0), (0, 1)]
