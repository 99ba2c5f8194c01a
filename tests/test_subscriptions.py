from datetime import date, datetime
from decimal import Decimal

import pytest

from keepsight.operators import subscriptions as subs
from keepsight.sources.tables import schema_of
from tests.helpers import by_key, rows

SUBS = (
    "subscription_id bigint, customer_id bigint, plan_id int, status string, "
    "billing_cycle string, start_date date, end_date date"
)
TICKETS = "ticket_id bigint, customer_id bigint, created_at timestamp_ntz"
CUSTOMERS = "customer_id bigint, company_name string, industry string"


@pytest.fixture
def plans(table):
    return table(
        [
            (1, "Free", "free", Decimal(0), Decimal(0)),
            (2, "Basic", "starter", Decimal(30), Decimal(240)),
            (3, "Big", "enterprise", Decimal(300), Decimal(3000)),
            (4, "Bigger", "enterprise", Decimal(500), Decimal(5000)),
            (5, "Odd", "mystery", Decimal(10), Decimal(100)),
        ],
        schema_of("plans"),
    )


def sub(i, customer, plan, status="active", cycle="monthly", start=None, end=None):
    return (i, customer, plan, status, cycle, start, end)


def test_plan_health(table, plans):
    held = table(
        [
            sub(1, 1, 2),
            sub(2, 1, 2, cycle="annual"),
            sub(3, 2, 2, cycle="weekly"),
            sub(4, 1, 3),
            sub(5, 9, 1, status="cancelled"),
        ],
        SUBS,
    )
    tickets = table(
        [
            (1, 1, datetime(2001, 2, 1)),  # first instant of the window
            (2, 1, datetime(2001, 8, 15, 12)),  # its last instant
            (3, 1, datetime(2001, 1, 31, 23, 59, 59)),
            (4, 1, datetime(2001, 8, 15, 12, 0, 1)),
            (5, 7, datetime(2001, 5, 1)),
        ],
        TICKETS,
    )
    got = rows(subs.plan_health(held, plans, tickets, "2001-08-15 12:00:00"))
    # customer 1 has two tickets and three subscriptions, two of them on plan 2
    assert got == [
        ("Basic", "starter", 2, round((30 + 20 + 0) / 3, 2), round(4 / 2 / 6, 3)),
        ("Big", "enterprise", 1, 300.0, round(2 / 1 / 6, 3)),
    ]


def test_ltv_by_tier(table, plans):
    held = table(
        [
            sub(1, 1, 2),
            sub(2, 2, 2, "cancelled"),
            sub(3, 3, 2),
            sub(4, 4, 3),
            sub(9, 5, 2, "trial"),
            sub(5, 5, 2),
            sub(6, 6, 2),
            sub(7, 7, 99),
        ],
        SUBS,
    )
    customers = table([(i, f"c{i}", "x") for i in range(1, 9)], CUSTOMERS)
    invoices = table(
        [
            (1, Decimal(60), "paid"),
            (1, Decimal(40), "paid"),
            (2, Decimal(100), "paid"),
            (3, Decimal(70), "open"),
            (5, Decimal(70), "paid"),
        ],
        "customer_id bigint, amount_usd decimal(18,2), status string",
    )
    got = by_key(
        subs.ltv_by_tier(customers, held, plans, invoices),
        "customer_id",
        "plan_tier",
        "tier_rank",
        "ltv_usd",
        "tier_avg_ltv_usd",
        "pct_diff_from_tier_avg",
    )
    assert got == {
        1: ("starter", 1, Decimal(100), 50.0, 100.0),
        2: ("starter", 1, Decimal(100), 50.0, 100.0),
        3: ("starter", 3, Decimal(0), 50.0, -100.0),
        6: ("starter", 3, Decimal(0), 50.0, -100.0),
        4: ("enterprise", 1, Decimal(0), 0.0, None),
    }


def test_downgrades_after_tickets(table, plans):
    day = date(2001, 6, 1)
    held = table(
        [
            sub(1, 1, 4, start=date(2001, 1, 5)),
            sub(2, 1, 3, start=day),  # same tier, cheaper
            sub(3, 2, 2, start=date(2001, 6, 1)),  # first one: no previous plan
            sub(4, 3, 4, start=date(2000, 1, 1)),
            sub(5, 3, 3, start=day),
            sub(6, 3, 2, start=day),  # second downgrade on one date
            sub(7, 4, 2, start=date(2001, 1, 1)),
            sub(8, 4, 5, start=day),  # unknown tier ranks lowest
            sub(9, 5, 4, start=date(2001, 1, 1)),
            sub(10, 5, 2, start=date(2001, 8, 2)),  # after the range
            sub(11, 6, 3, start=None),
        ],
        SUBS,
    )
    customers = table([(i, f"c{i}", "x") for i in range(1, 7)], CUSTOMERS)
    tickets = table(
        [
            (1, 1, datetime(2001, 6, 1)),  # first instant of the day counts
            (2, 1, datetime(2001, 6, 1, 10)),  # later that day does not
            (3, 1, datetime(2001, 3, 3)),  # 90 days before
            (4, 1, datetime(2001, 3, 2, 23)),
            (5, 3, datetime(2001, 5, 1)),
            (6, 4, datetime(2001, 5, 31, 23)),
            (None, 4, datetime(2001, 5, 30)),
            (8, 5, datetime(2001, 8, 1)),
            (9, 2, datetime(2001, 5, 1)),
        ],
        TICKETS,
    )
    report = subs.downgrades_after_tickets(
        held, plans, customers, tickets, "2001-01-01", "2001-08-01"
    )
    got = rows(
        report,
        "customer_id",
        "tickets_before_downgrade",
        "previous_plan",
        "current_plan",
        "monthly_revenue_lost",
    )
    assert got == [
        (3, 2, "Big", "Basic", Decimal(270)),
        (1, 2, "Bigger", "Big", Decimal(200)),
        (3, 2, "Bigger", "Big", Decimal(200)),
        (4, 1, "Basic", "Odd", Decimal(20)),
    ]


def test_churn_trend(table, plans):
    jan, feb, apr = date(2001, 1, 10), date(2001, 2, 3), date(2001, 4, 30)
    held = table(
        [
            sub(1, 1, 2, start=jan),
            sub(2, 1, 2, "cancelled", start=jan, end=feb),
            sub(3, 1, 2, "trial", start=feb),
            sub(4, 1, 2, "cancelled", start=apr, end=date(2001, 6, 1)),
            sub(5, 1, 2, "cancelled", start=None, end=apr),
            sub(6, 1, 2, "active", start=None, end=apr),
            sub(7, 1, 2, "cancelled", start=apr, end=None),
            sub(8, 1, 2, "active", start=apr, end=apr),
        ],
        SUBS,
    )
    got = rows(subs.churn_trend(held, plans))
    third = round((0 + 100 + 100 / 3) / 3, 3)
    assert got == [
        ("starter", date(2001, 1, 1), 2, None, 0, 0.0, 0.0, None),
        ("starter", date(2001, 2, 1), 1, -50.0, 1, 100.0, 50.0, None),
        ("starter", date(2001, 4, 1), 3, 200.0, 1, 33.333, third, None),
        ("starter", date(2001, 6, 1), 0, -100.0, 1, 100.0, round((100 + 100 / 3 + 100) / 3, 3), None),
    ]


def test_churn_spike(table, plans):
    months = [date(2001, m, 1) for m in (1, 2, 3)]
    held = table(
        [sub(i, 1, 2, start=m) for i, m in enumerate(months)]
        + [sub(9, 1, 2, "cancelled", start=months[0], end=months[2])],
        SUBS,
    )
    got = [r[-1] for r in rows(subs.churn_trend(held, plans))]
    assert got == [None, None, "⚠ CHURN SPIKE"]


def test_unknown_tier_keeps_starts_and_ends_apart(table):
    plans = table([(1, "X", None, Decimal(1), Decimal(1))], schema_of("plans"))
    month = date(2001, 1, 1)
    held = table([sub(1, 1, 1, "cancelled", start=month, end=month)], SUBS)
    got = rows(subs.churn_trend(held, plans), "new_subs", "churned_subs", "churn_rate_pct")
    assert sorted(got) == [(0, 1, 100.0), (1, 0, 0.0)]


def test_tier_ids(table, plans):
    held = table(
        [sub(i, c, 1) for i, c in enumerate((10, 9, 100, 101, 9))] + [sub(9, 5, 2), sub(8, 6, 1, "x")],
        SUBS,
    )
    ids = subs.tier_customers(held, plans)
    assert sorted(r[0] for r in rows(ids)) == [9, 10, 100, 101]
    assert rows(subs.id_arrays(ids, chunk=50)) == [(0, [9, 10]), (2, [100, 101])]
    texts = rows(subs.id_texts(ids, chunk=3))
    assert texts == [(0, "10, 100, 101"), (1, "9")]


def test_id_texts_of_long_ids(table):
    ids = [9_000_000_000 + 7 * i for i in range(500)] + [3, 30, -5]
    df = table([(i,) for i in [*ids, *ids[:50], None]], "customer_id long").repartition(6)
    texts = rows(subs.id_texts(df, chunk=64))
    assert [chunk for chunk, _ in texts] == list(range(8))
    assert all(len(text.split(", ")) == 64 for _, text in texts[:-1])
    assert ", ".join(text for _, text in texts) == ", ".join(sorted(map(str, ids)))
    assert rows(subs.id_texts(df.limit(0))) == []
