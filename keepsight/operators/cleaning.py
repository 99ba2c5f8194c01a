"""Cleaning steps. Each function has a report counterpart that counts what the step changed.

A report is one aggregate over the de-duplicated rows, which carry their number of copies; no
step is counted by a pass of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.functions import (
    as_wall_clock,
    days_between,
    months_before,
    parse_wall_clock,
    strip_whitespace,
)
from keepsight.operators.events import engagement_score
from keepsight.operators.relational import first_row, last_row

# Fixed value: what counts as an e-mail address.
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"

LONGEST_SESSION_SEC = 86_400
COPIES = "_copies"


def _moment(df: DataFrame, name: str) -> Column:
    """A date or timestamp column as wall clock; text is parsed, bad text gives NULL."""
    if dict(df.dtypes)[name] == "string":
        return parse_wall_clock(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def _email(df: DataFrame) -> Column:
    return F.lower(strip_whitespace(F.col("contact_email")))


def clean_customers(df: DataFrame, order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """First row per customer by `order`; dates parsed, e-mail and NPS checked, churn flag added.

    An e-mail is stripped and lower-cased, and NULL if it does not look like one. An NPS outside
    0 to 10 becomes NULL. A customer without `is_active` counts as active. `drop` lists helper
    columns (a load number, say) to leave out.
    """
    unique = first_row(df, ["customer_id"], order)
    email = _email(df)
    return unique.withColumns(
        {
            "signup_date": _moment(df, "signup_date"),
            "churned_at": _moment(df, "churned_at"),
            "contact_email": F.when(email.rlike(EMAIL_PATTERN), email),
            "nps_score": F.when(F.col("nps_score").between(0, 10), F.col("nps_score")),
            "is_churned": ~F.coalesce(F.col("is_active"), F.lit(True)),
        }
    ).drop(*drop)


def clean_subscriptions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row per subscription; an end before the start and a negative MRR become NULL."""
    unique = first_row(df, ["subscription_id"], order)
    start, end = _moment(df, "start_date"), _moment(df, "end_date")
    return unique.withColumns(
        {
            "start_date": start.cast("date"),
            "end_date": F.when(start.isNull() | (end >= start), end).cast("date"),
            "trial_end_date": _moment(df, "trial_end_date").cast("date"),
            "mrr_usd": F.when(F.col("mrr_usd") >= 0, F.col("mrr_usd")),
        }
    )


def latest_per_customer(subscriptions: DataFrame) -> DataFrame:
    """Newest subscription per customer: latest start date, then highest id; no date is oldest."""
    return last_row(subscriptions, ["customer_id"], ["start_date", "subscription_id"])


def _resolution(df: DataFrame) -> Column:
    return days_between(_moment(df, "created_at"), _moment(df, "resolved_at")) * 24


def clean_tickets(df: DataFrame, order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """First row per ticket, with the hours to resolution (NULL if negative)."""
    unique = first_row(df, ["ticket_id"], order)
    hours = _resolution(df)
    return unique.withColumns(
        {
            "created_at": _moment(df, "created_at"),
            "resolved_at": _moment(df, "resolved_at"),
            "resolution_hours": F.when(hours >= 0, hours),
        }
    ).drop(*drop)


def ticket_summary(
    tickets: DataFrame, as_of: str | date | datetime, months: int = 6
) -> DataFrame:
    """Tickets, mean satisfaction and escalations per customer since `months` before `as_of`.

    The window is open at its end and not moved to a month start, unlike that of plan health.
    """
    return (
        tickets.filter(F.col("created_at") >= months_before(as_wall_clock(as_of), months))
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("ticket_id").alias("ticket_count"),
            F.avg(F.col("satisfaction_score").cast("double")).alias("avg_satisfaction"),
            F.count_if("escalated").alias("escalated_count"),
        )
    )


def member_engagement(
    activity: DataFrame, order: Sequence[str] = ("first_seen", "last_seen")
) -> DataFrame:
    """Score members on durations capped at a day; first row per (customer, member)."""
    unique = first_row(activity, ["customer_id", "member_id"], order)
    length = F.when(
        F.col("avg_session_sec") > LONGEST_SESSION_SEC, F.lit(float(LONGEST_SESSION_SEC))
    ).otherwise(F.col("avg_session_sec"))
    tenure = F.greatest(F.lit(1.0), days_between(F.col("first_seen"), F.col("last_seen")))
    return unique.withColumn("avg_session_sec", length).withColumns(
        {"tenure_days": tenure, "engagement_score": engagement_score(F.col("avg_session_sec"))}
    )


def _report(counted: DataFrame, table: str, changes: dict[str, Column]) -> DataFrame:
    """One row per step: rows in, rows out and values changed, in step order."""
    rows_in, rows_out = F.sum(COPIES), F.count(F.lit(1))
    totals = counted.agg(
        F.coalesce(rows_in, F.lit(0)).alias("in"),
        rows_out.alias("out"),
        *[F.count_if(change).alias(f"c{i}") for i, change in enumerate(changes.values())],
    )

    def entry(number: int, step: str, before: str, after: str, changed: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(number).alias("step_number"),
            F.lit(step).alias("step"),
            F.col(before).alias("rows_before"),
            F.col(after).alias("rows_after"),
            (F.col(before) - F.col(after)).alias("rows_dropped"),
            changed.cast("bigint").alias("values_changed"),
        )

    entries = [entry(1, "drop duplicates", "in", "out", F.lit(0))]
    for i, step in enumerate(changes):
        entries.append(entry(i + 2, step, "out", "out", F.col(f"c{i}")))
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def customer_report(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """What `clean_customers` does to its input. Missing dates are counted after parsing."""
    counted = first_row(df, ["customer_id"], order, COPIES)
    nps = F.col("nps_score")
    return _report(
        counted,
        "customers",
        {
            "signup_date missing": _moment(df, "signup_date").isNull(),
            "churned_at missing": _moment(df, "churned_at").isNull(),
            "contact_email invalid": ~F.coalesce(_email(df).rlike(EMAIL_PATTERN), F.lit(False)),
            "nps_score out of range": nps.isNotNull() & ~nps.between(0, 10),
        },
    )


def subscription_report(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """What `clean_subscriptions` does to its input."""
    counted = first_row(df, ["subscription_id"], order, COPIES)
    return _report(
        counted,
        "subscriptions",
        {
            "end_date before start_date": _moment(df, "end_date") < _moment(df, "start_date"),
            "mrr_usd negative": F.col("mrr_usd") < 0,
        },
    )


def ticket_report(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """What `clean_tickets` does to its input."""
    counted = first_row(df, ["ticket_id"], order, COPIES)
    return _report(counted, "tickets", {"resolution negative": _resolution(df) < 0})


def activity_report(
    activity: DataFrame, order: Sequence[str] = ("first_seen", "last_seen")
) -> DataFrame:
    """What `member_engagement` does to its input."""
    counted = first_row(activity, ["customer_id", "member_id"], order, COPIES)
    too_long = F.col("avg_session_sec") > LONGEST_SESSION_SEC
    return _report(counted, "activity", {"avg_session_sec capped": too_long})
