"""Customer level: master dataset, segments, profiles and the tables behind the charts."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keepsight.functions import half_even, steady_mean

# Bucket labels with the largest ticket count of each, and segment labels.
TICKET_BUCKETS = (
    ("0 tickets", 0),
    ("1 ticket", 1),
    ("2-3 tickets", 3),
    ("4-6 tickets", 6),
    ("7+ tickets", 100),
)
CHURNED_FRICTION = "Churned — High Friction"
CHURNED_QUIET = "Churned — Low Engagement"
UPSELL = "Upsell Candidates"
INACTIVE_FREE = "Inactive Free Tier"
CHAMPIONS = "Champions"
AT_RISK = "At-Risk Paid"
STABLE = "Stable Paid"

MANY_TICKETS = 3
ENGAGED_SCORE = 0.5
CHAMPION_MRR = 100

SUBSCRIPTION_COLUMNS = (
    "plan_tier",
    "plan_name",
    "mrr_usd",
    "status",
    "start_date",
    "end_date",
    "billing_cycle",
    "cancellation_reason",
)


def customer_engagement(members: DataFrame) -> DataFrame:
    """Scored members folded per customer: events add up, the best member sets the score."""
    return members.groupBy("customer_id").agg(
        F.sum("total_events").alias("total_events"),
        F.max("days_active").alias("days_active"),
        F.max("feature_count").alias("feature_count"),
        F.avg("avg_session_sec").alias("avg_session_sec"),
        F.max("engagement_score").alias("engagement_score"),
        F.count("member_id").alias("member_count"),
    )


class MergeCounts:
    """Rows around each merge of `merge_sources`, counted by the pass that computes its result.

    The counts are metrics of the running plan, so nothing is stored or computed for them. They
    are there once an action has read the merged rows, and belong to the first such action. A
    stage that Spark runs again after losing an executor is counted again; a merge is in order
    only if `rows_after` equals `rows_before`, and a report that is not calls for another run.
    """

    PARTS = ("latest subscriptions", "ticket summary", "engagement")

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, *more: Column) -> DataFrame:
        """`df`, counted as it is computed."""
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"), *more)

    def _found(self, name: str) -> dict[str, int]:
        """A watched frame's counts; Spark leaves a frame out of the running plan once it is empty."""
        try:
            return self._seen[name].get
        except Py4JJavaError:
            return {"rows": 0, "matched": 0}

    def report(self, spark: SparkSession) -> DataFrame:
        """Per merge the part's rows, the rows before and after it, and those with a match.

        Waits for an action on the merged rows.
        """
        before = self._found("customers")["rows"]
        rows = []
        for number, part in enumerate(self.PARTS, start=1):
            merged = self._found(f"with {part}")
            part_rows = self._found(part)["rows"]
            rows.append((number, part, part_rows, before, merged["rows"], merged["matched"]))
            before = merged["rows"]
        names = "step_number int, merged_part string, part_rows long, rows_before long"
        return spark.createDataFrame(rows, f"{names}, rows_after long, rows_matched long")


def merge_sources(
    customers: DataFrame,
    latest_subscriptions: DataFrame,
    ticket_summary: DataFrame,
    engagement: DataFrame,
    counts: MergeCounts | None = None,
) -> DataFrame:
    """One row per clean customer with subscription, tickets and engagement.

    Customers without tickets or events get zeros there; satisfaction and member count stay
    NULL. Every input has one row per customer, so no join repeats a row or has a hot key.
    `counts` watches the merges.
    """
    subscriptions = latest_subscriptions.select("customer_id", *SUBSCRIPTION_COLUMNS)
    parts = (subscriptions, ticket_summary, engagement)
    merged = counts.watch(customers, "customers") if counts else customers
    for name, part in zip(MergeCounts.PARTS, parts, strict=True):
        if counts is None:
            merged = merged.join(part, "customer_id", "left")
            continue
        part = counts.watch(part, name).withColumn("_matched", F.lit(True))
        merged = merged.join(part, "customer_id", "left")
        matched = F.count("_matched").alias("matched")
        merged = counts.watch(merged, f"with {name}", matched).drop("_matched")
    zeros = {
        name: F.coalesce(F.col(name), F.lit(0).cast(merged.schema[name].dataType))
        for name in (
            "ticket_count",
            "escalated_count",
            "total_events",
            "days_active",
            "feature_count",
            "engagement_score",
            "avg_session_sec",
        )
    }
    return merged.withColumns(zeros)


def bucket_label(tickets: Column) -> Column:
    """Ticket bucket; NULL above the last one."""
    label = F.lit(None).cast("string")
    for name, largest in reversed(TICKET_BUCKETS):
        label = F.when(tickets <= largest, name).otherwise(label)
    return F.when(tickets >= 0, label)


def segment_label() -> Column:
    """First matching rule; an unknown tier falls through to the paid rules."""
    many = F.col("ticket_count") > MANY_TICKETS
    free = F.coalesce(F.col("plan_tier") == "free", F.lit(False))
    return (
        F.when(F.col("is_churned") & many, CHURNED_FRICTION)
        .when(F.col("is_churned"), CHURNED_QUIET)
        .when(free & (F.col("engagement_score") >= ENGAGED_SCORE), UPSELL)
        .when(free, INACTIVE_FREE)
        .when(F.col("mrr_usd") >= CHAMPION_MRR, CHAMPIONS)
        .when(many, AT_RISK)
        .otherwise(STABLE)
    )


def assign_segments(merged: DataFrame) -> DataFrame:
    """Complete the master dataset with the ticket flag, the ticket bucket and the segment."""
    return merged.withColumns(
        {
            "high_ticket": F.col("ticket_count") > MANY_TICKETS,
            "ticket_bucket": bucket_label(F.col("ticket_count")),
            "segment_label": segment_label(),
        }
    )


def _churn_rate() -> Column:
    return F.avg(F.col("is_churned").cast("int"))


def ticket_buckets(master: DataFrame) -> DataFrame:
    """Customers and churn rate per ticket bucket, in bucket order."""
    position = F.lit(None).cast("int")
    for number, (name, _) in enumerate(TICKET_BUCKETS, start=1):
        position = F.when(F.col("ticket_bucket") == name, number).otherwise(position)
    return (
        master.filter(F.col("ticket_bucket").isNotNull())
        .groupBy("ticket_bucket")
        .agg(
            F.count("customer_id").alias("customers"),
            half_even(_churn_rate(), 3).alias("churn_rate"),
        )
        .orderBy(position)
    )


def segment_profile(master: DataFrame) -> DataFrame:
    """Size, churn and means per segment, by mean MRR; an unknown tier counts as not free."""
    free = F.coalesce(F.col("plan_tier") == "free", F.lit(False))
    means = {
        "churn_rate": _churn_rate(),
        "avg_engagement": steady_mean(F.col("engagement_score")),
        "avg_mrr": steady_mean(F.col("mrr_usd")),
        "avg_tickets": F.avg("ticket_count"),
        "avg_days_active": F.avg("days_active"),
        "pct_free_tier": F.avg(free.cast("int")),
    }
    return (
        master.groupBy("segment_label")
        .agg(
            F.count("customer_id").alias("n_customers"),
            *[half_even(mean, 3).alias(name) for name, mean in means.items()],
        )
        .orderBy(F.desc_nulls_last("avg_mrr"), "segment_label")
    )


def churn_by(master: DataFrame, column: str) -> DataFrame:
    """Customers and churn rate per non-NULL value, highest rate first."""
    return (
        master.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("customers"), _churn_rate().alias("churn_rate"))
        .orderBy(F.desc("churn_rate"), column)
    )


def segment_sizes(master: DataFrame) -> DataFrame:
    """Customers per segment, smallest first."""
    return (
        master.groupBy("segment_label")
        .agg(F.count("customer_id").alias("n_customers"))
        .orderBy("n_customers", "segment_label")
    )


def segment_mrr(master: DataFrame) -> DataFrame:
    """Mean MRR per segment to 3 digits, a segment without any MRR at 0, lowest first."""
    return (
        master.groupBy("segment_label")
        .agg(F.coalesce(half_even(steady_mean(F.col("mrr_usd")), 3), F.lit(0.0)).alias("avg_mrr"))
        .orderBy("avg_mrr", "segment_label")
    )


def engagement_vs_revenue(master: DataFrame, by: str = "plan_tier") -> DataFrame:
    """Mean engagement score and mean MRR (missing counts as 0) per group."""
    return (
        master.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            steady_mean(F.col("engagement_score")).alias("avg_engagement"),
            steady_mean(F.coalesce(F.col("mrr_usd"), F.lit(0))).alias("avg_mrr"),
        )
        .orderBy(F.asc_nulls_last(by))
    )


def kpis(master: DataFrame) -> DataFrame:
    """Customers, churn rate, mean MRR (missing counts as 0) and number of segments."""
    return master.agg(
        F.count(F.lit(1)).alias("customers"),
        _churn_rate().alias("churn_rate"),
        steady_mean(F.coalesce(F.col("mrr_usd"), F.lit(0))).alias("avg_revenue"),
        F.countDistinct("segment_label").alias("segments"),
    )


def engagement_coverage(master: DataFrame) -> DataFrame:
    """Customers with and without any engagement."""
    return master.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("engagement_score") > 0).alias("with_engagement"),
        F.count_if(F.col("engagement_score") == 0).alias("without_engagement"),
    )
