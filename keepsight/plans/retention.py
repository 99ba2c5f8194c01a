"""From the logical tables to the master dataset, its reports and the dashboard export."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame

from keepsight.operators import cleaning, customers, dashboard, events, hypothesis, ordered
from keepsight.sources.tables import read_parquet, write_csv, write_table

SCORE_LOW, SCORE_HIGH, SCORE_BINS = 0.0, 1.5, 15


@dataclass(frozen=True)
class Inputs:
    """Raw tables (events already normalised with feature fallback) and run parameters.

    The `*_order` columns decide which copy of a duplicated row is the first.
    """

    customers: DataFrame
    subscriptions: DataFrame
    plans: DataFrame
    tickets: DataFrame
    events: DataFrame
    as_of: str | date | datetime
    customer_order: Sequence[str]
    subscription_order: Sequence[str]
    ticket_order: Sequence[str]


TICKET_COLUMNS = (
    "ticket_id", "customer_id", "created_at", "resolved_at", "satisfaction_score", "escalated",
)


def _only(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.select(*columns, *[c for c in order if c not in columns])


@dataclass(frozen=True)
class RetentionFlow:
    """The cleaning and merging steps as lazy DataFrames."""

    inputs: Inputs

    @cached_property
    def subscriptions_with_plan(self) -> DataFrame:
        plans = self.inputs.plans.select("plan_id", "plan_name", "plan_tier", "monthly_price_usd")
        return self.inputs.subscriptions.join(plans, "plan_id")

    @cached_property
    def clean_customers(self) -> DataFrame:
        return cleaning.clean_customers(self.inputs.customers, self.inputs.customer_order)

    @cached_property
    def clean_subscriptions(self) -> DataFrame:
        return cleaning.clean_subscriptions(
            self.subscriptions_with_plan, self.inputs.subscription_order
        )

    @cached_property
    def latest_subscriptions(self) -> DataFrame:
        return cleaning.latest_per_customer(self.clean_subscriptions)

    @cached_property
    def clean_tickets(self) -> DataFrame:
        return cleaning.clean_tickets(self.inputs.tickets, self.inputs.ticket_order)

    @cached_property
    def ticket_summary(self) -> DataFrame:
        # Copies are folded on whole rows, so unused columns are dropped before that.
        tickets = _only(self.inputs.tickets, TICKET_COLUMNS, self.inputs.ticket_order)
        clean = cleaning.clean_tickets(tickets, self.inputs.ticket_order)
        return cleaning.ticket_summary(clean, self.inputs.as_of)

    @cached_property
    def activity(self) -> DataFrame:
        return events.activity_by_member(self.inputs.events)

    @cached_property
    def member_engagement(self) -> DataFrame:
        return cleaning.member_engagement(self.activity)

    @cached_property
    def customer_engagement(self) -> DataFrame:
        return customers.customer_engagement(self.member_engagement)

    def _merged(self, counts: customers.MergeCounts | None = None) -> DataFrame:
        return customers.assign_segments(
            customers.merge_sources(
                self.clean_customers,
                self.latest_subscriptions,
                self.ticket_summary,
                self.customer_engagement,
                counts,
            )
        )

    @cached_property
    def master(self) -> DataFrame:
        return self._merged()

    @cached_property
    def dashboard(self) -> DataFrame:
        """The dashboard export; the median score comes from the customers, before any merge."""
        return dashboard.dashboard_clean(self.master, self.clean_customers)

    @cached_property
    def merge_counts(self) -> customers.MergeCounts:
        return customers.MergeCounts()

    @cached_property
    def counted_master(self) -> DataFrame:
        """The master dataset; the first action on it fills `merge_counts`."""
        return self._merged(self.merge_counts)

    @cached_property
    def merge_report(self) -> DataFrame:
        """Rows before and after every merge, counted in one pass over the master dataset."""
        self.counted_master.write.format("noop").mode("overwrite").save()
        return self.merge_counts.report(self.inputs.customers.sparkSession)

    @cached_property
    def cleaning_report(self) -> DataFrame:
        parts = (
            cleaning.customer_report(self.inputs.customers, self.inputs.customer_order),
            cleaning.subscription_report(
                self.subscriptions_with_plan, self.inputs.subscription_order
            ),
            cleaning.ticket_report(self.inputs.tickets, self.inputs.ticket_order),
            cleaning.activity_report(self.activity),
        )
        report = parts[0]
        for part in parts[1:]:
            report = report.unionByName(part)
        return report


def _churned(master: DataFrame) -> DataFrame:
    return master.withColumn("churned", master["is_churned"].cast("int"))


MASTER_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "churn_by_ticket_group": hypothesis.churn_by_ticket_group,
    "mann_whitney": lambda m: hypothesis.mann_whitney(_churned(m), "churned", "high_ticket"),
    "normality_screen": lambda m: hypothesis.normality_screen(
        _churned(m), "churned", "high_ticket"
    ),
    "ticket_buckets": customers.ticket_buckets,
    "segment_profile": customers.segment_profile,
    "churn_by_tier": lambda m: customers.churn_by(m, "plan_tier"),
    "churn_by_industry": lambda m: customers.churn_by(m, "industry"),
    "engagement_vs_revenue": customers.engagement_vs_revenue,
    "score_distribution": lambda m: ordered.quartiles_by(m, "engagement_score", "is_churned"),
    "score_histogram": lambda m: ordered.histogram_by(
        m, "engagement_score", "is_churned", SCORE_LOW, SCORE_HIGH, SCORE_BINS
    ),
    "segment_sizes": customers.segment_sizes,
    "segment_mrr": customers.segment_mrr,
    "mrr_box_stats": lambda m: ordered.box_stats(m, "mrr_usd", "plan_tier"),
    "kpis": customers.kpis,
    "engagement_coverage": customers.engagement_coverage,
    "null_profile": dashboard.null_profile,
    "null_verdict": dashboard.null_verdict,
}

def run(inputs: Inputs, folder: str) -> None:
    """Write the master dataset once, then every report and the dashboard export from it."""
    flow = RetentionFlow(inputs)
    spark = inputs.customers.sparkSession
    write_table(flow.counted_master, f"{folder}/master")
    master = read_parquet(spark, f"{folder}/master")
    for name, report in MASTER_REPORTS.items():
        write_table(report(master), f"{folder}/{name}")
    write_table(flow.cleaning_report, f"{folder}/cleaning_report")
    write_table(flow.merge_counts.report(spark), f"{folder}/merge_report")
    clean = dashboard.dashboard_clean(master, flow.clean_customers)
    write_csv(master, f"{folder}/master_csv")
    write_csv(clean, f"{folder}/dashboard_csv")
    write_table(dashboard.column_profile(clean), f"{folder}/column_profile")
