"""Reports on plans and subscriptions.

Expected columns: ``plans(plan_id, plan_name, plan_tier, monthly_price_usd, annual_price_usd)``,
``subscriptions(subscription_id, customer_id, plan_id, status, billing_cycle, start_date,
end_date)``, ``support_tickets(ticket_id, customer_id, created_at)``,
``customers(customer_id, company_name, industry)`` and
``billing_invoices(customer_id, amount_usd, status)``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.functions import as_wall_clock, half_up, month_of, months_before, ratio
from keepsight.operators.intervals import interval_join
from keepsight.operators.ordered import numbered, previous_value, rank_within
from keepsight.operators.relational import last_row
from keepsight.session import pin

# Rank of the plan tiers (unknown tiers rank 0) and the alert text.
TIER_LEVELS = {"free": 1, "starter": 2, "professional": 3, "enterprise": 4}
CHURN_ALERT = "⚠ CHURN SPIKE"

MONEY = "decimal(28,10)"


def tier_level(tier: Column) -> Column:
    level = F.lit(0)
    for name, rank in TIER_LEVELS.items():
        level = F.when(tier == name, rank).otherwise(level)
    return level


def plan_health(
    subscriptions: DataFrame,
    plans: DataFrame,
    tickets: DataFrame,
    as_of: str | date | datetime,
    months: int = 6,
) -> DataFrame:
    """Active customers, mean monthly revenue and ticket rate of each plan, by plan id.

    The ticket window runs from the start of the month `months` before `as_of` up to `as_of`.
    A customer's tickets count once for every active subscription held, on every plan.

    Subscriptions are folded to (plan, customer) before they meet the tickets, so neither a
    customer with very many subscriptions nor one with very many tickets makes a large join
    group, and the distinct customer count becomes a plain count.
    """
    window_end = as_wall_clock(as_of)
    window_start = month_of(months_before(window_end, months)).cast("timestamp_ntz")

    price = (
        F.when(F.col("billing_cycle") == "monthly", F.col("monthly_price_usd").cast(MONEY))
        .when(F.col("billing_cycle") == "annual", (F.col("annual_price_usd") / 12).cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY))
    )
    held = (
        subscriptions.filter(F.col("status") == "active")
        .select("customer_id", "plan_id", "billing_cycle")
        .join(plans, "plan_id")
        .groupBy("plan_id", "plan_name", "plan_tier", "customer_id")
        .agg(
            F.count(F.lit(1)).alias("subs"),
            F.count(price).alias("priced"),
            F.sum(price).alias("revenue"),
        )
    )
    raised = (
        tickets.filter(F.col("created_at").between(window_start, window_end))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("tickets"))
    )
    customers = F.count("customer_id")
    weighted = F.sum(F.col("subs") * F.coalesce("tickets", F.lit(0)))
    return (
        held.join(raised, "customer_id", "left")
        .groupBy("plan_id", "plan_name", "plan_tier")
        .agg(
            customers.alias("active_customers"),
            half_up(ratio(F.sum("revenue"), F.sum("priced")), 2).alias("avg_monthly_revenue_usd"),
            half_up(ratio(weighted, customers * F.lit(months)), 3).alias(
                "tickets_per_customer_per_month"
            ),
        )
        .orderBy("plan_id")
        .drop("plan_id")
    )


def ltv_by_tier(
    customers: DataFrame, subscriptions: DataFrame, plans: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Customers ranked by paid revenue inside the tier of their newest subscription.

    The newest subscription is the one with the highest id; customers whose newest one is
    neither active nor cancelled are left out. Equal values share a rank.
    """
    newest = (
        last_row(
            subscriptions.select("customer_id", "subscription_id", "plan_id", "status"),
            ["customer_id"],
            ["subscription_id"],
        )
        .filter(F.col("status").isin("active", "cancelled"))
        .join(plans.select("plan_id", "plan_tier"), "plan_id")
        .select("customer_id", "plan_tier")
    )
    paid = (
        invoices.filter(F.col("status") == "paid")
        .groupBy("customer_id")
        .agg(F.sum("amount_usd").alias("paid_usd"))
    )
    valued = pin(
        customers.select("customer_id", "company_name")
        .join(newest, "customer_id")
        .join(paid, "customer_id", "left")
        .select(
            "customer_id",
            "company_name",
            "plan_tier",
            F.coalesce("paid_usd", F.lit(0)).alias("ltv_usd"),
        )
    )
    ranked = rank_within(
        valued,
        ["plan_tier"],
        "ltv_usd",
        "tier_rank",
        descending=True,
        totals={"mean_usd": ratio(F.sum("ltv_usd"), F.count(F.lit(1)))},
    )
    above = ratio(F.col("ltv_usd").cast("double") - F.col("mean_usd"), F.col("mean_usd"))
    return ranked.select(
        "plan_tier",
        "tier_rank",
        "customer_id",
        "company_name",
        half_up(F.col("ltv_usd"), 2).alias("ltv_usd"),
        half_up(F.col("mean_usd"), 2).alias("tier_avg_ltv_usd"),
        half_up(above * 100, 1).alias("pct_diff_from_tier_avg"),
    ).orderBy(F.asc_nulls_last("plan_tier"), "tier_rank", "customer_id")


def downgrades_after_tickets(
    subscriptions: DataFrame,
    plans: DataFrame,
    customers: DataFrame,
    tickets: DataFrame,
    start: str | date,
    end: str | date,
    lookback_days: int = 90,
    min_tickets: int = 1,
) -> DataFrame:
    """Plan downgrades between `start` and `end` that followed support tickets.

    The previous plan is that of the customer's preceding subscription by start date (equal
    dates by subscription id). A downgrade goes to a lower tier, or to a cheaper plan of the
    same tier. Tickets count from `lookback_days` before the downgrade date up to its first
    instant; k downgrades of a customer on one date each show k times the tickets.

    Tickets are first folded to one row per customer and day, downgrades to one row per customer,
    date and pair of plans. Days and dates meet by blocks of `lookback_days`, two a date.
    """
    first_day, last_day = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")

    history = subscriptions.select(
        "customer_id", "subscription_id", "plan_id", F.col("start_date").cast("date")
    ).filter(F.col("customer_id").isNotNull() & (F.col("start_date") <= last_day))
    moves = previous_value(
        history,
        ["customer_id"],
        [F.col("start_date"), F.col("subscription_id"), F.col("plan_id")],
        "plan_id",
        "previous_plan_id",
    ).filter(F.col("start_date") >= first_day)

    def plan_side(prefix: str) -> DataFrame:
        return plans.select(
            F.col("plan_id").alias(f"{prefix}_plan_id"),
            F.col("plan_name").alias(f"{prefix}_plan"),
            F.col("monthly_price_usd").alias(f"{prefix}_price"),
            tier_level(F.col("plan_tier")).alias(f"{prefix}_level"),
        )

    lower_tier = F.col("curr_level") < F.col("prev_level")
    cheaper = (F.col("curr_level") == F.col("prev_level")) & (
        F.col("curr_price") < F.col("prev_price")
    )
    plan_pair = ["prev_plan_id", "prev_plan", "prev_price", "curr_plan_id", "curr_plan", "curr_price"]
    # At most a row per pair of plans is left of a customer's moves on one date.
    folded = moves.groupBy(
        "customer_id",
        F.col("start_date").alias("downgrade_date"),
        F.col("previous_plan_id").alias("prev_plan_id"),
        F.col("plan_id").alias("curr_plan_id"),
    ).agg(F.count(F.lit(1)).alias("moves"))
    same_date = Window.partitionBy("customer_id", "downgrade_date")
    downgrades = (
        folded.join(plan_side("curr"), "curr_plan_id")
        .join(plan_side("prev"), "prev_plan_id")
        .filter(lower_tier | cheaper)
        .select("customer_id", "downgrade_date", "moves", *plan_pair)
        .withColumn("same_day_moves", F.sum("moves").over(same_date))
    )

    created = F.col("created_at")
    daily = (
        tickets.filter(created >= F.date_sub(first_day, lookback_days).cast("timestamp_ntz"))
        .filter(created <= last_day.cast("timestamp_ntz"))
        .filter(F.col("ticket_id").isNotNull())
        .groupBy("customer_id", F.to_date(created).alias("ticket_day"))
        .agg(
            F.count(F.lit(1)).alias("whole_day"),
            F.count_if(created == F.to_date(created).cast("timestamp_ntz")).alias("first_instant"),
        )
    )
    day_count = F.when(F.col("ticket_day") < F.col("downgrade_date"), F.col("whole_day")).otherwise(
        F.col("first_instant")
    )
    date_number = F.unix_date("downgrade_date")
    loaded = (
        interval_join(
            daily,
            downgrades,
            ["customer_id"],
            F.unix_date("ticket_day"),
            date_number - lookback_days,
            date_number,
            max(lookback_days, 1),
        )
        .groupBy("customer_id", "downgrade_date", "moves", "same_day_moves", *plan_pair)
        .agg((F.sum(day_count) * F.col("same_day_moves")).alias("tickets_before_downgrade"))
        .filter(F.col("tickets_before_downgrade") >= min_tickets)
    )
    return (
        loaded.join(customers.select("customer_id", "company_name", "industry"), "customer_id")
        .withColumn("monthly_revenue_lost", F.col("prev_price") - F.col("curr_price"))
        .withColumn("move", F.explode(F.sequence(F.lit(1).cast("bigint"), "moves")))
        .orderBy(
            F.desc_nulls_first("monthly_revenue_lost"),
            "customer_id",
            "downgrade_date",
            "prev_plan_id",
            "curr_plan_id",
        )
        .select(
            "customer_id",
            "company_name",
            "industry",
            "downgrade_date",
            "tickets_before_downgrade",
            F.col("prev_plan").alias("previous_plan"),
            F.col("curr_plan").alias("current_plan"),
            "prev_price",
            "curr_price",
            "monthly_revenue_lost",
        )
    )


def churn_trend(
    subscriptions: DataFrame, plans: DataFrame, rolling: int = 3, spike: float = 2.0
) -> DataFrame:
    """New and churned subscriptions per tier and month, with growth, churn rate and alerts.

    The base of the churn rate is the number of subscriptions that started in the month and
    are active or cancelled (1 if there is none). Growth and the rolling mean look at
    preceding *rows* of the tier, so months without any row are skipped.

    Each subscription is read once and turned into a start and an end mark; tiers times
    months is all that is left after the single grouping. Rows of an unknown (NULL) tier keep
    their starts and ends apart, as unknown keys never match each other.
    """
    cancelled = F.col("status") == "cancelled"
    started = F.struct(
        month_of(F.col("start_date")).alias("month"),
        F.lit(1).alias("new"),
        F.lit(0).alias("churned"),
        F.col("status").isin("active", "cancelled").cast("int").alias("base"),
    )
    ended = F.struct(
        F.when(cancelled, month_of(F.col("end_date"))).alias("month"),
        F.lit(0).alias("new"),
        F.lit(1).alias("churned"),
        F.lit(0).alias("base"),
    )
    unknown_side = F.when(F.col("plan_tier").isNull(), F.col("mark.new"))
    monthly = (
        subscriptions.select("plan_id", "status", "start_date", "end_date")
        .join(plans.select("plan_id", "plan_tier"), "plan_id")
        .select("plan_tier", F.explode(F.array(started, ended)).alias("mark"))
        .filter(F.col("mark.month").isNotNull())
        .groupBy("plan_tier", F.col("mark.month").alias("month"), unknown_side.alias("_side"))
        .agg(
            F.sum("mark.new").alias("new_subs"),
            F.sum("mark.churned").alias("churned_subs"),
            F.sum("mark.base").alias("_base"),
        )
    )
    base = F.when(F.col("plan_tier").isNotNull() & (F.col("_base") > 0), F.col("_base")).otherwise(
        F.lit(1)
    )
    months = Window.partitionBy("plan_tier").orderBy("month", "_side")
    before = F.lag("new_subs").over(months)
    rate = ratio(F.col("churned_subs") * 100, F.col("_active"))
    mean_rate = F.avg("_rate").over(months.rowsBetween(1 - rolling, 0))
    return (
        monthly.withColumn("_active", base)
        .withColumn("_rate", rate)
        .withColumns(
            {
                "mom_growth_pct": half_up(ratio((F.col("new_subs") - before) * 100, before), 2),
                "churn_rate_pct": half_up(F.col("_rate"), 3),
                "rolling_3m_avg_churn_pct": half_up(mean_rate, 3),
            }
        )
        .withColumn(
            "churn_alert",
            F.when(
                F.col("churn_rate_pct") > F.lit(spike) * F.col("rolling_3m_avg_churn_pct"),
                F.lit(CHURN_ALERT),
            ),
        )
        .orderBy(F.asc_nulls_last("plan_tier"), "month", "_side")
        .select(
            "plan_tier",
            "month",
            "new_subs",
            "mom_growth_pct",
            "churned_subs",
            "churn_rate_pct",
            "rolling_3m_avg_churn_pct",
            "churn_alert",
        )
    )


def tier_customers(subscriptions: DataFrame, plans: DataFrame, tier: str = "free") -> DataFrame:
    """Distinct customers with an active subscription on a tier."""
    return (
        subscriptions.filter(F.col("status") == "active")
        .select("customer_id", "plan_id")
        .join(plans.filter(F.col("plan_tier") == tier).select("plan_id"), "plan_id", "left_semi")
        .select("customer_id")
        .distinct()
    )


def id_arrays(ids: DataFrame, chunk: int = 10_000) -> DataFrame:
    """The ids as sorted arrays, one per id range of width `chunk`.

    The arrays of all chunks in order are the one sorted list; no row holds more than `chunk`
    ids.
    """
    return (
        ids.filter(F.col("customer_id").isNotNull())
        .groupBy(F.expr(f"(customer_id - pmod(customer_id, {chunk})) div {chunk}").alias("chunk"))
        .agg(F.sort_array(F.collect_set("customer_id")).alias("customer_ids"))
        .orderBy("chunk")
    )


def id_texts(ids: DataFrame, chunk: int = 10_000, separator: str = ", ") -> DataFrame:
    """The ids as text in text order, joined by `separator`: rows of `chunk` ids, numbered from 0.

    The texts of all rows in order, joined by the separator, are the one list. Every row but the
    last holds exactly `chunk` ids, however many digits they have.
    """
    texts = (
        ids.filter(F.col("customer_id").isNotNull())
        .select(F.col("customer_id").cast("string").alias("id"))
        .distinct()
    )
    entry = F.struct("number", "id")
    return (
        numbered(texts, [], [F.col("id")], "number")
        .groupBy(F.floor(F.col("number") / chunk).alias("chunk"))
        .agg(F.array_join(F.sort_array(F.collect_list(entry))["id"], separator).alias("customer_ids"))
        .orderBy("chunk")
    )
