"""Event side: normalisation, usage reports, upsell scoring and data diagnostics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsight.functions import (
    capped_share,
    days_between,
    half_even,
    iso_week,
    mean_of_parts,
    mean_parts,
    parse_wall_clock,
    ratio,
    steady_mean,
)
from keepsight.operators.ordered import quantiles
from keepsight.operators.relational import match_keys, may_be_in, top_k
from keepsight.session import pin

# The onboarding steps in funnel order.
FUNNEL_STEPS = (
    "signup",
    "first_login",
    "workspace_created",
    "first_project",
    "invited_teammate",
)

# Weights of the engagement score and the amounts that count as full.
FREQUENCY_WEIGHT, BREADTH_WEIGHT, DEPTH_WEIGHT = 0.40, 0.30, 0.30
FULL_FEATURES, FULL_SESSION_SEC = 10, 3600


def first_id(df: DataFrame, aliases: Sequence[str]) -> Column:
    """First non-NULL alias as a whole number.

    Numbers are taken by value, without their fraction; text that is no whole number becomes NULL.
    """
    kinds = {field.name: field.dataType for field in df.schema}

    def text(name: str) -> Column:
        value = F.col(name)
        if isinstance(kinds[name], (T.DoubleType, T.FloatType, T.DecimalType)):
            value = value.try_cast("bigint")
        return value.cast("string")

    return F.coalesce(*map(text, aliases)).try_cast("bigint")


def normalize_events(
    df: DataFrame,
    customer_aliases: Sequence[str] = (),
    member_aliases: Sequence[str] = (),
    native_time: str | None = None,
    text_time: str | None = None,
    feature_fallback: bool = False,
    time_formats: tuple[str, ...] = (),
) -> DataFrame:
    """Replace the alias columns by `customer_id`, `member_id` and `ts`.

    A native timestamp is kept, a textual one is parsed, text that is not ISO gives NULL. With
    `feature_fallback` a missing `feature` takes the event type. This is a plain projection.
    """
    added: dict[str, Column] = {}
    if customer_aliases:
        added["customer_id"] = first_id(df, customer_aliases)
    if member_aliases:
        added["member_id"] = first_id(df, member_aliases)
    times = []
    if native_time:
        times.append(F.col(native_time).cast("timestamp_ntz"))
    if text_time:
        times.append(parse_wall_clock(F.col(text_time), time_formats))
    if times:
        added["ts"] = F.coalesce(*times)
    if feature_fallback:
        added["feature"] = F.coalesce("feature", "event_type")
    used = {*customer_aliases, *member_aliases, native_time, text_time} - set(added)
    return df.withColumns(added).drop(*[c for c in used if c])


def weekly_sessions(
    events: DataFrame, top: int | None = 100, tiers: DataFrame | None = None
) -> DataFrame:
    """Weekly sessions and session length per customer, busiest customers first.

    Events count per (customer, member, ISO week). A member has the mean count over active
    weeks, and of the weekly mean durations the elements at zero-based index floor(q * n)
    of the ascending list; a week without any duration is a NULL that sorts first. Customers
    show the plain means over their members. `tiers(customer_id, plan_tier)` adds the tier.

    The only arrays hold one entry per calendar week.
    """
    complete = (
        F.col("ts").isNotNull() & F.col("customer_id").isNotNull() & F.col("member_id").isNotNull()
    )
    weekly = (
        events.filter(complete)
        .groupBy("customer_id", "member_id", iso_week(F.col("ts")).alias("week"))
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            steady_mean(F.col("session_duration_sec")).alias("duration"),
        )
    )
    weeks = F.size("durations")
    shares = {"p25_session_dur_sec": 0.25, "p50_session_dur_sec": 0.5, "p75_session_dur_sec": 0.75}
    per_member = (
        weekly.groupBy("customer_id", "member_id")
        .agg(
            F.avg("sessions").alias("sessions"),
            F.sort_array(F.collect_list(F.struct("duration"))).alias("durations"),
        )
        .select(
            "customer_id",
            "sessions",
            *[
                F.get("durations", F.floor(F.lit(q) * weeks).cast("int"))["duration"].alias(name)
                for name, q in shares.items()
            ],
        )
    )
    result = per_member.groupBy("customer_id").agg(
        F.avg("sessions").alias("avg_sessions_per_user_per_week"),
        *[F.avg(name).alias(name) for name in shares],
        F.count(F.lit(1)).alias("user_count"),
    )
    order = (F.desc(F.round("avg_sessions_per_user_per_week", 9)), F.col("customer_id"))
    result = top_k(result, top, *order) if top else result.orderBy(*order)
    if tiers is not None:
        result = result.join(tiers, "customer_id", "left").orderBy(*order)
    return result


def feature_retention(events: DataFrame, days: int = 7, dau_window: int = 30) -> DataFrame:
    """Users, return within `days` of the first use and daily use of each feature.

    Events of a (member, feature, day) fold into one row before anything is compared.
    """
    used_days = (
        events.filter(F.col("ts").isNotNull() & F.col("member_id").isNotNull())
        .filter(F.col("feature").isNotNull())
        .select("member_id", "feature", F.to_date("ts").alias("day"))
        .distinct()
    )
    first_day = F.min("day").over(Window.partitionBy("member_id", "feature"))
    returned = (F.col("day") > F.col("first")) & (F.col("day") <= F.date_add("first", days))
    return (
        used_days.withColumn("first", first_day)
        .groupBy("member_id", "feature")
        .agg(F.count(F.lit(1)).alias("days"), F.max(returned.cast("int")).alias("returned"))
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("total_unique_users"),
            F.sum("returned").alias("retained_users"),
            F.sum("days").alias("total_person_days"),
        )
        .withColumns(
            {
                "retention_rate_7d_pct": half_even(
                    ratio(F.col("retained_users") * 100, F.col("total_unique_users")), 2
                ),
                "avg_dau_estimate": half_even(
                    ratio(F.col("total_person_days"), F.lit(dau_window)), 1
                ),
            }
        )
        .orderBy(F.desc("retention_rate_7d_pct"), "feature")
    )


def funnel_stages(
    events: DataFrame, id_col: str, steps: Sequence[str] = FUNNEL_STEPS
) -> DataFrame:
    """Users who completed each step and the upper median of the step duration.

    A member counts once per step, with the duration of the earliest event (ties by `id_col`;
    events without a time come last). The median ignores missing durations and is the
    element at zero-based index floor(n / 2).
    """
    label = F.lit(None).cast("string")
    for position, step in enumerate(steps, start=1):
        label = F.when(F.col("step") == step, f"{position}_{step}").otherwise(label)
    earliest = F.struct(F.col("ts").isNull(), F.col("ts"), F.col(id_col))
    reached = (
        events.filter(F.col("completed") & F.col("member_id").isNotNull())
        .withColumn("funnel_step", label)
        .filter(F.col("funnel_step").isNotNull())
        .groupBy("funnel_step", "member_id")
        .agg(F.min_by("duration_seconds", earliest).alias("duration"))
    )
    durations = pin(
        reached.groupBy("funnel_step", "duration").agg(F.count(F.lit(1)).alias("n"))
    )
    medians = quantiles(
        durations.filter(F.col("duration").isNotNull()),
        ["funnel_step"],
        "duration",
        {"median_step_duration_sec": 0.5},
        interpolate=False,
    )
    users = durations.groupBy("funnel_step").agg(F.sum("n").alias("unique_users"))
    return (
        match_keys(users, medians.drop("n"), ["funnel_step"], "left")
        .select("funnel_step", "unique_users", "median_step_duration_sec")
        .orderBy("funnel_step")
    )


def funnel_dropoff(stages: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Share of users lost from each step to the next one; a step without users is skipped.

    The input has one row per step that somebody reached, so the step number is the order.
    """
    number = F.split_part("funnel_step", F.lit("_"), F.lit(1)).cast("int")
    numbered = stages.select(number.alias("step"), "funnel_step", "unique_users")
    following = numbered.select(
        (F.col("step") - 1).alias("step"),
        F.col("funnel_step").alias("to_step"),
        F.col("unique_users").alias("to_users"),
    )
    lost = F.col("unique_users") - F.col("to_users")
    return (
        numbered.join(following, "step")
        .filter((F.col("unique_users") > 0) & (F.col("to_users") > 0))
        .filter(F.col("step") < len(steps))
        .select(
            F.col("funnel_step").alias("from_step"),
            "to_step",
            F.round(ratio(lost * 100, F.col("unique_users")), 1).alias("dropoff_pct"),
        )
        .orderBy("from_step")
    )


def member_rollup(events: DataFrame) -> DataFrame:
    """Events, active days, features, mean duration and first and last event per member.

    Events fold once to (member, day, feature). A day counts at the first of its rows, a feature
    too, so no row is repeated for the distinct counts; both windows and the last grouping use
    the one shuffle on the member, who has at most days times features rows there.
    """
    member = ["customer_id", "member_id"]
    sums = mean_parts(F.col("session_duration_sec"))
    folded = (
        events.groupBy(*member, F.to_date("ts").alias("_day"), "feature")
        .agg(
            F.count(F.lit(1)).alias("_events"),
            F.min("ts").alias("_first"),
            F.max("ts").alias("_last"),
            *[part.alias(f"_{name}") for name, part in sums.items()],
        )
        .repartition(*member)
    )
    of_day = Window.partitionBy(*member, "_day").orderBy("feature")
    of_feature = Window.partitionBy(*member, "feature").orderBy("_day")
    marked = folded.withColumns(
        {
            "_new_day": F.col("_day").isNotNull() & (F.row_number().over(of_day) == 1),
            "_new_feature": F.col("feature").isNotNull() & (F.row_number().over(of_feature) == 1),
        }
    )
    return marked.groupBy(*member).agg(
        F.sum("_events").alias("total_events"),
        F.count_if("_new_day").alias("days_active"),
        F.count_if("_new_feature").alias("feature_count"),
        mean_of_parts({name: F.sum(f"_{name}") for name in sums}).alias("avg_session_sec"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
    )


def engagement_score(duration: Column) -> Column:
    """Weighted score of active days per day of tenure, features used and session length.

    Tenure is at least one day. The first part is not capped, the other two are.
    """
    tenure = F.greatest(F.lit(1.0), days_between(F.col("first_seen"), F.col("last_seen")))
    return half_even(
        F.lit(FREQUENCY_WEIGHT) * (F.col("days_active") / tenure)
        + F.lit(BREADTH_WEIGHT) * capped_share(F.col("feature_count"), FULL_FEATURES)
        + F.lit(DEPTH_WEIGHT) * capped_share(F.coalesce(duration, F.lit(0.0)), FULL_SESSION_SEC),
        4,
    )


def upsell_targets(
    events: DataFrame,
    ids: DataFrame | None = None,
    top: int | None = 20,
    gate: tuple[int, int, int] | None = None,
    all_if_empty: bool = False,
) -> DataFrame:
    """Members with the highest engagement score, optionally only of the customers in `ids`.

    With `all_if_empty` an empty list leaves the filter out, otherwise it selects nobody.

    `gate` = (days, events, features) keeps members that reach any of the three. Normalise the
    events with ``feature_fallback=True`` to count event types as features.

    Lists of any length are one plan: a Bloom filter of the ids thins the events as they are
    read, and the ids are joined to the members after the events are folded.
    """
    complete = events.filter(F.col("ts").isNotNull() & F.col("member_id").isNotNull())
    if ids is None:
        members = member_rollup(complete)
    else:
        wanted = ids.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
        no_list = wanted.agg(F.count(F.lit(1)) == 0).scalar() if all_if_empty else F.lit(False)
        thinned = complete.filter(no_list | may_be_in(F.col("customer_id"), wanted))
        listed = wanted.withColumn("_listed", F.lit(True))
        members = (
            member_rollup(thinned)
            .join(listed, "customer_id", "left")
            .filter(no_list | F.col("_listed"))
            .drop("_listed")
        )
    if gate is not None:
        days, count, features = gate
        members = members.filter(
            (F.col("days_active") >= days)
            | (F.col("total_events") >= count)
            | (F.col("feature_count") >= features)
        )
    scored = members.select(
        "customer_id",
        "member_id",
        engagement_score(F.col("avg_session_sec")).alias("engagement_score"),
        "days_active",
        "feature_count",
        half_even(F.col("avg_session_sec"), 0).alias("avg_session_dur_sec"),
        "total_events",
        "last_seen",
    )
    order = (F.desc("engagement_score"), F.asc_nulls_last("customer_id"), F.col("member_id"))
    return top_k(scored, top, *order) if top else scored.orderBy(*order)


def activity_by_member(events: DataFrame) -> DataFrame:
    """`member_rollup` of complete events, the duration rounded to whole seconds."""
    complete = (
        F.col("ts").isNotNull() & F.col("customer_id").isNotNull() & F.col("member_id").isNotNull()
    )
    return member_rollup(events.filter(complete)).withColumn(
        "avg_session_sec", half_even(F.col("avg_session_sec"), 0)
    )


def event_cleaning_report(events: DataFrame) -> DataFrame:
    """Events read, those that miss an id or a valid time, and those complete enough to use.

    `events` come from `normalize_events`; ids and times that are no such values are NULL there.
    """
    missing = {c: F.col(c).isNull() for c in ("customer_id", "member_id", "ts")}
    steps = {
        "events": F.count(F.lit(1)),
        **{f"{c} missing or invalid": F.count_if(gone) for c, gone in missing.items()},
        "complete": F.count_if(~reduce(or_, missing.values())),
    }
    counts = events.agg(*[count.alias(step) for step, count in steps.items()])
    return counts.unpivot([], list(steps), "step", "rows")


def field_presence(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Documents per combination of present and missing fields."""
    flags = [F.when(F.col(c).isNotNull(), "present").otherwise("missing").alias(c) for c in fields]
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("documents")).orderBy(*fields)


def distinct_values(df: DataFrame, column: str, first: int | None = None) -> DataFrame:
    """Distinct non-NULL values in order, or the first few of them."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return top_k(found, first, F.col(column)) if first else found.orderBy(column)


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-NULL values."""
    return df.agg(F.countDistinct(column).alias("distinct_values"))


def id_coverage(events: DataFrame, ids: DataFrame) -> DataFrame:
    """How many of the listed customers have any event."""
    seen = events.select("customer_id").distinct()
    return seen.join(ids.select("customer_id").distinct(), "customer_id").agg(
        F.count(F.lit(1)).alias("customers_with_events")
    )


def heavy_users(
    df: DataFrame, customer: str, member: str, min_events: int = 2, top: int = 5
) -> DataFrame:
    """(customer, member) groups of raw columns with at least `min_events` events, largest first."""
    groups = (
        df.groupBy(customer, member)
        .agg(F.count(F.lit(1)).alias("events"))
        .filter(F.col("events") >= min_events)
    )
    order = [F.asc_nulls_last(c) for c in (customer, member)]
    return top_k(groups, top, F.desc("events"), *order)


def events_of(
    df: DataFrame, customer_id: int, aliases: Sequence[str] = ("customer_id",)
) -> DataFrame:
    """Events in which any of the alias columns, number or text, holds the customer id."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    match = F.lit(False)
    for alias in aliases:
        match |= F.col(alias) == F.lit(str(customer_id) if alias in texts else customer_id)
    return df.filter(match)


def find_one(df: DataFrame, condition: Column, order: Sequence[str | Column]) -> DataFrame:
    """The first row in a total `order` for which the condition holds; no row if there is none."""
    return df.filter(condition).orderBy(*order).limit(1)


def sample_rows(
    df: DataFrame, columns: Sequence[str], n: int = 5, order: Sequence[str] = ()
) -> DataFrame:
    """The first `n` rows by `order` (by the columns themselves if not given)."""
    return top_k(df, n, *(order or columns)).select(*columns)
