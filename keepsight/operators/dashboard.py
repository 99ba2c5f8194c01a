"""Dashboard export: imputation and the profiles that check it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsight.functions import half_even
from keepsight.operators.customers import TICKET_BUCKETS

# What stands for a missing value, per column.
TEXT_FILLS = {
    "company_name": "Unknown",
    "industry": "Unknown",
    "company_size": "Unknown",
    "country_code": "Unknown",
    "country_name": "Unknown",
    "timezone": "Unknown",
    "contact_email": "Unknown",
    "plan_tier": "Unknown",
    "plan_name": "Unknown",
    "status": "Unknown",
    "billing_cycle": "Unknown",
    "cancellation_reason": "Not Cancelled",
    "churn_reason": "Not Churned",
}
DATE_FILLS = {"churned_at": "0", "end_date": "0", "start_date": ""}
ZERO_FILLS = ("mrr_usd", "avg_satisfaction")
FLAGS = ("is_churned", "is_active", "high_ticket")
NO_BUCKET = 99


def _fills(nps: Column) -> dict[str, Column]:
    """The filled columns; `nps` is what stands for a missing score."""
    fills = {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in TEXT_FILLS.items()}
    fills |= {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in DATE_FILLS.items()}
    fills |= {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ZERO_FILLS}
    fills |= {c: F.col(c).cast("int") for c in FLAGS}
    fills["nps_score"] = F.coalesce(F.col("nps_score").cast("double"), nps)
    position = F.lit(NO_BUCKET)
    for number, (name, _) in enumerate(TICKET_BUCKETS, start=1):
        position = F.when(F.col("ticket_bucket") == name, number).otherwise(position)
    fills["ticket_bucket_sort"] = position
    return fills


def dashboard_clean(master: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Fill missing values for a BI tool; flags become 1/0 and buckets get a sort number.

    Dates become text. Sign-up date, member count and ticket bucket stay as they are. Missing
    scores become the median of `nps_score` in `scores`, a row per customer (the clean customers,
    say), which spares a second pass over the merged rows; without it, of `master` itself.
    """
    # The cleaned score has at most 11 values, so the exact median keeps 11 counters.
    median = half_even(F.median("nps_score"), 1)
    return master.withColumns(_fills((master if scores is None else scores).agg(median).scalar()))


def _null_counts(master: DataFrame) -> tuple[DataFrame, list[str]]:
    """One row with the row count and the missing values per column, from a single pass.

    A missing score stays missing only where there is no score at all, so its median isn't needed.
    """
    fills = _fills(F.lit(None))
    names = [*master.columns, *[c for c in fills if c not in master.columns]]
    after = {c: F.count_if((fills[c] if c in fills else F.col(c)).isNull()) for c in names}
    no_score = F.count("nps_score") == 0
    after["nps_score"] = F.when(no_score, F.count(F.lit(1))).otherwise(F.lit(0).cast("bigint"))
    counts = master.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"b_{c}") for c in master.columns],
        *[number.alias(f"a_{c}") for c, number in after.items()],
    )
    return counts, names


def null_profile(master: DataFrame) -> DataFrame:
    """Missing values per dashboard column before and after filling, in column order."""
    counts, names = _null_counts(master)
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            (F.col(f"b_{c}") if c in master.columns else F.lit(None).cast("bigint")).alias(
                "nulls_before"
            ),
            F.col(f"a_{c}").alias("nulls_after"),
        )
        for i, c in enumerate(names, start=1)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*").orderBy("position")


def null_verdict(master: DataFrame) -> DataFrame:
    """Rows, columns and missing values before and after filling, and whether none is left."""
    counts, names = _null_counts(master)
    before = sum((F.col(f"b_{c}") for c in master.columns), F.lit(0).cast("bigint"))
    after = sum((F.col(f"a_{c}") for c in names), F.lit(0).cast("bigint"))
    return counts.select(
        "row_count",
        F.lit(len(master.columns)).alias("columns_before"),
        F.lit(len(names)).alias("columns_after"),
        before.alias("nulls_before"),
        after.alias("nulls_after"),
        (after == 0).alias("zero_nulls"),
    )


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Range of each numeric column (2 digits), distinct values of each other one, in one pass.

    Distinct values are counted exactly by folding (column, value) pairs, in which a numeric
    column is one pair with its range; `approximate` keeps one sketch per column instead and
    needs no shuffle of values. Without rows, ranges are NULL and distinct values 0.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if not df.columns:
        raise ValueError("no columns to profile")

    def number(c: str) -> Column:
        return F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")

    def text(c: str) -> Column:
        return F.lit(None).cast("string") if c in numeric else F.col(c).cast("string")

    low, high, unique = F.col("low"), F.col("high"), F.col("unique_values")
    if approximate:
        parts = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.min(number(c)).alias("low"),
                F.max(number(c)).alias("high"),
                F.approx_count_distinct(text(c)).alias("unique_values"),
            )
            for c in df.columns
        ]
        found = df.agg(F.array(*parts).alias("parts"))
    else:
        pairs = [
            F.struct(
                F.lit(c).alias("column_name"), text(c).alias("value"), number(c).alias("number")
            )
            for c in df.columns
        ]
        found = (
            df.select(F.inline(F.array(*pairs)))
            .groupBy("column_name", "value")
            .agg(F.min("number").alias("low"), F.max("number").alias("high"))
            .groupBy("column_name")
            .agg(
                F.min("low").alias("low"),
                F.max("high").alias("high"),
                F.count("value").alias("unique_values"),
            )
            # One row per column of `df`, so the list has a fixed length.
            .agg(F.collect_list(F.struct("column_name", low, high, unique)).alias("parts"))
        )
    by_name = F.map_from_entries(
        F.transform("parts", lambda p: F.struct(p["column_name"].alias("key"), p.alias("value")))
    )
    rows = []
    for position, c in enumerate(df.columns, start=1):
        part = F.try_element_at("by_name", F.lit(c))
        distinct = F.coalesce(part["unique_values"], F.lit(0)).cast("bigint")
        rows.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit("numeric" if c in numeric else "other").alias("kind"),
                half_even(part["low"], 2).alias("min_value"),
                half_even(part["high"], 2).alias("max_value"),
                (F.lit(None).cast("bigint") if c in numeric else distinct).alias("unique_values"),
            )
        )
    return (
        found.select(by_name.alias("by_name")).select(F.inline(F.array(*rows))).orderBy("position")
    )
