"""Rank-sum test and normality screen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.functions import normal_upper_tail, ratio
from keepsight.operators.ordered import running_counts, value_counts

ALPHA = 0.05


def churn_by_ticket_group(master: DataFrame) -> DataFrame:
    """Customers and churn rate with many and with few tickets."""
    return (
        master.groupBy("high_ticket")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.avg(F.col("is_churned").cast("int")).alias("churn_rate"),
        )
        .orderBy(F.desc("high_ticket"))
    )


def mann_whitney(df: DataFrame, value: str, group: str, alpha: float = ALPHA) -> DataFrame:
    """One-sided Mann-Whitney U test: are values larger where the boolean `group` is true?

    Mean ranks with tie correction, normal approximation with continuity correction. Ranks are
    taken over the distinct values with their counts, not over rows. With an empty group or
    only one value there is no p.
    """
    known = df.filter(F.col(group).isNotNull()).withColumn("_all", F.lit(0))
    counts = value_counts(known, ["_all"], value, F.count_if(F.col(group)).alias("n_first"))
    ranked = running_counts(counts, ["_all"], value)

    def exact(column: str) -> Column:
        return F.col(column).cast("decimal(20,0)")

    twice_rank = exact("before") * 2 + exact("n") + 1
    ties = F.pow(F.col("n").cast("double"), F.lit(3)) - F.col("n")
    n1, n2, total = F.col("n_high"), F.col("n_low"), F.col("n_high") + F.col("n_low")
    mean = n1.cast("double") * n2 / 2
    variance = (
        n1.cast("double") * n2 / 12 * ((total + 1) - ratio(F.col("_ties"), total * (total - 1.0)))
    )
    deviation = F.when(variance > 0, F.sqrt(variance))
    half_square = exact("n_high") * (exact("n_high") + 1)
    return (
        ranked.agg(
            F.sum("n_first").alias("n_high"),
            (F.sum("n") - F.sum("n_first")).alias("n_low"),
            F.sum((exact("n_first") * twice_rank).cast("decimal(38,0)")).alias("_twice_ranks"),
            F.sum(ties).alias("_ties"),
        )
        .withColumn(
            "u_statistic",
            ((F.col("_twice_ranks") - half_square.cast("decimal(38,0)")).cast("double") / 2),
        )
        .withColumn("z", ratio(F.col("u_statistic") - mean - 0.5, deviation))
        .withColumn("p_value", normal_upper_tail(F.col("z")))
        .select(
            "n_high",
            "n_low",
            "u_statistic",
            "z",
            "p_value",
            (F.col("p_value") < alpha).alias("reject_h0"),
        )
    )


def normality_screen(df: DataFrame, value: str, group: str, alpha: float = ALPHA) -> DataFrame:
    """Jarque-Bera test per group over all rows.

    Fewer than three values, or values that are all equal, give no verdict.
    """
    number = F.col(value).cast("double")
    n, skew, excess = F.col("n"), F.col("skewness"), F.col("excess_kurtosis")
    statistic = n / 6 * (skew * skew + excess * excess / 4)
    return (
        df.groupBy(group)
        .agg(
            F.count(number).alias("n"),
            F.skewness(number).alias("skewness"),
            F.kurtosis(number).alias("excess_kurtosis"),
        )
        .withColumn("jarque_bera", F.when(n >= 3, statistic))
        .withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))
        .withColumn(
            "verdict",
            F.when(F.col("p_value").isNull(), "insufficient data")
            .when(F.col("p_value") > alpha, "NORMAL")
            .otherwise("NOT normal"),
        )
        .orderBy(F.desc(group))
    )
