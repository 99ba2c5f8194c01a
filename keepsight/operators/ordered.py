"""Ranks, quantiles and box statistics over groups that do not fit one task.

A window over a whole group (all customers of one plan tier, say) sorts that group in a single
task. Here each group is cut into value ranges first. The range totals give every range its
offset, so sorting is only needed inside a range. Ranges come from approximate quantiles, but
results are exact: the cut points only decide how the work is split, and they are pinned, so
that every part of a plan uses the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.operators.relational import match_keys
from keepsight.session import pin

RANGES = 200

# Up to this many groups the cut points (RANGES values each) and offsets (2 * RANGES rows each)
# are broadcast; beyond it they are joined by shuffle.
FEW_GROUPS = 1_000

# A frequency table of at most this many rows is not cut: one task sorts it at once.
ONE_TASK_ROWS = 200_000


def _small(side: DataFrame, groups: DataFrame) -> DataFrame:
    """Broadcast a table with a bounded number of rows per group if there are few groups."""
    few = groups.count() <= FEW_GROUPS
    return F.broadcast(side) if few else side


def _count_below(cuts: str, value: str, most: int) -> Column:
    """How many of the sorted `cuts` are below the value, by halving steps."""
    steps = [2**bit for bit in reversed(range(most.bit_length()))]

    def advance(position: Column, step: Column) -> Column:
        reached = F.get(cuts, position + step - 1) < F.col(value)
        return F.when(reached, position + step).otherwise(position)

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), advance)


def _with_ranges(
    df: DataFrame, by: Sequence[str], value: str, weight: Column, ranges: int, totals: list[Column]
) -> tuple[DataFrame, DataFrame]:
    """The rows with their `_range`, and the offsets of all ranges.

    A range is odd for a value equal to a cut point, even for the open gap between two. Offsets
    hold the rows in the range, in all lower ranges and in the group. `df` should be stored.
    """
    if not totals and df.count() <= ONE_TASK_ROWS:
        ranged = df.withColumn("_range", F.lit(0))
        return ranged, F.broadcast(_offsets(ranged, by, weight))
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = pin(
        df.groupBy(*by).agg(
            F.array_distinct(F.percentile_approx(value, steps, 10 * ranges)).alias("_cuts"),
            *totals,
        )
    )
    below = _count_below("_cuts", value, ranges)
    on_cut = F.coalesce(F.get("_cuts", below) == F.col(value), F.lit(False)).cast("int")
    ranged = (
        match_keys(df, _small(cuts, cuts), by, "inner")
        .withColumn("_range", below * 2 + on_cut)
        .drop("_cuts")
    )
    return ranged, _small(_offsets(ranged, by, weight), cuts)


def _offsets(ranged: DataFrame, by: Sequence[str], weight: Column) -> DataFrame:
    """Rows per range, rows in all lower ranges, rows of the group."""
    group = Window.partitionBy(*by)
    lower = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.groupBy(*by, "_range")
        .agg(F.sum(weight).alias("_size"))
        .withColumns(
            {
                "_offset": F.coalesce(F.sum("_size").over(lower), F.lit(0)),
                "_total": F.sum("_size").over(group),
            }
        )
    )


def rank_within(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    name: str,
    descending: bool = False,
    totals: dict[str, Column] | None = None,
    ranges: int = RANGES,
) -> DataFrame:
    """``rank()`` of a non-NULL `value` per group, exact, with the sort split into ranges.

    Rows equal to a cut point all have the same rank, so they are spread over salts: a value
    that a large share of the rows holds is always a cut point. `totals` adds aggregates of the
    group as columns. `df` is read three times and should be stored.
    """
    totals = totals or {}
    ranged, offsets = _with_ranges(
        df, by, value, F.lit(1), ranges, [total.alias(n) for n, total in totals.items()]
    )
    salt = F.when(F.col("_range") % 2 == 1, F.pmod(F.xxhash64(*df.columns), F.lit(64)))
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*by, "_range", "_salt").orderBy(order)
    ahead = (
        F.col("_total") - F.col("_offset") - F.col("_size") if descending else F.col("_offset")
    )
    return (
        match_keys(ranged, offsets, [*by, "_range"], "inner")
        .withColumn("_salt", salt)
        .withColumn(name, ahead + F.rank().over(inside))
        .select(*df.columns, name, *totals)
    )


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The rows, pinned, with `_range` and their place `_at` in it, along (by, order).

    Rows are dealt out by ranges of all of `by` and `order`, so a group of any size is many ranges.
    Rows that are equal in them, whose order does not matter, are spread by a hash.
    """
    keys = [*[F.col(c) for c in by], *order, F.col("_spread")]
    place = F.monotonically_increasing_id()
    ranges = (
        df.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_spread")
    )
    return pin(ranges.withColumns({"_at": place, "_range": F.shiftright(place, 33)}))


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str
) -> DataFrame:
    """``row_number() - 1`` per group as `name`, for groups of any size; no `by` is one group.

    No task holds more than a range of the rows: a row's number is its place in its range after
    the group's rows in lower ranges.
    """
    placed = in_ranges(df, by, order)
    lower = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*by, "_range")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_ahead", F.coalesce(F.sum("_rows").over(lower), F.lit(0)))
    )
    number = F.col("_at") - F.col("_first") + F.col("_ahead")
    return match_keys(placed, starts, [*by, "_range"], "inner").select(*df.columns, number.alias(name))


def previous_value(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, name: str
) -> DataFrame:
    """``lag(value)`` per group along `order` as `name`, for groups of any size.

    The lag runs inside a range of the rows; the first row of a range takes the last value of
    the group's range before.
    """
    placed = in_ranges(df, by, order)
    inside = Window.partitionBy(*by, "_range").orderBy("_at")
    along = Window.partitionBy(*by).orderBy("_range")
    ends = (
        placed.groupBy(*by, "_range")
        .agg(F.min("_at").alias("_first"), F.max_by(value, "_at").alias("_end"))
        .withColumn("_carried", F.lag("_end").over(along))
        .drop("_end")
    )
    rows = placed.withColumn("_before", F.lag(value).over(inside))
    picked = F.when(F.col("_at") == F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))
    return match_keys(rows, ends, [*by, "_range"], "inner").select(*df.columns, picked.alias(name))


def value_counts(df: DataFrame, by: Sequence[str], value: str, *more: Column) -> DataFrame:
    """Pinned frequency table of the non-NULL values per group; `more` adds aggregates."""
    return pin(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), *more)
    )


def running_counts(
    counts: DataFrame, by: Sequence[str], value: str, ranges: int = RANGES
) -> DataFrame:
    """Add `before`, the number of rows of the group with a smaller value, to `value_counts`."""
    ranged, offsets = _with_ranges(counts, by, value, F.col("n"), ranges, [])
    return _running(match_keys(ranged, offsets, [*by, "_range"], "inner"), by, value).select(
        *counts.columns, "before"
    )


def _running(placed: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    smaller = (
        Window.partitionBy(*by, "_range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn(
        "before", F.col("_offset") + F.coalesce(F.sum("n").over(smaller), F.lit(0))
    )


def quantiles(
    counts: DataFrame,
    by: Sequence[str],
    value: str,
    wanted: dict[str, float],
    interpolate: bool = True,
    ranges: int = RANGES,
) -> DataFrame:
    """Exact quantiles per group from `value_counts`, plus the group's row count `n`.

    With `interpolate` the quantile q lies at position q * (n - 1) of the ascending values,
    linearly between neighbours; without, it is the element at zero-based index floor(q * n).
    Only the ranges that hold a wanted position are sorted.
    """
    ranged, offsets = _with_ranges(counts, by, value, F.col("n"), ranges, [])

    def position(q: float) -> Column:
        if interpolate:
            return F.lit(float(q)) * (F.col("_total") - 1)
        return F.floor(F.lit(float(q)) * F.col("_total")).cast("double")

    spots = {name: (F.floor(position(q)), F.ceil(position(q))) for name, q in wanted.items()}
    needed = F.lit(False)
    for low, high in spots.values():
        for spot in (low, high):
            needed |= (spot >= F.col("_offset")) & (spot < F.col("_offset") + F.col("_size"))
    placed = match_keys(ranged, offsets.filter(needed), [*by, "_range"], "inner")

    def value_at(spot: Column) -> Column:
        holds = (F.col("before") <= spot) & (spot < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col(value).cast("double")))

    picks = []
    for name, (low, high) in spots.items():
        picks.append(value_at(low).alias(f"_{name}_low"))
        picks.append(value_at(high).alias(f"_{name}_high"))
    results = []
    for name, q in wanted.items():
        share = position(q) - F.floor(position(q))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * share).alias(name))
    return (
        _running(placed, by, value)
        .groupBy(*by, "_total")
        .agg(*picks)
        .select(*by, F.col("_total").alias("n"), *results)
    )


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles and whiskers per non-NULL group, by median (groups without values last).

    Quartiles interpolate linearly. A whisker ends at the furthest value within 1.5 times the
    interquartile range, and at the quartile itself if there is no such value beyond it.
    """
    known = df.filter(F.col(group).isNotNull())
    # One pass over `df`; groups without values are known by their rows of NULL.
    folded = pin(known.groupBy(group, value).agg(F.count(F.lit(1)).alias("n")))
    counts = folded.filter(F.col(value).isNotNull())
    quartiles = quantiles(counts, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    amount = F.col(value).cast("double")
    few = _small(quartiles, counts.select(group).distinct())
    whiskers = (
        match_keys(counts.drop("n"), few, [group], "inner")
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(amount >= F.col("q1") - reach, amount)).alias("_low"),
            F.max(F.when(amount <= F.col("q3") + reach, amount)).alias("_high"),
        )
        .select(
            group,
            "n",
            "q1",
            "median",
            "q3",
            F.least("_low", "q1").alias("whisker_low"),
            F.greatest("_high", "q3").alias("whisker_high"),
        )
    )
    return (
        match_keys(folded.select(group).distinct(), whiskers, [group], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .orderBy(F.asc_nulls_last("median"), group)
    )


def quartiles_by(df: DataFrame, value: str, group: str) -> DataFrame:
    """Row count, quartiles and median of the non-NULL values per group."""
    counts = value_counts(df, [group], value)
    return quantiles(counts, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def histogram_by(
    df: DataFrame, value: str, group: str, low: float, high: float, bins: int
) -> DataFrame:
    """Rows per group and fixed bin [start, start + width); the last bin is closed.

    Values outside [low, high] fall into bin 0 or bin `bins` + 1, so no row is lost.
    """
    amount = F.col(value).cast("double")
    number = F.when(amount == F.lit(float(high)), F.lit(bins)).otherwise(
        F.width_bucket(amount, F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    )
    width = (high - low) / bins
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(group, number.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width))
        .select(group, "bin", "bin_start", "n")
        .orderBy(group, "bin")
    )
