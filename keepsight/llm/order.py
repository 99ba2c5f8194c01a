"""Ranks and running sums within groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.llm.store import stored

#: Rows of a group that one task sums up in order.
CHUNK = 1024
#: A sum's terms and totals are taken modulo this, where `modulo` is asked for.
MODULUS = 1 << 40


def ranked(df: DataFrame, group: str, order: Sequence[str | Column], label: str) -> DataFrame:
    """The rows with `rank` (from 0, in `order`) within `group` and `size` (rows of the group).

    Rows are dealt out by ranges of (group, order), so a group of any size is many ranges; equal
    rows, which any order suits, are spread as well. Each row's place in its range is taken as the
    ranges are written, and the ranges' totals tell where in its group a range starts.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_spread")]
    ranges = df.withColumn("_spread", spread).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    placed = ranges.drop("_spread").withColumns({"_at": place, "_range": F.shiftright(place, 33)})
    placed = stored(placed, label)
    whole = Window.partitionBy(group)
    ahead = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(group, "_range")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumns(
            {"_ahead": F.coalesce(F.sum("_rows").over(ahead), F.lit(0)), "size": F.sum("_rows").over(whole)}
        )
        .select(F.col(group).alias("_group"), F.col("_range").alias("_part"), "_first", "_ahead", "size")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_part"))
    return placed.join(starts, same).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("rank"), "size"
    )


def running_sums(
    df: DataFrame,
    group: str,
    at: str,
    columns: Sequence[str],
    own: bool = True,
    backwards: bool = False,
    modulo: bool = False,
) -> DataFrame:
    """`columns` replaced by their sums over the rows of `group` up to each row, in order of `at`.

    `at` numbers the rows of a group and is never NULL; `own` adds the row itself. Chunks of
    `CHUNK` numbers are summed one by one, with what the chunks before them sum to.
    """
    chunk = F.floor(F.col(at) / CHUNK)
    d = df.withColumn("_chunk", chunk)
    order = F.col(at).desc() if backwards else F.col(at).asc()
    inside = Window.partitionBy(group, "_chunk").orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    chunks = F.col("_chunk").desc() if backwards else F.col("_chunk").asc()
    ahead = Window.partitionBy(group).orderBy(chunks).rowsBetween(Window.unboundedPreceding, -1)

    def rest(column: Column) -> Column:
        return F.pmod(column, F.lit(MODULUS)) if modulo else column

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    totals = d.groupBy(group, "_chunk").agg(*[rest(F.sum(c)).alias(c) for c in columns])
    carried = totals.select(group, "_chunk", *[rest(before(c, ahead)).alias(f"_before_{c}") for c in columns])
    summed = d.withColumns({f"_{c}": before(c, inside) for c in columns})
    sums = {c: rest(F.col(f"_{c}") + F.col(f"_before_{c}")) for c in columns}
    return summed.join(carried, [group, "_chunk"]).withColumns(sums).select(*df.columns)
