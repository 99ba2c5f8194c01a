"""Joins of points with the intervals that hold them, by blocks of the axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: Column,
    low: Column,
    high: Column,
    width: int,
) -> DataFrame:
    """Every point with every interval of its `keys` that holds it, ends included.

    `at` (of `points`), `low` and `high` (of `intervals`) are whole numbers. The axis is cut into
    blocks of `width`; an interval stands in each block it reaches into, a point in its own, and
    both meet on (keys, block). So a key with many points is as many groups as it has blocks,
    and a row meets only rows at most an interval and a block away. An interval is repeated
    (high - low) / `width` times: choose a width near the usual length.

    NULL keys, points or ends match nothing; an interval that ends before it starts is empty.
    Columns of both sides other than the keys should have different names.
    """
    where = F.floor(at / width).alias("_block")
    first, last = F.floor(low / width), F.floor(high / width)
    reached = F.when(low <= high, F.sequence(first, last))
    placed = points.select("*", at.alias("_at"), where)
    spans = intervals.select("*", low.alias("_low"), high.alias("_high"), F.explode(reached).alias("_block"))
    inside = F.col("_at").between(F.col("_low"), F.col("_high"))
    return (
        placed.join(spans, [*keys, "_block"])
        .filter(inside)
        .drop("_block", "_at", "_low", "_high")
    )
