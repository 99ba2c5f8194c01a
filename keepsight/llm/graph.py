"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsight.llm.store import stored


def _state(edges: DataFrame) -> tuple:
    """Number of links and an order-free check sum; one row whatever the table's size."""
    mixed = F.xxhash64("high", "low").cast("decimal(20,0)")
    row = edges.agg(F.count(F.lit(1)), F.sum(mixed)).first()
    return row[0], row[1]


def _step(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours, then its smaller ones, to its least neighbour."""
    both = edges.select("high", "low").union(edges.select(F.col("low"), F.col("high"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
    ).distinct()
    floor = large.groupBy("high").agg(F.min("low").alias("m"))
    small = large.join(floor, "high")
    down = small.where("low != m").select(F.col("low").alias("high"), F.col("m").alias("low"))
    return down.union(floor.select("high", F.col("m").alias("low"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node`, `label` for every node of the links (columns `a`, `b`): the least node reachable.

    Each step folds neighbours on the map side and joins them to one row per node, so no task
    holds a node's neighbours; each step's links are stored, so a lost executor repeats no
    earlier step. Links of a node to itself and repeated ones change nothing; no links give no
    rows.
    """
    edges = stored(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while True:
        edges = stored(_step(edges), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    high = edges.select(F.col("high").alias("node"), F.col("low").alias("label"))
    return high.union(edges.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct())
