"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into `BLOCKS` blocks by a hash of the document id. A source's blocks are
put into a random order, once for each time the source may be taken, and drawn until its target
of words is reached; the last block is drawn in part, down to a threshold of a second hash. How
many drawn blocks of each source go to which output shard is decided by a tree: at each node
the source quotas of a range of shards are split in two as a random draw without replacement
of all the node's units does it, so the parts are multivariate hypergeometric and sum to the
quotas. Each shard takes the next blocks of each source's order, so draws are disjoint, and
orders its documents by a hash.

Only sums by block and source are gathered; the tree works on at most `BLOCKS` * `MOST_TIMES`
units per source, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.llm.order import ranked, running_sums
from keepsight.llm.store import WORD_GAP, stored

BLOCKS = 256
#: Second hash by which the last block of a source is cut.
FINE = 65536
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's size in percent of all sizes, and how often a source may be taken.
PERCENT = 150
MOST_TIMES = 2
SHARDS = 16
#: Parts a shard is written in.
SLICES = 64


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _tag(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _placed(docs: DataFrame) -> DataFrame:
    """The rows with their source's tag, block and fine hash."""
    return docs.select(
        "*",
        _tag(F.col("source")).alias("tag"),
        F.pmod(_hash(1, "doc_id"), F.lit(BLOCKS)).cast("int").alias("block"),
        F.pmod(_hash(2, "doc_id"), F.lit(FINE)).cast("int").alias("fine"),
    )


def word_count(text: Column) -> Column:
    pieces = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    blank = (F.element_at(pieces, 1) == "").cast("int") + (
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")
    ).cast("int")
    return (F.size(pieces) - blank).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (`tag`, `source`, `source_size`) with `target`, its share of the mix in words.

    Targets are water levels: a source gets its cap (`MOST_TIMES` its size) or a common level
    times its weight, whichever is less.
    """
    s = sources.withColumn("all", F.lit(0))
    s = ranked(s, "all", [F.col("source").isNull(), F.col("source")], "sources")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    s = s.withColumn("weight", weight.cast("double")).drop("rank", "size")
    s = s.withColumn("cap", (MOST_TIMES * F.col("source_size")).cast("double"))
    s = s.withColumn("full", F.col("cap") / F.col("weight"))
    # In the order in which a rising level fills them; a source's level is that with all before it full.
    s = ranked(s, "all", [F.col("full"), F.col("tag")], "levels").drop("size")
    s = s.withColumns({"cap_before": F.col("cap"), "weight_before": F.col("weight")})
    s = stored(running_sums(s, "all", "rank", ["cap_before", "weight_before"], own=False), "levels")
    left = s.agg(F.sum("source_size") * (PERCENT / 100)).scalar() - F.col("cap_before")
    weights = s.agg(F.sum("weight")).scalar() - F.col("weight_before")
    s = s.withColumn("level", left / weights)
    found = s.where("level < full").agg(F.min_by("level", "rank")).scalar()
    target = F.least("cap", F.coalesce(found * F.col("weight"), "cap"))
    return s.select("tag", "source_size", target.alias("target"))


def _units(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Drawn blocks: `tag`, `block`, `turn`, `number` (their order in the source), `below`
    (documents with a smaller fine hash are taken)."""
    blocks = sizes.groupBy("tag", "block").agg(F.sum("size").alias("words"))
    turns = F.explode(F.sequence(F.lit(1), F.lit(MOST_TIMES))).alias("turn")
    along = Window.partitionBy("tag").orderBy("turn", _hash(3, "tag", "turn", "block"), "block")
    ordered = (
        blocks.select("*", turns)
        .withColumn("upto", F.sum("words").over(along))
        .withColumn("number", F.row_number().over(along))
        .join(goals, "tag")
        .withColumn("need", F.col("target") - (F.col("upto") - F.col("words")))
    )
    drawn = ordered.where("need > 0 or (need = 0 and words = 0 and target > 0)")
    drawn = stored(drawn.select("tag", "block", "turn", "number", "words", "need"), "drawn")
    cut = drawn.where("need < words")
    parts = (
        sizes.join(cut.select("tag", "block", "need"), ["tag", "block"])
        .groupBy("tag", "need", "fine")
        .agg(F.sum("size").alias("words"))
    )
    over = F.sum("words").over(Window.partitionBy("tag").orderBy("fine"))
    off = F.struct(F.abs(F.col("sum") - F.col("need")).alias("off"), "below")
    none = cut.select("tag", "need", F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("below"))
    ends = parts.select("tag", "need", over.alias("sum"), (F.col("fine") + 1).alias("below"))
    chosen = ends.unionByName(none).groupBy("tag").agg(F.min(off)["below"].alias("part"))
    whole = F.col("need") >= F.col("words")
    return drawn.join(chosen, "tag", "left").select(
        "tag", "block", "turn", "number", F.when(whole, FINE).otherwise(F.col("part")).alias("below")
    )


def _quotas(units: DataFrame, shards: int) -> DataFrame:
    """For each source its numbers 1.. with the shard that takes the block of that number."""
    node = ["first", "past"]
    tree = units.select(
        "tag", F.col("number").alias("unit"), F.lit(0).alias("first"), F.lit(shards).alias("past")
    )
    depth = (shards - 1).bit_length()
    for level in range(depth):
        middle = F.floor((F.col("first") + F.col("past") + 1) / 2).cast("int")
        share = (middle - F.col("first")) / (F.col("past") - F.col("first"))
        draw = F.row_number().over(
            Window.partitionBy(*node).orderBy(_hash(100 + level, "tag", "unit"), "tag", "unit")
        )
        size = F.count(F.lit(1)).over(Window.partitionBy(*node))
        left = draw <= F.round(size * share)
        tree = tree.withColumn("middle", middle).withColumn("left", left).select(
            "tag",
            "unit",
            F.when(F.col("left"), F.col("first")).otherwise(F.least("middle", F.col("past") - 1)).alias("first"),
            F.when(F.col("left"), F.col("middle")).otherwise(F.col("past")).alias("past"),
        )
    along = Window.partitionBy("tag").orderBy("first", "unit")
    return tree.select("tag", F.row_number().over(along).alias("number"), F.col("first").alias("shard"))


def draws(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of all documents, targets of the sources, and the drawn blocks with their shards."""
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = stored(_placed(sizes), "sizes")
    sources = sizes.groupBy("tag").agg(
        F.first("source", ignorenulls=True).alias("source"), F.sum("size").alias("source_size")
    )
    goals = stored(targets(sources), "targets")
    units = stored(_units(sizes, goals), "units")
    dealt = units.join(_quotas(units, shards), ["tag", "number"])
    return sizes, goals, stored(dealt.drop("number"), "units")


def _named(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        F.col(text_column).alias("text"),
    )


def mix_report(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shards: int = SHARDS,
) -> DataFrame:
    """Per row `doc_id`, `size` (words), `source_size`, `target` (of the source, in words),
    `taken` (words of the document that the mix takes, repeats counted) and `shards` (one for
    each time it is taken).

    Sources are ordered by code point, NULL last, and NULL is a source like any other. A text
    NULL or empty has size 0. A document is taken whole, at most `MOST_TIMES` times; rows that
    share an id, NULL included, are taken together. Sources without words have the target 0.
    Every run gives the same result. An empty table gives no rows; other columns are not read.
    """
    sizes, goals, units = draws(_named(docs, id_column, text_column, source_column), shards)
    blocks = units.groupBy("tag", "block").agg(F.collect_list(F.struct("turn", "below", "shard")).alias("draws"))
    mine = F.filter(F.coalesce("draws", F.array()), lambda d: F.col("fine") < d["below"])
    return (
        sizes.join(blocks, ["tag", "block"], "left")
        .join(goals, "tag")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.transform(F.sort_array(mine), lambda d: d["shard"]).alias("shards"),
        )
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (F.col("size") * F.size("shards")).alias("taken"),
            "shards",
        )
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shards: int = SHARDS,
) -> DataFrame:
    """The mixed rows of `docs`, each as often as it is taken, with `mix_shard` and `mix_key`.

    Rows are dealt out by shard and a part of their random key, and sorted by the key, so files
    written from the result are parts of a shuffled shard. Cases are those of `mix_report`.
    """
    _, _, units = draws(_named(docs, id_column, text_column, source_column), shards)
    own = [F.col(c).alias(f"own_{i}") for i, c in enumerate(docs.columns)]
    keyed = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), F.struct(*own).alias("row")
    )
    taken = _placed(keyed).join(units, ["tag", "block"]).where("fine < below")
    key = _hash(4, "doc_id", "turn", "shard")
    out = taken.select(
        *[F.col(f"row.own_{i}").alias(c) for i, c in enumerate(docs.columns)],
        F.col("shard").alias("mix_shard"),
        key.alias("mix_key"),
    )
    return out.repartition("mix_shard", F.pmod("mix_key", F.lit(SLICES))).sortWithinPartitions(
        "mix_shard", "mix_key"
    )
