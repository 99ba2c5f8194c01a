"""Approximate nearest neighbours by small-world graphs of shards, with results merged.

Vectors of one direction are folded to one node first, with the few smallest ids that an answer
can hold, so a vector with very many copies or multiples is one node. The nodes are dealt by hash
to shards of about `SHARD_ROWS`; each shard's graph is built in one task and stored as flat arrays.
Queries move to the shards, whose graphs stay whole: a shard is copied only for every `QUERY_ROWS`
queries. Each shard gives its best with all ties at the last place, scored in double precision,
and a ranking per query merges them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsight.llm.small_world import SmallWorld
from keepsight.llm.store import python_path, stored

SHARD_ROWS = 4096
QUERY_ROWS = 8192
BREADTH = 160
NEIGHBOURS = 5
# cosines that agree in so many digits are ties, directions that do so are one
TIE_DIGITS = 12

_INDEX = (
    "dim int, shard long, nodes binary, vectors binary, entry int, levels binary, links array<binary>"
)
_FOUND = "query binary, node binary, score double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by the largest component first, as squares may overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node", kind="stable")
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    graph = SmallWorld.build(_unit(vectors).astype(np.float32), seed=int(rows["shard"].iloc[0]) + 1)
    return pd.DataFrame(
        {
            "dim": rows["dim"].iloc[:1].to_numpy(),
            "shard": rows["shard"].iloc[:1].to_numpy(),
            "nodes": [b"".join(rows["node"])],
            "vectors": [vectors.tobytes()],
            "entry": [graph.entry],
            "levels": [graph.levels.tobytes()],
            "links": [[level.tobytes() for level in graph.links]],
        }
    )


def _searcher(breadth: int, most: int):
    def search(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """Answers of one shard (a single row, or none) to its queries."""
        out: list[tuple[bytes, bytes, float]] = []
        if len(shard) and len(queries):
            row = shard.iloc[0]
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, int(row["dim"]))
            unit = _unit(vectors)
            levels = np.frombuffer(row["levels"], np.int8)
            links = [np.frombuffer(level, np.int32).reshape(len(vectors), -1) for level in row["links"]]
            graph = SmallWorld(unit.astype(np.float32), levels, links, int(row["entry"]))
            width = len(row["nodes"]) // len(vectors)
            nodes = [row["nodes"][i : i + width] for i in range(0, len(row["nodes"]), width)]
            wanted = _unit(np.stack(queries["vector"].to_numpy()).astype(np.float64))
            for name, vector in zip(queries["node"], wanted, strict=True):
                found = graph.nearest(vector.astype(np.float32), breadth)
                scores = np.clip(unit[found] @ vector, -1.0, 1.0)
                last = np.sort(scores)[-min(most, len(scores))] - 10.0**-TIE_DIGITS
                for at in np.flatnonzero(scores >= last):
                    out.append((bytes(name), nodes[found[at]], float(scores[at])))
        return pd.DataFrame(out, columns=["query", "node", "score"])

    return search


def _direction(vector: Column) -> Column:
    """16 bytes that vectors of one direction share: components by the largest, on a fine grid."""
    largest = F.array_max(F.transform(vector, F.abs))
    grid = F.transform(vector, lambda x: F.floor(x / largest * F.lit(10.0**TIE_DIGITS) + F.lit(0.5)))
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(i), F.size(vector), grid)), 16, "0") for i in (1, 2)]
    return F.unhex(F.concat(*halves))


def _usable(vector: Column) -> Column:
    value = vector.cast("array<double>")
    sound = F.forall(
        value,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & sound & F.exists(value, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    breadth: int = BREADTH,
) -> DataFrame:
    """The `k` nearest rows by cosine that the graphs find for each query row.

    `is_query` is a condition on the rows of `vectors`. Returns `query_id`, `rank` (from 1),
    `vec_id` and `score` (cosine in double precision), nearest first, ties (cosines that agree in
    `TIE_DIGITS` digits) to the smaller id; a row is no candidate of its own id.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor
    do rows with an id NULL; only vectors of the same number of components are compared. With
    fewer candidates all are returned. Rows repeated with their id are one; an id with several
    vectors is a candidate with each, and as a query answers with its best. An empty table
    gives no rows; other columns are not read.
    """
    python_path(vectors.sparkSession)
    value = F.col(vector_column).cast("array<double>")
    rows = stored(
        vectors.where(F.col(id_column).isNotNull() & _usable(F.col(vector_column)))
        .select(
            F.col(id_column).alias("vec_id"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.size(value).alias("dim"),
            value.alias("vector"),
        )
        .withColumn("node", _direction(F.col("vector"))),
        "vectors",
    )
    # an answer needs the k smallest ids of a direction, and one more for the query's own
    ordered = Window.partitionBy("node").orderBy("vec_id")
    names = rows.groupBy("node", "vec_id").agg(F.max("asks").alias("asks"))
    named = stored(
        names.select("node", "vec_id", F.row_number().over(ordered).alias("n")).where(F.col("n") <= k + 1),
        "members",
    ).drop("n")

    def directions(of: DataFrame) -> DataFrame:
        # the same vector of a direction in every run
        vector = F.min_by("vector", F.struct("vec_id", "vector"))
        return of.groupBy("node").agg(F.first("dim").alias("dim"), vector.alias("vector"))

    count = rows.agg(F.approx_count_distinct("node")).first()[0]
    shards = max(1, -(-count // shard_rows))
    dealt = directions(rows).withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)))
    index = stored(dealt.groupBy("dim", "shard").applyInPandas(_build, _INDEX), "index")

    asking = rows.where("asks")
    asked = stored(directions(asking), "queries")
    blocks = max(1, -(-asked.count() // query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    there = asked.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)))
    there = there.withColumn("shard", every(shards)).groupBy("dim", "shard", "block")
    here = index.withColumn("block", every(blocks)).groupBy("dim", "shard", "block")
    found = stored(here.cogroup(there).applyInPandas(_searcher(breadth, k + 1), _FOUND), "found")

    # ties at the k-th place may be many vectors; all of them stay candidates
    level = F.round("score", TIE_DIGITS)
    near = found.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(level.desc())))
    near = near.where(F.col("place") <= k + 1).drop("place")
    asks = names.where("asks").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    pairs = (
        near.join(asks, "query")
        .join(named, "node")
        .where("vec_id != query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    last = Window.partitionBy("query_id").orderBy(level.desc(), "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
