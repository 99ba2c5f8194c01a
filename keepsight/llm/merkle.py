"""Merkle manifest of a dataset: leaves, subroots of languages, a root, and proofs.

The leaves of a group have ranks, and every node is labelled with the interval [lo, hi] of the
leaf ranks it covers. Nodes of level k start at multiples of FAN ** k, so a node's parent is found
by an equal bucket (its lo divided by the parent's width) and by containment of the intervals.
What a parent's interval covers beside a node's own are the node's siblings: the children that end
before it starts stand left of it in the hash, those that start after it ends stand right.

Ancestors are attached from the top down, one containment join a level: a node's path is its step
(texts left and right) followed by its parent's path. Only the last of these joins has a row for
each leaf; the ones above have an eighth of the rows each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.llm.order import ranked
from keepsight.llm.store import lower_ascii, stored

FAN = 8
#: Documents whose id's crc32 this divides are tampered with in the audit.
TAMPER_EVERY = 3
#: What a tree's tops hand down to its leaves beside the path.
CARRIED = ("subroot", "root")
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as `-` if NULL, else its UTF-8 byte count, `:` and value."""

    def framed(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return sha256_hex(F.concat(*map(framed, fields)))


def _parents(nodes: DataFrame, width: int) -> DataFrame:
    """The parents of `nodes` that are not the last of their group, over runs of FAN nodes."""
    child = F.struct("lo", "hi", "digest")
    runs = nodes.groupBy("group", "size", F.floor(F.col("lo") / (FAN * width)).alias("bucket")).agg(
        F.sort_array(F.collect_list(child)).alias("children")
    )
    return runs.select(
        "group",
        "size",
        "bucket",
        F.array_min("children.lo").alias("lo"),
        F.array_max("children.hi").alias("hi"),
        sha256_hex(F.array_join("children.digest", "")).alias("digest"),
        "children",
    )


def build_tree(leaves: DataFrame) -> list[DataFrame]:
    """Inner levels, lowest first, over `leaves` (`group`, `rank`, `size`, `digest`).

    A level holds the nodes of the groups that have more than one node below it: `group`, `size`,
    `bucket`, `lo`, `hi`, `digest` and `children` (lo, hi, digest; FAN at most).
    """
    nodes = leaves.select("group", "size", F.col("rank").alias("lo"), F.col("rank").alias("hi"), "digest")
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels: list[DataFrame] = []
    width = 1
    while width < most:
        level = stored(_parents(nodes.where(F.col("size") > width), width), "tree-level")
        levels.append(level)
        nodes, width = level, width * FAN
    return levels


def subroots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The last node of each group: `group`, `digest`."""
    found = leaves.where("size = 1").select("group", "digest")
    width = FAN
    for level in levels:
        found = found.unionByName(level.where(F.col("size") <= width).select("group", "digest"))
        width *= FAN
    return found


def _attach(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """`nodes` (`group`, `lo`, `hi`, ...) with what `parents` carry from above, and their `path`.

    `parents` are of the level above, whose nodes are `width` ranks wide, with their paths; a
    path is the step to the parent followed by the parent's path.
    """
    carried = [c for c in parents.columns if c in CARRIED]
    above = parents.select(
        F.col("group").alias("g"),
        F.col("lo").alias("from"),
        F.col("hi").alias("to"),
        F.floor(F.col("lo") / width).alias("above_bucket"),
        F.col("children").alias("run"),
        F.col("path").alias("above"),
        *carried,
    )
    inside = (
        F.col("group").eqNullSafe(F.col("g"))
        & (F.floor(F.col("lo") / width) == F.col("above_bucket"))
        & (F.col("from") <= F.col("lo"))
        & (F.col("hi") <= F.col("to"))
    )
    left = F.filter("run", lambda c: c["hi"] < F.col("lo"))
    right = F.filter("run", lambda c: c["lo"] > F.col("hi"))
    step = F.struct(
        F.array_join(left["digest"], "").alias("left"), F.array_join(right["digest"], "").alias("right")
    )
    path = F.concat(F.array(step), F.col("above")).alias("path")
    return nodes.join(above, inside).select(*nodes.columns, *carried, path)


def attach_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """`leaves` with `path` (for each level up to the root the texts `left` and `right` of it)
    and the other columns of `tops`.

    `tops` has a row for each `group`: the `path` on from the group's last node, and `CARRIED`.
    """

    def last(nodes: DataFrame) -> DataFrame:
        rest = tops.withColumnRenamed("group", "g")
        carried = [c for c in tops.columns if c in CARRIED]
        joined = nodes.join(rest, nodes["group"].eqNullSafe(rest["g"]))
        return joined.select(*nodes.columns, *carried, "path")

    known: DataFrame | None = None
    width = FAN ** len(levels)
    for level in reversed(levels):
        found = last(level.where(F.col("size") <= width))
        if known is not None:
            found = found.unionByName(_attach(level.where(F.col("size") > width), known, width * FAN))
        known = stored(found, "tree-paths")
        width //= FAN
    ends = leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank")})
    out = last(ends.where("size = 1"))
    if known is not None:
        out = out.unionByName(_attach(ends.where("size > 1"), known, FAN))
    return out.drop("lo", "hi")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""
    return F.aggregate(path, leaf, lambda node, step: sha256_hex(F.concat(step["left"], node, step["right"])))


def merkle_manifest(docs: DataFrame, id_column: str = "doc_id", group_column: str = "lang") -> DataFrame:
    """Per row `doc_id`, `leaf`, `tampered_leaf`, `subroot`, `root` and `path` of the Merkle tree.

    `docs` has the columns `FIELDS`. The leaves of one language ascend by id (NULL first; rows of
    one id by their leaf, so repeated rows are leaves of their own); FAN nodes after one another
    make a parent, and the last node is the language's subroot. The subroots, by language (NULL
    first, then by code units of UTF-8), make the root in the same way. `tampered_leaf` is the
    leaf of a row whose id's crc32 `TAMPER_EVERY` divides, with A-Z of its text lower-cased; NULL
    for the others and where the id is NULL. A NULL in any field is hashed as `-`. An empty table
    gives no rows; other columns, whatever their names, are not read.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = [*fields[:-1], lower_ascii(F.col(FIELDS[-1]))]
    tampered = F.crc32(F.col(id_column).cast("string")) % TAMPER_EVERY == 0
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(group_column).cast("string").alias("group"),
        leaf_digest(fields).alias("digest"),
        F.when(tampered, leaf_digest(changed)).alias("tampered_leaf"),
    )
    leaves = ranked(rows, "group", [F.col("doc_id"), F.col("digest")], "leaves")
    leaves = stored(leaves, "ranked-leaves")
    levels = build_tree(leaves)
    tops = subroots(leaves, levels).withColumnRenamed("group", "name").withColumn("group", F.lit(0))
    tops = stored(ranked(tops, "group", [F.col("name")], "subroots"), "ranked-subroots")
    upper = build_tree(tops)
    root = subroots(tops, upper).withColumnRenamed("digest", "root")
    start = root.withColumn("path", F.array().cast("array<struct<left: string, right: string>>"))
    ways = attach_paths(tops.withColumnRenamed("digest", "subroot"), upper, start)
    ways = stored(ways.select(F.col("name").alias("group"), "subroot", "root", "path"), "upper-paths")
    return attach_paths(leaves, levels, ways).select(
        "doc_id", F.col("digest").alias("leaf"), "tampered_leaf", "subroot", "root", "path"
    )


def audit(manifest: DataFrame) -> DataFrame:
    """Per row of a manifest `proof_sha256` (of the siblings' digests in order), `folded_root`
    (of the tampered leaf, else the leaf) and `verified` (it equals the root)."""
    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    folded = fold(F.coalesce("tampered_leaf", "leaf"), F.col("path"))
    return (
        manifest.withColumns({"proof_sha256": sha256_hex(F.array_join(siblings, "")), "folded_root": folded})
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    )
