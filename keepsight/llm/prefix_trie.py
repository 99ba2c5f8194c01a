"""Prefix trie of conversations by fixed-length block hashing.

A conversation is cut into blocks of BLOCK turns. The key of its first j full blocks is a hash
that adds up over the blocks, so it comes from running sums and not from a walk along the
conversation. Conversations are first grouped by block: an edge is a distinct block (full, or a
shorter last one) after a distinct key. Where a key has one edge, all its conversations go the
same way through the block, and each turn of it is one node at once. Only where a key has
several edges, because conversations diverge or end inside the block, are turn boundaries
compared, on the edges and not on the conversations.

A node's subtree is summed along chains. The smallest member of a node is the smallest member of
the nodes below it on its own way, so the nodes of one smallest member are a chain of depths,
and each chain but the root's hangs from a node of another chain. What chains hold is summed up
to the chains they hang from by doubling the distance, in as many steps as the logarithm of the
chains' nesting, and inside a chain by running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.llm.mixing import word_count
from keepsight.llm.order import CHUNK, MODULUS, ranked, running_sums
from keepsight.llm.store import python_path, stored

BLOCK = 4
#: Lanes of a key's hash, 40 bits each.
LANES = 4
#: A key with more than one row in so many of all is met by a broadcast, so there are at most as
#: many such keys; all others are few rows each and met by a shuffle.
HOT_SHARE = 512
#: Ids that are joined to one text before a node's ids are hashed in order.
ID_RANGE = 4096
REBUILT_FROM = 20
HEAD_TURNS = 4
EMPTY = sha256().hexdigest()
_ENDS = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("/", *parts).cast("binary"), 256)


def _framed(text: Column) -> Column:
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)


def turns_of(conversations: DataFrame) -> DataFrame:
    """Turns with their digest and words: `conv_id`, `position` (from 0), `turns`, `digest`, `words`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("turn"),
        _sha(_framed(role), _framed(text)).alias("digest"),
        word_count(text).alias("words"),
    )
    placed = ranked(rows, "conv_id", [F.col("turn"), F.col("digest")], "turns")
    named = {"rank": "position", "size": "turns"}
    placed = placed.withColumnsRenamed(named).select("conv_id", "position", "turns", "digest", "words")
    return stored(placed, "placed-turns")


def rebuild(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations of the audit, in the columns of `turns`.

    Conversation c gets the first h turns of conversation c - c % 20 (all if it has fewer, none
    if it is not there) before its own turns after its first h; h is c's crc32 modulo 4. One
    without turns is a row with `position` NULL.
    """
    heads = (
        turns.where(F.col("position") < HEAD_TURNS - 1)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "digest", "words"))).alias("head"))
    )
    c = F.col("conv_id")
    convs = turns.where("position = 0").select(
        "conv_id",
        F.col("turns").alias("own"),
        (c - c % REBUILT_FROM).alias("base"),
        (F.crc32(c.cast("string")) % HEAD_TURNS).alias("h"),
    )
    none = F.array().cast("array<struct<position: bigint, digest: string, words: bigint>>")
    head = F.filter(F.coalesce("head", none), lambda t: t["position"] < F.col("h"))
    convs = (
        convs.join(heads, "base", "left")
        .withColumn("head", head)
        .withColumn("added", F.size("head").cast("bigint"))
        .withColumn("total", F.col("added") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    convs = stored(convs.select("conv_id", "own", "h", "head", "added", "total"), "rebuilt")
    # A conversation of any length meets its row in chunks, not as one key.
    last = F.floor((F.col("own") - 1) / CHUNK)
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk")
    shifts = convs.select("conv_id", "h", "added", "total", chunks)
    kept = (
        turns.withColumn("chunk", F.floor(F.col("position") / CHUNK))
        .join(shifts, ["conv_id", "chunk"])
        .where(F.col("position") >= F.col("h"))
        .withColumns({"position": F.col("position") - F.col("h") + F.col("added"), "turns": F.col("total")})
        .select("conv_id", "position", "turns", "digest", "words")
    )
    begun = convs.select("conv_id", "total", F.explode_outer("head").alias("t")).where("t is not null or total = 0")
    begun = begun.select("conv_id", F.col("t.position"), F.col("total").alias("turns"), "t.digest", "t.words")
    return kept.unionByName(begun)


def _key(*lanes: Column) -> Column:
    return _sha(*[lane.cast("string") for lane in lanes])


def _edges(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct blocks after distinct keys, and the node that each conversation ends at.

    Edges: `key`, `block`, `digests`, `words` (of the block's turns), `next` (the key after a full
    block), `n_convs`, `conv_id` (smallest). Ends: `node`, `conv_id`.
    """
    turn = F.struct("position", "digest", "words")
    blocks = (
        turns.where("position is not null")
        .groupBy("conv_id", "turns", F.floor(F.col("position") / BLOCK).alias("block"))
        .agg(F.sort_array(F.collect_list(turn)).alias("t"))
        .select("conv_id", "turns", "block", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))
    )
    body = _sha(F.col("block").cast("string"), F.array_join("digests", "/"))
    lanes = [f"lane{i}" for i in range(LANES)]
    hashes = {lane: F.pmod(F.xxhash64(F.lit(i), "body"), F.lit(MODULUS)) for i, lane in enumerate(lanes)}
    blocks = stored(blocks.withColumn("body", body).withColumns(hashes), "blocks")
    before = running_sums(
        blocks.select("conv_id", "block", *lanes), "conv_id", "block", lanes, own=False, modulo=True
    ).select("conv_id", "block", *[F.col(lane).alias(f"before_{lane}") for lane in lanes])
    # Both sides hold a block once and are dealt out by conversation and block, whatever its length.
    keyed = blocks.join(before, ["conv_id", "block"])
    past = [F.pmod(F.col(f"before_{lane}") + F.col(lane), F.lit(MODULUS)) for lane in lanes]
    at, full = F.col("block"), F.size("digests") == BLOCK
    keyed = keyed.select(
        "conv_id",
        "turns",
        "block",
        "body",
        "digests",
        "words",
        _key(at, *[F.col(f"before_{lane}") for lane in lanes]).alias("key"),
        F.when(full, _key(at + 1, *past)).alias("next"),
    )
    keyed = stored(keyed, "keyed-blocks")
    edges = keyed.groupBy("key", "block", "body", "next").agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.first("digests").alias("digests"),
        F.first("words").alias("words"),
    )
    at_end = F.col("block") * BLOCK + F.size("digests") == F.col("turns")
    ends = keyed.where(at_end).select(_boundary(F.size("digests")).alias("node"), "conv_id")
    root = _key(*[F.lit(0)] * (LANES + 1))
    turnless = turns.where("position is null").select(root.alias("node"), "conv_id")
    return stored(edges, "edges"), stored(ends.unionByName(turnless), "ends")


def _boundary(turn: Column) -> Column:
    """Key of the node after the first `turn` turns of a block."""
    inside = _sha(F.col("key"), F.array_join(F.slice("digests", 1, turn), "/"))
    return F.when(turn == 0, F.col("key")).when(turn == BLOCK, F.col("next")).otherwise(inside)


def _met(rows: DataFrame, by: str, side: DataFrame, left: bool = False) -> DataFrame:
    """`rows` joined with `side` (one row a key `by`), however many rows a key has."""
    count = F.count(F.lit(1)).alias("rows")
    total = rows.agg(count).scalar()
    hot = stored(rows.groupBy(by).agg(count).where(F.col("rows") * HOT_SHARE > total).select(by), "hot-keys")
    hot_side = side.join(F.broadcast(hot), by, "left_semi")
    cold = rows.join(F.broadcast(hot), by, "left_anti")
    kind = "left" if left else "inner"
    many = rows.join(F.broadcast(hot), by, "left_semi").join(F.broadcast(hot_side), by, kind)
    return many.unionByName(cold.join(side, by, kind))


def _nodes(edges: DataFrame) -> DataFrame:
    """All nodes but the root: `node`, `parent`, `depth`, `n_convs`, `conv_id`, `words`."""
    ways = edges.groupBy("key").agg(F.count(F.lit(1)).alias("ways"))
    known = _met(edges, "key", ways)
    turn = F.explode(F.sequence(F.lit(1), F.size("digests"))).alias("r")
    steps = known.select("*", turn).select(
        _boundary(F.col("r")).alias("node"),
        _boundary(F.col("r") - 1).alias("parent"),
        (F.col("block") * BLOCK + F.col("r")).alias("depth"),
        "n_convs",
        "conv_id",
        F.element_at("words", F.col("r")).alias("words"),
        "ways",
    )
    alone = steps.where("ways = 1").drop("ways")
    parted = steps.where("ways > 1").groupBy("node", "parent", "depth").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words")
    )
    return alone.unionByName(parted)


def _end_digests(ends: DataFrame) -> DataFrame:
    """Per `node` the SHA-256 of its conversations' ids, ascending and joined by commas.

    The hash is one by definition, so a node's ids pass through one task; they come as texts of
    `ID_RANGE` ids and are hashed as they come.
    """
    texts = (
        ends.groupBy("node", F.floor(F.col("conv_id") / ID_RANGE).alias("ids"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("found"))
        .select("node", "ids", F.array_join(F.col("found").cast("array<string>"), ",").alias("text"))
    )
    python_path(ends.sparkSession)
    ordered = texts.repartition("node").sortWithinPartitions("node", "ids")
    return ordered.mapInArrow(_hash_ids, "node string, ends_sha256 string")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if name == node:
                state.update(b"," + text.as_py().encode())
                continue
            if state is not None:
                done.append((node, state.hexdigest()))
            node, state = name, sha256(text.as_py().encode())
        yield pa.RecordBatch.from_pylist([{"node": n, "ends_sha256": d} for n, d in done], schema=_ENDS)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], schema=_ENDS)


def _chain_totals(chains: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of each chain with those of all chains that hang below it.

    `chains`: `chain`, `above` (the chain it hangs from; NULL for the root's) and `columns`. Step k
    adds what lies 2 ** k to 2 ** (k + 1) chains below, so steps are few.
    """
    sums, jumps = chains.select("chain", *columns), chains.where("above is not null").select("chain", "above")
    while True:
        jumps = stored(jumps, "chain-jumps")
        if jumps.isEmpty():
            return sums
        below = _met(jumps.withColumnRenamed("chain", "from"), "from", sums.withColumnRenamed("chain", "from"))
        below = below.groupBy(F.col("above").alias("chain")).agg(*[F.sum(c).alias(f"more_{c}") for c in columns])
        added = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in columns]
        sums = stored(sums.join(below, "chain", "left").select("chain", *added), "chain-sums")
        on = jumps.select(F.col("chain").alias("above"), F.col("above").alias("next"))
        jumps = _met(jumps, "above", on).select("chain", F.col("next").alias("above"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie over `turns` (`conv_id`, `position`, `turns`, `digest`, `words`).

    Per node `conv_id` (its smallest member), `depth`, `parent_conv_id` (the parent's smallest
    member; NULL for the root), `n_convs`, `n_children`, `n_leaves`, `saved_tokens` (over the
    subtree, words of a node's turn that its members repeat) and `ends_sha256`. A conversation
    without turns (`position` NULL) ends at the root. No conversations give no nodes.
    """
    turns = stored(turns, "trie-turns")
    edges, ends = _edges(turns)
    nodes = _nodes(edges)
    root_key = _key(*[F.lit(0)] * (LANES + 1))
    starts = turns.where("position = 0 or position is null")
    root = starts.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    root = root.where("n_convs > 0").select(
        root_key.alias("node"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("bigint").alias("depth"),
        "n_convs",
        "conv_id",
        F.lit(0).cast("bigint").alias("words"),
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    heads = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = (
        _met(nodes.where("parent is not null"), "parent", heads)
        .unionByName(nodes.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("bigint")))
        .join(children, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
        .drop("words", "parent")
    )
    known = stored(known, "known-nodes")
    totals = ["n_leaves", "saved_tokens"]
    top = F.col("parent_conv_id").isNull() | (F.col("parent_conv_id") != F.col("conv_id"))
    hangs = known.where(top).select(
        F.col("conv_id").alias("chain"), F.col("parent_conv_id").alias("above"), (F.col("depth") - 1).alias("hung_at")
    )
    held = known.groupBy(F.col("conv_id").alias("chain")).agg(*[F.sum(c).alias(c) for c in totals])
    chains = stored(held.join(hangs, "chain"), "chains")
    whole = _chain_totals(chains.drop("hung_at"), totals)
    hung = (
        whole.join(chains.select("chain", "above", "hung_at"), "chain")
        .where("above is not null")
        .groupBy(F.col("above").alias("conv_id"), F.col("hung_at").alias("depth"))
        .agg(*[F.sum(c).alias(f"hung_{c}") for c in totals])
    )
    own = known.join(hung, ["conv_id", "depth"], "left").withColumns(
        {c: F.col(c) + F.coalesce(f"hung_{c}", F.lit(0)) for c in totals}
    )
    below = running_sums(own.select(*known.columns), "conv_id", "depth", totals, backwards=True)
    digests = _end_digests(ends)
    return below.join(digests, "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, rebuilt: bool = False) -> DataFrame:
    """`prefix_trie` of `conversations` (`conv_id`, `turn`, `role`, `text`), as they are or `rebuilt`.

    Turns are in the order of `turn` (NULL first; ties by a digest of role and text, so repeated
    rows are repeated turns). A NULL role or text is empty. Rows without a `conv_id` belong to no
    conversation and make no node. Texts and conversations are of any length. An empty table
    gives no rows; other columns, whatever their names, are not read.
    """
    turns = turns_of(conversations)
    return prefix_trie(rebuild(turns) if rebuilt else turns)
