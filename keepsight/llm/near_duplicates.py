"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A document's set of word shingles gets `BAND_SYMBOLS` MinHash symbols of 16 bits for each band.
Two sets of Jaccard similarity s agree in a symbol with probability s. Two signatures that differ
in fewer symbols than twice the bands differ, by pigeonhole, in at most one symbol of some band. So every band is indexed once for each symbol that may be wrong
(the key is the band's other symbols), and all pairs under that signature distance meet in a
bucket. The less similar a link may be, the more bands there are (`bands`): a pair at the least
similarity is beyond that distance with probability `MISSED` at most. At 0.85 these are 6 bands,
at 0.80 they are 9. Pairs beyond it that share a bucket are confirmed too: a pair shares none
with probability 1.8e-6 at 0.85 and 2.1e-7 at 0.80.

Equal sets are folded to one class first. Buckets are not expanded into pairs: in a first
round every class meets the least and the most central class of each of its buckets, links are
confirmed on full sets, and components are formed. In the second round only classes of buckets
that hold several components take part. Two of them meet if they share a shingle among the
rarest of each, at places that leave room for a link (the shingles before the first common one
can't be common) and are in different components; they are confirmed likewise, whatever their
signature distance. That is necessary for a link, so no link between components is lost that
shares a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.llm.graph import components
from keepsight.llm.store import forget, python_path, release, small_batches, stored

WORDS_PER_SHINGLE = 5
PERCENT = 85
BAND_SYMBOLS = 4
#: Probability that a pair at the least similarity of a link is beyond the signature distance.
MISSED = 6e-5
MOST_BANDS = 64
SYMBOL_BITS = 16
#: Characters whose shingles are made at a time.
CHUNK_CHARS = 1_000_000
COLUMNS_AT_A_TIME = 4096
#: Shingles are ranked by counts of this many leading bits of their hashes, then by hash.
COUNT_BITS = 20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_MOST = (MOST_BANDS * BAND_SYMBOLS, 1)
_FACTORS = _RANDOM.integers(1, 2**63, size=_MOST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, size=_MOST, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(percent: int) -> int:
    """Least number of bands whose signature distance misses at most `MISSED` of the links."""
    same = percent / 100
    for count in range(1, MOST_BANDS):
        size = count * BAND_SYMBOLS
        wrong = range(2 * count, size + 1)
        if sum(comb(size, k) * (1 - same) ** k * same ** (size - k) for k in wrong) <= MISSED:
            return count
    return MOST_BANDS


def shingle_set(text: str | None, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles (all its words if they are fewer)."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    width = min(size, len(split))
    rows = len(split) - width + 1
    mixed = np.full(rows, width, np.uint64)
    for place in range(width):
        mixed += hashes[place : place + rows] * _PLACES[place]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _PLACES[-1]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(shingles: np.ndarray, symbols: int) -> np.ndarray:
    least = np.full(symbols, 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), COLUMNS_AT_A_TIME):
        part = shingles[None, start : start + COLUMNS_AT_A_TIME]
        np.minimum(least, ((part * _FACTORS[:symbols] + _SHIFTS[:symbols]) >> np.uint64(20)).min(axis=1), out=least)
    return (least & np.uint64(2**SYMBOL_BITS - 1)).astype(np.int32)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list]]:
    texts = batch.column(1)
    start = size = 0
    pieces: list = []
    for at, text in enumerate(texts):
        pieces.append(text.as_py())
        size += len(pieces[-1] or "")
        if size >= CHUNK_CHARS or at + 1 == len(texts):
            yield batch.column(0).slice(start, at + 1 - start), pieces
            start, size, pieces = at + 1, 0, []


def _sign(size: int, symbols: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for ids, texts in _chunks(batch):
                sets = [shingle_set(text, size) for text in texts]
                node = [_digest(s) for s in sets]
                signs = [signature(s, symbols) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(node, pa.binary()),
                        pa.array(signs, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_shingles", "node", "symbols"],
                )

    return task


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _full_sets(size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for _, texts in _chunks(batch):
                sets = [shingle_set(text, size) for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["node", "shingles"],
                )

    return task


def _keys(count: int) -> Column:
    """One bucket key for each band and each of its symbols that may be wrong.

    A function over the keys' numbers, as one term a key would make plans of many pages.
    """

    def key(number: Column) -> Column:
        wrong = number % BAND_SYMBOLS
        first = number - wrong
        out = number.cast("long")
        for place in range(BAND_SYMBOLS - 1):
            kept = first + place + (wrong <= place).cast("int")
            out = F.shiftleft(out, SYMBOL_BITS).bitwiseOR(F.get("symbols", kept).cast("long"))
        return out

    numbers = F.sequence(F.lit(0), F.lit(count * BAND_SYMBOLS - 1))
    return F.explode(F.transform(numbers, key)).alias("key")


def _distance(a: str, b: str) -> Column:
    """Number of symbols in which two signatures differ."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda wrong: wrong))


def _sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Full sets of the classes named in `nodes` (`node`, distinct)."""
    wanted = stored(nodes.join(classes, "node").select("node", "doc_id"), "wanted")
    ids = wanted.select("doc_id").where("doc_id is not null")
    texts = docs.join(ids, "doc_id", "left_semi").union(docs.where("doc_id is null"))
    sets = (
        texts.mapInArrow(_full_sets(size), "node binary, shingles array<bigint>")
        .join(wanted.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
    )
    return stored(sets, "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) of classes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - F.col("both")
    links = (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", "x", "y", both.alias("both"))
        .where(100 * F.col("both") >= percent * either)
        .select("a", "b")
    )
    return stored(links, "confirmed")


def _near(pairs: DataFrame, symbols: DataFrame, count: int) -> DataFrame:
    """Distinct pairs under the signature distance that bands with one error guarantee."""
    left = symbols.select(F.col("node").alias("a"), F.col("symbols").alias("x"))
    right = symbols.select(F.col("node").alias("b"), F.col("symbols").alias("y"))
    under = _distance("x", "y") < 2 * count
    near = pairs.distinct().join(left, "a").join(right, "b").where(under)
    return stored(near.select("a", "b"), "pairs")


def _shared_buckets(classes: DataFrame, count: int) -> DataFrame:
    """Rows `key`, `node`, `copies`, `size` of buckets with several classes."""
    buckets = classes.select(_keys(count), "node", "copies")
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    return stored(buckets.join(sizes.where("size > 1"), "key"), "buckets")


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's least class and its most central one.

    Central is the class whose buckets are largest in sum, with more copies if several are: in a
    group of varied copies of one text that is a text which agrees with most of them.
    """
    weights = buckets.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = buckets.join(weights, "node")
    heads = weighed.groupBy("key").agg(
        F.min("node").alias("a"), F.max(F.struct("weight", "copies", "node"))["node"].alias("z")
    )
    met = buckets.join(heads, "key")
    ends = F.explode(F.array_distinct(F.array("a", "z"))).alias("head")
    pairs = met.select("node", ends).where("node != head")
    return pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))


def _open_classes(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Classes of buckets that hold several components, with their component."""
    named = buckets.join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")
    )
    mixed = named.groupBy("key").agg(F.min("label").alias("p"), F.max("label").alias("q"))
    found = named.join(mixed.where("p != q").select("key"), "key", "left_semi")
    return stored(found.select("node", "label").distinct(), "open")


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in batches:
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        counts += np.bincount(_places(values), minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["place", "n"])


def _table(places: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Counts by place, in the narrowest type that holds them, as all tasks are sent them."""
    counts = np.zeros(1 << COUNT_BITS, np.min_scalar_type(found.max(initial=0)))
    counts[places] = found
    return counts


def _rarest(counts: np.ndarray, percent: int):
    """The first shingles by rarity of each set: as many as a link can't be without."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                some = batch.slice(start, 200)
                rare = []
                for values in some.column(1):
                    own = values.values.to_numpy(zero_copy_only=False)
                    ranked = own[np.lexsort((own, counts[_places(own)]))]
                    rare.append(ranked[: len(own) - (percent * len(own) + 99) // 100 + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([len(x) for x in some.column(1)], pa.int32()),
                        pa.array(rare, pa.list_(pa.int64())),
                    ],
                    names=["node", "n", "rare"],
                )

    return task


def _cross_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a rare shingle where a link is possible."""
    counted = sets.select("shingles").mapInArrow(_count_task, "place bigint, n bigint")
    found = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = _table(found.column("place").to_numpy(), found.column("n").to_numpy())
    del found
    release()
    rows = (
        sets.mapInArrow(_rarest(counts, percent), "node binary, n int, rare array<bigint>")
        .join(open_, "node")
        .select("node", "label", "n", F.posexplode("rare").alias("place", "shingle"))
        .select("shingle", "node", "label", "n", (F.col("n") - F.col("place")).alias("room"))
    )
    left = rows.select("shingle", *[F.col(c).alias(f"a_{c}") for c in rows.columns[1:]])
    right = rows.select("shingle", *[F.col(c).alias(f"b_{c}") for c in rows.columns[1:]])
    possible = (
        (F.col("a_node") < F.col("b_node"))
        & (F.col("a_label") != F.col("b_label"))
        & (
            (100 + percent) * F.least("a_room", "b_room")
            >= percent * (F.col("a_n") + F.col("b_n"))
        )
    )
    pairs = left.join(right, (left["shingle"] == right["shingle"]) & possible)
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Component of near duplicates of every document.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set holds its
    distinct shingles of `size` words, or all its words as one if they are fewer. Documents
    with 100 * intersection >= `percent` * union are linked (confirmed on full sets).

    Returns per row `doc_id`, `n_shingles`, `component_id` (the least id reachable by links,
    itself included) and `kept` (doc_id = component_id). A text that is NULL, empty or without
    words has no shingle and is linked with nothing. Repeated rows are copies of each other and
    share their component; rows that share an id but not the text are judged one by one. An id
    NULL takes part but names no component; if all ids of a component are NULL its
    `component_id` is NULL and its rows are kept. An empty table gives no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    python_path(spark)
    count = bands(percent)
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    with small_batches(spark):
        signed = stored(
            docs.mapInArrow(
                _sign(size, count * BAND_SYMBOLS),
                f"doc_id {kind}, n_shingles bigint, node binary, symbols array<int>",
            ),
            "signed",
        )
    some = signed.where("n_shingles > 0")
    classes = stored(
        some.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"),
            F.min("symbols").alias("symbols"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    symbols, names = classes.select("node", "symbols"), classes.select("node", "doc_id")
    buckets = _shared_buckets(classes, count)
    pairs = _near(_star_pairs(buckets), symbols, count)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    with small_batches(spark):
        sets = _sets(nodes, docs, names, size)
    links = _confirmed(pairs, sets, percent)
    first = components(links)
    open_ = _open_classes(buckets, first)
    with small_batches(spark):
        sets = _sets(open_.select("node"), docs, names, size)
        pairs = stored(_cross_pairs(open_, sets, percent).distinct(), "pairs")
    # The first round's components are links to their least class, so they are not formed again.
    links = first.where("node != label").toDF("a", "b").union(_confirmed(pairs, sets, percent))
    joined = components(links).join(names, "node", "right").select(
        "node", "doc_id", F.coalesce("label", "node").alias("label")
    )
    least = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(least, "label").select("node", "component_id")
    own = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = some.join(named, "node").select("doc_id", "n_shingles", "component_id")
    kept = F.when(F.col("component_id").isNull(), True).otherwise(
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
    return found.union(own).withColumn("kept", kept)
