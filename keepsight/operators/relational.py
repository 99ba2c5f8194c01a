"""Row selection helpers that stay safe when one key holds a large share of the rows.

`first_row`/`last_row` are aggregates, not windows: duplicates are folded on the map side, so
a key with a huge number of copies never reaches a single task as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_row(df: DataFrame, keys: Sequence[str], pick: Column, count_as: str | None) -> DataFrame:
    aggregates = [pick.alias("_row")]
    if count_as:
        aggregates.append(F.count(F.lit(1)).alias(count_as))
    names = [F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    extra = [F.col(count_as)] if count_as else []
    return df.groupBy(*keys).agg(*aggregates).select(*names, *extra)


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """The row with the smallest `order` (NULL first) per key; optionally the number of copies.

    Ties go to the row whose other columns are smaller, so the result is the same for any
    partitioning.
    """
    rest = [c for c in df.columns if c not in keys]
    return _one_row(df, keys, F.min_by(F.struct(*rest), _total(order, rest)), count_as)


def last_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], count_as: str | None = None
) -> DataFrame:
    """The row with the largest `order` per key; a NULL loses against any value.

    Ties go to the row whose other columns are larger.
    """
    rest = [c for c in df.columns if c not in keys]
    return _one_row(df, keys, F.max_by(F.struct(*rest), _total(order, rest)), count_as)


def _total(order: Sequence[str], rest: Sequence[str]) -> Column:
    """`order`, then all other columns."""
    return F.struct(*order, *[c for c in rest if c not in order])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First `k` rows of a total order (each task keeps `k` rows, nothing is fully sorted)."""
    return df.orderBy(*order).limit(k)


def broadcast_below(df: DataFrame, limit: int) -> DataFrame:
    """Mark `df` for broadcast if it has at most `limit` rows; otherwise leave it to a shuffle.

    Counts the rows, so `df` should be stored (see ``session.pin``).
    """
    return F.broadcast(df) if df.count() <= limit else df


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; the left key columns are kept."""
    renamed = right.select(
        *[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    on = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in keys]
    )
    return left.join(renamed, on, how).drop(*[f"_right_{c}" for c in keys])


#: Words of 64 bits of a Bloom filter: 1 MB, whatever the number of keys.
BLOOM_WORDS = 1 << 17
BLOOM_BITS = 4


def _bloom_place(key: Column) -> tuple[Column, Column]:
    """The word of a key and its bits in it."""
    word = F.pmod(F.xxhash64(key), F.lit(BLOOM_WORDS))
    hashed = F.xxhash64(F.lit(BLOOM_BITS), key)
    one = F.lit(1).cast("bigint")
    bits = [
        F.call_function("shiftleft", one, F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(BLOOM_BITS)
    ]
    return word, reduce(lambda a, b: a.bitwiseOR(b), bits)


def may_be_in(key: Column, keys: DataFrame) -> Column:
    """Whether a key may be one of `keys` (one column): true for each that is, and a few others.

    A Bloom filter of fixed size, built and read inside the plan. Some 2 % of the other keys
    pass for a million keys; with far more of them most pass, so it only saves work, and an exact
    join has to follow. Never true or false for a NULL key, which no key equals.
    """
    name = keys.columns[0]
    word, bits = _bloom_place(F.col(name))
    found = keys.filter(F.col(name).isNotNull()).select(word.alias("word"), bits.alias("bits"))
    every = keys.sparkSession.range(BLOOM_WORDS).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = found.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filter_ = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"]).scalar()
    word, bits = _bloom_place(key)
    held = F.get(filter_, word.cast("int")).bitwiseAND(bits) == bits
    return F.when(key.isNotNull(), held)
