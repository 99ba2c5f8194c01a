"""Token counts of documents without token ids.

A byte-level tokenizer first cuts a text into pre-tokens (a word with the space before it, a
number, a run of marks, white space) and then splits each pre-token by itself. So a text's count
is the sum over its distinct pre-tokens of how often each occurs times its pieces.

The distinct pre-tokens of all documents are tokenised once each and stored as a table. Those in
most documents (a bounded number of bounded length) are sent to the tasks, which sum them while
they count a document's pre-tokens; the pre-tokens of a document that are not among them are
kept with their frequencies and joined to the whole table. No frequent pre-token is then a join
key, and no two rows of a document are ever brought together but its rare pre-tokens' sums.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from operator import mul

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from keepsight.llm.store import python_path, remembered, stored

LIMIT = 512
#: Pre-tokens that are sent to every task, by the most characters they may have: at most some 30
#: MB in all. All others are joined.
COMMON = {32: 100_000, 4_096: 1_000}
#: Longer ones that many texts share meet in so many parts.
LONG_PARTS = 16
#: Distinct pre-tokens that a task gathers before it hands them on.
GATHERED = 200_000
#: Pre-tokens that are tokenised at a time.
TOGETHER = 2_000

# fixed values: how the byte-level pre-tokenizer cuts, for all characters and for ASCII alone
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"


class PreTokens:
    """Cuts texts into pre-tokens as the tokenizer of a file does, and counts their pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark runs a task per core already; more threads in each only wait for one another.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        cutter = setup["pre_tokenizer"] or {}
        added = setup["added_tokens"]
        plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
        if not plain or cutter["add_prefix_space"] or setup["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.tokenizer = Tokenizer.from_file(path)
        names = sorted((re.escape(a["content"]) for a in added), key=len, reverse=True)
        self.added = re.compile("|".join(names)) if names else None
        self.cut = regex.compile(CUT).findall
        self.cut_ascii = re.compile(CUT_ASCII).findall
        self.alike: dict[str, bool] = {}

    def _as_regex(self, char: str) -> bool:
        """Whether the tokenizer takes a character for the kind that `regex` takes it for.

        The two know different editions of Unicode; white space is the same in both.
        """
        kind = "L" if regex.match(r"\p{L}", char) else "N" if regex.match(r"\p{N}", char) else ""
        ends = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{char}1")]
        found = {((0, 2), (2, 3)): "L", ((0, 1), (1, 3)): "N"}.get(tuple(ends), "")
        return kind == found

    def _segment(self, text: str) -> list[str]:
        if text.isascii():
            return self.cut_ascii(text)
        alike = self.alike
        chars = set(text)
        for char in chars.difference(alike):
            alike[char] = char.isascii() or self._as_regex(char)
        if all(map(alike.__getitem__, chars)):
            return self.cut(text)
        spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[first:past] for _, (first, past) in spans]

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token occurs, and the number of added tokens in the text."""
        if self.added is None:
            return Counter(self._segment(text)), 0
        segments = self.added.split(text)
        if len(segments) == 1:
            return Counter(self._segment(text)), 0
        return Counter(chain.from_iterable(map(self._segment, segments))), len(segments) - 1

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        found: list[int] = []
        for first in range(0, len(pre_tokens), TOGETHER):
            some = pre_tokens[first : first + TOGETHER]
            found += map(len, self.tokenizer.encode_batch_fast(some, add_special_tokens=False))
        return found


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _cutter(path: str) -> PreTokens:
    return remembered(f"pre-tokens {path}", lambda: PreTokens(path))


def _gather(path: str, schema: pa.Schema) -> Task:
    """Distinct pre-tokens of a task's texts with the number of texts that hold them."""

    def out(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(cutter.frequencies(text.as_py() or "")[0].keys())
                if len(found) > GATHERED:
                    yield out(found)
                    found = Counter()
        yield out(found)

    return task


def _count(path: str, schema: pa.Schema) -> Task:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        for batch in batches:
            counts = pa.array(cutter.pieces(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], schema=schema)

    return task


def _sum(path: str, common, schema: pa.Schema) -> Task:
    """Per text its tokens in the common pre-tokens, and its other pre-tokens with frequencies."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        pieces = common.value
        for batch in batches:
            sums, rare, times = [], [], []
            for text in batch.column(1):
                found, tokens = cutter.frequencies(text.as_py() or "")
                rare.append([token for token in found if token not in pieces])
                times.append([found.pop(token) for token in rare[-1]])
                tokens += sum(map(mul, map(pieces.__getitem__, found), found.values()))
                sums.append(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sums, pa.int64()),
                    pa.array(rare, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                schema=schema,
            )

    return task


def piece_counts(docs: DataFrame, vocabulary: str, text_column: str = "text") -> DataFrame:
    """Every distinct pre-token of the texts with its `pieces` and the `texts` that hold it."""
    found = T.StructType([T.StructField("token", T.StringType()), T.StructField("texts", T.LongType())])
    counted = T.StructType([T.StructField("token", T.StringType()), T.StructField("pieces", T.LongType())])
    python_path(docs.sparkSession)
    each = docs.select(text_column).mapInArrow(_gather(vocabulary, to_arrow_schema(found)), found)
    distinct = stored(each.groupBy("token").agg(F.sum("texts").alias("texts")), "pre-tokens")
    pieces = distinct.select("token").mapInArrow(_count(vocabulary, to_arrow_schema(counted)), counted)
    return stored(pieces.join(distinct, "token"), "pieces")


def _most_common(pieces: DataFrame, common: dict[int, int]) -> dict[str, int]:
    """Pieces of the pre-tokens in most texts: for each length bound so many, at most."""
    found: dict[str, int] = {}
    shorter = 0
    for most, number in sorted(common.items()):
        fit = pieces.where((F.length("token") > shorter) & (F.length("token") <= most))
        top = fit.orderBy(F.desc("texts"), "token").select("token", "pieces").limit(number)
        found.update({row[0]: row[1] for row in top.toLocalIterator()})
        shorter = most
    return found


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
    common: dict[int, int] = COMMON,
) -> DataFrame:
    """Per row `doc_id`, `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit`).

    `vocabulary` is the path of a byte-level tokenizer file that every executor has; begin and
    end tokens are not counted, an added token's name inside a text is one token, as the
    library takes it. A text NULL or empty has 0 bytes and tokens. Each row is a document:
    ids NULL, tied or repeated are carried as they are. A text of any length is counted whole,
    by one task, in memory for its distinct pre-tokens. An empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    pieces = piece_counts(docs, vocabulary, text_column)
    sent = spark.sparkContext.broadcast(_most_common(pieces, common))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("rare", T.ArrayType(T.StringType())),
            T.StructField("times", T.ArrayType(T.LongType())),
        ]
    )
    n_bytes = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("bigint")
    texts = docs.select(id_column, text_column, n_bytes.alias("n_bytes"))
    summed = texts.mapInArrow(_sum(vocabulary, sent, to_arrow_schema(schema)), schema)
    # Numbered as it is written, so that a row keeps its number whatever executors are lost.
    summed = stored(summed.withColumn("row", F.monotonically_increasing_id()), "sums")
    rare = summed.select("row", F.explode(F.arrays_zip("rare", "times")).alias("pair")).select(
        "row", F.col("pair.rare").alias("token"), F.col("pair.times").alias("times")
    )
    long = F.length("token") > max(common, default=0)
    rare = rare.withColumn("part", F.when(long, F.pmod("row", F.lit(LONG_PARTS))).otherwise(0))
    last = F.when(long, LONG_PARTS - 1).otherwise(0)
    parts = pieces.select("token", "pieces", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    more = rare.join(parts, ["token", "part"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("pieces")).alias("more")
    )
    n_tokens = F.col("n_tokens") + F.coalesce("more", F.lit(0))
    return (
        summed.join(more, "row", "left")
        .select("doc_id", "n_bytes", n_tokens.alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
