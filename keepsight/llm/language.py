"""Language identification by word-first backoff.

A word that the model knows counts with its log frequency in every language. An unknown word is
read by its character n-grams of `LONGEST` characters (with marks at its ends); an n-gram that
is unknown too gives way to the two shorter ones in it, down to single characters.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsight.llm.store import forget, only_value, python_path, remainder, remembered, stored, whole_row

#: Documents of each language that are learnt from, about, at most.
SAMPLE_DOCUMENTS = 4000
#: Words, and n-grams of each length, that are kept of each language, at most.
KNOWN_WORDS = 20_000
KNOWN_GRAMS = 5_000
LONGEST = 4
UNKNOWN = "und"
#: Words a counting task holds at most.
HELD_WORDS = 150_000
#: Tokens a scoring worker remembers at most (some 250 bytes each), and their longest length.
SCORED_TOKENS = 1_000_000
REMEMBERED_CHARS = 48
CHUNK_CHARS = 500_000

_RUNS = re.compile(r"[^\W\d_]+")


def letter_words(token: str) -> list[str]:
    """The runs of letters in a lower-cased token."""
    return [run for run in _RUNS.findall(token) if any(map(str.isalpha, run))]


def grams(word: str, size: int) -> list[str]:
    """The word's n-grams with marks at its ends; the whole if it is shorter."""
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(max(1, len(marked) - size + 1))]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language, kind (0: word, else length of the n-gram) and item."""
    forget()
    tokens: dict[str, Counter[str]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in tokens.items():
            counts: Counter[tuple[int, str]] = Counter()
            for token, n in own.items():
                for word in letter_words(token):
                    counts[0, word] += n
                    for size in range(1, LONGEST + 1):
                        for gram in grams(word, size):
                            counts[size, gram] += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts), pa.string()),
                    pa.array([kind for kind, _ in counts], pa.int32()),
                    pa.array([item for _, item in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "kind", "item", "n"],
            )
        tokens.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            tokens.setdefault(lang.as_py(), Counter()).update((text.as_py() or "").lower().split())
            if sum(map(len, tokens.values())) >= HELD_WORDS:
                yield from flush()
    yield from flush()


class Model:
    """Log frequencies by item and language, less each item's largest."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        self.langs = sorted({lang for lang, *_ in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        items = sorted({(kind, item) for _, kind, item, _ in rows})
        self.rows = {item: row for row, item in enumerate(items, start=1)}
        counts = np.zeros((len(items) + 1, len(self.langs)))
        for lang, kind, item, n in rows:
            counts[self.rows[kind, item], place[lang]] = n
        kinds = np.array([-1] + [kind for kind, _ in items])
        self.logs = np.zeros_like(counts)
        for kind in range(LONGEST + 1):
            own = kinds == kind
            whole = counts[own].sum(axis=0) + 0.5 * max(own.sum(), 1)
            self.logs[own] = np.log((counts[own] + 0.5) / whole)
        if self.langs:
            self.logs -= self.logs.max(axis=1, keepdims=True)

    def _read(self, size: int, gram: str, weight: float, out: list[tuple[int, float]]) -> None:
        row = self.rows.get((size, gram))
        if row is not None:
            out.append((row, weight))
        elif len(gram) > 1 and size > 1:
            shorter = {gram[:-1], gram[1:]} if len(gram) == size else {gram}
            for part in shorter:
                self._read(size - 1, part, weight / len(shorter), out)

    def read(self, token: str) -> list[tuple[int, float]] | None:
        """Rows and weights that a token stands for; None without a letter."""
        words = letter_words(token)
        if not words:
            return None
        out: list[tuple[int, float]] = []
        for word in words:
            row = self.rows.get((0, word))
            if row is not None:
                out.append((row, 1.0))
                continue
            parts = grams(word, LONGEST)
            for part in parts:
                self._read(LONGEST, part, 1.0 / len(parts), out)
        return out or [(0, 1.0)]


class Reader:
    """A model and the tokens one worker has met; row 0 is for tokens without a letter."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1, len(self.model.langs)))
        self.used = 1

    def _learn(self, new: set[str]) -> None:
        found = [(token, self.model.read(token)) for token in new]
        readable = [(token, parts) for token, parts in found if parts is not None]
        self.rows.update((token, 0) for token, parts in found if parts is None)
        if not readable:
            return
        rows = np.array([row for _, parts in readable for row, _ in parts])
        weights = np.array([weight for _, parts in readable for _, weight in parts])
        first = np.cumsum([0] + [len(parts) for _, parts in readable[:-1]])
        values = np.add.reduceat(self.model.logs[rows] * weights[:, None], first, axis=0)
        end = self.used + len(readable)
        if end > len(self.table):
            more = np.zeros((max(end, 2 * len(self.table)) - len(self.table), values.shape[1]))
            self.table = np.concatenate([self.table, more])
        self.table[self.used : end] = values
        self.rows.update((token, self.used + i) for i, (token, _) in enumerate(readable))
        self.used = end

    def languages(self, texts: list[str]) -> tuple[list[str], list[float]]:
        split = [text.lower().split() for text in texts]
        tokens = set().union(*split)
        new = tokens.difference(self.rows)
        if max(self.used, len(self.rows)) + len(new) > SCORED_TOKENS:
            self._forget()
            new = tokens
        self._learn(new)
        get = self.rows.__getitem__
        names, scores = [], []
        for text in split:
            rows = np.fromiter(map(get, text), np.int64, len(text))
            if not rows.any() or not self.model.langs:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.table[rows].sum(axis=0)
            best = int(total.argmax())
            names.append(self.model.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        for token in new:
            if len(token) > REMEMBERED_CHARS:
                del self.rows[token]
        return names, scores


def _predict_task(key: str, pickled: bytes):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = remembered(f"languages {key}", lambda: Reader(pickle.loads(pickled)))
        for batch in batches:
            start = size = 0
            texts: list[str] = []
            for at, text in enumerate(batch.column(batch.num_columns - 1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK_CHARS or at + 1 == batch.num_rows:
                    names, scores = reader.languages(texts)
                    kept = batch.slice(start, at + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *kept.columns[:-1],
                            pa.array(names, pa.string()),
                            pa.array(scores, pa.float64()),
                        ],
                        names=[*kept.schema.names[:-1], "lang_pred", "score"],
                    )
                    start, size, texts = at + 1, 0, []

    return task


def _model_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pickled model of all rows."""
    forget()
    rows: list[tuple[str, int, str, int]] = []
    for batch in batches:
        rows.extend(zip(*(column.to_pylist() for column in batch.columns), strict=True))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model(rows))], pa.binary())], names=["model"])


def _model(docs: DataFrame, folds: int) -> bytes:
    """The pickled model; one task builds it from the bounded tables, so the driver holds no row."""
    known = docs.where("lang is not null").where(remainder(F.col("doc_id"), folds) != 0)
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("documents")), "languages")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = known.join(sizes, "lang").where(place * F.col("documents") < SAMPLE_DOCUMENTS)
    counts = (
        sample.select("lang", "text")
        .mapInArrow(_count_task, "lang string, kind int, item string, n bigint")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n"))
        .where("kind > 0 or n > 1")
    )
    by_size = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    most = F.when(F.col("kind") == 0, KNOWN_WORDS).otherwise(KNOWN_GRAMS)
    ranked = counts.withColumn("rank", F.row_number().over(by_size))
    rows = ranked.where(F.col("rank") <= KNOWN_WORDS).where(F.col("rank") <= most)
    rows = rows.select("lang", "kind", "item", "n").repartition(1)
    found = only_value(rows.mapInArrow(_model_task, "model binary"))
    return pickle.dumps(Model([])) if found is None else found


def identify_language(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    folds: int = 5,
    carry: bool = False,
) -> DataFrame:
    """Language of every whole text, learnt from the documents' own `lang_column`.

    Learns from documents with a language whose id's crc32 modulo `folds` is not 0: of each
    language about `SAMPLE_DOCUMENTS`, by the hash of the id. Returns per row `doc_id`,
    `held_out`, `lang_pred` (a learnt language, or `und`), `score` (0 to 1, the language's
    share of the likelihood) and, with `carry`, the whole row as the struct `row`.

    A text that is NULL or has no letter is `und` with score 0, as is every text if no document
    has a language. Equally likely languages go to the first by name. Repeated rows and ids
    NULL are judged one by one. An empty table gives no rows; other columns are not read.
    """
    python_path(docs.sparkSession)
    docs = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(lang_column).cast("string").alias("lang"),
        *([whole_row(docs)] if carry else []),
        F.col(text_column).alias("text"),
    )
    pickled = _model(docs, folds)
    key = hashlib.blake2b(pickled, digest_size=8).hexdigest()
    docs = docs.drop("lang")
    added = T.StructType().add("lang_pred", "string").add("score", "double")
    schema = T.StructType([*docs.schema.fields[:-1], *added.fields])
    found = docs.mapInArrow(_predict_task(key, pickled), schema)
    held_out = remainder(F.col("doc_id"), folds) == 0
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", *docs.columns[1:-1]
    )
