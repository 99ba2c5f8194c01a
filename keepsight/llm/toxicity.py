"""Toxicity of whole texts: a recurrent network over all overlapping windows of words.

The network (`recurrent`) is trained on a bounded sample of labelled documents. A label says
that some part of a document is toxic, so training alternates between picking each sampled
document's highest windows and learning from them. A window starts at every word. Windows share
their states: the network runs once over a run of words, `CONTEXT` words further on each side
than its windows reach, and attention pools the states of each window by sliding sums. A
document's score is that of its highest window; the cut at 0.5 is set on the sample, at the
labels' own class shares.
"""

from __future__ import annotations

import hashlib
import pickle
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsight.llm.recurrent import BUCKETS, WORD_SIZE, Network, gram_buckets, sliding_sums
from keepsight.llm.store import forget, only_value, python_path, release, remainder, remembered, whole_row

#: Documents that are sampled of each label, at most, and their characters in total.
SAMPLE_DOCUMENTS = 2000
SAMPLE_CHARS = 6_000_000
#: Words the network knows by themselves, at most.
KNOWN_WORDS = 20_000
WINDOW = 24
#: Words before and after a window that its states have read at least, where the text has them.
CONTEXT = 12
#: Windows that share one run.
RUN_WINDOWS = 104
ROUNDS = 2
EPOCHS = 4
#: Words whose gates a worker remembers; beyond it the memory starts anew.
MEMORY_WORDS = 100_000
CHUNK_CHARS = 500_000
RUNS_AT_A_TIME = 1024

_MARKS = string.punctuation.encode()


def split(text: str | None) -> list[bytes]:
    """Words in lower case, without the marks around them unless they are nothing else."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [word.strip(_MARKS) or word for word in found]


def runs(sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, first word, end, first window and number of windows of every run.

    Each window of each document, one at least, is in one run; a run holds its windows' words and
    up to `CONTEXT` more on each side.
    """
    windows = np.maximum(1, sizes - WINDOW + 1)
    count = -(-windows // RUN_WINDOWS)
    doc = np.repeat(np.arange(len(sizes)), count)
    first = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * RUN_WINDOWS
    held = np.minimum(windows[doc] - first, RUN_WINDOWS)
    begin = np.maximum(first - CONTEXT, 0)
    end = np.minimum(first + held - 1 + WINDOW + CONTEXT, sizes[doc])
    return doc, begin, end, first, held


class Scorer:
    """A network and the gates of the words one worker has met."""

    def __init__(self, network: Network):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.table = np.concatenate([self.network.padding()] * 1024)

    def _learn(self, new: list[bytes]) -> None:
        start = len(self.rows) + 1
        need = start + len(new)
        if need > len(self.table):
            extra = max(need, 2 * len(self.table)) - len(self.table)
            more = np.zeros((extra, *self.table.shape[1:]), np.float32)
            self.table = np.concatenate([self.table, more])
        self.table[start:need] = self.network.gates(new)
        self.rows.update(zip(new, range(start, need), strict=True))

    def peaks(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logit and first word of every text's highest window, the first of several."""
        new = {word for text in texts for word in text} - self.rows.keys()
        if len(self.rows) + len(new) > MEMORY_WORDS:
            self._forget()
            new = {word for text in texts for word in text}
        if new:
            self._learn(sorted(new))
        get = self.rows.__getitem__
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.fromiter((get(w) for text in texts for w in text), np.int64, int(sizes.sum()))
        flat = np.append(flat, 0)
        base = np.cumsum(sizes) - sizes
        doc, begin, end, first, held = runs(sizes)
        highest = np.empty(len(doc), np.float32)
        start = np.empty(len(doc), np.int64)
        by_length = np.argsort(end - begin, kind="stable")
        for at in range(0, len(doc), RUNS_AT_A_TIME):
            some = by_length[at : at + RUNS_AT_A_TIME]
            steps = np.arange(max(int((end - begin)[some].max()), 1))
            place = begin[some][:, None] + steps
            inside = place < end[some][:, None]
            index = np.where(inside, flat[np.where(inside, base[doc[some]][:, None] + place, -1)], 0)
            logits = self.network.logits(self.table, index, WINDOW).T
            from_first = place - first[some][:, None]
            own = (from_first >= 0) & (from_first < held[some][:, None])
            logits = np.where(own, logits, -np.inf)
            best = logits.argmax(axis=1)
            rows = np.arange(len(some))
            highest[some], start[some] = logits[rows, best], place[rows, best]
        order = np.lexsort((start, -highest, doc))
        order = order[np.searchsorted(doc, np.arange(len(texts)))]
        return highest[order], start[order]


def _first_guess(network: Network, texts: list[list[bytes]]) -> np.ndarray:
    """First word of every text's highest window by the inputs that start as log odds."""
    vocabulary = sorted({w for text in texts for w in text})
    x = np.concatenate(
        [np.zeros((0, 2 * WORD_SIZE))]
        + [network.inputs(vocabulary[i : i + 5000])[0] for i in range(0, len(vocabulary), 5000)]
    )
    value = dict(zip(vocabulary, x[:, 0] + x[:, WORD_SIZE], strict=True))
    starts = np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts):
        if text:
            sums = sliding_sums(np.array([value[w] for w in text]), WINDOW)
            starts[at] = sums[: max(1, len(text) - WINDOW + 1)].argmax()
    return starts


def _odds(found: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Smoothed log odds of documents that hold a feature; columns: clean, toxic."""
    rate = np.log((found[:, 1] + 0.5) / (toxic + 1)) - np.log((found[:, 0] + 0.5) / (clean + 1))
    seen = found.sum(axis=1)
    return np.clip(rate * seen / (seen + 4), -3, 5)


def _fresh(texts: list[list[bytes]], labels: np.ndarray) -> Network:
    """A network whose first input dimensions start as log odds."""
    counts: Counter[bytes] = Counter()
    for text in texts:
        counts.update(set(text))
    ranked = sorted((w for w in counts if counts[w] > 1), key=lambda w: (-counts[w], w))[:KNOWN_WORDS]
    network = Network({word: row for row, word in enumerate(ranked, start=1)})
    words = np.zeros((len(ranked) + 1, 2))
    grams = np.zeros((BUCKETS + 1, 2))
    for text, label in zip(texts, labels, strict=True):
        own = list(set(text))
        if own:
            words[np.array([network.words.get(w, 0) for w in own]), label] += 1
            grams[np.unique(gram_buckets(own)[0]), label] += 1
    toxic, clean = int(labels.sum()), int((1 - labels).sum())
    odds = _odds(words, toxic, clean)
    odds[0] = 0
    network.p["word"][:, 0] = 0.5 * odds
    network.p["gram"][:BUCKETS, 0] = 0.5 * _odds(grams[:BUCKETS], toxic, clean)
    return network


def train(texts: list[str], labels: np.ndarray, weights: tuple[float, float]) -> Network:
    """A network from whole labelled texts; `weights`: how many documents each row of a class
    (0, 1) stands for. Both classes must be there."""
    shared: dict[bytes, bytes] = {}
    split_texts = [[shared.setdefault(word, word) for word in split(text)] for text in texts]
    judged = _every_fifth(labels)
    learnt = np.flatnonzero(~judged)
    own = [split_texts[i] for i in learnt]
    network = _fresh(own, labels[learnt])
    random = np.random.Generator(np.random.PCG64(5))
    for turn in range(ROUNDS):
        best = Scorer(network).peaks(own)[1] if turn else _first_guess(network, own)
        words, places, found = [], [], []
        for text, label, start in zip(own, labels[learnt], best.tolist(), strict=True):
            if not text:
                continue
            chosen = [start]
            if not label:
                chosen.append(int(random.integers(max(1, len(text) - WINDOW + 1))))
            for first in chosen:
                begin = max(first - CONTEXT, 0)
                words.append(text[begin : first + WINDOW + CONTEXT])
                places.append(slice(first - begin, first - begin + WINDOW))
                found.append(label)
        network.learn(words, places, np.array(found), EPOCHS, 0.01 if turn < ROUNDS - 1 else 0.004)
    held = np.flatnonzero(judged)
    logits = Scorer(network).peaks([split_texts[i] for i in held])[0].astype(np.float64)
    network.cut = _cut(logits, labels[held], weights)
    return network


def _every_fifth(labels: np.ndarray) -> np.ndarray:
    """Sampled documents that only set the cut: every fifth of a class, its first one too if
    there are two or more (a lone one is learnt from and sets the cut)."""
    judged = np.zeros(len(labels), bool)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        judged[own[:: 5 if len(own) > 1 else 2]] = len(own) > 1
    return judged


def _cut(logits: np.ndarray, labels: np.ndarray, weights: tuple[float, float]) -> float:
    """The logit between the classes with the least weight of errors; the middle of ties."""
    order = np.argsort(logits, kind="stable")
    ranked, found = logits[order], labels[order]
    missed = np.concatenate([[0], np.cumsum(found)]) * weights[1]
    alarms = (len(found) - found.sum()) - np.concatenate([[0], np.cumsum(1 - found)])
    errors = missed + alarms * weights[0]
    if not len(ranked):
        return 0.0
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    at = int(best[len(best) // 2])
    low = ranked[at - 1] if at else ranked[0] - 1
    high = ranked[at] if at < len(ranked) else ranked[-1] + 1
    return float((low + high) / 2)


def _task(key: str, pickled: bytes):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(f"network {key}", lambda: Scorer(pickle.loads(pickled)))
        for batch in batches:
            start = size = 0
            texts: list[list[bytes]] = []
            for at, text in enumerate(batch.column(batch.num_columns - 1)):
                value = text.as_py()
                texts.append(split(value))
                size += len(value or "")
                if size >= CHUNK_CHARS or at + 1 == batch.num_rows:
                    logit = scorer.peaks(texts)[0] - scorer.network.cut
                    score = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -60, 60)))
                    kept = batch.slice(start, at + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns[:-1], pa.array(score)],
                        names=[*kept.schema.names[:-1], "score"],
                    )
                    start, size, texts = at + 1, 0, []

    return task


def _sample_rows(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[DataFrame, tuple] | None:
    """Rows `doc_id`, `text`, `toxic` of the sample and class weights; None unless both classes
    are there."""
    known = (
        labels.where("toxic in (0, 1) and doc_id is not null")
        .where(remainder(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    labelled = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(labelled) < 2:
        return None
    ids = None
    for label in (0, 1):
        some = (
            known.where(F.col("toxic") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(SAMPLE_DOCUMENTS)
        )
        ids = some if ids is None else ids.union(some)
    sizes = (
        docs.select("doc_id", F.length("text").alias("chars"))
        .where("chars > 0")
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.max("chars").alias("chars"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
    )
    room = [SAMPLE_CHARS, SAMPLE_CHARS]
    chosen = []
    for row in sizes.collect():
        if row["chars"] <= room[row["toxic"]]:
            room[row["toxic"]] -= row["chars"]
            chosen.append(row)
    found = [sum(row["toxic"] == label for row in chosen) for label in (0, 1)]
    if not all(found):
        return None
    some = docs.sparkSession.createDataFrame(chosen, sizes.schema)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(some), "doc_id")
        .where(F.length("text") == F.col("chars"))
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    return rows, tuple(labelled[c] / found[c] for c in (0, 1))


def _in_order(ids: list, texts: list[str], labels: list[int]) -> tuple[list[str], np.ndarray]:
    order = sorted(range(len(ids)), key=ids.__getitem__)
    return [texts[i] for i in order], np.array([labels[i] for i in order], np.int64)


def _sample(docs: DataFrame, labels: DataFrame, folds: int) -> tuple[list, np.ndarray, tuple] | None:
    """Texts, labels and class weights of the sample, on the driver."""
    sample = _sample_rows(docs, labels, folds)
    if sample is None:
        return None
    rows, weights = sample
    return *_in_order(*zip(*rows.select("doc_id", "text", "toxic").collect(), strict=True)), weights


def _train_task(weights: tuple[float, float]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        columns: tuple[list, ...] = ([], [], [])
        for batch in batches:
            for values, more in zip(columns, batch.columns, strict=True):
                values.extend(more.to_pylist())
        if columns[0]:
            network = pickle.dumps(train(*_in_order(*columns), weights))
            # The worker goes on to score.
            del columns
            release()
            yield pa.RecordBatch.from_arrays([pa.array([network], pa.binary())], names=["network"])

    return task


def _trained(docs: DataFrame, labels: DataFrame, folds: int) -> bytes | None:
    """The pickled network; one task learns from the bounded sample, so the driver holds no text."""
    sample = _sample_rows(docs, labels, folds)
    if sample is None:
        return None
    rows, weights = sample
    rows = rows.select("doc_id", "text", "toxic").repartition(1)
    return only_value(rows.mapInArrow(_train_task(weights), "network binary"))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 5,
    carry: bool = False,
) -> DataFrame:
    """Toxicity of every whole text, learnt from `labels` (`doc_id`, `toxic` 0 or 1).

    Only documents whose id's crc32 modulo `folds` is not 0 are learnt from: of each label the
    `SAMPLE_DOCUMENTS` first in hash order, whole and of any length, but for those that the
    `SAMPLE_CHARS` characters of a label in total have no room left for. Returns per
    row `doc_id`, `held_out`, `score` (0 to 1), `predicted` (1 from 0.5 on) and, with `carry`,
    the whole row as the struct `row`.

    A text NULL or without words is scored as an empty window. Documents labelled twice count
    as toxic if any label does; other labels, NULL ones and those of unknown documents are not
    used. Without both classes in the sample every score is 0. Rows with an id NULL or repeated
    are scored one by one. An empty table gives no rows; other columns are not read.
    """
    python_path(docs.sparkSession)
    docs = docs.select(
        F.col(id_column).alias("doc_id"),
        *([whole_row(docs)] if carry else []),
        F.col(text_column).alias("text"),
    )
    kept = docs.columns[:-1]
    held_out = remainder(F.col("doc_id"), folds) == 0
    pickled = _trained(docs, labels.select("doc_id", "toxic"), folds)
    if pickled is None:
        scored = docs.select(*kept, F.lit(0.0).alias("score"))
    else:
        key = hashlib.blake2b(pickled, digest_size=8).hexdigest()
        schema = T.StructType([*docs.schema.fields[:-1], T.StructField("score", T.DoubleType())])
        scored = docs.mapInArrow(_task(key, pickled), schema)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        *kept[1:],
    )
