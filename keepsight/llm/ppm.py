"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to `ORDER` bytes, counted over all training
documents. A symbol seen after the longest known context has probability (count - 1/2) / total;
the rest, distinct / (2 * total), is the escape to the next shorter context,
whose distribution is taken without the symbols already seen (symbol exclusion) and scaled to
one. Below the empty context all byte values are alike.

The trie of contexts of up to two bytes has at most 2^24 cells and is sent to every task, with
the most frequent of the longer contexts, up to `DEEP_CELLS` cells for each length. All other
contexts are stored tables, one row for each context (it has at most 256 symbols). A task gives
the cells whose context it does not hold back with how often a text has them; their distinct
ones are joined to the tables by context and scored level by level, and joined to the texts. So
no cell is left out, however many there are.

Word counts likewise: frequent words (a fixed number at most) are looked up in the tasks; all
others are joined to the table of counts by a shuffle, so every count is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsight.llm.store import python_path, remainder, stored

#: Bytes of the longest context.
ORDER = 4
#: Contexts of up to so many bytes are complete.
COMPLETE = 2
#: Cells of each longer context length that are sent to every task, at most; the rest is joined.
DEEP_CELLS = 1_000_000
#: Marks the start (`ORDER` times) and the end of a text; no UTF-8 text holds this byte.
EDGE = 255
#: Frequent words that are sent to every task, at most.
FREQUENT_WORDS = 200_000
#: Distinct words, and distinct cells, that a counting task holds before it passes them on.
HELD = 500_000
#: Bytes that are counted or scored at a time; the arrays of a chunk take many times as much.
CHUNK_BYTES = 250_000
#: The end of a document as a token; no word is empty.
END = b""

_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EIGHT = np.uint64(8)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Lower-cased texts in groups of a bounded size, with the position of the first."""
    start = size = 0
    held: list[bytes] = []
    for at, text in enumerate(texts):
        held.append((text.as_py() or "").encode("utf-8", "surrogatepass").lower())
        size += len(held[-1])
        if size >= CHUNK_BYTES or at + 1 == len(texts):
            yield start, held
            start, size, held = at + 1, 0, []


def cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of every byte and end of the texts as numbers, and each text's first."""
    edge = bytes([EDGE])
    start = edge * ORDER
    data = np.frombuffer(b"".join(start + text + edge for text in texts), np.uint8).astype(np.uint64)
    size = len(data) - ORDER
    numbers = data[:size].copy()
    for place in range(1, ORDER + 1):
        numbers <<= _EIGHT
        numbers |= data[place : place + size]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.concatenate([[0], np.cumsum(lengths)])
    # between two texts there are as many numbers that end in a start mark as start marks
    gaps = (first[1:-1] + np.arange(len(texts) - 1) * ORDER)[:, None] + np.arange(ORDER)
    return np.delete(numbers, gaps.ravel()), first[:-1]


def _fold(numbers: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of `times` by number, sorted."""
    order = np.argsort(numbers, kind="stable")
    numbers, times = numbers[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    return numbers[first], np.add.reduceat(times, first)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def found_words() -> pa.RecordBatch:
        out = [
            pa.array(list(counts.keys()), pa.binary()),
            pa.nulls(len(counts), pa.int64()),
            pa.array(list(counts.values()), pa.int64()),
        ]
        counts.clear()
        return pa.RecordBatch.from_arrays(out, names=["token", "cell", "n"])

    def found_cells() -> pa.RecordBatch:
        numbers, times = _fold(*map(np.concatenate, zip(*parts, strict=True)))
        parts.clear()
        out = [
            pa.nulls(len(numbers), pa.binary()),
            pa.array(numbers.astype(np.int64)),
            pa.array(times.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(out, names=["token", "cell", "n"])

    for batch in batches:
        for _, texts in _chunks(batch.column(0)):
            for text in texts:
                counts.update(text.split())
            counts[END] += len(texts)
            parts.append(np.unique(cells(texts)[0], return_counts=True))
            if sum(len(numbers) for numbers, _ in parts) >= 2 * HELD:
                parts[:] = [_fold(*map(np.concatenate, zip(*parts, strict=True)))]
            if parts and len(parts[0][0]) >= HELD:
                yield found_cells()
            if len(counts) >= HELD:
                yield found_words()
    if counts:
        yield found_words()
    if parts:
        yield found_cells()


def _level(
    counts: np.ndarray, lower: np.ndarray, first: np.ndarray, distinct: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the cells' chances and of the contexts' escapes, from the cells' counts and
    log10 probabilities at the next shorter length; `first` cell and number of cells by context."""
    total = np.add.reduceat(counts, first)
    unseen = 1 - np.add.reduceat(10.0**lower, first)
    # where all symbols were seen nothing is left to escape to
    given = np.where(unseen > 1e-9, 0.5, 0)
    chance = (counts - np.repeat(given, distinct)) / np.repeat(total, distinct)
    scale = np.maximum(given * distinct, 1e-300) / total / np.maximum(unseen, 1e-9)
    return np.log10(chance), np.maximum(np.log10(scale), -30)


class Trie:
    """log10 probabilities of the cells, and of the escapes of the contexts, by hashed number.

    A cell's number is its context and symbol, tagged with the context's length; a context's is
    itself with another tag. Conflicts are solved by taking the next free slot.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], complete: int | None = None):
        """`levels`: sorted cell numbers and counts by length of context, from 0. Beyond the
        length `complete` there are contexts that the trie does not hold."""
        self.order = len(levels) - 1
        self.complete = self.order if complete is None else complete
        self.bits = 10
        self.keys, self.values = self._slots()
        self.size = 0
        for length, (numbers, counts) in enumerate(levels):
            if len(numbers):
                self._grow(numbers.astype(np.uint64), counts, length)

    def _slots(self) -> tuple[np.ndarray, np.ndarray]:
        return np.full(1 << self.bits, _EMPTY), np.zeros(1 << self.bits, np.float32)

    def _grow(self, numbers: np.ndarray, counts: np.ndarray, length: int) -> None:
        lower = self.log_probabilities(numbers, length - 1)
        contexts, first, distinct = np.unique(
            numbers >> _EIGHT, return_index=True, return_counts=True
        )
        chance, escape = _level(counts, lower, first, distinct)
        self._put(self._cell(numbers, length), chance)
        self._put(self._context(contexts, length), escape)

    def _cell(self, numbers: np.ndarray, length: int) -> np.ndarray:
        inside = np.uint64((1 << 8 * (length + 1)) - 1)
        return numbers & inside | np.uint64(2 * length << 56)

    def _context(self, contexts: np.ndarray, length: int) -> np.ndarray:
        inside = np.uint64((1 << 8 * length) - 1)
        return contexts & inside | np.uint64(2 * length + 1 << 56)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            used = self.keys != _EMPTY
            keys = np.concatenate([self.keys[used], keys])
            values = np.concatenate([self.values[used], values])
            while 2 * self.size > 1 << self.bits:
                self.bits += 1
            self.keys, self.values = self._slots()
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == _EMPTY
            self.keys[slot[free]] = keys[free]
            here = self.keys[slot] == keys
            self.values[slot[here]] = values[here]
            keys, values, slot = keys[~here], values[~here], (slot[~here] + 1) % len(self.keys)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self._slot(keys)
        there = self.keys[slot]
        value, hit = self.values[slot].astype(np.float64), there == keys
        at = np.flatnonzero(~hit & (there != _EMPTY))
        while len(at):
            slot[at] = (slot[at] + 1) % len(self.keys)
            there = self.keys[slot[at]]
            found = there == keys[at]
            value[at[found]], hit[at[found]] = self.values[slot[at[found]]], True
            at = at[~found & (there != _EMPTY)]
        return value, hit

    def _log(self, numbers: np.ndarray, length: int) -> np.ndarray:
        if length < 0:
            return np.full(len(numbers), -np.log10(256))
        value, hit = self._find(self._cell(numbers, length))
        left = np.flatnonzero(~hit)
        if len(left):
            value[left] = self._log(numbers[left], length - 1)
            escape, known = self._find(self._context(numbers[left] >> _EIGHT, length))
            value[left] += np.where(known, escape, 0)
        return value

    def log_probabilities(self, numbers: np.ndarray, length: int | None = None) -> np.ndarray:
        """log10 probability of each symbol after its context (the last `length` bytes of it)."""
        return self._log(numbers, self.order if length is None else length)

    def holds(self, numbers: np.ndarray, length: int) -> np.ndarray:
        """Whether the trie holds the context of `length` bytes of each cell."""
        return self._find(self._context(numbers >> _EIGHT, length))[1]

    def unsettled(self, numbers: np.ndarray) -> np.ndarray:
        """Cells whose longest context may be one that only the stored tables hold."""
        if self.complete == self.order:
            return np.zeros(len(numbers), bool)
        # a context is unknown where a shorter one is that would be held
        return ~self.holds(numbers, self.order) & self.holds(numbers, self.complete)


_OPEN = pa.struct([("cell", pa.int64()), ("n", pa.int64())])


def code_lengths(texts: list[bytes], trie: Trie) -> tuple[np.ndarray, pa.Array]:
    """log10 probability of each text and its end, without the cells that are listed with it:
    those that the trie can't settle, and how often the text has them."""
    numbers, first = cells(texts)
    logs = trie.log_probabilities(numbers)
    at = np.flatnonzero(trie.unsettled(numbers))
    logs[at] = 0
    text = np.searchsorted(first, at, side="right") - 1
    order = np.lexsort((numbers[at], text))
    own, text = numbers[at][order], text[order]
    new = np.flatnonzero(
        np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])])[: len(own)]
    )
    times = np.diff(np.append(new, len(own)))
    offsets = np.searchsorted(text[new], np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.StructArray.from_arrays(
        [pa.array(own[new].astype(np.int64)), pa.array(times.astype(np.int64))], fields=list(_OPEN)
    )
    return np.add.reduceat(logs, first), pa.ListArray.from_arrays(pa.array(offsets), listed)


def _joined_logs(
    trie: Trie, numbers: np.ndarray, row: np.ndarray, batch: pa.RecordBatch, length: int
) -> np.ndarray:
    """log10 probability at `length` of the cells of each `row` of the batch, which has its
    contexts' rows of the stored tables (`own3`, `escape3`, ...; NULL if there is none)."""
    if length <= trie.complete:
        return trie.log_probabilities(numbers, length)
    value = _joined_logs(trie, numbers, row, batch, length - 1)
    held = trie.holds(numbers, length)
    value[held] = trie.log_probabilities(numbers[held], length)
    escape = batch.column(f"escape{length}").to_numpy(zero_copy_only=False).astype(np.float64)[row]
    known = ~np.isnan(escape)
    value[known] += escape[known]
    table = batch.column(f"own{length}").flatten()
    if len(table):
        found, first = np.unique(table.field("cell").to_numpy().astype(np.uint64), return_index=True)
        wanted = numbers & np.uint64((1 << 8 * (length + 1)) - 1)
        place = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
        hit = known & (found[place] == wanted)
        value[hit] = table.field("log").to_numpy()[first[place[hit]]]
    return value


_LOGS = pa.struct([("cell", pa.int64()), ("log", pa.float64())])


def _level_task(sent: Broadcast, length: int):
    """Scored contexts (`context`, `own`, `escape`) of those counted (`context`, `counted`)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            counted = batch.column("counted")
            distinct = counted.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(distinct)), distinct)
            found = counted.flatten()
            numbers = found.field("cell").to_numpy().astype(np.uint64)
            lower = _joined_logs(trie, numbers, row, batch, length - 1)
            first = np.cumsum(distinct) - distinct
            chance, escape = _level(found.field("n").to_numpy(), lower, first, distinct)
            offsets = np.append(first, len(numbers)).astype(np.int32)
            own = pa.StructArray.from_arrays([found.field("cell"), pa.array(chance)], fields=list(_LOGS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("context"), pa.ListArray.from_arrays(pa.array(offsets), own), pa.array(escape)],
                names=["context", "own", "escape"],
            )

    return task


def _open_task(sent: Broadcast):
    """log10 probabilities (`cell`, `log`) of cells that are listed by context."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        for batch in batches:
            listed = batch.column("wanted")
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            found = listed.flatten()
            row = np.repeat(np.arange(len(sizes)), sizes)
            logs = _joined_logs(trie, found.to_numpy().astype(np.uint64), row, batch, trie.order)
            yield pa.RecordBatch.from_arrays([found, pa.array(logs)], names=["cell", "log"])

    return task


def _with_tables(rows: DataFrame, tables: dict[int, DataFrame]) -> DataFrame:
    """Rows by `context`, with the table rows of the last bytes of it for each length."""
    for length, table in tables.items():
        own = table.select(
            F.col("context").alias("key"), F.col("own").alias(f"own{length}"), F.col("escape").alias(f"escape{length}")
        )
        last = F.col("context").bitwiseAND(F.lit((1 << 8 * length) - 1))
        rows = rows.withColumn("key", last).join(own, "key", "left").drop("key")
    return rows


_RARE = pa.struct([("token", pa.binary()), ("n", pa.int64())])


def _score_task(sent: Broadcast, frequent: Broadcast):
    """Scores of texts; `frequent`: log10 (c + 0.1) of the frequent words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, logs = sent.value, frequent.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, texts in _chunks(batch.column(2)):
                totals, known, sums = [], [], []
                words: list[bytes] = []
                times: list[int] = []
                ends = [0]
                for text in texts:
                    counts = Counter(text.split())
                    counts[END] = 1
                    totals.append(counts.total())
                    sums.append(math.fsum(logs[w] * n for w, n in counts.items() if w in logs))
                    rare = [w for w in counts if w not in logs]
                    words += rare
                    times += map(counts.__getitem__, rare)
                    known.append(totals[-1] - sum(times[ends[-1] :]))
                    ends.append(len(words))
                size = len(texts)
                rest = [pa.array(words, pa.binary()), pa.array(times, pa.int64())]
                score, open_cells = code_lengths(texts, trie)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + size)),
                        batch.column(0).slice(start, size),
                        batch.column(1).slice(start, size),
                        pa.array(totals, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(sums, pa.float64()),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.StructArray.from_arrays(rest, fields=list(_RARE))
                        ),
                        pa.array(score, pa.float64()),
                        open_cells,
                    ],
                    names=[
                        *("row", "doc_id", "held_out", "n_tokens", "known", "logs", "rare", "score"),
                        "open",
                    ],
                )
                row += size

    return task


def _step(total: str) -> Column:
    return F.floor(F.log2(total) * 4)


def _least_step(rows: DataFrame, total: str, most: int) -> tuple[float, bool]:
    """Step of `total` from which on there are `most` rows or fewer, and whether these are all."""
    steps = rows.groupBy(_step(total).alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    size, least = 0, math.inf
    for step, count in sorted(map(tuple, steps), reverse=True):
        size += count
        if size > most:
            return least, False
        least = step
    return least, True


def _trie(counts: DataFrame, deep_cells: int) -> tuple[Broadcast, dict[int, DataFrame]]:
    """The trie of the cells (`cell`, `n`) of the longest contexts, sent to the executors, and for
    each length that it does not hold whole the table of its other contexts."""
    levels = []
    complete = counts.groupBy(
        F.col("cell").bitwiseAND(F.lit((1 << 8 * (COMPLETE + 1)) - 1)).alias("cell")
    ).agg(F.sum("n").alias("n"))
    found = complete.toArrow()
    numbers = found.column("cell").to_numpy().astype(np.uint64)
    times = found.column("n").to_numpy()
    for length in range(COMPLETE + 1):
        inside = np.uint64((1 << 8 * (length + 1)) - 1)
        levels.append(_fold(numbers & inside, times) if len(numbers) else (numbers, times))
    whole, floor, others = COMPLETE, -math.inf, {}
    for length in range(COMPLETE + 1, ORDER + 1):
        inside = F.lit((1 << 8 * (length + 1)) - 1)
        of = counts.groupBy(F.col("cell").bitwiseAND(inside).alias("cell")).agg(F.sum("n").alias("n"))
        of = stored(of.withColumn("context", F.shiftright("cell", 8)), "cells")
        totals = of.groupBy("context").agg(F.sum("n").alias("total"))
        of = of.join(totals, "context")
        least, all_kept = _least_step(of, "total", deep_cells)
        # a context that is held has all shorter ones held: those come as often at least
        floor = max(floor, -math.inf if all_kept else least)
        kept = of if floor == -math.inf else of.where(_step("total") >= F.lit(float(floor)))
        if floor == -math.inf:
            whole = length
        else:
            others[length] = of.where(_step("total") < F.lit(float(floor)))
        found = kept.select("cell", "n").toArrow()
        numbers = found.column("cell").to_numpy().astype(np.uint64)
        order = np.argsort(numbers)
        levels.append((numbers[order], found.column("n").to_numpy()[order]))
    # One copy a worker, which its tasks share; inside a task's function each task would read its own.
    sent, tables = counts.sparkSession.sparkContext.broadcast(Trie(levels, whole)), {}
    for length, of in others.items():
        counted = of.groupBy("context").agg(F.collect_list(F.struct("cell", "n")).alias("counted"))
        tables[length] = stored(
            _with_tables(counted, tables).mapInArrow(
                _level_task(sent, length),
                "context bigint, own array<struct<cell: bigint, log: double>>, escape double",
            ),
            "contexts",
        )
    return sent, tables


def _open_scores(scored: DataFrame, sent: Broadcast, tables: dict[int, DataFrame]) -> DataFrame:
    """`row` and the log10 probability of its cells that the trie did not settle."""
    listed = scored.select("row", F.explode("open").alias("x")).select("row", "x.cell", "x.n")
    wanted = (
        listed.select("cell")
        .distinct()
        .groupBy(F.shiftright("cell", 8).alias("context"))
        .agg(F.collect_list("cell").alias("wanted"))
    )
    logs = _with_tables(wanted, tables).mapInArrow(_open_task(sent), "cell bigint, log double")
    return (
        listed.join(stored(logs, "logs"), "cell")
        .groupBy("row")
        .agg(F.sum(F.col("n") * F.col("log")).alias("more_score"))
    )


def score_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 10,
    frequent_words: int = FREQUENT_WORDS,
    deep_cells: int = DEEP_CELLS,
) -> DataFrame:
    """Code length of every whole text under the byte trie, and a word baseline.

    The model learns from documents whose id's crc32 modulo `folds` is not 0. Returns per row
    `doc_id`, `held_out` (that remainder is 0), `n_tokens` (words and one end), `n_known` (tokens
    that training documents hold), `train_tokens`, `base_score` (sum of the tokens' log10
    (c + 0.1) / (N + 0.1 (V + 1))) and `score` (log10 probability of the lower-cased text's bytes
    and its end).

    A text NULL is empty: one token, the end. An id NULL counts as the id of empty text. Repeated
    and tied rows are scored one by one. Without training documents every byte is as likely as
    another. An empty table gives no rows; other columns are not read.
    """
    python_path(docs.sparkSession)
    docs = docs.select(
        F.col(id_column).alias("doc_id"),
        (remainder(F.col(id_column), folds) == 0).alias("held_out"),
        F.col(text_column).alias("text"),
    )
    partial = stored(
        docs.where("not held_out")
        .select("text")
        .mapInArrow(_count_task, "token binary, cell bigint, n bigint"),
        "counts",
    )
    words = stored(
        partial.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")), "words"
    )
    row = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = row[0], row[1]
    least, _ = _least_step(words, "n", frequent_words)
    frequent = words.where(_step("n") >= F.lit(float(least))).toArrow()
    found = zip(*(frequent.column(c).to_pylist() for c in ("token", "n")), strict=True)
    hot = docs.sparkSession.sparkContext.broadcast({word: math.log10(n + 0.1) for word, n in found})
    all_cells = partial.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n"))
    sent, tables = _trie(stored(all_cells, "cells"), deep_cells)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = stored(
        docs.mapInArrow(
            _score_task(sent, hot),
            f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, "
            "logs double, rare array<struct<token: binary, n: bigint>>, score double, "
            "open array<struct<cell: bigint, n: bigint>>",
        ),
        "scored",
    )
    rest = (
        scored.select("row", F.explode("rare").alias("x"))
        .select("row", "x.token", F.col("x.n").alias("times"))
        .join(words, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more"),
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("more_logs"),
        )
    )
    per_token = math.log10(tokens + 0.1 * (distinct + 1))
    score = F.col("score")
    if tables:
        scored = scored.join(_open_scores(scored, sent, tables), "row", "left")
        score = score + F.coalesce("more_score", F.lit(0.0))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * per_token).alias(
            "base_score"
        ),
        score.alias("score"),
    )
