"""Harmonic packing of tokenised documents into sequences of one length.

Lengths fall into reciprocal-capacity classes. A class is a piece length L: the capacity
divided by 1, 2, ... `CLASSES` (rounded down), and every length below the smallest of them. A
bin of class L holds exactly capacity // L pieces. A document is cut into the largest class
length that fits, again and again, which takes about three pieces; a full bin so pads fewer
tokens than it has pieces, or one short piece.

Every task fills the bins of its own classes, without any exchange between tasks. What is left
in half-filled bins at a task's end is bounded by the classes (not by the data): it is laid end
to end into full sequences, and the rest into sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from keepsight.llm.store import python_path, remembered

CAPACITY = 4096
CLASSES = 64
END_ID = 2
#: Words whose ids one worker remembers (some 200 bytes each); beyond it the memory starts anew.
MEMORY_WORDS = 1_000_000
#: Longer words are tokenised each time, so the memory's size is bounded.
REMEMBERED_CHARS = 48
#: Characters that are tokenised at a time.
CHUNK_CHARS = 1_000_000

#: Letters whose lower case is one letter again; words of them stay one unit of the tokenizer.
_LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)])).translate({215: None, 247: None})
#: A run of these marks is one unit too (an apostrophe may start a unit with letters after it).
_MARKED = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")


class WordEncoder:
    """Token ids of texts, remembered per word.

    The vocabulary's pre-tokenizer never joins characters across a space or line feed, nor
    letters with the marks after them, so the ids of a text are those of its words, and these
    those of their letters and marks, in order. Letters only need their lower case and their
    bytes' characters, so they are given to the tokenizer's model itself, which is the same and
    takes half the time; a vocabulary for which it isn't the same reads every word as a text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        # Spark runs a task per core already; more threads in each only wait for one another.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        (written, _), = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(_LETTERS)
        chars = dict(zip(_LETTERS.encode(), written, strict=True))
        self.byte_chars = "".join(chars.get(i, " ") for i in range(256))
        probe = [*_LETTERS, *(a + b for a in _LETTERS for b in "aeß"), _LETTERS]
        self.direct = self._letter_ids(probe) == self._ids(probe)

    def _ids(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array("I", ids.ids).tobytes() for ids in found]

    def _letter_ids(self, words: list[str]) -> list[bytes]:
        """`_ids` of words of letters."""
        lower = " ".join(words).lower().encode()
        written = codecs.charmap_decode(lower, "strict", self.byte_chars)[0].split(" ")
        tokens = map(self.model.tokenize, written)
        return [array("I", [token.id for token in own]).tobytes() for own in tokens]

    def _learn(self, new: set[str]) -> None:
        found = [m for m in map(_MARKED.fullmatch, new) if m] if self.direct else []
        cores = list({m[1] for m in found})
        ids = dict(zip(cores, self._letter_ids(cores), strict=True)) if cores else {}
        marks = list({m[2] for m in found})
        mark_ids = dict(zip(marks, self._ids(marks), strict=True))
        other = list(new.difference([m[0] for m in found]))
        self.known.update((m[0], ids[m[1]] + mark_ids[m[2]]) for m in found)
        self.known.update(zip(other, self._ids(other), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > MEMORY_WORDS:
            self.known.clear()
            new = set(words)
        long = [word for word in new if len(word) > REMEMBERED_CHARS]
        self._learn(new.difference(long))
        self.known.update(zip(long, self._ids(long), strict=True))
        found = list(map(self.known.__getitem__, words))
        for word in long:
            del self.known[word]
        ids = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        codes = coded.indices.to_numpy()
        sizes = size[codes]
        ends = np.append(0, np.cumsum(sizes))
        place = np.repeat(first[codes] - ends[:-1], sizes) + np.arange(ends[-1])
        raw = ids[place].tobytes()
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return list(map(raw.__getitem__, map(slice, cuts[:-1], cuts[1:])))


def class_lengths(capacity: int = CAPACITY, classes: int = CLASSES) -> np.ndarray:
    """For every length up to the capacity, the longest class length that fits into it."""
    reciprocal = {capacity // k for k in range(1, min(classes, capacity) + 1)}
    smallest = min(reciprocal)
    lengths = np.array(sorted(reciprocal | set(range(1, smallest))))
    return lengths[np.searchsorted(lengths, np.arange(capacity + 1), side="right") - 1]


class Bins:
    """The open bins of one task, and the pieces of those that are full."""

    def __init__(self, first_id: int, capacity: int, classes: int):
        self.capacity = capacity
        self.fit = class_lengths(capacity, classes).tolist()
        self.next_id = first_id
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc: object, ids: bytes) -> None:
        """Cut one document and put its pieces into the bins of their classes."""
        total, start = len(ids) // 4, 0
        while start < total:
            left = total - start
            length = self.capacity if left >= self.capacity else self.fit[left]
            piece = (doc, start, length, ids[4 * start : 4 * (start + length)], total)
            pieces = self.open.setdefault(length, [])
            pieces.append(piece)
            if len(pieces) == self.capacity // length:
                self._close(pieces)
                self.open[length] = []
            start += length

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1

    def finish(self) -> None:
        """Lay the pieces of half-filled bins end to end, cut where a sequence ends."""
        rest = [piece for length in sorted(self.open, reverse=True) for piece in self.open[length]]
        tokens = sum(piece[2] for piece in rest)
        sizes = [self.capacity] * (tokens // self.capacity)
        tail = tokens % self.capacity
        sizes += [1 << bit for bit in reversed(range(tail.bit_length())) if tail >> bit & 1]
        room = iter(sizes)
        size = filled = 0
        bin_: list[tuple] = []
        for doc, start, length, ids, total in rest:
            while length:
                if filled == size:
                    size, filled, bin_ = next(room), 0, []
                cut = min(length, size - filled)
                bin_.append((doc, start, cut, ids[: 4 * cut], total))
                start, length, ids, filled = start + cut, length - cut, ids[4 * cut :], filled + cut
                if filled == size:
                    self._close(bin_)
        self.open = {}

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Rows in groups of a bounded number of characters (one text at least)."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for doc, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(doc.as_py())
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _packer(
    path: str, schema: pa.Schema, capacity: int, classes: int, end_id: int, with_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        out = [
            (doc, start, length, zlib.crc32(ids), total, sequence, offset)
            + ((np.frombuffer(ids, "<u4").astype(np.int32),) if with_ids else ())
            for doc, start, length, ids, total, sequence, offset in rows
        ]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(schema)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(f"word ids {path}", lambda: WordEncoder(path))
        bins = Bins(TaskContext.get().partitionId() << 32, capacity, classes)
        for rows in batches:
            for some, chunk in _chunks(rows):
                for doc, ids in zip(some, encoder.encode(chunk), strict=True):
                    bins.add(doc, ids + end)
                if bins.done:
                    yield batch(bins.take())
        bins.finish()
        if bins.done:
            yield batch(bins.take())

    return pack_task


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    classes: int = CLASSES,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most `capacity` tokens.

    `vocabulary` is the path of a tokenizer file that every executor has. One row per piece:
    the document's id as `doc_id`, `start` (its tokens before), `length`, `ids_crc32` (of the
    ids as unsigned little-endian 32-bit numbers), `doc_tokens` (with the end id),
    `sequence_id`, `offset` (gapless from 0) and, with `with_ids`, the ids as `token_ids`.

    A text NULL or empty is the end id alone. Ids NULL, tied or repeated are carried as they
    are: each row is a document. An empty table gives no rows; other columns, whatever their
    names, are not read. Sequence ids depend on how Spark cuts the input into tasks; a task
    that is run again gives the same rows.
    """
    kind = docs.schema[id_column].dataType
    fields = [
        T.StructField("doc_id", kind),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    python_path(docs.sparkSession)
    task = _packer(vocabulary, to_arrow_schema(schema), capacity, classes, end_id, with_ids)
    return docs.select(id_column, text_column).mapInArrow(task, schema)
