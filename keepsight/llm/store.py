"""Stored steps, word patterns and column helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run without these six ASCII white-space characters.
WORD_GAP = r"[ \t-\r]+"
#: Rows that `small_batches` sends a Python worker at a time, at most.
BATCH_ROWS = 1000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def step_folder(spark: SparkSession) -> str:
    """The folder for stored steps: `spark.checkpoint.dir`, or below the warehouse where unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/steps"
    return shared.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet into the shared folder and read it from there.

    Cuts the lineage: a lost executor costs at most the tasks that read this step.
    """
    spark = df.sparkSession
    path = f"{step_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only_value(df: DataFrame) -> bytes | None:
    """The binary value of a table of one column and one row at most; None without a row.

    It comes as an Arrow batch: a collected row would be pickled in the driver's JVM, whose buffers
    for a value of several MB are some ten times its size and make the heap grow.
    """
    found = df.toArrow().column(0).to_pylist()
    release()
    return found[0] if found else None


_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession, rows: int | None = None) -> None:
    """From now on send Python at most `rows` rows at a time (`BATCH_ROWS` if None).

    Spark's 10,000 whole texts stand several times over in an executor's memory, beside its heap.
    A setting that is smaller already holds.
    """
    rows = rows or BATCH_ROWS
    if not 0 < int(spark.conf.get(_ROWS_SETTING)) <= rows:
        spark.conf.set(_ROWS_SETTING, str(rows))


@contextmanager
def small_batches(spark: SparkSession, rows: int | None = None) -> Iterator[None]:
    """`limit_batches` for the steps that run meanwhile; the session's setting comes back."""
    before = spark.conf.get(_ROWS_SETTING)
    limit_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_ROWS_SETTING, before)


def python_path(spark: SparkSession) -> None:
    """Let Python workers that see this installation's folder import the package from it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


#: What this Python worker keeps between tasks; one operator's memory at a time.
_MEMORY: dict[str, object] = {}


def forget() -> None:
    """Drop what earlier operators keep on this Python worker and give the memory back to the system.

    Workers live on through the steps of a job, so tables of an earlier operator would stand
    beside the memory of a later one that keeps nothing itself.
    """
    if _MEMORY:
        _MEMORY.clear()
        release()


def release() -> None:
    """Give the memory that this Python no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def remembered(key: str, make: Callable[[], object]) -> object:
    """The object of `key` that an earlier task on this worker made, or a new one."""
    if key not in _MEMORY:
        forget()
        _MEMORY[key] = make()
    return _MEMORY[key]


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; the id NULL counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % of


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct, under names that clash with nothing."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")


def row_columns(docs: DataFrame) -> list[Column]:
    """The columns of `whole_row` under their own names."""
    return [F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
