"""Corpus pipeline: toxicity, language, near duplicates, mixing and packing of all documents.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before kept; `run` writes
each stage's rows as Parquet into the shared folder and reads them for the next. Stages that send
whole texts to Python lower the session's Arrow batches (`limit_batches`), as they run when written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsight.llm.language import UNKNOWN, identify_language
from keepsight.llm.mixing import mix
from keepsight.llm.near_duplicates import near_duplicates
from keepsight.llm.packing import pack
from keepsight.llm.queries import vocabulary_path
from keepsight.llm.store import limit_batches, row_columns, stored, table
from keepsight.llm.toxicity import score_toxicity

#: Least share of the likelihood that a document's language needs.
LEAST_LANGUAGE_SCORE = 0.5
#: Least similarity of near duplicates, percent of the word shingles of two documents.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    limit_batches(spark)
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 0").select(row_columns(docs))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; those without a letter go."""
    limit_batches(spark)
    found = identify_language(docs, carry=True)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(known).select(row_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Repeated rows of an id and text stay once. Rows with an id NULL can't be told apart by the
    decision; they stay, once for each text.
    """
    kept = near_duplicates(docs, percent=NEAR_PERCENT).where("kept").select("doc_id").where("doc_id is not null")
    kept = stored(kept.distinct(), "kept")
    named = docs.withColumn("text_hash", F.xxhash64("text"))
    # Dealt out by id once: copies are dropped where the decisions met the rows.
    chosen = named.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text_hash"])
    unnamed = named.where("doc_id is null").dropDuplicates(["text_hash"])
    return chosen.union(unnamed).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in shuffled shards."""
    return mix(docs).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    limit_batches(spark)
    return pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
