"""A corpus pipeline over ``documents``: quality, repeated lines, near copies, source mix, tokens.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read back as the
next one's documents.

Defined results: null and empty texts have log weight 0 in the first stage, which keeps or rejects them
by their key like others; they lose no lines and are nobody's near copies; the mix takes no word of
them, so they end there. Null ids are ids of their own in every stage; rows that are equal are
near copies, of which one stays. Further columns go along until the last stage. An empty table
gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import bpe, importance, jaccard, line_dedup, mixing
from corvid.llm.common import WORD_CLASS, discard, materialise
from corvid.sources.tables import load

#: SQL can express neither the sampled stages nor the tokens; tests compare brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return importance.resample(docs, load(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; those that lose all text go."""
    out = line_dedup.dedup_lines(docs)
    return _counted(out.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD_CLASS)).select(*docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each time that a document is taken."""
    return _counted(mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, and digests of the ids and of the bytes they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(docs.select("doc_id", "text"), path, pattern, with_ids=True).drop("text")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies),
          ("mixing sources", mixture), ("byte-level BPE", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table goes once the next one's is stored."""
    docs, last = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if last is not None:
            discard(last)
        last = docs
    return docs
