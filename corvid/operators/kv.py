"""Key-value jobs (KV) expressed on two-column DataFrames, word count and text statistics.

Pair-RDD operators map onto aggregates: ``reduceByKey``/``foldByKey``/``aggregateByKey``
become ``groupBy().agg()`` with map-side partial aggregation; ``groupByKey`` becomes a
bounded collect only where the list itself is the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import clean_tokens, tokens
from corvid.operators.partition import spread_small_input


def words(df: DataFrame, text_col: str = "text", clean: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per token (``flatMap``); streaming explode, nothing gathered per document."""
    toks = clean_tokens(text_col) if clean else tokens(text_col)
    return spread_small_input(df).select(*(keep or []), F.explode(toks).alias("word"))


def word_count(df: DataFrame, text_col: str = "text", clean: bool = False) -> DataFrame:
    """``flatMap(split) -> map((w, 1)) -> reduceByKey(+)``."""
    return words(df, text_col, clean).groupBy("word").agg(F.count("*").alias("n"))


def longest(df: DataFrame, col: str, name: str = "longest") -> DataFrame:
    """The longest value (ties: the smallest value), as a mergeable aggregate."""
    return df.agg(F.min_by(F.col(col), F.struct((-F.length(col)).alias("l"), F.col(col).alias("w"))).alias(name))


def text_stats(docs: DataFrame, text_col: str = "text", needle: str = "data", long_word: int = 6) -> DataFrame:
    """Line and word statistics of a corpus in a single aggregate over the lines.

    Word-level figures are computed per line with array functions on the line's tokens
    and then merged, so lines and words never need to be joined.
    """
    lines = spread_small_input(docs).select(F.explode(F.split(text_col, "\n")).alias("line"))
    # tokens are materialised once per line and then read three times
    tokenised = lines.select("line", tokens("line").alias("toks"))
    toks = F.col("toks")
    per_line = tokenised.select(
        "line", F.size(toks).alias("nw"),
        F.size(F.filter(toks, lambda w: F.length(w) > long_word)).alias("nlong"),
        F.array_min(F.transform(toks, lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w")))).alias("best"))
    return per_line.agg(
        F.count("*").alias("n_lines"),
        F.max(F.length("line")).alias("longest_line"),
        F.sum(F.length("line")).alias("total_chars"),
        F.count_if(F.col("line").contains(needle)).alias("lines_with_needle"),
        F.sum("nw").alias("n_words"),
        F.min("best").getField("w").alias("longest_word"),
        F.sum("nlong").alias("long_words"))


def top_longest_words(docs: DataFrame, k: int = 3, text_col: str = "text") -> DataFrame:
    """``takeOrdered(k, key=-len)`` over distinct words, ties broken by the word."""
    ws = words(docs, text_col).select("word").distinct()
    return ws.orderBy(F.length("word").desc(), F.col("word")).limit(k).select(
        "word", F.length("word").alias("len"))


def tagged_union(parts: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Union inputs with a source tag: ``(key, tag, value)`` rows, ready to regroup by key."""
    tagged = [df.select(F.col(key).alias("key"), F.lit(tag).alias("tag"), F.col(value).alias("value"))
              for tag, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def argmax_categories(counts: DataFrame, value: str, flag: str = "is_max") -> DataFrame:
    """Flag every category whose count equals the maximum (all ties reported).

    The maximum is a scalar subquery (one global aggregate, evaluated once and used as a
    literal), so categories are neither gathered into one task nor cross-joined.
    """
    top = counts.select(F.max(value)).scalar()
    return counts.withColumn(flag, F.col(value) == top)


def fail_counts(df: DataFrame, category: str, cond: Column, name: str = "n_fail") -> DataFrame:
    return argmax_categories(df.groupBy(category).agg(F.count_if(cond).alias(name)), name)
