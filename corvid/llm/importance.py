"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are compared: the raw model counts the n-grams of
*all* documents, the target model those of documents labelled good. A document's log weight
is the log ratio of the two models summed over its n-grams; adding Gumbel noise and taking
the top k is sampling k documents without replacement in proportion to the weights.

N-grams: tokens are runs of letters or digits and runs of other signs. Counted are single
tokens, pairs (an immediate repetition is one n-gram of its own) and triples of token shapes
(upper, lower, title, digits, signs). ``BUCKETS`` hash buckets bound both models.

Defined results: null and empty texts have no n-grams, so log weight 0. Rows whose keys tie
with the k-th are all taken. Repeated rows get the same key and stay or go together. Without
usable labels nothing is rejected. Labels with null ids or null quality are left out; a
document labelled several times is good only if all its labels say so. Of the rows that share a
labelled id the one with the smallest hash of its text stands for the id in the fit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import add_columns, discard, fresh, kth_largest, materialise, text_portions
from corvid.llm.tokens import Tokens, mix, tokenise

BUCKETS = 1 << 16
#: Rows of ``labels`` (the smallest hashes of doc_id) that the target model and the cut are fitted on.
MAX_LABELLED = 200_000
#: Pseudo-counts that draw a bucket's ratio to 1.
PRIOR = 32.0
SEED = 20

#: Byte classes: letters, digits and all of UTF-8 beyond ASCII are 1, other printed signs 2.
_CLASSES = np.full(256, 2, dtype=np.uint8)
_CLASSES[:33] = 0
_CLASSES[128:] = 1
_CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_LOWER = np.zeros(256, dtype=np.int32)
_LOWER[97:123] = 1
_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[65:91] = 1
_PAIR, _TRIPLE, _REPEAT = np.uint64(0x9E3779B97F4A7C15), np.uint64(131), np.uint64(77_777)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(48)).astype(np.int32)


def _shapes(tokens: Tokens) -> np.ndarray:
    """0 neither case, 1 upper, 2 lower, 3 both; signs are the number of their first byte and more."""
    def holds(table):
        sums = np.concatenate([[0], np.cumsum(table[tokens.data], dtype=np.int32)])
        return sums[tokens.ends] > sums[tokens.starts]

    first = tokens.data[tokens.starts]
    shape = holds(_UPPER) + 2 * holds(_LOWER)
    return np.where(_CLASSES[first] == 2, 4 + first.astype(np.int64), shape).astype(np.uint64)


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams, and for each the position of its text."""
    tokens = tokenise(texts, _CLASSES)
    text = np.repeat(np.arange(len(texts)), tokens.counts)
    h, shape = tokens.hash, _shapes(tokens)
    pair = np.where(h[1:] == h[:-1], _REPEAT, h[:-1] * _PAIR + h[1:])[text[1:] == text[:-1]]
    triple = ((shape[:-2] * _TRIPLE + shape[1:-1]) * _TRIPLE + shape[2:] + np.uint64(99_991))[text[2:] == text[:-2]]
    return (_bucket(np.concatenate([h, pair, triple])),
            np.concatenate([text, text[1:][text[1:] == text[:-1]], text[2:][text[2:] == text[:-2]]]))


def ngram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket``, ``n``: counts over all texts. Every task adds up its own buckets first."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def counted(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for texts in text_portions(batch.column(0)):
                counts += np.bincount(ngram_buckets(texts)[0], minlength=BUCKETS)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])],
                                         names=["bucket", "n"])

    return docs.select(text_col).mapInArrow(counted, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame) -> np.ndarray:
    """Counts as an array of BUCKETS numbers (the bound of what reaches the driver)."""
    out = np.zeros(BUCKETS)
    got = counts.toPandas()
    out[got["bucket"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=float)
    return out


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log ratio of the target to the raw model per bucket, drawn to 0 by ``prior``."""
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + prior) / (expected + prior))


def log_weights(docs: DataFrame, ratios: np.ndarray, out: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the log weight of every text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ratios.astype(np.float64))
    at = docs.columns.index(text_col)

    def scored(batch):
        sums = []
        for texts in text_portions(batch.column(at)):
            buckets, text = ngram_buckets(texts)
            sums.append(np.bincount(text, weights=shared.value[buckets], minlength=len(texts)))
        return [pa.array(np.concatenate(sums) if sums else [], pa.float64())]

    return add_columns(docs, scored, [T.StructField(out, T.DoubleType())])


def gumbel(id_col, seed: int = SEED):
    """Standard Gumbel noise that depends only on the id and the seed."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 12).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 52))))


def best_cut(keys: np.ndarray, good: np.ndarray) -> float:
    """Cut that separates labelled rows with the fewest errors, a lost good one counting twice."""
    order = np.argsort(keys, kind="stable")
    keys, good = keys[order], good[order]
    lost = 2 * np.concatenate([[0], np.cumsum(good)])
    kept = (~good).sum() - np.concatenate([[0], np.cumsum(~good)])
    at = int(np.argmin(lost + kept))
    if at == 0:
        return float("-inf")
    return float((keys[at - 1] + keys[min(at, len(keys) - 1)]) / 2)


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``_label_id``, ``_good``, ``_fit``: labelled documents, ``max_labelled`` at most; half fit
    the target model, half place the cut."""
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
           .groupBy(F.col("doc_id").alias("_label_id")).agg((F.min("quality") > 0).alias("_good")))
    draw = F.xxhash64(F.lit(5), F.col("_label_id"))
    return one.withColumn("_fit", draw % 2 == 0).orderBy(draw, "_label_id").limit(max_labelled)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             seed: int = SEED, max_labelled: int = MAX_LABELLED, share: float | None = None,
             keep_text: bool = True) -> DataFrame:
    """All rows of ``docs`` with ``log_weight``, ``gumbel_key`` and ``kept``.

    k is ``share`` of the rows; when None, the number of rows whose key lies above the cut that
    separates good from bad labels best. ``keep_text=False`` leaves the text out of the result
    and of the table that it is stored in.
    """
    weight, key, kept = (fresh(docs, c) for c in ("log_weight", "gumbel_key", "kept"))
    sample = materialise(labelled_sample(labels, max_labelled), "labels")
    # a sample of few rows is sent to the texts; beyond, the texts are shuffled
    few = F.broadcast(sample) if max_labelled <= MAX_LABELLED else sample.hint("merge")
    # one text for each labelled id, however many rows have that id
    held = (docs.select(F.col(id_col).alias("_label_id"), F.col(text_col).alias("_text")).join(few, "_label_id")
            .groupBy("_label_id", "_good", "_fit").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text")))
    known = materialise(held, "labelled")
    raw = _vector(ngram_counts(docs, text_col))
    target = _vector(ngram_counts(known.where("_fit AND _good"), "_text"))
    ratios = log_ratios(raw, target) if target.sum() else np.zeros(BUCKETS)

    scored = log_weights(docs, ratios, weight, text_col)
    scored = scored.withColumn(key, F.col(weight) + gumbel(F.col(id_col), seed))
    scored = materialise(scored if keep_text else scored.drop(text_col), "scored")
    fixed = scored.select(F.floor(F.col(key) * F.lit(float(1 << 20))).cast("long").alias("_fixed"))
    total = fixed.count()
    if share is None:
        held = (log_weights(known.where("NOT _fit"), ratios, "_w", "_text")
                .select("_good", (F.col("_w") + gumbel(F.col("_label_id"), seed)).alias("_k")).toPandas())
        keys, good = held["_k"].to_numpy(dtype=float), held["_good"].to_numpy(dtype=bool)
        usable = good.any() and not good.all() and target.sum()
        border = best_cut(keys, good) if usable else float("-inf")
        k = total if np.isinf(border) else fixed.where(F.col("_fixed") >= int(np.floor(border * (1 << 20)))).count()
    else:
        k = min(total, int(np.ceil(share * total)))
    discard(known, sample)
    cut = kth_largest(fixed, "_fixed", k)
    if cut is None:
        return scored.withColumn(kept, F.lit(total == k))
    return scored.withColumn(kept, F.floor(F.col(key) * F.lit(float(1 << 20))).cast("long") >= F.lit(cut))
