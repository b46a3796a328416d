"""Similarity join of documents on word shingles, with Bayesian pruning of candidates.

Shingles are the runs of five words of a text (texts of one to four words: all words as one
shingle), as a set. Two documents are linked when the Jaccard similarity of their sets is
``threshold`` or more. Documents with equal sets are one class; the join runs on classes.

1. Every class gets ``HASHES`` MinHash values; classes that agree in all values of a band are
   candidates. Classes of a band value are compared in blocks of bounded size.
2. Candidates compare their MinHash values a step at a time. With m of n values equal and a
   uniform prior, the similarity has a Beta(m + 1, n - m + 1) distribution; a pair is dropped
   when P(similarity >= threshold) is below ``TOLERANCE``. The pairs that outlast the short
   signature connect the classes into candidate groups.
3. Within each group, again in blocks, all pairs pass the whole signature step by step and the
   survivors are verified exactly on their shingle sets. Only link counts and spanning edges
   leave a block, not pairs.

At the threshold a pair misses all bands with probability 6e-5, far less above it.

Defined results: texts without words, null or empty, are linked with nothing. Rows are
documents of their own even when ids repeat; a class is named by its smallest id, null ids
come last. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import add_columns, discard, fresh, materialise, text_portions
from corvid.llm.graph import EDGES, Forest, components, edges_table, map_blocks, smallest_ids
from corvid.llm.tokens import tokenise, windows

WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 6
HASHES = BANDS * BAND_ROWS
#: MinHash values compared in the first pass, and the values compared at a time.
SHORT, STEP = 64, 32
TOLERANCE = 1e-6
BLOCK_ROWS = 512

_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    tokens = tokenise(texts)
    out, at = [], 0
    for count in tokens.counts:
        words = tokens.hash[at: at + count]
        at += count
        out.append(np.unique(windows(words, min(n, count))) if count else np.zeros(0, dtype=np.uint64))
    return out


def minhash(shingle_set: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits: the top bits of the smallest product with each multiplier."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingle_set), 256):
        part = shingle_set[start: start + 256]
        least = np.minimum(least, (part[None, :] * _MULTIPLIERS[:, None]).min(axis=1))
    mixed = (least ^ (least >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.uint16)


def set_key(shingle_set: np.ndarray) -> bytes:
    return blake2b(shingle_set.tobytes(), digest_size=16).digest()


@lru_cache(maxsize=None)
def fewest_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest of ``n`` equal values at which P(similarity >= threshold) reaches ``tolerance``."""
    xs = threshold + (1 - threshold) * (np.arange(4000) + 0.5) / 4000
    for m in range(n + 1):
        scale = lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
        tail = np.exp(scale + m * np.log(xs) + (n - m) * np.log1p(-xs)).mean() * (1 - threshold)
        if tail >= tolerance:
            return m
    return n


def outlast(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` (signatures, pair by pair) pass every step."""
    alive = np.arange(len(left))
    same = np.zeros(len(left), dtype=np.int32)
    for start in range(0, left.shape[1], STEP):
        stop = min(start + STEP, left.shape[1])
        same[alive] += (left[alive, start:stop] == right[alive, start:stop]).sum(axis=1, dtype=np.int32)
        alive = alive[same[alive] >= fewest_matches(stop, threshold, TOLERANCE)]
    passed = np.zeros(len(left), dtype=bool)
    passed[alive] = True
    return passed


def _bands(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, for rows of signatures."""
    cut = signature[:, : BANDS * BAND_ROWS].reshape(len(signature), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.zeros((len(signature), 1), dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = (key + cut[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _upper_pairs(own: np.ndarray, diagonal: bool, rows: int = 64):
    """Positions (i, j), i < j, of a block's pairs, some rows at a time; off the diagonal only
    pairs of different chunks."""
    n = len(own)
    for start in range(0, n, rows):
        i = np.arange(start, min(n, start + rows))
        wanted = np.arange(n)[None, :] > i[:, None]
        if not diagonal:
            wanted &= own[None, :] != own[i][:, None]
        a, b = np.nonzero(wanted)
        yield i[a], b


def _signatures(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    n = len(column)
    return np.frombuffer(raw, dtype=np.uint16).reshape(n, -1) if n else np.zeros((0, 0), np.uint16)


def _candidate_edges(threshold: float):
    def run(group: pa.Table) -> pa.Table | None:
        nodes = group["node"].to_pylist()
        sigs = _signatures(group["sig"])
        diagonal = group["_i"][0].as_py() == group["_j"][0].as_py()
        forest = Forest(len(nodes))
        for i, j in _upper_pairs(group["_c"].to_numpy(), diagonal):
            ok = outlast(sigs[i], sigs[j], threshold)
            for a, b in zip(i[ok].tolist(), j[ok].tolist()):
                forest.join(a, b)
        return edges_table(nodes, forest.edges) if forest.edges else None

    return run


def _jaccard_matches(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Exact test of the pairs (i, j). Few pairs are intersected one by one; many at once, by
    products of incidence matrices over the shingles that some but not all sets hold."""
    sizes = np.array([len(s) for s in sets])
    if len(i) <= 4 * len(sets):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
    else:
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), sizes)
        _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
        everywhere = int((held == len(sets)).sum())
        shared = (held > 1) & (held < len(sets))
        number = np.cumsum(shared) - 1
        use = shared[column]
        row, column = row[use], number[column[use]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        products = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for start in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(column, [start, start + 4096])
            strip = np.zeros((len(sets), 4096), dtype=np.float32)
            strip[row[lo:hi], column[lo:hi] - start] = 1
            products += strip @ strip.T
        both = products[i, j].astype(np.int64) + everywhere
    # in whole numbers, so that a similarity of exactly the threshold counts
    union = sizes[i] + sizes[j] - both
    return both * 1_000_000 >= round(threshold * 1_000_000) * union


_COUNTS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("links", T.LongType()),
                        T.StructField("peer", T.BinaryType())])


def _verified(threshold: float):
    """Per block: a row (node, linked documents, null) per linked class and a row (node, 0, peer)
    per spanning edge."""
    def run(group: pa.Table) -> pa.Table | None:
        nodes = group["node"].to_pylist()
        copies = group["copies"].to_numpy()
        sets = shingles(group["text"].to_pylist())
        sigs = np.stack([minhash(s) for s in sets])
        diagonal = group["_i"][0].as_py() == group["_j"][0].as_py()
        links = np.zeros(len(nodes), dtype=np.int64)
        forest = Forest(len(nodes))
        found_i, found_j = [], []
        for i, j in _upper_pairs(group["_c"].to_numpy(), diagonal):
            near = outlast(sigs[i], sigs[j], threshold)
            found_i.append(i[near])
            found_j.append(j[near])
        i, j = np.concatenate(found_i), np.concatenate(found_j)
        if not len(i):
            return None
        linked = _jaccard_matches(sets, i, j, threshold)
        i, j = i[linked], j[linked]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        for a, b in zip(i.tolist(), j.tolist()):
            forest.join(a, b)
        own = np.flatnonzero(links).tolist()
        return pa.table({
            "node": pa.array([nodes[a] for a in own] + [nodes[a] for a, _ in forest.edges], pa.binary()),
            "links": pa.array([int(links[a]) for a in own] + [0] * len(forest.edges), pa.int64()),
            "peer": pa.array([None] * len(own) + [nodes[b] for _, b in forest.edges], pa.binary())})

    return run


def sketch(docs: DataFrame, node: str, signature: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the key of the shingle set (null without words) and the MinHash signature."""
    at = docs.columns.index(text_col)

    def sketched(batch):
        keys, sigs = [], []
        for texts in text_portions(batch.column(at)):
            for found in shingles(texts):
                keys.append(set_key(found) if len(found) else None)
                sigs.append(minhash(found).tobytes() if len(found) else None)
        return [pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())]

    return add_columns(docs, sketched, [T.StructField(node, T.BinaryType()), T.StructField(signature, T.BinaryType())])


def _band_rows(classes: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("band", T.LongType()), T.StructField("node", T.BinaryType())])

    def banded(batches):
        for batch in batches:
            if batch.num_rows:
                keys = _bands(_signatures(batch.column(1)))
                at = np.repeat(np.arange(batch.num_rows), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(at))],
                                                 names=["band", "node"])

    return classes.select("node", "sig").mapInArrow(banded, schema)


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(documents: id, text hash, node; nodes: node, root, n_links, class_id).

    ``n_links`` counts the documents linked with one of the node, ``class_id`` is the smallest id
    among the documents reachable by links.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketched = sketch(base, "node", "sig").select("id", F.xxhash64("text").alias("text_hash"), "node", "sig")
    rows = materialise(sketched, "sketches")
    with_words = rows.where("node IS NOT NULL")
    classes = materialise(with_words.groupBy("node").agg(
        F.min("sig").alias("sig"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("one")), "classes")

    # candidates: rows of band values that two classes share, then their short signatures
    bands = materialise(_band_rows(classes), "bands")
    # band values shared by the same classes are compared once
    members = [F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("x2")]
    shared = bands.groupBy("band").agg(F.count("*").alias("n"), *members).where("n > 1")
    shared = materialise(shared.groupBy("n", "x1", "x2").agg(F.min("band").alias("band")).select("band"), "shared")
    met = bands.join(shared, "band")
    short = classes.select("node", F.substring("sig", 1, 2 * SHORT).alias("sig"))
    met = materialise(met.join(short, "node"), "met")
    edges = map_blocks(met, "band", "node", block_rows, _candidate_edges(threshold), EDGES)
    groups = components(edges)

    # exact links within each group; texts are read again for the classes in it only
    wanted = materialise(groups.join(classes, "node").select(
        "node", F.col("root").alias("group"), "copies", F.col("one.id").alias("id"),
        F.col("one.text_hash").alias("text_hash")), "wanted")
    texts = base.withColumn("text_hash", F.xxhash64("text"))
    # the merge keeps the plan the same at every size
    held = (texts.join(wanted.hint("merge"), texts["id"].eqNullSafe(wanted["id"]) & (texts["text_hash"] == wanted["text_hash"]))
            .select(wanted["node"], "group", "copies", "text").dropDuplicates(["node"]))
    held = materialise(held, "held")
    verified = materialise(map_blocks(held, "group", "node", block_rows // 2,
                                      _verified(threshold), _COUNTS), "verified")
    links = verified.where("peer IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(verified.where("peer IS NOT NULL").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    least = smallest_ids(with_words, "node", "id", comps, "class_id")
    nodes = (classes.select("node", "copies").join(links, "node", "left").join(least, "node")
             .select("node", "root", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "class_id"))
    nodes = materialise(nodes, "nodes")
    discard(bands, shared, met, wanted, held, verified, classes)
    return rows.drop("sig"), nodes


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``id_col``, ``class_id``, ``n_links``, ``kept`` (true for one document
    of each class; documents without words are classes of their own)."""
    rows, nodes = similarity_classes(docs, id_col, text_col, threshold)
    out = rows.join(nodes, "node", "left")
    return out.select(F.col("id").alias(id_col),
                      F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      (F.col("node").isNull() | F.col("id").eqNullSafe(F.col("class_id"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one of the smallest id; all documents
    without words stay. Of rows that share that id the first by text hash stays."""
    rows, nodes = similarity_classes(docs, id_col, text_col, threshold)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    keepers = rows.where("node IS NOT NULL").join(nodes, "node").groupBy("root").agg(best)
    keepers = materialise(keepers.select(F.col("best.id").alias("k_id"), F.col("best.text_hash").alias("k_hash")), "keepers")
    key = fresh(docs, "text_hash_")
    held = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    empty = ~F.coalesce(F.col(text_col), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    chosen = held.where(~empty).join(
        keepers, F.col(id_col).eqNullSafe(F.col("k_id")) & (F.col(key) == F.col("k_hash"))).drop("k_id", "k_hash")
    chosen = chosen.dropDuplicates([id_col, key])
    return chosen.unionByName(held.where(empty)).select(*docs.columns)
