"""Near-duplicate embeddings by lattice hashing.

Every vector is scaled to length 1 and, for each of ``TABLES`` tables, projected to ``PARTS`` random
subspaces of eight dimensions; each projection is decoded to the nearest point of the E8
lattice (scaled by ``CELL``), and the points of a table together are the vector's cell. Besides
its own cell a vector probes the ``PROBES`` cells that it is nearest to crossing into, by the
minimal vectors of the lattice. Vectors that meet in a cell are verified by cosine in double
precision; cells with many vectors are compared in blocks of bounded size. Exactly equal
vectors are one class throughout.

Verified pairs leave a block as spanning edges only; once components are known, the links
within each are counted by products of blocks of its vectors. So a pair is linked when it is
in a component, whichever table found it.

Vectors of different lengths have no cosine; each length has projections and cells of its own, in
the same pass, so vectors of every length link with their like.

Defined results: null, empty, zero or non-finite vectors link with nothing. Rows with equal ids
are rows of their own. Null ids come last.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import materialise
from corvid.llm.graph import EDGES, Forest, components, edges_table, map_blocks, smallest_ids

TABLES, PARTS, PROBES = 6, 4, 3
CELL = 0.36
COSINE = 0.95
BLOCK_ROWS = 512
SEED = 8


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0...) in any two places, and halves with an even
    number of minus signs."""
    whole = [[s if k == i else t if k == j else 0 for k in range(8)]
             for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    half = [v for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + [list(v) for v in half], dtype=float)


MINIMAL = _minimal_vectors()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(x))
    step = np.where(off[rows, worst] >= 0, 1.0, -1.0)
    odd = near.sum(axis=1) % 2 != 0
    near[rows[odd], worst[odd]] += step[odd]
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of every row: the nearer of the two cosets' points."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def projections(dims: int, seed: int = SEED) -> np.ndarray:
    """TABLES x PARTS random projections to eight dimensions, with orthonormal rows per table where
    the dimensions allow it; scaled so that coordinates don't depend on ``dims``."""
    rng = np.random.default_rng([seed, dims])
    out = np.zeros((TABLES, PARTS, 8, dims))
    for t in range(TABLES):
        rows = rng.standard_normal((dims, 8 * PARTS))
        rows = np.linalg.qr(rows)[0].T if dims >= 8 * PARTS else rows.T / np.sqrt(dims)
        out[t] = rows.reshape(PARTS, 8, dims) * np.sqrt(dims / 64)
    return out


@lru_cache(maxsize=16)
def _projections(dims: int) -> np.ndarray:
    """This worker's projections of the lengths it met last."""
    return projections(dims)


def cells(unit: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """64-bit keys, vectors x (TABLES * (1 + PROBES)): per table the own cell, then those probed."""
    keys = []
    for t in range(len(tables)):
        points, gains, moves = [], [], []
        for part in tables[t]:
            x = unit @ part.T / CELL
            point = nearest_e8(x)
            gain = (x - point) @ MINIMAL.T
            best = np.argpartition(-gain, PROBES, axis=1)[:, :PROBES]
            points.append(point)
            gains.append(np.take_along_axis(gain, best, axis=1))
            moves.append(MINIMAL[best])
        own = np.concatenate(points, axis=1)
        # of the moves of all parts those that cross the nearest borders
        gain = np.concatenate(gains, axis=1)
        order = np.argsort(-gain, axis=1, kind="stable")[:, :PROBES]
        options = [own]
        for k in range(PROBES):
            part, move = order[:, k] // PROBES, order[:, k] % PROBES
            moved = own.copy()
            for p in range(len(points)):
                rows = np.flatnonzero(part == p)
                moved[rows, 8 * p: 8 * p + 8] += moves[p][rows, move[rows]]
            options.append(moved)
        for option in options:
            whole = np.rint(2 * option).astype(np.int64).astype(np.uint64)
            key = np.full(len(unit), (unit.shape[1] << 8) + t + 1, dtype=np.uint64)
            for c in range(whole.shape[1]):
                key = (key ^ whole[:, c]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length of the lists of doubles: the rows that have it, and their values as a matrix
    (NaN for nulls)."""
    length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    start = np.cumsum(length) - length
    for n in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == n)
        yield rows, values[start[rows][:, None] + np.arange(n)]


def _units(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length of the stored vectors: the rows that have it, and these scaled to length 1."""
    raw = column.to_pylist()
    length = np.array([len(v) for v in raw])
    for n in np.unique(length).tolist():
        rows = np.flatnonzero(length == n)
        x = np.frombuffer(b"".join(raw[i] for i in rows.tolist()), dtype=np.float64).reshape(len(rows), -1)
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(rows: DataFrame) -> DataFrame:
    """``rows`` (id, embedding) with ``node``, a key of the exact vector, and ``vec``, its doubles;
    both null where the vector can't be compared."""
    schema = T.StructType([rows.schema["id"], T.StructField("node", T.BinaryType()), T.StructField("vec", T.BinaryType())])

    def keyed(batches):
        for batch in batches:
            nodes, vectors = [None] * batch.num_rows, [None] * batch.num_rows
            for at, x in _by_length(batch.column(1)):
                good = np.isfinite(x).all(axis=1) & x.any(axis=1)
                x = x[good] / np.abs(x[good]).max(axis=1, keepdims=True) + 0.0  # keeps squares finite, and -0.0 is 0.0
                for i, vector in zip(at[good].tolist(), x):
                    vectors[i] = vector.tobytes()
                    nodes[i] = blake2b(vectors[i], digest_size=16).digest()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(vectors, pa.binary())],
                                             names=["id", "node", "vec"])

    return rows.mapInArrow(keyed, schema)


def _cell_rows(classes: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("cell", T.LongType()), T.StructField("node", T.BinaryType())])

    def probed(batches):
        for batch in batches:
            for rows, unit in _units(batch.column(1)):
                keys = cells(unit, _projections(unit.shape[1]))
                at = np.repeat(rows, keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(at))],
                                                 names=["cell", "node"])

    return classes.select("node", "vec").mapInArrow(probed, schema).distinct()


def _linked(group: pa.Table, cosine: float) -> np.ndarray:
    """Which pairs of a block are linked: above the diagonal, and off it only across chunks."""
    own = group["_c"].to_numpy()
    near = np.zeros((group.num_rows, group.num_rows), dtype=bool)
    for rows, unit in _units(group["vec"]):
        near[np.ix_(rows, rows)] = unit @ unit.T >= cosine
    near = np.triu(near, 1)
    if group["_i"][0].as_py() != group["_j"][0].as_py():
        near &= own[:, None] != own[None, :]
    return near


def _near_edges(cosine: float):
    def run(group: pa.Table) -> pa.Table | None:
        forest = Forest(group.num_rows)
        for i, j in zip(*(x.tolist() for x in np.nonzero(_linked(group, cosine)))):
            forest.join(i, j)
        return edges_table(group["node"].to_pylist(), forest.edges) if forest.edges else None

    return run


_COUNTS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("links", T.LongType())])


def _counts(cosine: float):
    def run(group: pa.Table) -> pa.Table | None:
        near, copies = _linked(group, cosine), group["copies"].to_numpy()
        links = near @ copies + near.T @ copies
        own = np.flatnonzero(links)
        return pa.table({"node": group["node"].take(pa.array(own)).combine_chunks(),
                         "links": pa.array(links[own].astype(np.int64))}) if len(own) else None

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id`` (smallest id reachable), ``kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    keyed = materialise(_classes(rows), "vectors")
    valid = keyed.where("node IS NOT NULL")
    classes = materialise(valid.groupBy("node").agg(F.first("vec").alias("vec"), F.count("*").alias("copies")), "classes")

    found = materialise(_cell_rows(classes), "cells")
    members = [F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("x2")]
    shared = found.groupBy("cell").agg(F.count("*").alias("n"), *members).where("n > 1")
    shared = materialise(shared.groupBy("n", "x1", "x2").agg(F.min("cell").alias("cell")).select("cell"), "shared")
    met = materialise(found.join(shared, "cell").join(classes.select("node", "vec"), "node"), "met")
    comps = components(map_blocks(met, "cell", "node", block_rows, _near_edges(cosine), EDGES))

    groups = materialise(classes.join(comps, "node"), "groups")
    links = (map_blocks(groups, "root", "node", block_rows, _counts(cosine), _COUNTS)
             .groupBy("node").agg(F.sum("links").alias("links")))
    least = smallest_ids(valid, "node", "id", comps, "component_id")
    nodes = (classes.select("node", "copies").join(links, "node", "left").join(least, "node")
             .select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"))
    out = keyed.select("id", "node").join(materialise(nodes, "nodes"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
