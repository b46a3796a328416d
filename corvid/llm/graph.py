"""Links between records: groups cut into blocks of bounded size, and connected components
by alternating star contractions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import discard, map_groups, materialise

EDGES = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


class Forest:
    """Union-find over positions 0..n-1; ``edges`` holds the joins that merged two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


def edges_table(ids: list, pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([ids[i] for i, _ in pairs], pa.binary()),
                     "b": pa.array([ids[j] for _, j in pairs], pa.binary())})


def blocks(members: DataFrame, key: str, node: str, block_rows: int) -> DataFrame:
    """Rows of keys with two members or more, dealt into blocks ``(key, _i, _j)`` so that any
    two members of a key meet in a block and no block holds much more than two times
    ``block_rows`` rows. ``_c`` is a row's own chunk: in a block with ``_i = _j`` all pairs
    count, in the others those of different chunks.

    ``members`` must be a stored table (it is read twice). The sizes are stored too, so that
    the join with them has a plain shuffle on both sides, which AQE splits for a hot key.
    """
    sizes = materialise(
        members.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
        .select(F.col(key), F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_chunks")), "sizes")
    dealt = members.join(sizes, key).withColumn(
        "_c", F.pmod(F.xxhash64(F.lit(17), F.col(node)), F.col("_chunks").cast("long")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return (dealt.withColumn("_i", F.least("_c", "_o")).withColumn("_j", F.greatest("_c", "_o"))
            .drop("_o", "_chunks"))


def _contract(edges: DataFrame) -> DataFrame:
    """Spanning forest of each partition's edges: same components, no more edges than nodes."""
    def forests(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            order = sorted(set(a) | set(b))
            at = {x: i for i, x in enumerate(order)}
            forest = Forest(len(order))
            for x, y in zip(a, b):
                forest.join(at[x], at[y])
            pairs = [(i, r) for i in range(len(order)) if (r := forest.root(i)) != i]
            yield from edges_table(order, pairs).to_batches()

    return edges.select("a", "b").mapInArrow(forests, EDGES)


def _star(edges: DataFrame, at: Column, other: Column, keep: Column, extra: bool,
          name: str) -> tuple[DataFrame, DataFrame]:
    """The new edges, and a stored table that they read."""
    near = edges.select(at.alias("u"), other.alias("v"))
    stored = materialise(near.groupBy("u").agg(F.min("v").alias("m")), f"{name}-min")
    low = stored.select("u", F.least("u", "m").alias("m"))
    out = near.join(low, "u").where(keep).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if extra:
        out = out.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct(), stored


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (binary columns ``a``, ``b``): ``node``, ``root``, the
    smallest node of its component. Nodes without an edge aren't listed.

    Every round hangs the larger neighbours of a node, then the smaller ones, on the smallest;
    it ends when all edges point at roots. Rounds grow with the logarithm of the longest path.
    """
    edges = materialise(_contract(edges.where(F.col("a") != F.col("b"))), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        star, low = _star(both, F.col("a"), F.col("b"), F.col("v") > F.col("u"), False, "large")
        large = materialise(star, "large")
        star, lower = _star(large, F.greatest("a", "b"), F.least("a", "b"), F.lit(True), True, "small")
        small = materialise(star, "small")
        discard(edges, low, large, lower)
        edges = small
        roots = edges.select(F.col("b").alias("a")).distinct()
        if edges.join(roots, "a", "left_semi").isEmpty() and edges.groupBy("a").count().where("count > 1").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    out = materialise(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "components")
    discard(edges)
    return out


def smallest_ids(rows: DataFrame, node: str, id_col: str, comps: DataFrame, out: str) -> DataFrame:
    """``node``, ``root``, ``out``: the component that each node of ``rows`` is in, and the smallest
    ``id_col`` in it."""
    own = rows.groupBy(F.col(node).alias("node")).agg(F.min(id_col).alias("_least"))
    own = materialise(own.join(comps, "node", "left")
                      .select("node", F.coalesce("root", "node").alias("root"), "_least"), "own-least")
    least = materialise(own.groupBy("root").agg(F.min("_least").alias(out)), "root-least")
    return own.join(least, "root").select(F.col("node").alias(node), "root", out)


def map_blocks(members: DataFrame, key: str, node: str, block_rows: int, fn, schema: T.StructType) -> DataFrame:
    """``fn`` over every block of ``blocks(members, ...)``."""
    return map_groups(blocks(members, key, node, block_rows), [key, "_i", "_j"], fn, schema)

