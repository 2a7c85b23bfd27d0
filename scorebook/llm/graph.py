"""Connected components of an edge table, by union-find forests inside tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.common import Scratch

#: A task empties its union-find forest after this many edges, which bounds its memory.
FOREST_EDGES = 200_000


class UnionFind:
    """Forest whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        path = []
        while (up := self.parent.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for node in path:
            self.parent[node] = x
        return x

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task, replaced by (member, root) edges of its forest."""
    forest, seen = UnionFind(), 0

    def emit() -> pa.RecordBatch:
        pairs = [(x, root) for x in list(forest.parent) if (root := forest.find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.union(a, b)
        seen += batch.num_rows
        if seen >= FOREST_EDGES:
            yield emit()
            forest, seen = UnionFind(), 0
    yield emit()


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Link every neighbour to the smallest of its star: those above the centre, or those below and the centre."""
    if larger:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = around.join(least, "u")
    if larger:
        return linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    out = linked.filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.union(least.filter("u != m").select(F.col("u"), F.col("m"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``, ``root`` for every node of an edge (binary columns ``a``, ``b``); the root is the smallest node.

    Null ends and loops are ignored, repeated and reversed edges count once. Each round is a written table; rounds end
    when the edges no longer change, after about the logarithm of the longest path.
    """
    now = scratch.keep(edges.filter("a is not null and b is not null and a != b").select("a", "b").mapInArrow(_forest, "a binary, b binary"), "forest")
    state = None
    while True:
        new = scratch.keep(_stars(_stars(now, True), False), "stars")
        scratch.drop(now)
        seen = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        now = new
        if tuple(seen) == state:
            break
        state = tuple(seen)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b"), F.col("b")).distinct())
