"""Connected components by union-find: first inside each partition, then star contraction across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frameloom.llm.common import cut, lean


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while parent.get(x, x) != root:
        parent[x], x = root, parent[x]
    return root


def union(parent: dict[int, int], a: int, b: int) -> None:
    """The smaller root wins, so that a component is named by its least node."""
    a, b = find(parent, a), find(parent, b)
    if a != b:
        low, high = min(a, b), max(a, b)
        parent[high] = low
        parent.setdefault(low, low)


@lean
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            union(parent, a, b)
    rows = [(x, find(parent, x)) for x in parent]
    rows = [(x, r) for x, r in rows if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (columns a, b); the root is the component's least node.

    Every partition is reduced to a spanning forest by union-find; then large-star
    and small-star steps alternate until nothing changes, which takes a number
    of rounds that grows with the logarithm of the longest path. Groups of any
    size are handled by windows that spill; nothing is gathered on the driver.
    Edges with a null end and loops are left out; an empty table gives an empty result.
    """
    forest = (
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .mapInArrow(_contract, "u long, v long")
    )
    current = cut(forest.distinct())
    seen = None
    while True:
        state = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if (state["n"], state["h"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["h"])
        w = Window.partitionBy("u")
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.withColumn("m", F.least(F.min("v").over(w), F.col("u")))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        low = large.withColumn("m", F.min("v").over(w))
        small = low.select("u", F.col("m").alias("v")).unionByName(low.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        current = cut(small.distinct())
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
