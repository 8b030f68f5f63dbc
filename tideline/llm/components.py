"""Connected components by union-find: within each partition first, then by contraction between partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def union_find(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Nodes and the smallest node reachable from each, over the links a[i]-b[i]."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for x, y in zip(a, b):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    return nodes, [root(x) for x in nodes]


def local_forest(links: DataFrame) -> DataFrame:
    """Links (a, b) of the same components with a < b, for each partition one per node at most."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        xs: list[int] = []
        ys: list[int] = []
        for batch in batches:
            xs += batch.column(0).to_pylist()
            ys += batch.column(1).to_pylist()
            if len(xs) > 500_000:
                ys, xs = union_find(xs, ys)
        nodes, roots = union_find(xs, ys)
        a, b = np.array(roots, dtype=np.int64), np.array(nodes, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a[a < b]), pa.array(b[a < b])], names=["a", "b"])

    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(run, "a long, b long")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of links (a, b) the smallest node reachable. Nodes without links have no row.

    Each round hooks every node on its smallest neighbour, follows that twice, and contracts the links; a chain of n
    nodes takes log n rounds, a star one. All tables are written, and grow with the links.
    """
    links = saved(local_forest(links).distinct(), "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("up")).select("a", F.least("a", "up").alias("up"))
        twice = hook.join(hook.select(F.col("a").alias("up"), F.col("up").alias("top")), "up").select("a", "top")
        twice = saved(twice, "parents")
        labels = labels.join(twice.withColumnRenamed("a", "component"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        labels = saved(labels, "labels")
        left = links.join(twice, "a").select(F.col("top").alias("x"), "b")
        moved = left.join(twice.select(F.col("a").alias("b"), F.col("top").alias("y")), "b")
        links = saved(local_forest(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct(), "links")
    return labels
