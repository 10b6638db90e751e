"""Connected components by union-find: inside partitions first, then large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import written


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over one partition's links; a spanning star for each of its groups leaves."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for pdf in batches:
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = list(parent)
    yield pd.DataFrame({"u": nodes, "v": [find(x) for x in nodes]}, dtype="int64")


def _digest(edges: DataFrame) -> tuple:
    # xor is order-free and can't overflow
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, component)``, component being the smallest node reachable.

    Self links and nulls are dropped; nodes without links do not appear.  A hot
    node only ever feeds a partial minimum and an ordinary equi-join.
    """
    edges = edges.where("u is not null and v is not null and u <> v")
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
    edges = written(edges.mapInPandas(_forest, "u long, v long").where("u <> v").distinct(), "cc")
    before = _digest(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .where("u <> v").distinct()
        )
        edges = written(small, "cc")
        now = _digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = members.select(F.col("component").alias("node"), "component").distinct()
    return members.unionByName(roots)
