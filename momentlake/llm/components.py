"""Connected components of an edge table: contraction inside tasks, then rounds of large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from momentlake.llm.common import shared_table

#: Nodes that a task holds while it contracts its edges.
TASK_NODES = 1_000_000


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v.  The grouped side has one row per u, so a node
    with very many neighbours is a skewed join key that is split, not a group."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _round(edges: DataFrame) -> DataFrame:
    """edges (u, v), v < u: connect larger neighbours to the least one, then each node and its smaller ones."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    small = _with_least(large)
    down = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
    return down.where("u > v").distinct()


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges of each task replaced by stars around the least nodes of what they connect there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.get(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root.get(x, x)
            return top

        def stars() -> pd.DataFrame:
            pairs = [(u, find(u)) for u in list(root)]
            return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"])

        for batch in batches:
            for a, b in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(root) > TASK_NODES:
                yield stars()
                root.clear()
        yield stars()

    return edges.mapInPandas(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) that is not the least of its component.

    Rounds end when the edge set no longer changes; it is compared by count and two checksums.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    # A task leaves one edge for each node but the least, so no node has more edges than there were tasks.
    now = shared_table(_contracted(_contracted(ordered).repartition("u")).distinct())
    before = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first()
        if mark == before or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        now = shared_table(_round(now))
