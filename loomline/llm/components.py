"""Connected components of a link table, by alternating large-star and small-star rounds over DataFrames.

Each round's links are written to the shared folder, so lineage stays short and lost executors cost one round; the
round before goes then. Only a count and a checksum of a round reach the driver. Hot nodes (one end of many links) meet only in
min() aggregates, which combine before the shuffle, and in joins that Spark can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.textops import cut, forget


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every id of links (a, b) that is not its component's least id itself."""
    pairs = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    pairs = cut(pairs)
    mark = None
    for _ in range(most_rounds):
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table of its own: Spark then splits what the links of one node (a group's center) bring to the join
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.join(least, "u").where("v > u").select("v", F.col("m").alias("u")).where("u < v"))
        low = cut(large.groupBy("v").agg(F.min("u").alias("m")))
        small = large.join(low, "v")
        before, pairs = pairs, cut(small.select("v", F.col("m").alias("u")).union(small.where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))).distinct())
        forget(before, least, large, low)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == mark:
            return pairs.select(F.col("v").alias("id"), F.col("u").alias("component_id"))
        mark = now
    raise RuntimeError("components did not settle")


class Forest:
    """Union by least member over 0..n-1, for links found within one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def links(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(root's id, member's id): at most one link a member, with the same components."""
        return [(int(ids[r]), int(ids[i])) for i in range(len(self.up)) if (r := self.root(i)) != i]
