"""Connected components of a link table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
    return row["n"], row["h"] or 0


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` of every node of ``links`` (columns ``a, b``); the root is the component's smallest node.

    A round hangs every neighbour of a node, then every larger one, below its
    smallest neighbour; both are a minimum per node and a join, so a node with
    very many links is split like any skewed join.  Links become stars in a
    logarithmic number of rounds.  Null ends and self-links are ignored.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = scratch.write(edges)
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, mid = scratch.write(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        done, last = mark, path
        edges, path = scratch.write(small.distinct())
        mark = _mark(edges)
        scratch.release(mid)
        scratch.release(last)
        if mark == done:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
