"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from peerscore.session import scratch_root


def _settled(edges: DataFrame) -> tuple[DataFrame, dict]:
    """A reliable checkpoint, with the number of links and of links that don't end in a root."""
    seen = Observation()
    digest = F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))
    kept = edges.observe(seen, F.count("*").alias("n"), digest.alias("digest")).checkpoint()
    return kept, seen.get


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in links (a, b): the smallest node of its component.

    Each round links the larger neighbours of a node to its smallest neighbour (large star), then
    a node and its smaller neighbours to the smallest (small star). Minima combine before their
    shuffle; joins on a hot node are left to Spark's splitting of skewed joins. Rounds are
    checkpoints, so a lost executor costs a retry. No links give no rows; loops, repeated and
    reversed links change nothing.
    """
    scratch_root(links.sparkSession)
    edges, state = _settled(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while state["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a")
        found, new = _settled(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionByName(root.select("a", F.col("m").alias("b"))).distinct()
        )
        done = new == state
        edges, state = found, new
        if done:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(roots.select("node", F.col("node").alias("component")))
    )
