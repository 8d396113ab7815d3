"""Distributed union-find: connected components of an edge table, with joins and grouped minima only.

Large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014). No node's
neighbours are gathered: each round takes minima, which combine before the shuffle, and joins them back, where
AQE splits a hot node. Each step is written to the shared folder, so a lost executor costs one step. Joins are by
sort and merge, as a broadcast would pass the minima through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u")
    return larger.join(least.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node, root (the smallest node of the component), for every node that has an edge to another node.

    Null ends and self-edges are ignored; repeated edges count once; no edges give no rows.
    """
    x, y = F.col(left), F.col(right)
    now = materialize(edges.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen:
            break
        state = seen
        half = materialize(_large_star(now), "edges")  # written, as the small star reads it three times
        after = materialize(_small_star(half), "edges")
        release(now, half)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def held_bytes(df: DataFrame, row_bytes: int) -> int:
    """A bound of what df takes in memory: row_bytes for each row, and the counted bytes of its strings."""
    strings = [F.sum(F.octet_length(f"`{c}`")) for c, kind in df.dtypes if kind == "string"]
    strings += [F.sum(F.octet_length(F.to_json(f"`{c}`"))) for c, kind in df.dtypes if kind.startswith(("struct", "array")) and "string" in kind]
    got = df.agg(F.count("*"), *strings).first()
    return got[0] * row_bytes + sum(x or 0 for x in got[1:])


def sized_join(large: DataFrame, small: DataFrame, on, how: str, row_bytes: int, most: int = 8 << 20) -> DataFrame:
    """Join a table that was written before; it is broadcast only if its counted bytes fit into most.

    Beyond that Spark shuffles both sides, and AQE splits hot keys; the hint keeps Spark from broadcasting by file size.
    """
    return large.join(F.broadcast(small) if held_bytes(small, row_bytes) <= most else small.hint("merge"), on, how)
