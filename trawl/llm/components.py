"""Connected components of an edge table (alternating large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _star(down)
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the least node of its component.

    Each round halves path lengths, and its edges are written to the shared checkpoint folder; it ends
    when a round leaves the edges as they are. Self-loops, repeated edges and either direction are
    allowed; an empty table gives no rows.
    """
    tidy = edges.toDF("u", "v").where("u <> v").distinct()
    now, seen = stored(tidy, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v")).distinct()
        seen = mark
        now = stored(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
