"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscore.session import scratch_root


def _towards_smallest(edges: DataFrame, both: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of every node to its smallest neighbour. Minimum and
    join are keyed by the node; the minimum is combined before the shuffle and
    a node with very many neighbours is a skewed join, which Spark splits."""
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.join(least, "a")
    if larger_only:
        m = F.least("a", "m")
        return joined.where("b > a").select(F.col("b").alias("a"), m.alias("b"))
    pairs = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return joined.select(F.inline(pairs)).where("a <> b")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root for every node of ``edges`` (longs a, b): root is the smallest
    node that can be reached. Large-star and small-star steps by turns; every
    round is written to the shared checkpoint folder, which cuts the lineage.
    Only a count and a checksum come to the driver. No edges, no rows."""
    scratch_root(edges.sparkSession)
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _towards_smallest(e, both, larger_only=True).distinct()
        e = _towards_smallest(large, large, larger_only=False).distinct().checkpoint()
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
