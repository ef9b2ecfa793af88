"""Connected components of a graph given as edges, as a Spark job.

Alternating large-star and small-star steps: every node's larger neighbours are tied to
the least node it sees, then its smaller ones.  Each step is one grouped minimum and one
join, so no component is ever collected; the edges of a step are written to the shared
folder, which cuts the lineage.  Steps grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanload.llm.common import stage


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``a`` with the least of itself and its neighbours ``b``."""
    return edges.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (both.join(_least(both), F.col("a") == F.col("_a")).where("b > a")
            .select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    tied = down.join(_least(down), F.col("a") == F.col("_a"))
    return (tied.select(F.col("b").alias("a"), F.col("_m").alias("b"))
            .unionAll(tied.select("a", F.col("_m").alias("b"))).where("a <> b").distinct())


def components(edges: DataFrame, most_steps: int = 100) -> DataFrame:
    """Rows ``id, component``: every node of an edge ``a, b`` with the least node reachable.

    Nulls and loops are left out.  No edges: no rows.
    """
    now = stage(edges.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_steps):
        found = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("a")).first()
        n, digest, nodes = found
        # a star forest: each node but the centres has one edge, and no centre has one
        if n == 0 or (digest == before and nodes == n):
            break
        if nodes == n and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        before = digest
        now = stage(_small_star(_large_star(now)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_steps} steps")
    centres = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(centres)
