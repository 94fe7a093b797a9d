"""Connected components by alternating large-star and small-star steps.

Edges are (u, v) with u > v. Large-star hangs every greater neighbour of a node
under the node's smallest neighbour; small-star does so for the smaller
neighbours. Alternating them turns each component into a star around its
smallest id in O(log^2 n) rounds; the loop ends when the edge set stays the
same, so chains and hubs of any size converge. Smallest neighbours come from a
partially aggregated ``min``; only narrow (id, id) rows move. Every round is
written to the shared staging folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    up = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.union(low.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, src: str = "id_a", dst: str = "id_b") -> DataFrame:
    """(node, label = smallest id of its component) for every node on an edge between two ids.

    Loops, repeated edges, either direction and null ends are accepted (loops
    and nulls are dropped); no edges give an empty table.
    """
    a, b = F.col(src), F.col(dst)
    stars = stage(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(stars)
    while mark[0]:
        stars = stage(_small_star(_large_star(stars)).distinct(), "stars")
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
