"""Connected components of a link table by alternating star contraction.

Each round lets every node point its larger neighbours at its smallest
neighbour (large star) and then its smaller neighbours likewise (small star),
until the links form stars.  Both steps are a min-aggregate (partial sums on the
map side) and a join; the minima are stored before the join, so that AQE can
split the partition of a node with very many links.  Links never leave the
executors; the driver sees a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize


def _to_smallest(links: DataFrame, name: str) -> DataFrame:
    """``links(u, v)`` with the smallest of u and its neighbours as column m."""
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), name)
    return links.join(least, "u").withColumn("m", F.least("m", "u"))


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_smallest(both, "large-star").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(stars: DataFrame) -> DataFrame:
    near = _to_smallest(stars, "small-star")
    moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link to another node; ``root``
    is the smallest node of its component.

    Nodes are of any orderable type.  Links may repeat and point either way;
    links of a node with itself or with null are no links.  No links give an
    empty table.
    """
    stars = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    stars = materialize(stars, "links")
    seen = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        stars = materialize(_small_star(_large_star(stars).distinct()).distinct(), "stars")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
