"""Subtree sums of a forest by parallel tree contraction.

Rounds alternate two steps on the nodes that are left.  *Rake*: leaves go, their
sums are final and are added to their parents.  *Compress*: of a chain of nodes
with one child each, those go whose number, drawn anew each round, is larger than
that of both neighbours; the child of such a node moves up to the node's parent
and carries the node's sum on its link.  Half of the nodes of any forest are leaves
or stand in chains, of which a third goes at once on average, so the number of
rounds grows with the logarithm of the nodes, in deep chains and bushy trees alike.

The contracted nodes are then expanded again, last round first: a compressed node's
sum is its own part plus the final sum of the child it had.  Each round looks up
only among the nodes that outlived it, so all rounds together cost about as much as
the first.

Every join is between unique node ids.  Children meet their parent as a partial
aggregate by parent, so that a node with very many children is no hot key.  What a
round leaves is stored; the driver sees counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize


def _rake(left: DataFrame, values: list[str]) -> DataFrame:
    """Nodes with ``is_leaf``, sums with the leaves' added, and ``rest``: how many
    children stay, one of them and what its link carries."""
    has_parent = F.col("parent").isNotNull()
    parents = left.where(has_parent).select(F.col("parent").alias("node")).distinct().withColumn("has_child", F.lit(True))
    marked = left.join(parents, "node", "left").withColumn("is_leaf", F.col("has_child").isNull()).drop("has_child")
    stays = ~F.col("is_leaf")
    by_parent = marked.where(has_parent).groupBy(F.col("parent").alias("node")).agg(
        *(F.sum(F.when(F.col("is_leaf"), F.col(v) + F.col(f"link_{v}")).otherwise(0)).alias(f"raked_{v}") for v in values),
        F.count(F.when(stays, True)).alias("n_rest"),
        F.max(F.when(stays, F.struct("node", *(f"link_{v}" for v in values)))).alias("rest"),
    )
    sums = ((F.col(v) + F.coalesce(f"raked_{v}", F.lit(0))).alias(v) for v in values)
    return marked.join(by_parent, "node", "left").select("node", "parent", "is_leaf", *sums, *(f"link_{v}" for v in values), F.coalesce("n_rest", F.lit(0)).alias("n_rest"), "rest")


def _compressed(raked: DataFrame, values: list[str], turn: int) -> DataFrame:
    """Nodes of chains that go: ``node, parent, child``, what is added to the
    child's sum for their own (``own_``) and to the child's link (``up_``)."""
    chain = raked.where("NOT is_leaf AND n_rest = 1 AND parent IS NOT NULL").select(
        "node", "parent", F.col("rest.node").alias("child"), F.xxhash64(F.lit(turn), "node").alias("drawn"),
        *((F.col(v) + F.col("rest")[f"link_{v}"]).alias(f"own_{v}") for v in values),
        *((F.col(v) + F.col(f"link_{v}")).alias(f"up_{v}") for v in values),
    )
    below = chain.select(F.col("node").alias("child"), F.col("drawn").alias("below"))
    above = chain.select(F.col("child").alias("node"), F.col("drawn").alias("above"))
    met = chain.join(below, "child", "left").join(above, "node", "left")
    goes = (F.col("below").isNull() | (F.col("drawn") > F.col("below"))) & (F.col("above").isNull() | (F.col("drawn") > F.col("above")))
    return met.where(goes).drop("drawn", "below", "above")


def subtree_sums(forest: DataFrame, values: Sequence[str], node: str = "node", parent: str = "parent") -> DataFrame:
    """``node`` and each column of ``values`` (bigint) summed over the node's
    subtree, the node included.

    ``forest`` has one row a node; ids are of any orderable type that can be hashed.
    The parent of a root is null or no node of the table.  Null values count as 0;
    rows without an id are left out; repeated ids and parents that lead in a circle
    are an error.  Further columns are dropped.  An empty table gives no rows.
    """
    values = list(values)
    left = materialize(
        forest.where(F.col(node).isNotNull()).select(
            F.col(node).alias("node"), F.col(parent).alias("parent"), *(F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values),
            *(F.lit(0).cast("bigint").alias(f"link_{v}") for v in values),
        ),
        "forest",
    )
    n_left = left.count()
    if left.select("node").distinct().count() < n_left:
        raise ValueError("a node id is repeated")
    final, gone = [], []  # by round: sums of leaves, compressed nodes
    while n_left:
        raked = materialize(_rake(left, values), "rake")
        final.append(raked.where("is_leaf").select("node", *values))
        gone.append(materialize(_compressed(raked, values, len(gone)), "compress"))
        moved = gone[-1].select(F.col("child").alias("node"), F.col("parent").alias("moved_to"), *(f"up_{v}" for v in values))
        stay = raked.where("NOT is_leaf").join(gone[-1].select("node"), "node", "left_anti").join(moved, "node", "left")
        links = ((F.col(f"link_{v}") + F.coalesce(f"up_{v}", F.lit(0))).alias(f"link_{v}") for v in values)
        left = materialize(stay.select("node", F.coalesce("moved_to", "parent").alias("parent"), *values, *links), "forest")
        before, n_left = n_left, left.count()
        if n_left == before:
            raise ValueError("parents lead in a circle")
    out = [left.select("node", *values)]
    for leaves, chain in zip(reversed(final), reversed(gone)):
        # the child of a compressed node outlived the round
        known = out[0]
        for more in out[1:]:
            known = known.unionByName(more)
        expanded = chain.join(known.select(F.col("node").alias("child"), *values), "child").select("node", *((F.col(v) + F.col(f"own_{v}")).alias(v) for v in values))
        out += [leaves, materialize(expanded, "expand")]
    sums = out[0]
    for more in out[1:]:
        sums = sums.unionByName(more)
    return sums.withColumnRenamed("node", node)
