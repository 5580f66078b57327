"""The prefix trie of conversations, and totals of its subtrees.

A node of depth d stands for a distinct sequence of d turns; conversations that
begin with it are its members.  A turn is known by two 64-bit hashes of its role
and text, so texts are read once and never exchanged.  A prefix is known by 128
bits: the running sums, in four lanes of 32 bits, of a hash of each turn's place
and content; the sums without the last turn are the parent's.  Running sums need no
conversation in one task (``running``), and members meet in a partial aggregate,
so neither a conversation with very many turns nor a prefix that many share is a
hot group.

Totals of subtrees come from parallel tree contraction (``contraction``).

The digest of a node's ends is over a text as long as they are many, so it is fed
from rows sorted by (node, conversation) as they stream by; a task holds one row at
a time, however many conversations end at one node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.contraction import subtree_sums
from quire.llm.running import running_sums
from quire.session import materialize

_LOW = (1 << 32) - 1
_LANES = ["a", "b", "c", "d"]
_NODE = ["depth", "k1", "k2"]
EMPTY_DIGEST = hashlib.sha256().hexdigest()


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, place, t1, t2, size`` of every turn: its place in its conversation
    (from 1), hashes of role and text, and the text's bytes.

    Places are by turn number, null first; turns with equal numbers are in the order
    of their hashes.  Null role or text counts as empty.  Rows without a conversation
    are left out; other columns are dropped.
    """
    said = (F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    narrow = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(F.lit(1), *said).alias("t1"), F.xxhash64(F.lit(2), *said).alias("t2"),
        F.octet_length(said[1]).cast("bigint").alias("size"), F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_sums(materialize(narrow, "turns"), "conv", [F.col("turn").asc_nulls_first(), "t1", "t2"], ["one"])
    return placed.select("conv", F.col("run_one").alias("place"), "t1", "t2", "size")


def _keys(lanes: list[Column]) -> list[Column]:
    a, b, c, d = (x.bitwiseAND(F.lit(_LOW)) for x in lanes)
    return [F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)]


def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv, depth, k1, k2, p1, p2, size``: each conversation's prefixes of one
    turn and more, their keys and those of their parents."""
    hashed = [F.xxhash64(F.lit(i), "place", "t1", "t2") for i in (1, 2)]
    lanes = [part for h in hashed for part in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW)))]
    rows = materialize(turns.select("conv", "place", "size", *(x.alias(n) for x, n in zip(lanes, _LANES))), "places")
    run = running_sums(rows, "conv", ["place"], _LANES)
    own, parent = _keys([F.col(f"run_{n}") for n in _LANES]), _keys([F.col(f"run_{n}") - F.col(n) for n in _LANES])
    return run.select("conv", F.col("place").alias("depth"), own[0].alias("k1"), own[1].alias("k2"), parent[0].alias("p1"), parent[1].alias("p2"), "size")


def _digests(batches):
    node, digest = None, None

    def batch_of(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*_NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv"))):
            if key != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if done:
            yield batch_of(done)
    if node is not None:
        yield batch_of([(*node, digest.hexdigest())])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node of the trie over ``turns(conv, place, t1, t2, size)``:
    ``conv`` (its smallest member) and ``depth``, which together name it,
    ``parent_conv``, ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless
    nodes of its subtree), ``saved`` (over its subtree, size of the last turn times
    members but one) and ``ends_sha256`` (of the decimal numbers of the members that
    end there, ascending, comma-joined).

    ``convs(conv)`` lists every conversation once, those without turns too; places of
    one go from 1 without gaps.  The root has depth 0 and no parent.  Without
    conversations there are no rows.
    """
    prefixes = materialize(_prefixes(turns), "prefixes")
    members = prefixes.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.max("size").alias("size"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nothing = F.lit(0).cast("bigint")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0").select(
        nothing.alias("depth"), nothing.alias("k1"), nothing.alias("k2"), "n_convs", "conv", nothing.alias("size"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2")
    )
    nodes = materialize(members.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "nodes")

    # parents by key: a prefix with very many children is split by AQE (both sides are stored)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    linked = materialize(nodes.join(parents, ["depth", "p1", "p2"], "left").drop("p1", "p2"), "linked")
    children = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = linked.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", nothing))
    counted = materialize(counted.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "saving": (F.col("n_convs") - 1) * F.col("size")}), "counted")
    sums = subtree_sums(counted, ["leaf", "saving"]).select("node", F.col("leaf").alias("n_leaves"), F.col("saving").alias("saved"))

    last = prefixes.groupBy("conv").agg(F.max(F.struct(*_NODE)).alias("at")).select("conv", "at.*")
    ended = convs.select("conv").join(last, "conv", "left").select("conv", *(F.coalesce(c, nothing).alias(c) for c in _NODE))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digests = ended.repartition(parts, *_NODE).sortWithinPartitions(*_NODE, "conv").mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")
    out = counted.join(sums, "node").join(digests, _NODE, "left")
    return out.select("conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"))
