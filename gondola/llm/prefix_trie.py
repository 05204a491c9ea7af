"""Prefix trie of conversations by collapsing whole sequences.

Turns are replaced by 128-bit digests at the scan. A node is named by its depth and two sums of 60-bit
hashes of (position, turn), so the names of all prefixes of a sequence are running sums, and a prefix is
never built as text. Two different prefixes get one name with probability about n^2 / 2^113.

Identical sequences are grouped into one weighted sequence with the list of conversations that end
there; sequences that are a proper prefix of another are found by an anti-join, which leaves the
leaves; then every prefix of a sequence adds its sequence's weight to the prefix's node. What a subtree
saves needs no walk either: summed over a subtree, n_convs * length is what the members have after the
node's parent, and the lengths of the distinct nodes are told apart by owner: a node belongs to its smallest
member, so the nodes of one owner are the tail of its sequence.

A conversation with very many turns is spread by ranges (operators.scan), copies collapse by partial aggregation, a hot
parent is a skewed join key with one row on the other side.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import written
from gondola.operators.scan import running

#: Conversation ids of one part of an end list share all but so many low bits.
END_BITS = 12


class Trie(NamedTuple):
    nodes: DataFrame  # node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    ends: DataFrame   # node, part, conv_ids: the members that end at the node, ascending over the parts and inside


def turn_rows(df: DataFrame) -> DataFrame:
    """(conv_id, n, fp, len): turns numbered from 1 by turn, null first; equal turns by their digest.

    Null role and text count as empty. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    fp = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256)), 1, 16)
    rows = df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", fp.alias("fp"), F.length(text).cast("long").alias("len"))
    return running(rows, ["conv_id"], ["turn", "fp"], count="n").drop("turn")


def rebuild(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, depth, fp, len) with a row of depth 0 for every conversation.

    Conversation c takes the first h turns of conversation c - c % block (all if it has fewer, none if there
    is none), h = crc32(decimal c) % most, then its own turns after its first h.
    """
    turns = written(turns, "trie-turns")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = turns.where((F.col("n") < most) & (F.col("conv_id") % block == 0)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("n", "fp", "len"))).alias("head"))  # at most most - 1 turns
    convs = turns.where("n = 1").select("conv_id", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    convs = written(convs.join(heads, "base", "left").select(
        "conv_id", "h", F.expr("slice(head, 1, cast(h as int))").alias("head")), "trie-convs")
    lent = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.n").alias("depth"), "t.fp", "t.len")
    size = convs.select("conv_id", "h", F.when(F.col("head").isNull(), 0).otherwise(F.size("head")).alias("lent"))
    own = turns.where(F.col("n") > shared).join(size, "conv_id").select(
        "conv_id", (F.col("n") - F.col("h") + F.col("lent")).alias("depth"), "fp", "len")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("fp"), F.lit(0).cast("long").alias("len"))
    return root.unionByName(lent).unionByName(own)


def _name(depth: Column, *sums: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])


def prefix_trie(sequences: DataFrame) -> Trie:
    """The trie of ``sequences`` (conv_id, depth from 0, fp, len; conv_id and depth identify a row).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (summed over the
    subtree, (n_convs - 1) * len). An empty table has no nodes, not even a root.
    """
    mask = F.lit((1 << 60) - 1)
    term = [F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.xxhash64(F.lit(k), "depth", "fp").bitwiseAND(mask)).cast("decimal(20,0)") for k in (1, 2)]
    steps = sequences.select("conv_id", "depth", "len", term[0].alias("x"), term[1].alias("y"))
    steps = running(steps, ["conv_id"], ["depth"], sums={"sx": F.col("x"), "sy": F.col("y"), "cum": F.col("len")})
    steps = written(steps.select(
        "conv_id", "depth", "len", "cum", _name(F.col("depth"), F.col("sx"), F.col("sy")).alias("node"),
        F.when(F.col("depth") > 0, _name(F.col("depth") - 1, F.col("sx") - F.col("x"), F.col("sy") - F.col("y"))).alias("parent")), "trie-steps")

    # whole sequences: copies collapse to one with a weight; the smallest conversation stands for them
    ends = written(steps.groupBy("conv_id").agg(F.max(F.struct("depth", "node", "cum")).alias("end")).select(
        "conv_id", F.col("end.node").alias("node"), F.col("end.depth").alias("last"), F.col("end.cum").alias("total")), "trie-ends")
    seqs = ends.groupBy("node").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.first("last").alias("last"),
                                    F.first("total").alias("total"))
    seqs = written(seqs, "trie-sequences")
    paths = steps.join(seqs.select("conv_id", "weight", "last", "total"), "conv_id")
    inner = paths.where("depth < last").select("node").distinct()
    leaves = seqs.join(inner, "node", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    paths = written(paths.join(leaves, "conv_id", "left").fillna({"leaf": 0}), "trie-paths")

    nodes = paths.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min(F.struct("conv_id", "total")).alias("owner"),
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * F.col("total")).alias("held"),
        F.first(F.col("cum") - F.col("len")).alias("before"))
    nodes = nodes.select("node", "parent", "depth", F.col("owner.conv_id").alias("conv_id"), F.col("owner.total").alias("total"),
                         "n_convs", "n_leaves", "held", "before")
    nodes = written(nodes, "trie-nodes")
    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = written(nodes.join(up, "parent", "left"), "trie-parents")
    # a sequence's own nodes are a tail of it, from the node whose parent has another owner
    tails = nodes.where("parent is null or conv_id <> parent_conv_id").select("conv_id", (F.col("total") - F.col("before")).alias("own"))
    distinct = paths.select("conv_id", "node").join(tails, "conv_id").groupBy("node").agg(F.sum("own").alias("owned"))
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    out = nodes.join(distinct, "node").join(tails, "conv_id").join(kids, "node", "left")
    # the distinct nodes below: tails of the others, and the owner's sequence from here on
    lengths = F.col("owned") - F.col("own") + F.col("total") - F.col("before")
    out = out.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                     "n_leaves", (F.col("held") - F.col("n_convs") * F.col("before") - lengths).alias("saved_tokens"))
    lists = ends.groupBy("node", F.shiftright("conv_id", END_BITS).alias("part")).agg(F.sort_array(F.collect_set("conv_id")).alias("conv_ids"))
    return Trie(out, lists)


def _digest(batches):
    """Digest per node over its id lists, which come in order; holds one batch and one open digest."""
    open_node, state, nodes, sums = None, None, [], []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != open_node:
                if state is not None:
                    nodes.append(open_node)
                    sums.append(state.hexdigest())
                open_node, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(nodes) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sums)], names=["node", "ends_sha256"])
            nodes, sums = [], []
    if state is not None:
        nodes.append(open_node)
        sums.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(sums, pa.string())], names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's end list, decimal ids joined by commas.

    The parts of a list are sorted where they were gathered; the digest itself is sequential, so one
    task reads a node's parts in order, holding one Arrow batch at a time.
    """
    parts = ends.select("node", "part", F.array_join(F.col("conv_ids").cast("array<string>"), ",").alias("ids"))
    return parts.repartition("node").sortWithinPartitions("node", "part").select("node", "ids").mapInArrow(
        _digest, "node string, ends_sha256 string")
