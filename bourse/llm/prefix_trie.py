"""The trie of conversation prefixes, its subtree totals found by parallel
tree contraction.

A node stands for a distinct sequence of first turns (role, text). Its id
joins two running sums, modulo 2**62, of hashes of (place, role, text); sums
over blocks of BLOCK turns are added up block by block, so a very long
conversation is not one window. The node's parent has the sums without the
last turn.

Contraction works on the table of nodes, in rounds of joins:

- rake: every node without children is closed, and its totals go to its
  parent;
- compress: of a chain of nodes with one child each, some are spliced out.
  A node goes if its own coin is 1 and its child's is 0, so no two
  neighbours go at once. In round r the coin is bit r of the depth, which
  halves an unbroken chain every round (later a hash). What the node had
  rides on its child's edge from then on.

A chain of n nodes is gone after about log2(n) rounds, a bushy tree after
as many as it is high, so no step follows the number of nodes. Re-expansion
gives a spliced node its total: that of the child it was spliced onto, plus
what it had; pointers through later splices are doubled until they reach a
raked node.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import stored
from bourse.operators.ranks import places

# Turns whose hashes one window sums.
BLOCK = 1024
# Rounds in which depth bits are the coins: chains of up to 2**16 nodes.
DEPTH_ROUNDS = 16
WORD = r"[^\x20\x09-\x0D]+"
_LIMIT = 2**62
_ROOT = Decimal(0)
_ID = "decimal(38,0)"


# ---- turns ---------------------------------------------------------------------

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text, place): turns in order, null first; of one turn
    number by role and text. Null roles and texts are empty. Rows without a
    conv_id belong to no conversation and are left out."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    order = [F.col("turn").asc_nulls_first(), F.asc("role"), F.substring("text", 1, 256).asc(), F.xxhash64("text").asc()]
    return places(rows, order, ["conv_id"]).drop("turn")


def with_shared_openings(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share openings: conversation c begins with
    the first h turns of conversation c - c % ``group`` (all if it has fewer,
    none if it is absent) and goes on with its own turns after its first h; h
    is crc32 of its decimal id modulo ``heads``. Gives the turns (conv_id,
    place, role, text, last) and all conversations (conv_id, n_turns)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    opening = turns.filter(F.col("place") < heads).filter(F.col("conv_id") % group == 0)
    found = opening.groupBy("conv_id").agg(F.count(F.lit(1)).alias("found")).withColumnRenamed("conv_id", "base")
    plan = counts.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group) \
        .join(found, "base", "left").withColumn("lead", F.least("h", F.coalesce("found", F.lit(0)))) \
        .select("conv_id", "h", "base", "lead", (F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))
    plan = stored(plan, "openings")
    rest = turns.join(plan, "conv_id").filter("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("lead"))
    lead = plan.join(opening.withColumnRenamed("conv_id", "base"), "base").filter("place <= lead")
    cols = ["conv_id", "place", "role", "text", (F.col("place") == F.col("n_turns")).alias("last")]
    return rest.select(*cols).unionByName(lead.select(*cols)), plan.select("conv_id", "n_turns")


# ---- nodes ---------------------------------------------------------------------

def _node_id(a: Column, b: Column) -> Column:
    limit = F.lit(Decimal(_LIMIT))
    return ((a % limit).cast("decimal(19,0)") * limit + b % limit).cast(_ID)


def prefix_steps(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, id, parent, words, last): the node each turn leads to."""
    mask = F.lit(_LIMIT - 1)
    hashes = [F.xxhash64("place", "role", "text"), F.xxhash64(F.lit("again"), "text", "role", "place")]
    slim = stored(turns.select(
        "conv_id", "place", "last", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.floor((F.col("place") - 1) / BLOCK).alias("block"),
        *[x.bitwiseAND(mask).cast("decimal(19,0)").alias(c) for x, c in zip(hashes, "ab")]), "turn_hashes")
    inside = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(_ROOT)
    carried = slim.groupBy("conv_id", "block").agg(F.sum("a").alias("a"), F.sum("b").alias("b")) \
        .select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), zero).alias(f"{c}0") for c in "ab"])
    sums = slim.select("*", *[F.sum(c).over(inside).alias(f"{c}1") for c in "ab"]).join(carried, ["conv_id", "block"])
    at = [F.col(f"{c}0") + F.col(f"{c}1") for c in "ab"]
    return sums.select("conv_id", F.col("place").alias("depth"), _node_id(*at).alias("id"),
                       _node_id(at[0] - F.col("a"), at[1] - F.col("b")).alias("parent"), "words", "last")


def _end_blocks(batches):
    """The ids of each run of one node in a batch, joined; batches are sorted
    by node and conversation."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, conv = batch.column("id"), batch.column("conv_id").to_pylist()
        new = np.flatnonzero(pc.not_equal(node.slice(1), node.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)) + 1
        starts = [0, *new.tolist()]
        joined = [",".join(map(str, conv[lo:hi])) for lo, hi in zip(starts, [*starts[1:], len(conv)])]
        yield pa.RecordBatch.from_arrays([node.take(pa.array(starts)), pa.array([conv[lo] for lo in starts]), pa.array(joined)],
                                         names=["id", "first", "ids"])


def _end_digests(batches):
    """SHA-256 of each node's joined ids, from blocks sorted by node and place."""
    last, digest = None, None
    for batch in batches:
        nodes, out = [], []
        for node, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
            if node != last:
                if digest is not None:
                    nodes.append(last)
                    out.append(digest.hexdigest())
                last, digest = node, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digest_rows(nodes, out)
    if digest is not None:
        yield _digest_rows([last], [digest.hexdigest()])


def _digest_rows(nodes: list, digests: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.decimal128(38, 0)), pa.array(digests, pa.string())],
                                      names=["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): hash of the ids of the conversations that end at a
    node, ascending and joined by commas. A node's ids are sorted over many
    partitions; the task that hashes them gets them in joined blocks."""
    blocks = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id") \
        .mapInArrow(_end_blocks, f"id {_ID}, first long, ids string")
    return blocks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_end_digests, f"id {_ID}, ends_sha256 string")


# ---- contraction ---------------------------------------------------------------

def _coin(depth: str, round_: int) -> Column:
    if round_ < DEPTH_ROUNDS:
        return F.shiftright(depth, round_).bitwiseAND(F.lit(1)) == 1
    return F.pmod(F.xxhash64(depth, F.lit(round_)), F.lit(2)) == 1


def subtree_totals(nodes: DataFrame, totals: list[str]) -> DataFrame:
    """(id, *totals): each of the columns ``totals`` (long) of ``nodes`` (id,
    parent, depth, n_children) summed over the node's subtree, itself
    included. A root's parent is null. An empty table gives an empty result."""
    add = [f"{c}_up" for c in totals]  # what else the edge to the parent carries
    active = stored(nodes.select("id", "parent", F.col("depth").cast("long").alias("depth"), F.col("n_children").alias("n"),
                                 *totals, *[F.lit(0).cast("long").alias(a) for a in add]), "contraction")
    raked, spliced, round_ = [], [], 0
    while not active.isEmpty():
        raked.append(active.filter("n = 0").select("id", *totals))
        stays = F.col("n") > 0
        kids = active.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
            F.count(F.when(stays, 1)).alias("left"), F.max(F.when(stays, F.col("depth"))).alias("child_depth"),
            *[F.coalesce(F.sum(F.when(~stays, F.col(c) + F.col(a))), F.lit(0)).alias(f"{c}_in") for c, a in zip(totals, add)])
        lone = (F.col("left") == 1) & F.col("parent").isNotNull()
        held = stored(active.filter(stays).join(kids, F.col("id") == F.col("of")).select(
            "id", "parent", "depth", F.col("left").alias("n"),
            *[(F.col(c) + F.col(f"{c}_in")).alias(c) for c in totals], *add,
            (lone & _coin("depth", round_) & ~_coin("child_depth", round_)).alias("goes")), "raked")
        gone = held.filter("goes").select(F.col("id").alias("cut"), F.col("parent").alias("over"),
                                          *[F.col(c).alias(f"{c}_cut") for c in totals],
                                          *[F.col(a).alias(f"{a}_cut") for a in add])
        # A row whose parent goes takes its place below the next one up. The
        # spliced node's total is this row's plus what both carried.
        active = stored(held.filter("NOT goes").join(gone, F.col("parent") == F.col("cut"), "left").select(
            "id", F.when(F.col("cut").isNull(), F.col("parent")).otherwise(F.col("over")).alias("parent"), "depth", "n", *totals,
            *[(F.col(a) + F.coalesce(F.col(f"{c}_cut") + F.col(f"{a}_cut"), F.lit(0))).alias(a) for c, a in zip(totals, add)],
            "cut", *[(F.col(f"{c}_cut") + F.col(a)).alias(f"{c}_more") for c, a in zip(totals, add)]), "contraction")
        spliced.append(active.filter("cut IS NOT NULL").select(
            F.col("cut").alias("id"), F.col("id").alias("via"), *[F.col(f"{c}_more").alias(c) for c in totals]))
        round_ += 1
    if not raked:
        return nodes.select("id", *totals)
    closed, links = stored(_union(raked), "closed"), stored(_union(spliced), "spliced")
    while True:
        further = links.select(F.col("id").alias("at"), F.col("via").alias("next"), *[F.col(c).alias(f"{c}_next") for c in totals])
        links = stored(links.join(further, F.col("via") == F.col("at"), "left").select(
            "id", F.coalesce("next", "via").alias("via"), F.col("next").isNotNull().alias("moved"),
            *[(F.col(c) + F.coalesce(F.col(f"{c}_next"), F.lit(0))).alias(c) for c in totals]), "spliced")
        if links.filter("moved").isEmpty():
            break
    at = closed.select(F.col("id").alias("at"), *[F.col(c).alias(f"{c}_at") for c in totals])
    opened = links.join(at, F.col("via") == F.col("at")).select("id", *[(F.col(c) + F.col(f"{c}_at")).alias(c) for c in totals])
    return closed.unionByName(opened)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` (conv_id, place from 1 without gaps, role, text, last) and
    ``conversations`` (conv_id, n_turns; each once) hold no nulls
    (``ordered_turns`` makes them so). saved_tokens counts the words
    (``[^\\x20\\x09-\\x0D]+``) of every node's last text once for each member
    but one, over the subtree. A conversation without turns is a member of
    the root only and ends there. Equal conversations share all nodes; very
    long texts are only hashed. Without conversations there is no root and
    the result is empty.
    """
    steps = stored(prefix_steps(turns), "steps")
    root = conversations.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0") \
        .select(F.lit(_ROOT).cast(_ID).alias("id"), F.lit(None).cast(_ID).alias("parent"), F.lit(0).cast("long").alias("depth"),
                "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    found = steps.groupBy("id").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                    F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    bare = stored(found.unionByName(root), "nodes")
    children = bare.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(bare.join(children, F.col("id") == F.col("of"), "left").drop("of")
                   .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "nodes")
    sums = subtree_totals(nodes.select(
        "id", "parent", "depth", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ends = steps.filter("last").select("id", "conv_id").unionByName(
        conversations.filter("n_turns = 0").select(F.lit(_ROOT).cast(_ID).alias("id"), "conv_id"))
    above = nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    # Written, so that a node with very many children can be split in the next join.
    named = stored(nodes.join(sums, "id").join(end_digests(ends), "id", "left"), "named")
    return named.join(above, F.col("parent") == F.col("up"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
