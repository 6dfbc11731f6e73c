"""Conversation prefix trie by the Euler-tour technique.

The tour runs down and up the trie: an enter and an exit arc per node, linked by successor pointers.
Ranking that list with weights (pointer jumping, a join per round) gives every arc the sum of all
weights from it to the tour's end; the difference of a node's enter and exit arcs is its subtree's sum.

A node is named by its smallest member and its depth.  The nodes with the same smallest member are a
chain, and the tour enters a chain's nodes one after the other, so it is linked in pieces: one for all
enter arcs of a chain (with the exits down to the first node where others branch off), and one for the
exits from a branching node down to the next.  Sums within a piece are running sums along the chain."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import BLOCK, deal, following, keyed_index, running
from ..session import cut_lineage
from .common import pick, ship

ship(__name__)

GROUP = 20
MAX_SHARED = 4
ENTER = -1  # slot of a chain's enter piece; an exit piece has the depth that it starts from


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, in order of turn), length, role, t1, t2 (two hashes of the text), words.

    Texts are read here only: what follows moves their hashes and word counts."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    narrow = rows.select("conv_id", "turn", "role", F.xxhash64(F.lit(1), "text").alias("t1"), F.xxhash64(F.lit(2), "text").alias("t2"),
                         F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return cut_lineage(keyed_index(narrow, "conv_id", ["turn", "role", "t1", "t2"], rn="pos", total="length").drop("turn"))


def shared_starts(own: DataFrame) -> DataFrame:
    """The conversations of the query, rebuilt: conv_id, depth, role, t1, t2, words, length.

    Conversation c begins with the first h turns of conversation c - c % 20 (none if absent, all if fewer),
    h = crc32(c) % 4, and goes on with its own after the first h.  At most three rows a conversation are borrowed."""
    convs = own.where("pos = 1").select("conv_id", "length", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_SHARED)
                                        .alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    bases = own.where("pos = 1").select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = cut_lineage(convs.join(bases, "base", "left")
                        .withColumn("taken", F.least("h", F.coalesce("base_length", F.lit(0).cast("long"))))
                        .withColumn("rebuilt", F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0).cast("long")))
                        .select("conv_id", "base", "h", "taken", "rebuilt"))
    first = own.where(F.col("pos") < MAX_SHARED).select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "role", "t1", "t2", "words")
    borrowed = convs.join(first, "base").where(F.col("depth") <= F.col("h"))
    rest = own.join(convs, "conv_id").where(F.col("pos") > F.col("h")).withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    names = ["conv_id", "depth", "role", "t1", "t2", "words", F.col("rebuilt").alias("length")]
    start = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), *[
        F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "words")], F.col("rebuilt").alias("length"))
    return cut_lineage(start.unionByName(borrowed.select(*names)).unionByName(rest.select(*names)))


def with_starts(own: DataFrame) -> DataFrame:
    """The conversations as they are, with a row of depth 0 each: what ``trie`` takes."""
    rows = own.select("conv_id", F.col("pos").alias("depth"), "role", "t1", "t2", "words", "length")
    start = own.where("pos = 1").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), *[
        F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "words")], "length")
    return cut_lineage(start.unionByName(rows))


def nodes_of(seq: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends): one row per distinct prefix, named by (conv_id, depth) and by its digest (depth, p1, p2), with the
    parent's digest; and the conversations that end at each digest.

    A prefix's digest is the exclusive or of two 64-bit hashes of each (depth, role, text) in it, so prefixes of a
    conversation are a running aggregate, which also a conversation with a third of all turns is cut for."""
    def lane(seed: int) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "depth", "role", "t1", "t2"))
    rows = seq.select("conv_id", "depth", "words", "length", lane(1).alias("x1"), lane(2).alias("x2"))
    rows = cut_lineage(running(rows, "conv_id", ["depth"], {"p1": ("xor", "x1"), "p2": ("xor", "x2")}))
    nodes = rows.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("x1").alias("x1"), F.max("x2").alias("x2"))
    nodes = nodes.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("x1")), "q2": F.col("p2").bitwiseXOR(F.col("x2"))})
    return cut_lineage(nodes.drop("x1", "x2")), rows.where("depth = length").select("depth", "p1", "p2", "conv_id")


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, p1, p2, ends_sha256 of the comma-joined conv_ids in ascending order.

    SHA-256 runs over one node's ids in order; lists are cut into blocks whose text is made in parallel, and the
    task that holds a node only feeds these texts to the hash, one after the other."""
    keys = ["depth", "p1", "p2"]
    d = deal(ends, keys, ["conv_id"])
    parts = d.frame.groupBy(*keys, BLOCK).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for b in batches:
            for k1, k2, k3, ids in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                if (k1, k2, k3) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2, k3), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*keys, "ends_sha256"])
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, state.hexdigest())], names=[*keys, "ends_sha256"])

    ordered = parts.repartition(*keys).sortWithinPartitions(*keys, BLOCK).select(*keys, "ids")
    return ordered.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string")


def rank_list(pieces: DataFrame) -> DataFrame:
    """id_c, id_s, leaves, saved of a linked list (id_c, id_s, to_c, to_s, leaves, saved), summed from each piece to the end.

    Pointer jumping: every piece adds its successor's sums and takes over its successor, so the way to the end
    halves in each round; pieces that have arrived leave the join.  A piece has one predecessor: no skew."""
    done, live = None, cut_lineage(pieces)
    names = ["id_c", "id_s", "to_c", "to_s", "leaves", "saved"]
    while True:
        arrived = live.where("to_c IS NULL")
        if live.where("to_c IS NOT NULL").limit(1).count() == 0:
            return arrived.drop("to_c", "to_s")
        there = live.select(F.col("id_c").alias("to_c"), F.col("id_s").alias("to_s"), F.col("to_c").alias("on_c"),
                            F.col("to_s").alias("on_s"), F.col("leaves").alias("more"), F.col("saved").alias("more_saved"))
        jumped = live.where("to_c IS NOT NULL").join(there, ["to_c", "to_s"]).select(
            "id_c", "id_s", F.col("on_c").alias("to_c"), F.col("on_s").alias("to_s"),
            (F.col("leaves") + F.col("more")).alias("leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"))
        live = cut_lineage(arrived.select(*names).unionByName(jumped))


def trie(seq: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, depth from 0, role, t1, t2, words, length): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes, ends = nodes_of(seq)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    up = nodes.join(parents, ["depth", "q1", "q2"], "left")
    up = cut_lineage(up.select("conv_id", "depth", "p1", "p2", "parent", "n_convs",
                               ((F.col("n_convs") - 1) * F.col("words")).alias("saving")))

    # chains, and where they branch off: node (parent, depth - 1) of another chain
    heads = up.where("parent IS NULL OR parent != conv_id").select(
        F.col("conv_id").alias("chain"), "parent", (F.col("depth") - 1).alias("at"))
    nxt = following(heads, ["parent", "at"], ["chain"], ["chain"]).select("chain", "parent", "at", F.col("next_chain").alias("sibling"))
    branches = (heads.where("parent IS NOT NULL").groupBy(F.col("parent").alias("chain"), "at")
                .agg(F.min("chain").alias("first"), F.count(F.lit(1)).alias("n"), (-F.max("at")).alias("down")))
    branches = cut_lineage(following(branches, "chain", ["down"], ["first"]).drop("left", "down"))

    chains = up.groupBy(F.col("conv_id").alias("chain")).agg(F.max("depth").alias("last"), F.sum("saving").alias("saved"))
    top = branches.groupBy("chain").agg(F.max("at").alias("top"), F.max_by("first", "at").alias("first"))
    chains = chains.join(nxt, "chain").join(top, "chain", "left")
    # behind a chain's last exit: the next chain that branches off at the same node, or that node's exits
    after_c = F.coalesce("sibling", "parent")
    after_s = F.when(F.col("sibling").isNotNull(), F.lit(ENTER).cast("long")).when(F.col("parent").isNotNull(), F.col("at"))
    chains = cut_lineage(chains.select(
        "chain", "saved", (F.col("top").isNull() | (F.col("top") < F.col("last"))).cast("long").alias("leaves"),
        "first", after_c.alias("after_c"), after_s.alias("after_s")))
    enter = F.lit(ENTER).cast("long")
    pieces = chains.select(
        F.col("chain").alias("id_c"), enter.alias("id_s"), F.coalesce("first", "after_c").alias("to_c"),
        F.when(F.col("first").isNotNull(), enter).otherwise(F.col("after_s")).alias("to_s"), "leaves", "saved")
    zero = F.lit(0).cast("long")
    exits = branches.join(chains.select("chain", "after_c", "after_s"), "chain").select(
        F.col("chain").alias("id_c"), F.col("at").alias("id_s"), F.coalesce("next_first", "after_c").alias("to_c"),
        F.when(F.col("next_first").isNotNull(), enter).otherwise(F.col("after_s")).alias("to_s"), zero.alias("leaves"), zero.alias("saved"))
    ranked = rank_list(pieces.unionByName(exits))

    # per chain: sums from its enter piece on, and from behind that piece; per branching node: from its exits on
    entered = (ranked.where(F.col("id_s") == ENTER).select(F.col("id_c").alias("chain"), F.col("leaves").alias("in_leaves"), F.col("saved").alias("in_saved"))
               .join(chains.select("chain", "leaves", "saved"), "chain")
               .select(F.col("chain").alias("conv_id"), "in_leaves", "in_saved", (F.col("in_leaves") - F.col("leaves")).alias("end_leaves"),
                       (F.col("in_saved") - F.col("saved")).alias("end_saved")))
    left = ranked.where(F.col("id_s") != ENTER).select(F.col("id_c").alias("conv_id"), F.col("id_s").alias("exit_at"),
                                                      F.col("leaves").alias("out_leaves"), F.col("saved").alias("out_saved"))
    placed = up.join(branches.select(F.col("chain").alias("conv_id"), F.col("at").alias("depth"), "n"), ["conv_id", "depth"], "left")
    placed = placed.withColumns({"rise": -F.col("depth"), "branch": F.when(F.col("n").isNotNull(), F.col("depth"))})
    placed = cut_lineage(placed)
    # savings from a node down its chain, and the next branching node at or below it
    placed = running(placed, "conv_id", ["rise"], {"below": ("sum", "saving"), "exit_at": ("min", "branch"), "last": ("max", "depth")})
    out = (placed.join(entered, "conv_id").join(left, ["conv_id", "exit_at"], "left")
           .join(end_digests(ends), ["depth", "p1", "p2"], "left"))
    chain_saved = F.col("in_saved") - F.col("end_saved")
    return out.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        (F.coalesce("n", zero) + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        (F.col("in_leaves") - F.coalesce("out_leaves", "end_leaves")).alias("n_leaves"),
        (F.col("in_saved") - (chain_saved - F.col("below")) - F.coalesce("out_saved", "end_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """The trie of all conversations (``rebuild``: with the shared starts of the query).

    Turns are ordered by turn (null first), then role and hash of the text; null role or text counts as
    empty; rows without conv_id belong to no conversation and are left out; a row given twice is two turns; an
    empty table gives no rows (not even a root).  Extra columns are not read."""
    own = turns(conversations)
    return trie(shared_starts(own) if rebuild else with_starts(own))
