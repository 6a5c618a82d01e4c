"""The trie of conversation prefixes, rolled up by pointer jumping.

A node is a distinct sequence of first turns. It is keyed by its depth and a digest that grows turn by turn, so the digest of
a turn's node and of its parent come from running sums and never from a whole conversation in one row. Each node points to
its parent; in round k every pointer leads 2**k levels up, sums of subtrees are handed along it, and pointers are joined to
pointers. So the rounds number the logarithm of the greatest depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, map_batches

#: Turns a block: a conversation is numbered and digested over its blocks first, then within a block.
BLOCK = 1024
#: Ids of conversations that end in a node are joined in pieces, each of one range of so many ids.
PIECE = 4096
#: Pointers to one node are followed by a broadcast of that node if they number more than one in so many.
HOT = 10_000
NODE = ["depth", "a", "b"]


def _place(rows: DataFrame, group: list[str], block: Column, order: list[Column], sums: dict[str, tuple]) -> DataFrame:
    """Adds running values over ``group`` in ``order``, by blocks: ``sums`` has name -> (aggregate, combine, value, start)."""
    rows = rows.withColumn("_block", block)
    at = [*group, "_block"]
    blocks = rows.groupBy(*at).agg(*(agg(value).alias(f"_{c}") for c, (agg, _, value, _) in sums.items()))
    before = W.partitionBy(*group).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*at, *(F.coalesce(agg(f"_{c}").over(before), F.lit(start)).alias(f"_{c}") for c, (agg, _, _, start) in sums.items()))
    inside = W.partitionBy(*at).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({f"_in_{c}": agg(value).over(inside) for c, (agg, _, value, _) in sums.items()})
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in at]
    joined = rows.alias("r").join(blocks.alias("s"), same[:-1] + [same[-1]])
    out = [F.col(f"r.{c}") for c in rows.columns if not c.startswith("_")]
    return joined.select(*out, *(both(F.col(f"_{c}"), F.col(f"_in_{c}")).alias(c) for c, (_, both, _, _) in sums.items()))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with shared openings: (conv_id, depth, bytes, digest) of every turn, depth from 1, and (conv_id,
    n_turns) of every conversation. The first h turns of conversation c - c % group come first, then c's own after its first
    h, with h = crc32(decimal c) % most."""
    said = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    digest = F.sha2(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said), 256)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(said[1]).cast("long").alias("bytes")
    )
    rows = cut(rows, "trie-turns")
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    one = {"place": (F.sum, _add, F.lit(1), 0)}
    rows = cut(_place(rows, ["conv_id"], F.floor(F.col("turn") / BLOCK), order, one).drop("turn"), "trie-placed")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    take = F.crc32(F.col("conv_id").cast("string")) % most
    convs = sizes.select("conv_id", "n", take.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    opening = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(opening, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = cut(
        convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")), "trie-convs"
    )
    first = rows.where(F.col("place") < most).withColumnRenamed("conv_id", "base").join(convs.where("taken > 0"), "base").where("place <= taken")
    own = rows.join(convs, "conv_id").where("place > h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    both = [x.select("conv_id", F.col("place").alias("depth"), "bytes", "digest") for x in (first, own)]
    return both[0].unionByName(both[1]), convs.select("conv_id", "n_turns")


def _jump(nodes: DataFrame, up: list[str], targets: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """``nodes`` joined with ``targets`` (keyed by ``up``). Targets that very many nodes point to, of which there can't be
    many, are broadcast; the others are joined by a shuffle, without a hot key. ``counts``: (up, n_children), a stored table."""
    many = max(BROADCAST_ROWS, n // HOT)
    hot = counts.where(F.col("n_children") > many).select(*up)
    if hot.isEmpty():
        return nodes.join(targets.hint("merge"), up, "left")
    marked = nodes.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), up, "left")
    few = F.broadcast(targets.join(F.broadcast(hot), up, "left_semi"))
    rest = marked.where("_hot is null").drop("_hot").join(targets.hint("merge"), up, "left")
    return rest.unionByName(marked.where("_hot").drop("_hot").join(few, up, "left"))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of (depth, a, b, conv_id): ids are joined in pieces of bounded length, and the pieces of a
    node run through one hash in order, without ever being one string."""
    piece = F.floor(F.col("conv_id") / PIECE)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ends.groupBy(*NODE, piece.alias("piece")).agg(joined.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, hashlib.sha256()

        def made() -> pa.RecordBatch:
            columns = [pa.array([x], t) for x, t in zip((*node, running.hexdigest()), (pa.int64(),) * 3 + (pa.string(),), strict=True)]
            return pa.RecordBatch.from_arrays(columns, [*NODE, "ends_sha256"])

        for batch in batches:
            out = []
            for *key, ids in zip(*(batch[c].to_pylist() for c in (*NODE, "ids")), strict=True):
                if key == node:
                    running.update(b"," + ids.encode())
                else:
                    out += [made()] if node else []
                    node, running = key, hashlib.sha256(ids.encode())
            yield from out
        if node:
            yield made()

    rows = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    return map_batches(rows, hashed, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, depth from 1 without gaps, bytes, digest) and ``convs`` (conv_id, n_turns), which also has
    conversations without turns. A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    conv_id is the least that starts with the node's turns; with depth it names the node. Sums are over the subtree, its
    top included. Without conversations there is no root and no row. Digests have 128 bits; equal ones count as equal.
    """
    keyed = turns.select(
        "conv_id", "depth", "bytes", *(F.xxhash64(F.lit(c), "depth", "digest").alias(f"own_{c}") for c in ("a", "b"))
    )
    keyed = cut(keyed, "trie-keyed")
    grown = {c: (F.bit_xor, _xor, F.col(f"own_{c}"), 0) for c in ("a", "b")}
    placed = _place(keyed, ["conv_id"], F.floor(F.col("depth") / BLOCK), [F.col("depth")], grown)
    own = {c: F.col(c).bitwiseXOR(F.col(f"own_{c}")).alias(f"up_{c}") for c in ("a", "b")}
    members = placed.select("conv_id", "depth", "bytes", "a", "b", *own.values())
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("bytes", "a", "b", "up_a", "up_b")))
    members = cut(members.select(root.columns[0], F.col("depth").cast("long").alias("depth"), "bytes", "a", "b", "up_a", "up_b").unionByName(root), "trie-members")

    nodes = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("up_a").alias("up_a"),
        F.min("up_b").alias("up_b"), F.min("bytes").alias("bytes")
    )
    parent = F.when(F.col("depth") > 0, F.col("depth") - 1)
    nodes = cut(
        nodes.select(
            *NODE, "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), parent.alias("up_depth"), "up_a", "up_b"
        ),
        "trie-nodes"
    )
    n = nodes.count()
    up = ["up_depth", "up_a", "up_b"]
    named = lambda df, *more: df.select(*(F.col(c).alias(u) for c, u in zip(NODE, up, strict=True)), *more)
    counts = cut(nodes.where("up_depth is not null").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    children = counts.select(*(F.col(u).alias(c) for c, u in zip(NODE, up, strict=True)), "n_children")
    state = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    state = state.select(
        *NODE, "conv_id", "n_convs", "n_children", *up, (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens")
    )
    state = cut(state.withColumn("parent_conv_id", F.lit(None).cast("long")), "trie-state")
    first = True
    while True:
        # sums of all that is less than 2**k below go to the node 2**k above
        live = state.where("up_depth is not null")
        handed = live.groupBy(*up).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"), F.count(F.lit(1)).alias("n_children")
        )
        handed = cut(handed, "trie-handed")
        if handed.isEmpty():
            break
        targets = named(state, F.col("conv_id").alias("_conv"), *(F.col(u).alias(f"next_{u}") for u in up))
        jumped = _jump(live, up, targets, handed.select(*up, "n_children"), n).select(
            *NODE, *(c for c in state.columns if c not in (*NODE, *up, "parent_conv_id")),
            *(F.col(f"next_{u}").alias(u) for u in up), F.col("_conv" if first else "parent_conv_id").alias("parent_conv_id")
        )
        state = jumped.unionByName(state.where("up_depth is null"))
        below = handed.select(*(F.col(u).alias(c) for c, u in zip(NODE, up, strict=True)), "more_leaves", "more_saved")
        state = state.join(below, NODE, "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0)),
        })
        state, first = cut(state.drop("more_leaves", "more_saved"), "trie-state"), False

    ends = members.join(convs, "conv_id").where("depth = n_turns").select(*NODE, "conv_id")
    ends = cut(_joined_ids(ends), "trie-ends")
    return state.join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")
    )


def conversation_trie(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """The trie (see :func:`prefix_trie`) of the conversations that :func:`rebuilt` makes of ``turns`` (conv_id, turn, role,
    text).

    Turns are ordered by turn, null first; those of one turn by a digest of role and text. A null role or text is empty;
    rows with a null conv_id belong to no conversation and are left out; repeated rows are turns of their own; texts of any
    length; other columns are not read; an empty table gives no rows. Only the rows of one turn number, and of a block of
    turns, meet in one task, never a whole conversation."""
    long, convs = rebuilt(turns, group, most)
    return prefix_trie(cut(long, "trie-rebuilt"), convs)
