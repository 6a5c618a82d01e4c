"""Chat formatting by multi-party perspective rotation, in DataFrame operations only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as
named users; the mask covers what the assistant says, its end mark included. A conversation may be of any length, so it
is never put together in one row: each message is a row with its place, its offset in the rendered dialogue and its mask
in characters of the dialogue. Joining ``rendered`` in the order of ``seq`` gives the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Roles that speak in every perspective as themselves and have none of their own.
NARRATORS = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Name of a speaker whose role is null.
NOBODY = "unknown"
#: Turns a block: offsets are summed over blocks first, then within a block.
BLOCK = 1024


def _sum_before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long")


def rotate_perspectives(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS, block: int = BLOCK) -> DataFrame:
    """From (conv_id, turn, role, text): conv_id, perspective, seq, turn, role, name, rendered, start, mask_start,
    mask_end, all for each participant and message. mask_start = mask_end where nothing is trained on.

    Messages are ordered by turn, role and text, nulls first; repeated rows are messages of their own. A null text is
    empty; a null role speaks as the user ``unknown`` and has no perspective; a conversation of narrators only has
    none and gives no rows, as an empty table does; null conv_id is a conversation like others. Other columns are not
    read.

    A conversation is cut into blocks of turns. Offsets are summed from lengths alone: over the blocks first, which are
    few rows, then within a block; so each text is shuffled once, with its block, before it is rendered for the
    perspectives, and no task has to hold a whole conversation (rows of one turn number stay in a task).
    """
    conv = F.concat_ws(":", F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    number = F.floor(F.col("turn") / block)
    rows = turns.select(
        "conv_id", "turn", F.col("role").alias("_role"), F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("_no_text"),
        conv.alias("_conv"), number.alias("_block"), F.concat_ws(":", F.coalesce(number.cast("string"), F.lit("")), conv).alias("_at"),
    )
    narrated = F.coalesce(F.col("_role").isin(*narrators), F.lit(False))
    name = F.coalesce("_role", F.lit(NOBODY))
    others = F.concat(F.lit(OPEN), F.when(narrated, F.col("_role")).otherwise(F.concat(F.lit("user name="), name)), F.lit("\n"))
    mine = F.lit(f"{OPEN}assistant\n")
    body = F.length("text") + F.length(F.lit(CLOSE))

    # lengths by block and role; a perspective's block is as long as for others, but for what its own messages differ by
    by_role = rows.groupBy("_conv", "_at", "_block", "_role").agg(
        F.sum(F.length(others) + body).alias("_others"), F.sum(F.length(mine) + body).alias("_mine"),
        F.count(F.lit(1)).alias("_rows")
    )
    by_role = cut(by_role, "chat-lengths")
    cast = by_role.where(
        F.col("_role").isNotNull() & ~F.col("_role").isin(*narrators)
    ).select("_conv", F.col("_role").alias("perspective")).distinct()
    blocks = by_role.groupBy("_conv", "_at", "_block").agg(
        F.sum("_others").alias("_length"), F.sum("_rows").alias("_rows")
    ).join(cast, "_conv")
    own = by_role.select("_at", F.col("_role").alias("perspective"), (F.col("_mine") - F.col("_others")).alias("_more"))
    blocks = blocks.join(own, ["_at", "perspective"], "left").withColumn("_length", F.col("_length") + F.coalesce("_more", F.lit(0)))
    over = W.partitionBy("_conv", "perspective").orderBy(F.col("_block").asc_nulls_first())
    blocks = blocks.select(
        "_at", "perspective", _sum_before(F.col("_length"), over).alias("_from"),
        _sum_before(F.col("_rows"), over).alias("_before")
    )

    # a broadcast would shuffle the rendered rows instead of the messages
    said = rows.join(blocks.hint("merge"), "_at")
    is_own = F.coalesce(F.col("_role") == F.col("perspective"), F.lit(False))
    head = F.when(is_own, mine).otherwise(others)
    said = said.withColumns({"_own": is_own, "_head": F.length(head), "rendered": F.concat(head, "text", F.lit(CLOSE))})
    inside = W.partitionBy("_at", "perspective").orderBy(
        *(F.col(c).asc_nulls_first() for c in ("turn", "_role")), F.col("_no_text").desc(), "text"
    )
    length = F.length("rendered")
    placed = said.withColumns(
        {"start": F.col("_from") + _sum_before(length, inside), "seq": F.col("_before") + _sum_before(F.lit(1), inside)}
    )
    end = F.col("start") + length - 1  # the line end after the end mark is not trained on
    return placed.select(
        "conv_id", "perspective", "seq", "turn", F.when(F.col("_own"), "assistant").when(narrated, F.col("_role")).otherwise("user").alias("role"),
        F.when(~F.col("_own") & ~narrated, name).alias("name"), "rendered", "start",
        F.when(
            F.col("_own"), F.col("start") + F.col("_head")
        ).otherwise(F.col("start")).alias("mask_start"), F.when(F.col("_own"), end).otherwise(F.col("start")).alias("mask_end"),
    )


def training_texts(messages: DataFrame) -> DataFrame:
    """Whole dialogues with their masks, for conversations known to fit into a row: (conv_id, perspective, text,
    masks). Use it after a filter on the number or length of messages."""
    one = F.sort_array(F.collect_list(F.struct("seq", "rendered", "mask_start", "mask_end")))
    grouped = messages.groupBy("conv_id", "perspective").agg(one.alias("m"))
    masks = F.filter(
        F.transform("m", lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end"))),
        lambda x: x["end"] > x["start"]
    )
    return grouped.select("conv_id", "perspective", F.array_join("m.rendered", "").alias("text"), masks.alias("masks"))
