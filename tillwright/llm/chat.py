"""Collapse cumulative snapshots of logged conversations, then render the maximal ones.

A log that stores a conversation after every turn holds each prefix as a conversation of its own. Every turn
gets a hash of its place and content, and the running sums of two such hashes name the first n turns. A conversation
is a snapshot if the sums of all its turns are those of a shorter stretch of another; an anti-join drops it.

Turns stay rows until a kept conversation is rendered. They are put in order once, by ranges, and a conversation
that spans many ranges is numbered and summed range by range: each range on its own, then their totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Fixed strings of the rendered form.
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"
#: Characters of a role and text that tell ranges apart; rows that agree in them share a range.
RANGE_KEY = 64
#: Bits of a row's number within its range, as `monotonically_increasing_id` has them.
ROW_BITS = 33


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Distinct (conv_id, turn, role, text) with `_id`, which follows their order, and the `_sha` of role and text.

    Written, as the numbers must not change. Ranges are cut by conversation, turn, and the beginnings of role and text, so
    that neither a conversation nor a turn number with many texts must fit one task.
    """
    # Lengths before the strings keep different turns from reading alike.
    def part(name):
        value = F.col(name)
        return F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        )

    said = common.pick(turns, "conv_id", "turn", "role", "text").distinct()
    begins = [F.substring(F.col(name).cast("string"), 1, RANGE_KEY) for name in ("role", "text")]
    ranged = said.repartitionByRange("conv_id", "turn", *begins).sortWithinPartitions("conv_id", "turn", "role", "text")
    return common.written(
        ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn(
            "_sha", F.sha2(F.concat(part("role"), part("text")), 256)
        ),
        "turns",
    )


def prefix_sums(ordered: DataFrame) -> DataFrame:
    """(conv, place, n_turns, one, two) for every turn: its place from 1 and the sums of all turns up to it.

    conv is a struct of conv_id, so that null equals null. Windows cover a conversation's rows of one range, or a
    conversation's ranges.
    """
    rows = ordered.select(
        F.struct("conv_id").alias("conv"), F.shiftright("_id", ROW_BITS).alias("block"), "_id", "_sha"
    )
    by_block = Window.partitionBy("conv").orderBy("block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv", "block").agg(F.min("_id").alias("first"), F.count("*").alias("n")).select(
        "conv", "block", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("conv")).alias("n_turns"),
    )
    own = Window.partitionBy("conv", "block").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.join(spans, ["conv", "block"]).withColumn("place", F.col("offset") + F.col("_id") - F.col("first") + 1)
    hashes = (F.xxhash64("place", "_sha"), F.xxhash64(F.lit("second"), "place", "_sha"))
    inside = common.written(placed.select(
        "conv", "block", "place", "n_turns",
        *[F.sum(h.cast("decimal(20,0)")).over(own).alias(name) for name, h in zip(("one", "two"), hashes)],
    ), "prefixes")
    # A range's last sums are its totals.
    carried = inside.groupBy("conv", "block").agg(
        *[F.max_by(name, "place").alias(f"all_{name}") for name in ("one", "two")]
    ).select("conv", "block", *[
        F.coalesce(F.sum(f"all_{name}").over(before), F.lit(0)).alias(f"before_{name}") for name in ("one", "two")
    ])
    return inside.join(carried, ["conv", "block"]).select(
        "conv", "place", "n_turns",
        *[(F.col(name) + F.col(f"before_{name}")).cast("decimal(38,0)").alias(name) for name in ("one", "two")],
    )


def kept_conversations(sums: DataFrame) -> DataFrame:
    """(conv, n_turns, snapshots) of the conversations that are no proper prefix of another, one of equal ones."""
    prefixes = sums.where("place < n_turns").select(F.col("place").alias("n_turns"), "one", "two").distinct()
    return (
        sums.where("place = n_turns")
        .groupBy("n_turns", "one", "two")
        # Null loses against any other id, as in min(conv_id).
        .agg(F.struct(F.min("conv.conv_id").alias("conv_id")).alias("conv"), F.count(F.lit(1)).alias("snapshots"))
        .join(prefixes, ["n_turns", "one", "two"], "left_anti")
        .select("conv", "n_turns", "snapshots")
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns and snapshots (equal conversations, itself included) of those to keep.

    Kept are conversations that are no proper prefix of another one; of equal ones the smallest
    conv_id stays (null ids lose against others). Turns are ordered by turn, then role and text;
    turn numbers themselves are not compared. Rows repeated in every column count once. A null role
    or text is a value of its own, unlike the empty string. Rows with a null conv_id are one
    conversation. An empty table gives an empty result. Other columns are ignored. Only the turns of a kept
    conversation meet in one row, which is the result's.
    """
    ordered = ordered_turns(turns)
    kept = common.written(kept_conversations(prefix_sums(ordered)), "kept")
    said = F.struct("_id", "turn", "role", "text")
    return (
        ordered.withColumn("conv", F.struct("conv_id"))
        .join(kept, "conv")
        .groupBy("conv", "n_turns", "snapshots")
        .agg(F.sort_array(F.collect_list(said)).alias("turns"))
        .select("conv.conv_id", "n_turns", F.transform("turns", lambda t: t.dropFields("_id")).alias("turns"), "snapshots")
    )


def render(kept: DataFrame) -> DataFrame:
    """conv_id, n_turns, snapshots, rendered: all turns in the chat template; null parts render empty."""
    before, between, after = TURN.replace("{role}", "\x00").replace("{text}", "\x00").split("\x00")
    empty = F.lit("")
    one = lambda t: F.concat(
        F.lit(before), F.coalesce(t["role"], empty), F.lit(between), F.coalesce(t["text"], empty), F.lit(after)
    )
    return kept.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), "snapshots",
        F.array_join(F.transform("turns", one), "").alias("rendered"),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """Snapshots collapsed, the rest rendered: one row per maximal conversation."""
    return render(maximal_conversations(turns))
