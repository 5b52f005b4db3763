"""Chat formatting: logged snapshots collapse into the conversations they are prefixes of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Turn numbers per block; a long conversation is worked on in blocks.
BLOCK_TURNS = 256
#: Turns in one rendered part at most.
PART_TURNS = 64


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-"))


def _turns(conversations: DataFrame) -> DataFrame:
    body = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    return conversations.select(
        "conv_id",
        _key().alias("conv"),
        F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))).cast("long").alias("block"),
        "turn",
        role.alias("role"),
        body.alias("text"),
        F.md5(F.concat(F.md5(role), F.md5(body))).alias("said"),
    )


def _inside() -> Column:
    """The number of a turn in its block, from 1."""
    return F.row_number().over(Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "said"))


def _starts(turns: DataFrame) -> DataFrame:
    """Per conversation and block: turns before it, and turns in all."""
    counts = turns.groupBy("conv", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "conv",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("conv")).alias("total"),
    )


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """Per turn: conv, length (turns so far), total, and two 64-bit hashes of the prefix that ends here.

    A turn's hash covers its position, role and text; a prefix's is the exclusive or of its turns',
    so it rolls from turn to turn and blocks of one conversation combine.
    """
    turns = _turns(conversations).select("conv", "block", "turn", "said")
    placed = turns.withColumn("inside", _inside()).join(_starts(turns), ["conv", "block"])
    placed = placed.withColumn("length", F.col("start") + F.col("inside"))
    for name, seed in (("a", 1), ("b", 2)):
        placed = placed.withColumn(name, F.xxhash64(F.lit(seed), "length", "said"))
    so_far = Window.partitionBy("conv", "block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.groupBy("conv", "block").agg(F.bit_xor("a").alias("wa"), F.bit_xor("b").alias("wb"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = whole.select(
        "conv",
        "block",
        F.coalesce(F.bit_xor("wa").over(before), F.lit(0)).alias("ea"),
        F.coalesce(F.bit_xor("wb").over(before), F.lit(0)).alias("eb"),
    )
    rolled = placed.withColumn("ra", F.bit_xor("a").over(so_far)).withColumn("rb", F.bit_xor("b").over(so_far))
    return rolled.join(earlier, ["conv", "block"]).select(
        "conv",
        "length",
        "total",
        F.col("ra").bitwiseXOR(F.col("ea")).alias("prefix_a"),
        F.col("rb").bitwiseXOR(F.col("eb")).alias("prefix_b"),
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv: the conversations that are no proper prefix of another; of equal ones the smallest id.

    Both sides of the anti-join hold one row per distinct prefix, combined before the shuffle, so
    a first turn that a third of all conversations share is one key with one row.
    """
    prefixes = prefix_hashes(conversations)
    same = ["length", "prefix_a", "prefix_b"]
    whole = prefixes.where("length = total").groupBy(*same).agg(F.min("conv").alias("conv"))
    proper = prefixes.where("length < total").select(*same).distinct()
    return whole.join(proper, same, "left_anti").select("conv")


def rendered(conversations: DataFrame, *, template: str = "<|{role}|>\n{text}<|end|>\n", part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, first_turn, n_turns, rendered: the maximal conversations as text, in parts.

    Turns stand in the order of ``turn`` (null first), equal ones by a hash of what is said, and
    are numbered from 0; repeated rows are repeated turns; null roles and texts count as empty; a
    null ``conv_id`` is a conversation.  Equal conversations leave the smallest key (ids compare
    as text).  Other columns are not read; an empty table gives an empty result.
    """
    turns = _turns(conversations)
    starts = _starts(turns).join(maximal_conversations(conversations), "conv", "left_semi")
    head, _, tail = template.partition("{role}")
    middle, _, end = tail.partition("{text}")
    line = F.concat(F.lit(head), F.col("role"), F.lit(middle), F.col("text"), F.lit(end))
    placed = (
        turns.withColumn("inside", _inside())
        .join(starts, ["conv", "block"])
        .withColumn("at", F.col("start") + F.col("inside") - 1)
        .withColumn("part", F.floor(F.col("at") / part_turns))
        .select("conv", "block", "part", "conv_id", "at", line.alias("line"))
    )
    parts = placed.groupBy("conv", "block", "part").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines")
    )
    return parts.select(
        "conv_id",
        F.col("lines")[0]["at"].alias("first_turn"),
        F.size("lines").cast("long").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("rendered"),
    )
