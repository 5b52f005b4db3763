"""Sharding by longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import boxed, shared_table

#: Groups of at least 1/GRAIN of all bytes are scheduled one by one: at most GRAIN of them.
#: Smaller ones go, whole, into GRAIN bundles by a hash of their text, and bundles are scheduled.
GRAIN = 8192
#: Slots are counted in this many blocks of a shard, so that no task numbers a whole shard.
SLOT_BLOCKS = 1024


def longest_first(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of each (size, name): largest first, ties by name, to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard(docs: DataFrame, *, shards: int = 8, grain: int = GRAIN, group: Column | None = None, size: Column | None = None) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``shard`` and ``slot``.

    ``group`` (default: the text, null as empty) names what must stay together, ``size``
    (default: UTF-8 bytes of the text plus 1) what is balanced.  What the driver schedules is
    bounded: at most 2 x ``grain`` items, each a group with at least 1/``grain`` of all bytes or
    a bundle of smaller ones.  A group larger than a shard's share makes that shard larger.
    ``slot`` numbers a shard's rows from 0 without gaps.  Repeated rows each get their own slot.
    Columns of ``docs`` with the names of the result are replaced; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    made = ["size", "shard", "slot"]
    named = F.sha2((text if group is None else group).cast("string"), 256).alias("_group")
    bytes_ = (F.octet_length(text) + 1).cast("long") if size is None else size.cast("long")
    rows = boxed(docs, "doc_id", named, bytes_.alias("size"), without=made)
    bundle = F.pmod(F.xxhash64("_group"), F.lit(grain)).cast("string")
    rows = rows.withColumn("_bundle", bundle)
    groups = shared_table(rows.groupBy("_group", "_bundle").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    large = F.col("bytes") * grain >= total
    # At most `grain` groups reach that share, and there are `grain` bundles.
    items = [(r["bytes"], "g" + r["_group"]) for r in groups.where(large).select("_group", "bytes").collect()]
    small = groups.where(~large).groupBy("_bundle").agg(F.sum("bytes").alias("bytes"))
    items += [(r["bytes"], "b" + r["_bundle"]) for r in small.collect()]
    plan = longest_first(items, shards)
    alone = spark.createDataFrame([(k[1:], v) for k, v in plan.items() if k[0] == "g"], "_group string, _own int")
    bundles = spark.createDataFrame([(k[1:], v) for k, v in plan.items() if k[0] == "b"], "_bundle string, _with int")
    placed = (
        rows.join(F.broadcast(alone), "_group", "left")
        .join(F.broadcast(bundles), "_bundle", "left")
        .withColumn("shard", F.coalesce("_own", "_with"))
        .drop("_own", "_with", "_bundle")
    )
    return with_slots(placed, by=["doc_id", "_group"]).select("box.*", *made)


def with_slots(placed: DataFrame, blocks: int = SLOT_BLOCKS, *, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Number the rows of each ``shard`` from 0: rows before the block, then rows before it inside.

    Blocks and the order inside go by the columns ``by``; rows equal in them take their slots in any order.
    """
    block = F.pmod(F.xxhash64(*by), F.lit(blocks)).cast("int")
    blocked = placed.withColumn("_block", block)
    counts = blocked.groupBy("shard", "_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard and block: bounded by shards x blocks.
    starts = counts.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "_block").orderBy(*by)
    return (
        blocked.withColumn("_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["shard", "_block"])
        .withColumn("slot", (F.col("_start") + F.col("_in")).cast("long"))
        .drop("_block", "_start", "_in")
    )
