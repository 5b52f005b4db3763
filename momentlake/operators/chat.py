"""Chat activity: tumbling windows, totals, spikes and emote rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def emote_uses(messages: DataFrame) -> DataFrame:
    """One row per emote use, with the position of the use inside the message."""
    return messages.select("vod_id", "pos", "t", F.posexplode("emotes").alias("emote_idx", "emote"))


def activity_windows(messages: DataFrame, window_seconds: int = 30) -> DataFrame:
    """Messages, distinct users and the most used emote per window.

    Empty windows are left out, and so is a window that starts at the time of
    the last message or later (the scan stops there).  Equal emote counts go to
    the emote seen first.
    """
    window_start = F.floor(F.col("t") / window_seconds) * window_seconds
    base = (
        messages.groupBy("vod_id", window_start.alias("window_start"))
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.countDistinct("usr").alias("unique_users"),
            F.max("t").alias("_last_t"),
        )
        .withColumn("_vod_last_t", F.max("_last_t").over(Window.partitionBy("vod_id")))
        .where(F.col("window_start") < F.col("_vod_last_t"))
        .drop("_last_t", "_vod_last_t")
    )
    peaks = (
        emote_uses(messages)
        .groupBy("vod_id", window_start.alias("window_start"), "emote")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "emote_idx")).alias("first_use"))
        .groupBy("vod_id", "window_start")
        .agg(F.min_by(F.struct("emote", "n"), F.struct(-F.col("n"), F.col("first_use"))).alias("peak"))
    )
    return base.join(peaks, ["vod_id", "window_start"], "left").select(
        "vod_id",
        "window_start",
        (F.col("window_start") + window_seconds).alias("window_end"),
        "message_count",
        "unique_users",
        F.col("peak.emote").alias("peak_emote"),
        F.coalesce("peak.n", F.lit(0)).alias("peak_emote_count"),
    )


def totals(messages: DataFrame, videos: DataFrame | None = None) -> DataFrame:
    """Messages, distinct chatters and emote uses per video; zeros for videos
    of ``videos`` without chat."""
    counted = messages.groupBy("vod_id").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.countDistinct("usr").alias("unique_chatters"),
        F.sum(F.coalesce(F.size("emotes"), F.lit(0)).cast("bigint")).alias("total_emotes"),
    )
    if videos is None:
        return counted
    return (
        videos.select("vod_id").distinct().join(counted, "vod_id", "left")
        .fillna(0, ["total_messages", "unique_chatters", "total_emotes"])
    )


def spikes(messages: DataFrame, bin_seconds: int = 10, z_threshold: float = 2.0) -> DataFrame:
    """Bins whose message count lies more than ``z_threshold`` population
    standard deviations above the mean of all bins, silent ones included.

    Silent bins enter through the number of bins only, so no spine of empty
    rows is built: with n bins, sum S and sum of squares Q the z-score of a
    count c is ``(c*n - S) / sqrt(n*Q - S*S)``.  Sums and products are decimal,
    exact to 38 digits, as they leave 64 bits on very busy videos.
    """
    bins = messages.groupBy("vod_id", F.floor(F.col("t") / bin_seconds).alias("bin")).agg(
        F.count(F.lit(1)).alias("message_count")
    )
    return bin_spikes(bins, bin_seconds, z_threshold)


def bin_spikes(bins: DataFrame, bin_seconds: int = 10, z_threshold: float = 2.0) -> DataFrame:
    """:func:`spikes` from counted bins (vod_id, bin, message_count)."""
    wide = lambda x: x.cast("decimal(38,0)")
    c = F.col("message_count").cast("decimal(19,0)")
    stats = bins.groupBy("vod_id").agg(
        wide(F.max("bin") + 1).alias("n"), wide(F.sum(c)).alias("s"), wide(F.sum(c * c)).alias("q")
    )
    spread = wide(F.col("n") * F.col("q")) - wide(F.col("s") * F.col("s"))
    intensity = (wide(c * F.col("n")) - F.col("s")).cast("double") / F.sqrt(spread.cast("double"))
    return (
        bins.join(stats.where(spread > 0), "vod_id")
        .withColumn("intensity", intensity)
        .where(F.col("intensity") > z_threshold)
        .select(
            "vod_id",
            (F.col("bin") * bin_seconds).alias("start_s"),
            ((F.col("bin") + 1) * bin_seconds).alias("end_s"),
            "intensity",
            "message_count",
        )
    )


def top_emotes(messages: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most used emotes per video; equal counts keep first-seen order."""
    counts = (
        emote_uses(messages)
        .groupBy("vod_id", "emote")
        .agg(F.count(F.lit(1)).alias("uses"), F.min(F.struct("pos", "emote_idx")).alias("first_use"))
    )
    rank = F.row_number().over(Window.partitionBy("vod_id").orderBy(F.desc("uses"), "first_use"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k).select("vod_id", "rank", "emote", "uses")


def emotes_around(
    points: DataFrame, messages: DataFrame, *, radius_seconds: int = 15, k: int = 5
) -> DataFrame:
    """Up to ``k`` most used emotes within ``radius_seconds`` of each distinct
    point ``(vod_id, t)``; ties keep first-seen order.  Uses are first counted
    per second, so a burst of messages is one row per emote.

    A span of time is as long as a block of time, so it is the end of one block and the beginning of the
    next.  Both are running totals over a block, and a point costs two rows per emote of its blocks
    however many seconds lie around it.
    """
    width = 2 * radius_seconds
    cell = ["vod_id", "_block", "_ends", "emote"]
    per_second = (
        emote_uses(messages)
        .groupBy("vod_id", "t", "emote")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "emote_idx")).alias("first_use"))
    )
    sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("_ends")
    uses = per_second.select("vod_id", F.floor(F.col("t") / width).alias("_block"), "t", "emote", "n", "first_use", sides)
    first = F.floor((F.col("t") - radius_seconds) / width)
    end = lambda block, at, ends: F.struct(block.alias("_block"), at.alias("t"), F.lit(ends).alias("_ends"))
    ends = F.array(end(first, F.col("t") - radius_seconds, True), end(first + 1, F.col("t") + radius_seconds, False))
    asked = (
        points.select("vod_id", "t").distinct()
        .select("vod_id", F.col("t").alias("point_t"), F.inline(ends))
        .join(uses.select("vod_id", "_block", "emote").distinct(), ["vod_id", "_block"])
    )
    # Of equal times the points come last, so they meet what is at them too.
    at = F.when(F.col("_ends"), -F.col("t")).otherwise(F.col("t"))
    upto = Window.partitionBy(*cell).orderBy(at, F.col("n").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        uses.unionByName(asked, allowMissingColumns=True)
        .select("vod_id", "point_t", "emote", F.sum("n").over(upto).alias("n"), F.min("first_use").over(upto).alias("first_use"))
        .where(F.col("point_t").isNotNull() & F.col("n").isNotNull())
    )
    counts = totals.groupBy("vod_id", "point_t", "emote").agg(F.sum("n").alias("uses"), F.min("first_use").alias("first_use"))
    rank = F.row_number().over(Window.partitionBy("vod_id", "point_t").orderBy(F.desc("uses"), "first_use"))
    return (
        counts.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("vod_id", F.col("point_t").alias("t"), "rank", "emote", "uses")
    )
