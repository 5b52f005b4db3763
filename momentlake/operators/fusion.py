"""Fusing transcript, chat and scenes into a timeline and into ranked moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import salted_lookup
from . import chat as chat_ops
from .intervals import last_marked, overlap_join, point_join, running_max_before

EXCITEMENT_THRESHOLD = 25


def excitement(text: Column) -> Column:
    """Points for shouting (+20), a tripled mark (+15) and short lines (+10)."""
    shouting = (F.upper(text) == text) & (F.lower(text) != text) & (F.length(text) > 5)
    tripled = text.contains("!!!") | text.contains("???") | text.contains("...")
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return (
        F.when(shouting, 20).otherwise(0) + F.when(tripled, 15).otherwise(0) + F.when(words < 5, 10).otherwise(0)
    )


def excited_lines(segments: DataFrame, threshold: int = EXCITEMENT_THRESHOLD) -> DataFrame:
    """Transcript lines whose excitement is above ``threshold``, scored 50 + points (at most 100)."""
    return (
        segments.withColumn("excitement", excitement(F.col("text")))
        .where(F.col("excitement") > threshold)
        .withColumn("score", F.least(F.lit(100), 50 + F.col("excitement")).cast("double"))
    )


def moment_signals(spikes: DataFrame, lines: DataFrame) -> DataFrame:
    """Union of chat spikes and excited lines as scored moments.

    ``src`` keeps the order of the two inputs (spikes first).
    """
    from_chat = spikes.select(
        "vod_id",
        F.lit(0).alias("src"),
        F.col("start_s").alias("pos"),
        "start_s",
        "end_s",
        F.least(F.lit(100.0), F.col("intensity") * 20).alias("score"),
        F.lit("chat_spike").alias("signal"),
        "message_count",
    )
    from_voice = excited_lines(lines).select(
        "vod_id",
        F.lit(1).alias("src"),
        "pos",
        "start_s",
        "end_s",
        "score",
        F.lit("voice_excitement").alias("signal"),
        "text",
    )
    return from_chat.unionByName(from_voice, allowMissingColumns=True)


def merge_moments(moments: DataFrame, gap_seconds: int = 5) -> DataFrame:
    """Merges moments that start less than ``gap_seconds`` after the end of what
    came before; keeps the largest end and score, all signals, and the text and
    message count of the first member.

    Islands are found on the grid of distinct start times (moments with equal
    starts always share an island), then attached to the rows, so the scan size
    follows the length of a video and not its number of moments.
    """
    grid = moments.groupBy("vod_id", "start_s").agg(F.max("end_s").alias("_end"))
    before = running_max_before(grid, order=["start_s"], value="_end", out="_end_before")
    opens = F.col("_end_before").isNull() | (F.col("start_s") >= F.col("_end_before") + gap_seconds)
    islands = last_marked(before, order="start_s", value=F.when(opens, F.col("start_s")), out="island_start")
    tagged = salted_lookup(
        moments,
        islands.select("vod_id", "start_s", "island_start"),
        ["vod_id", "start_s"],
        spread_by=["src", "pos"],
    )
    first = F.struct("start_s", "src", "pos")
    return tagged.groupBy("vod_id", "island_start").agg(
        F.max("end_s").alias("end_s"),
        F.max("score").alias("score"),
        F.array_sort(F.collect_set("signal")).alias("signals"),
        F.min_by(F.struct("text", "message_count"), first).alias("_first"),
        F.count(F.lit(1)).alias("members"),
    ).select(
        "vod_id",
        F.col("island_start").alias("start_s"),
        "end_s",
        "score",
        "signals",
        F.col("_first.text").alias("text"),
        F.col("_first.message_count").alias("message_count"),
        "members",
    )


def rank_moments(moments: DataFrame) -> DataFrame:
    """Rank by score, then start.  Merged moments do not overlap, so a video has
    at most its length divided by the merge gap of them."""
    order = Window.partitionBy("vod_id").orderBy(F.desc("score"), "start_s")
    return moments.withColumn("rank", F.row_number().over(order))


def timeline(
    segments: DataFrame,
    messages: DataFrame,
    scenes: DataFrame,
    *,
    window_seconds: int = 30,
    scene_tolerance: int = 2,
    emote_radius: int = 15,
) -> DataFrame:
    """One timeline row per transcript line: chat intensity of the activity
    window around its start, the first scene that starts within
    ``scene_tolerance`` seconds, and the top emotes nearby.

    Everything is looked up once per distinct start time and attached to the
    lines afterwards.
    """
    points = segments.select("vod_id", F.col("start_s").alias("t")).distinct()
    activity = chat_ops.activity_windows(messages, window_seconds)
    intensity = F.least(F.lit(10.0), F.col("message_count") / F.greatest(F.lit(1.0), F.lit(float(window_seconds))))
    in_window = (
        points.withColumn("window_start", F.floor(F.col("t") / window_seconds) * window_seconds)
        .join(activity.select("vod_id", "window_start", "message_count"), ["vod_id", "window_start"])
        .select("vod_id", "t", intensity.alias("chat_intensity"))
    )
    near_scene = (
        point_join(
            points,
            scenes.select(
                "vod_id",
                "scene_index",
                (F.col("start_s") - scene_tolerance).alias("_lo"),
                (F.col("start_s") + scene_tolerance).alias("_hi"),
            ),
            bucket=600,
            at="t",
            span=("_lo", "_hi"),
        )
        .groupBy("vod_id", "t")
        .agg(F.min("scene_index").alias("scene_index"))
    )
    emotes = (
        chat_ops.emotes_around(points, messages, radius_seconds=emote_radius)
        .groupBy("vod_id", "t")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "emote"))).alias("_ranked"))
        .select("vod_id", "t", F.col("_ranked.emote").alias("top_emotes"))
    )
    facts = (
        points.join(in_window, ["vod_id", "t"], "left")
        .join(near_scene, ["vod_id", "t"], "left")
        .join(emotes, ["vod_id", "t"], "left")
    )
    return salted_lookup(
        segments.withColumn("t", F.col("start_s")), facts, ["vod_id", "t"], spread_by=["pos"]
    ).select(
        "vod_id",
        "pos",
        "t",
        "text",
        F.col("scene_index").isNotNull().alias("scene_change"),
        "scene_index",
        F.coalesce("chat_intensity", F.lit(0.0)).alias("chat_intensity"),
        F.coalesce("top_emotes", F.array().cast("array<string>")).alias("top_emotes"),
    )


def spike_intensity(segments: DataFrame, spikes: DataFrame) -> DataFrame:
    """Each line with the largest intensity of the chat spikes it overlaps (0 if none)."""
    spans = segments.select("vod_id", "start_s", "end_s").distinct()
    valid = spikes.where(F.col("end_s") > F.col("start_s")).select(
        "vod_id", F.col("start_s").alias("_ss"), F.col("end_s").alias("_se"), "intensity"
    )
    best = (
        overlap_join(spans, valid, bucket=300, left_span=("start_s", "end_s"), right_span=("_ss", "_se"))
        .groupBy("vod_id", "start_s", "end_s")
        .agg(F.max("intensity").alias("_best"))
    )
    return (
        salted_lookup(segments, best, ["vod_id", "start_s", "end_s"], spread_by=["pos"])
        .withColumn("chat_intensity", F.coalesce("_best", F.lit(0.0)))
        .drop("_best")
    )
