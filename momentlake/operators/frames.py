"""Choosing still frames for windows and clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import surrounding_times

FRAME_SECONDS = 5


def frame_time(path: Column, seconds_per_frame: int = FRAME_SECONDS) -> Column:
    """Time of ``.../frame_000012.jpg``; NULL for other names."""
    return F.regexp_extract(path, r"(?:^|/)frame_(\d+)\.[^./]+$", 1).try_cast("bigint") * seconds_per_frame


def nearest_frames(windows: DataFrame, frames: DataFrame, per_window: int = 2) -> DataFrame:
    """Up to ``per_window`` frames per window: those nearest to its start, middle
    and end, filled up with the earliest frames of the video.

    ``windows``: vod_id, window_id, start_s, end_s.  ``frames``: vod_id, t, path.
    The nearest frame is one of the two times around a target; of equal
    distances the earlier one wins.
    """
    per_window = max(1, int(per_window))
    start = F.col("start_s")
    end = F.when(F.col("end_s") > start, F.col("end_s")).otherwise(start + 1)
    middle = start + F.greatest(F.lit(1), F.floor((end - start) / 2))
    targets = {1: [middle], 2: [start, middle]}.get(per_window, [start, middle, end])
    wanted = windows.select("vod_id", "window_id", F.posexplode(F.array(*targets)).alias("turn", "t"))
    around = surrounding_times(wanted, frames)
    nearer = F.when(
        F.col("next_mark").isNull() | (F.col("t") - F.col("prev_mark") <= F.col("next_mark") - F.col("t")),
        F.col("prev_mark"),
    ).otherwise(F.col("next_mark"))
    first_path = frames.groupBy("vod_id", F.col("t").alias("frame_t")).agg(F.min("path").alias("path"))
    picked = (
        wanted.join(around, ["vod_id", "t"])
        .withColumn("frame_t", nearer)
        .join(first_path, ["vod_id", "frame_t"])
        .groupBy("vod_id", "window_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "path"))).alias("_p"))
        .select("vod_id", "window_id", F.array_distinct(F.col("_p.path")).alias("picked"))
    )
    rank = F.row_number().over(Window.partitionBy("vod_id").orderBy("t", "path"))
    earliest = (
        frames.withColumn("_r", rank)
        .where(F.col("_r") <= 2 * per_window)
        .groupBy("vod_id")
        .agg(F.array_sort(F.collect_list(F.struct("_r", "path"))).alias("_e"))
        .select("vod_id", F.col("_e.path").alias("earliest"))
    )
    chosen = F.slice(F.array_distinct(F.concat("picked", "earliest")), 1, per_window)
    return picked.join(earliest, "vod_id").select(
        "vod_id", "window_id", F.posexplode(chosen).alias("turn", "path")
    )


def sample_points(start: Column, end: Column, count: int, spread: int) -> Column:
    """Evenly spaced times inside a clip; short clips are stepped through from their first second."""
    length = end - start
    short = F.when(
        length > 1,
        F.sequence(start + 1, end - 1, F.greatest(F.lit(1).cast("bigint"), F.floor(length / count))),
    ).otherwise(F.array().cast("array<bigint>"))
    step = F.greatest(F.floor(length / (count + 1)), F.lit(max(2, spread)))
    long = F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: start + i * step)
    return F.when(length <= 15, short).otherwise(long)


def extra_sample_points(start: Column, end: Column, count: int) -> Column:
    step = F.greatest(F.lit(1), F.floor((end - start) / (count + 1)))
    return F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: start + i * step)


def existing_samples(clips: DataFrame, points: Column, frames: DataFrame, limit: int | None = None) -> DataFrame:
    """Sample times of each clip whose frame exists, in order, at most ``limit``.

    ``frames``: vod_id, frame_index.  A time maps to the nearest frame number,
    halves to even.
    """
    wanted = clips.select("vod_id", "clip_id", F.posexplode(points).alias("turn", "t")).withColumn(
        "frame_index", F.rint(F.col("t") / FRAME_SECONDS).cast("bigint")
    )
    there = wanted.join(frames.select("vod_id", "frame_index").distinct(), ["vod_id", "frame_index"], "left_semi")
    if limit is None:
        return there
    rank = F.row_number().over(Window.partitionBy("vod_id", "clip_id").orderBy("turn"))
    return there.withColumn("_r", rank).where(F.col("_r") <= limit).drop("_r")
