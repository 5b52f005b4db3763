"""Scored clip windows over whole videos."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clamp, round_half_even
from .intervals import coverage_windows, overlap_join, point_join
from .objects import compact_detections, label_tenths

_WINDOW = ["vod_id", "start_s", "end_s"]
_BUCKET = 600


def video_durations(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """Longest time any source knows of, per video: ``[(table, time column), ...]``."""
    times = [df.select("vod_id", F.col(c).cast("double").alias("_t")) for df, c in sources]
    return (
        reduce(DataFrame.unionAll, times)
        .groupBy("vod_id")
        .agg(F.greatest(F.lit(0.0), F.max("_t")).alias("duration_s"))
    )


def first_known_durations(videos: DataFrame, sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """The duration of the metadata if positive, else the longest time of ``sources``."""
    fallback = video_durations(sources).withColumnRenamed("duration_s", "_fallback")
    known = F.when(F.col("duration_s") > 0, F.col("duration_s").cast("double"))
    return (
        videos.select("vod_id", "duration_s")
        .join(fallback, "vod_id", "full")
        .select("vod_id", F.coalesce(known, "_fallback", F.lit(0.0)).alias("duration_s"))
    )


def speech_seconds(windows: DataFrame, segments: DataFrame) -> DataFrame:
    """Seconds of speech inside each window; lines that overlap each other count twice.

    Equal spans are counted first, and the windows join in as zero rows of the
    same aggregation, so no window is lost and nothing is joined back.
    """
    spans = (
        segments.where(F.col("end_s") > F.col("start_s"))
        .groupBy("vod_id", F.col("start_s").alias("_ss"), F.col("end_s").alias("_se"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    frame = windows.select(*_WINDOW).distinct()
    shared = F.least("end_s", "_se") - F.greatest("start_s", "_ss")
    pairs = overlap_join(
        frame, spans, bucket=_BUCKET, left_span=("start_s", "end_s"), right_span=("_ss", "_se")
    ).select(*_WINDOW, (shared * F.col("_n")).cast("double").alias("_sec"))
    zero = frame.select(*_WINDOW, F.lit(0.0).alias("_sec"))
    return pairs.unionAll(zero).groupBy(*_WINDOW).agg(F.sum("_sec").alias("speech_seconds"))


def speech_ratio(windows: DataFrame, segments: DataFrame) -> DataFrame:
    """Share of each window that is speech, 0..1.  Blank lines are not speech."""
    spoken = segments.where(F.length(F.trim(F.coalesce("text", F.lit("?")))) > 0)
    length = F.greatest(F.lit(0.001), F.col("end_s") - F.col("start_s"))
    return speech_seconds(windows, spoken).select(
        *_WINDOW, clamp(F.col("speech_seconds") / length, 0, 1).alias("speech_norm")
    )


def mean_intensity(windows: DataFrame, points: DataFrame) -> DataFrame:
    """Mean of ``value`` over the points in the closed window, 0 where there are none.

    A point on a shared edge counts in both windows.  Points are summed per
    time before the join.
    """
    per_time = points.groupBy("vod_id", "t").agg(F.sum("value").alias("_v"), F.count(F.lit(1)).alias("_n"))
    frame = windows.select(*_WINDOW).distinct()
    hits = point_join(per_time, frame, bucket=_BUCKET, at="t", span=("start_s", "end_s")).select(
        *_WINDOW, "_v", "_n"
    )
    zero = frame.select(*_WINDOW, F.lit(0.0).alias("_v"), F.lit(0).cast("bigint").alias("_n"))
    return (
        hits.unionAll(zero)
        .groupBy(*_WINDOW)
        .agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"))
        .select(*_WINDOW, F.when(F.col("_n") > 0, F.col("_v") / F.col("_n")).otherwise(0.0).alias("mean_value"))
    )


def chat_intensity(windows: DataFrame, timeline: DataFrame) -> DataFrame:
    """Mean chat intensity of the timeline points in each window, each clamped to 0..1.

    A point at exactly 0 s does not count (its time reads as missing).
    """
    points = timeline.where(F.col("t") > 0).select(
        "vod_id", "t", clamp(F.coalesce("chat_intensity", F.lit(0.0)), 0, 1).alias("value")
    )
    return mean_intensity(windows, points).withColumnRenamed("mean_value", "chat_norm")


def window_objects(windows: DataFrame, detections: DataFrame) -> DataFrame:
    """Distinct labels seen from ``int(start)`` to ``int(end)``, both seconds included,
    and those that the windows carry themselves (``labels``, optional)."""
    labels = compact_detections(detections)
    frame = (
        windows.select(*_WINDOW)
        .distinct()
        .withColumn("_from", F.floor("start_s"))
        .withColumn("_to", F.greatest(F.floor("start_s"), F.floor("end_s")))
    )
    seen = point_join(labels, frame, bucket=_BUCKET, at="second_s", span=("_from", "_to")).select(*_WINDOW, "label")
    if "labels" in windows.columns:
        seen = seen.unionAll(windows.select(*_WINDOW, F.explode("labels").alias("label")))
    return (
        seen.distinct()
        .groupBy(*_WINDOW)
        .agg(
            F.array_sort(F.collect_list("label")).alias("objects_detected"),
            F.sum(label_tenths(F.col("label"))).alias("useful_tenths"),
        )
    )


def window_label(score: Column, has_speech: Column, chat: Column, n_objects: Column) -> Column:
    return (
        F.when(score >= 8.0, "hype")
        .when(score >= 5.0, "highlight")
        .when(~has_speech & (chat < 0.15) & (n_objects == 0), "dead")
        .otherwise("context")
    )


def clip_manifest(
    windows: DataFrame,
    segments: DataFrame,
    timeline: DataFrame,
    detections: DataFrame,
    *,
    speech_hint: Column | None = None,
    chat_hint: Column | None = None,
) -> DataFrame:
    """Scores every window from speech, chat and useful objects.

    ``windows``: vod_id, window_index, start_s, end_s, optional title, summary,
    labels, speech_hint, chat_hint.  For videos without any transcript line (or
    timeline point) the hints, 0..1 columns of ``windows``, stand in for the
    measured signal.
    """
    if speech_hint is None and "speech_hint" in windows.columns:
        speech_hint = F.col("speech_hint")
    if chat_hint is None and "chat_hint" in windows.columns:
        chat_hint = F.col("chat_hint")
    lo, hi = F.least("start_s", "end_s"), F.greatest("start_s", "end_s")
    frame = windows.withColumn("_lo", lo).withColumn("end_s", hi).withColumn("start_s", F.col("_lo")).drop("_lo")
    no_hint = F.lit(0.0)
    frame = frame.withColumn("_speech_hint", no_hint if speech_hint is None else speech_hint).withColumn(
        "_chat_hint", no_hint if chat_hint is None else chat_hint
    )
    if "title" not in frame.columns:
        frame = frame.withColumn("title", F.lit(None).cast("string"))
    if "summary" not in frame.columns:
        frame = frame.withColumn("summary", F.lit(None).cast("string"))

    spoken = segments.where((F.col("end_s") > F.col("start_s")) & (F.length(F.trim("text")) > 0))
    has_lines = spoken.groupBy("vod_id").agg(F.lit(True).alias("_has_lines"))
    has_points = timeline.where(F.col("t") > 0).groupBy("vod_id").agg(F.lit(True).alias("_has_points"))
    joined = (
        frame.join(speech_ratio(frame, segments), _WINDOW, "left")
        .join(chat_intensity(frame, timeline), _WINDOW, "left")
        .join(window_objects(frame, detections), _WINDOW, "left")
        .join(has_lines, "vod_id", "left")
        .join(has_points, "vod_id", "left")
        .withColumn("objects_detected", F.coalesce("objects_detected", F.array().cast("array<string>")))
        .withColumn("_tenths", F.coalesce("useful_tenths", F.lit(0)))
        .withColumn("_speech", F.when(F.col("_has_lines"), F.col("speech_norm")).otherwise(F.col("_speech_hint")))
        .withColumn("_chat", F.when(F.col("_has_points"), F.col("chat_norm")).otherwise(F.col("_chat_hint")))
    )
    speech_bonus = clamp(F.col("_speech") * 3.0, 0, 3)
    chat_bonus = clamp(F.col("_chat") * 3.0, 0, 3)
    object_bonus = clamp(F.col("_tenths") / 10.0, 0, 2)
    empty = (F.col("_speech") <= 0) & (F.col("_chat") <= 0) & (F.col("_tenths") == 0)
    scored = (
        joined.withColumn("speech_bonus", speech_bonus)
        .withColumn("chat_bonus", chat_bonus)
        .withColumn("object_bonus", object_bonus)
        .withColumn("empty_penalty", F.when(empty, 2.0).otherwise(0.0))
        .withColumn(
            "raw_score",
            F.lit(1.0) + F.col("speech_bonus") + F.col("chat_bonus") + F.col("object_bonus") - F.col("empty_penalty"),
        )
        .withColumn("score", round_half_even(clamp("raw_score", 0, 10), 2))
        .withColumn("has_speech", F.col("_speech") > 0)
        .withColumn(
            "label",
            window_label(F.col("score"), F.col("has_speech"), F.col("_chat"), F.size("objects_detected")),
        )
    )
    made_title = F.concat(F.initcap("label"), F.lit(" clip "), (F.col("window_index") + 1).cast("string"))
    two = lambda c: F.format_string("%.2f", round_half_even(c, 2))
    made_summary = F.when(
        F.col("label") == "dead", "Low activity window with minimal speech, chat, or detectable objects."
    ).otherwise(
        F.concat(
            F.lit("Speech "), two("_speech"), F.lit(", chat "), two("_chat"), F.lit(", objects "),
            F.size("objects_detected").cast("string"), F.lit(" contribute to a "), F.col("label"), F.lit(" moment."),
        )
    )
    given = lambda c: F.when(F.length(F.trim(c)) > 0, F.col(c))
    return scored.select(
        "vod_id",
        "window_index",
        round_half_even("start_s", 3).alias("start_s"),
        round_half_even("end_s", 3).alias("end_s"),
        F.coalesce(given("title"), made_title).alias("title"),
        "score",
        "objects_detected",
        F.coalesce(given("summary"), made_summary).alias("summary"),
        "has_speech",
        round_half_even("_chat", 3).alias("chat_intensity"),
        "label",
        *[
            round_half_even(c, 3).alias(c)
            for c in ("speech_bonus", "chat_bonus", "object_bonus", "empty_penalty", "raw_score")
        ],
    )


def text_preview(
    pairs: DataFrame, *, keys: list[str], order: list[str], text: str, out: str, max_chars: int | None = None
) -> DataFrame:
    """The texts of a group joined by spaces; with ``max_chars`` only so many characters.

    A line adds at least two characters with its space, so the first
    ``max_chars / 2 + 1`` lines then decide and the limit runs before the shuffle.
    """
    line = F.trim(F.col(text))
    kept = pairs.where(F.length(line) > 0).withColumn("_order", F.struct(*order))
    if max_chars is not None:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_order"))
        kept = kept.withColumn("_rank", rank).where(F.col("_rank") <= max_chars // 2 + 1)
    lines = F.array_sort(F.collect_list(F.struct("_order", line.alias("line"))))
    joined = kept.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda x: x["line"]), " ").alias(out))
    return joined if max_chars is None else joined.withColumn(out, F.substring(out, 1, max_chars))


def coverage_manifest(
    videos: DataFrame,
    segments: DataFrame,
    timeline: DataFrame,
    *,
    window_seconds: int = 30,
    step_seconds: int = 30,
) -> DataFrame:
    """Alternate manifest over full-length windows plus a tail-aligned one:
    up to 6 points for speech, 3 for chat, 1 for a length of 25 to 90 s."""
    windows = coverage_windows(videos, window_seconds, step_seconds).select(*_WINDOW)
    spans = segments.select(
        "vod_id", "pos", "text", F.col("start_s").alias("_ss"), F.col("end_s").alias("_se")
    ).where(F.col("_se") > F.col("_ss"))
    lines = overlap_join(
        windows, spans, bucket=_BUCKET, left_span=("start_s", "end_s"), right_span=("_ss", "_se"),
        spread_right_by=["pos"],
    )
    preview = text_preview(lines, keys=_WINDOW, order=["pos"], text="text", out="_preview")
    chat = mean_intensity(
        windows, timeline.select("vod_id", "t", F.coalesce("chat_intensity", F.lit(0.0)).alias("value"))
    )
    length = F.col("end_s") - F.col("start_s")
    ratio = F.col("speech_seconds") / F.greatest(F.lit(1.0), length)
    score = (
        F.least(F.lit(6.0), ratio * 8.0)
        + F.least(F.lit(3.0), F.col("mean_value") * 2.0)
        + F.when(length.between(25, 90), 1.0).otherwise(0.0)
    )
    return (
        speech_seconds(windows, segments)
        .join(chat, _WINDOW)
        .join(preview, _WINDOW, "left")
        .select(
            *_WINDOW,
            F.concat(
                F.lit("Candidate "), F.col("start_s").cast("string"), F.lit("s-"), F.col("end_s").cast("string"),
                F.lit("s"),
            ).alias("title"),
            round_half_even(clamp(score, 0, 10), 2).alias("score"),
            F.coalesce("_preview", F.lit("No transcript preview")).alias("summary"),
            (F.col("speech_seconds") > 2.0).alias("has_speech"),
            round_half_even("mean_value", 3).alias("chat_intensity"),
            F.lit("window_candidate").alias("label"),
        )
    )
