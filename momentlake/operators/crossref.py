"""Cross-referencing scenes and topic segments with frames, chat and speech."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even
from .intervals import point_join
from .manifest import text_preview
from .objects import VOCABULARIES, category

FRAME_STEP = 5

# Points per scene label.
SCENE_LABEL_POINTS = {"interaction": 1, "intro": 3, "outro": 3, "highlight": 5, "funny": 5, "quiet": 0}
SCENE_LABEL_POINTS_DENSITY = {"interaction": 3, "intro": 2, "outro": 2, "highlight": 4, "funny": 4, "quiet": -1}
INTERACTIVE_LABELS = ("interaction", "intro", "outro")

# Words that tie a topic to what is on screen, with the points for a match.
TOPIC_WORDS = {
    "food": (
        3.0, ("food", "eat", "snack", "cook", "meal", "dinner", "lunch", "breakfast", "drink", "coffee", "tea"),
    ),
    "person": (2.0, ("person", "people", "face", "someone", "i", "me", "we", "our", "my")),
    "device/screen": (2.0, ("screen", "computer", "phone", "laptop", "code", "type", "watch", "video")),
    "animal": (3.0, ("pet", "dog", "cat", "animal", "cute")),
}
# Points per emotion.
EMOTION_WEIGHTS = {
    "happy": 3, "excited": 4, "funny": 5, "surprised": 3, "sad": 2, "frustrated": 2, "angry": 2, "neutral": 1,
}


def frames(detections: DataFrame, vocabulary: str) -> DataFrame:
    """One row per frame time: object count and one flag per category."""
    flags = [
        F.max(F.coalesce(F.col("_category") == name, F.lit(False))).alias(f"is_{i}")
        for i, name in enumerate(VOCABULARIES[vocabulary])
    ]
    return (
        detections.withColumn("_category", category(F.col("class_name"), vocabulary))
        .groupBy("vod_id", "second_s")
        .agg(F.count(F.lit(1)).alias("num_objects"), *flags)
    )


def _lookup(values: dict[str, int], key: Column, default: int) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def _frames_in(spans: DataFrame, frame_rows: DataFrame, n_flags: int, *, from_multiple: bool) -> DataFrame:
    """Frames on the sampling grid of each span, summed up."""
    lo = F.col("start_s") - F.col("start_s") % FRAME_STEP if from_multiple else F.col("start_s")
    grid = spans.select("vod_id", "span_id", lo.alias("_lo"), F.col("end_s").alias("_hi"))
    return (
        point_join(frame_rows, grid, bucket=600, at="second_s", span=("_lo", "_hi"), closed=False)
        .where((F.col("second_s") - F.col("_lo")) % FRAME_STEP == 0)
        .groupBy("vod_id", "span_id")
        .agg(
            F.sum("num_objects").alias("objects_detected"),
            F.count(F.lit(1)).alias("frames_seen"),
            *[F.max(f"is_{i}").alias(f"is_{i}") for i in range(n_flags)],
        )
    )


def scene_candidates(
    scenes: DataFrame,
    detections: DataFrame,
    timeline: DataFrame,
    segments: DataFrame,
    *,
    scheme: str = "category",
    min_seconds: int = 30,
    k: int | None = 10,
    preview_chars: int | None = None,
) -> DataFrame:
    """Scores scenes of at least ``min_seconds`` and keeps the best ``k`` per video.

    ``scheme`` picks one of two rule sets: ``category`` rewards each kind of
    object in view, ``density`` rewards variety and number of objects.  The
    timeline is read as one value per whole second, the latest row winning.
    Clips are cut to 30..120 s.
    """
    if scheme not in ("category", "density"):
        raise ValueError(f"unknown scheme {scheme}")
    vocabulary = "scene_wide" if scheme == "category" else "scene"
    names = list(VOCABULARIES[vocabulary])
    spans = (
        scenes.withColumn("start_s", F.col("start_s").cast("bigint"))
        .withColumn("end_s", F.col("end_s").cast("bigint"))
        .withColumn("duration_s", F.col("end_s") - F.col("start_s"))
        .where(F.col("duration_s") >= min_seconds)
        .withColumn("span_id", F.col("scene_index"))
        .withColumn("label", F.coalesce("label", F.lit("unknown")))
    )
    seen = _frames_in(spans, frames(detections, vocabulary), len(names), from_multiple=scheme == "category")

    bounds = spans.select("vod_id", "span_id", F.col("start_s").alias("_lo"), F.col("end_s").alias("_hi"))
    per_second = (
        timeline.groupBy("vod_id", F.col("t").cast("bigint").alias("t"))
        .agg(F.max_by("chat_intensity", "pos").alias("value"))
        .where(F.col("value") > 0)
    )
    chat = (
        point_join(per_second, bounds, bucket=600, at="t", span=("_lo", "_hi"))
        .groupBy("vod_id", "span_id")
        .agg(F.avg("value").alias("avg_chat"))
    )
    lines = point_join(
        segments.select("vod_id", "pos", F.col("start_s").alias("_line_s"), "text"),
        bounds, bucket=600, at="_line_s", span=("_lo", "_hi"), spread_by=["pos"],
    )
    spoken = text_preview(
        lines, keys=["vod_id", "span_id"], order=["pos"], text="text", max_chars=preview_chars, out="text_preview"
    )
    joined = (
        spans.join(seen, ["vod_id", "span_id"], "left")
        .join(chat, ["vod_id", "span_id"], "left")
        .join(spoken, ["vod_id", "span_id"], "left")
        .fillna(0, ["objects_detected", "frames_seen"])
        .withColumn("_chat", F.coalesce("avg_chat", F.lit(0.0)))
        .withColumn("has_speech", F.col("text_preview").isNotNull())
    )
    has = {n: F.coalesce(F.col(f"is_{i}"), F.lit(False)) for i, n in enumerate(names)}
    points = lambda cond, p: F.when(cond, float(p)).otherwise(0.0)
    interactive = F.col("label").isin(*INTERACTIVE_LABELS)
    length = F.col("duration_s")
    if scheme == "category":
        score = (
            points(has["person"], 2)
            + points(has["person"] & interactive, 2)
            + points(has["food/drink"], 4)
            + points(has["device"], 2)
            + points(has["pet"], 6)
            + F.when(F.col("_chat") > 0.5, 3.0).when(F.col("_chat") > 0.1, 1.5).otherwise(0.0)
            + _lookup(SCENE_LABEL_POINTS, F.col("label"), 0)
            + points(F.col("has_speech"), 1.5)
            + points(length.between(30, 120), 1)
        )
    else:
        kinds = sum((h.cast("int") for h in has.values()), F.lit(0))
        score = (
            points(has["person"] & interactive, 4)
            + points(has["food/drink"], 3)
            + points(has["pet"], 5)
            + points(kinds >= 2, 2)
            + points(F.col("objects_detected") > 20, 2)
            + F.when(F.col("_chat") > 0.5, 3.0).when(F.col("_chat") > 0.1, 1.0).otherwise(0.0)
            + _lookup(SCENE_LABEL_POINTS_DENSITY, F.col("label"), 0)
            + points(F.col("has_speech"), 2)
            + points(length.between(30, 90), 1)
        )
    found = F.array(*[F.when(has[n], n) for n in sorted(names)])
    scored = joined.withColumn("score", round_half_even(score, 1)).select(
        "vod_id",
        "scene_index",
        "start_s",
        "end_s",
        "duration_s",
        "label",
        "score",
        F.filter(found, lambda x: x.isNotNull()).alias("visual_categories"),
        "objects_detected",
        round_half_even("_chat", 2).alias("avg_chat_intensity"),
        "has_speech",
        F.coalesce("text_preview", "label").alias("summary"),
    )
    return scored if k is None else top_clips(scored, order=["scene_index"], k=k)


def top_clips(scored: DataFrame, *, order: list[str], k: int = 10) -> DataFrame:
    """Best ``k`` rows per video by score, cut to clips of 30 to 120 s."""
    rank = F.row_number().over(Window.partitionBy("vod_id").orderBy(F.desc("score"), *order))
    length = F.least(F.lit(120), F.greatest(F.lit(30), F.col("end_s") - F.col("start_s")))
    return (
        scored.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .withColumn("clip_start", F.greatest(F.col("start_s"), F.lit(0)))
        .withColumn("clip_end", F.col("clip_start") + length)
    )


def topic_candidates(segments: DataFrame, detections: DataFrame, *, k: int | None = 10) -> DataFrame:
    """Scores topic segments by how well the frames shown match what is talked about.

    ``segments``: vod_id, pos, start_s, end_s, topic, emotion, novelty.  Segments
    without any frame are dropped.
    """
    names = list(VOCABULARIES["topic"])
    spans = segments.withColumn("span_id", F.col("pos"))
    seen = _frames_in(spans, frames(detections, "topic"), len(names), from_multiple=False)
    topic = F.lower(F.coalesce("topic", F.lit("")))
    emotion = F.lower(F.coalesce("emotion", F.lit("")))
    has = {n: F.col(f"is_{i}") for i, n in enumerate(names)}
    points = lambda cond, p: F.when(cond, float(p)).otherwise(0.0)
    visual = sum(
        (
            points(has[n] & F.array_contains(F.array(*[topic.contains(w) for w in words]), True), p)
            for n, (p, words) in TOPIC_WORDS.items()
        ),
        F.lit(0.0),
    )
    visual = (
        visual
        + points(emotion.isin("happy", "excited", "funny", "surprised") & has["person"], 2.0)
        + points(emotion.isin("sad", "frustrated", "angry") & has["person"], 1.5)
        + points(F.coalesce(F.col("novelty"), F.lit(False)), 1.0)
    )
    weight = _lookup(EMOTION_WEIGHTS, F.lower(F.coalesce("emotion", F.lit("neutral"))), 1)
    found = F.array(*[F.when(has[n], n) for n in sorted(names)])
    scored = (
        spans.join(seen, ["vod_id", "span_id"])
        .withColumn("_visual", visual)
        .withColumn("emotion_weight", weight)
        .withColumn("_total", F.col("_visual") + F.col("emotion_weight") * 0.5 + F.col("frames_seen") / 6.0)
        .select(
            "vod_id",
            "pos",
            "start_s",
            "end_s",
            "topic",
            "emotion",
            F.filter(found, lambda x: x.isNotNull()).alias("visual_categories"),
            round_half_even("_visual", 1).alias("visual_score"),
            "emotion_weight",
            round_half_even("_total", 1).alias("score"),
            F.col("frames_seen").alias("frames_sampled"),
            "objects_detected",
        )
    )
    return scored if k is None else top_clips(scored, order=["pos"], k=k)
