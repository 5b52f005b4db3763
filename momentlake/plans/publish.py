"""From discoveries and landed analyses to the clips to publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import context, scoring, selection, stitching, trim
from ..runtime import checkpointed

_KEY = ["vod_id", "clip_id"]
_UNPUBLISHED = ["penalty_trace", "hard_gates", "rejection_reasons", "merge_reasons", "source_candidate_ids", "source_windows"]


def with_times_and_link(clips: DataFrame, base_url: str) -> DataFrame:
    """Adds readable times and a deep link to the start of each clip."""
    times: list[Column] = [X.hms(F.col(c)).alias(f"{c}_hms") for c in ("start_s", "end_s", "trim_start", "trim_end")]
    return clips.select("*", *times, X.video_link(base_url, F.col("vod_id"), F.col("start_s")).alias("vod_url"))


def scored_arcs(
    candidates: DataFrame, analyses: DataFrame, segments: DataFrame, turns: DataFrame, names: DataFrame | None = None
) -> DataFrame:
    """Stitched arcs with the analysis of their best clip, their context and score.

    ``candidates`` as for stitching; ``analyses``: vod_id, candidate_id and the
    analysis columns of ``score_clips`` and ``final_clips``.
    """
    arcs = checkpointed(stitching.stitch(candidates)).withColumnRenamed("stitched_id", "clip_id")
    analysed = stitching.representative_analyses(arcs.withColumnRenamed("clip_id", "stitched_id"), analyses).drop(
        "candidate_id"
    ).withColumnRenamed("stitched_id", "clip_id")
    bounds = context.clip_bounds(
        arcs.select(*_KEY, "start_s", "end_s"), "start_s",
        F.greatest(F.lit(15.0), (F.col("end_s") - F.col("start_s")).cast("double")),
    )
    # Steps of many wide shuffles are written one by one: their files are gone before the next one begins.
    voices = checkpointed(context.speaker_stats(bounds, turns, names))
    silence = checkpointed(context.dead_air(bounds, segments))
    rows = (
        arcs.withColumn("pos", F.col("arc_no"))
        .join(analysed, _KEY)
        .join(silence, _KEY)
        .join(voices, _KEY)
        # A clip without any turn has an unknown voice; titles are then guarded as well.
        .withColumn("primary_speaker_identity", F.coalesce("primary_speaker_identity", F.lit("unknown")))
    )
    return scoring.score_clips(rows)


def published_clips(scored: DataFrame, energies: DataFrame, base_url: str, *, max_clips: int = 20) -> DataFrame:
    """Selected clips after trimming by loudness, with scores and gates recomputed.

    ``scored`` comes from :func:`scored_arcs`.  Videos without an eligible clip
    publish their three best ones.
    """
    # Traces of the first scoring and the making of an arc are not published.
    scored = checkpointed(scored.drop(*_UNPUBLISHED))
    chosen = checkpointed(
        selection.final_of_written(scored, min_score=scoring.MIN_FINAL_SCORE, max_clips=max_clips, fallback_top_n=3)
    )
    trimmed = trim.loudest_passage(
        trim.attach_energies(chosen.select(*_KEY, "start_s", "end_s", "trim_start", "trim_end"), energies)
    ).drop("start_s", "end_s")
    outcome = ["raw_score", "penalty_trace", "hard_gates", "rejection_reasons", "final_score", "eligible",
               "final_trim_start", "final_trim_end", "trim_start", "trim_end", "trim_source"]
    again = scoring.score_clips(scored.drop(*outcome).join(trimmed, _KEY))
    rescored = again.select(
        *_KEY, "raw_score", "final_score", "eligible", "rejection_reasons", "trim_source",
        F.col("final_trim_start").alias("trim_start"), F.col("final_trim_end").alias("trim_end"),
    )
    words = chosen.drop("raw_score", "score", "normalized_score", "trim_start", "trim_end", "trim_source")
    kept, _ = selection.regate(words.join(rescored, _KEY))
    kept = kept.withColumnRenamed("final_score", "score").withColumn("normalized_score", F.col("score"))
    return with_times_and_link(kept, base_url)
