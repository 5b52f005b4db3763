"""Everything that models are asked about: windows, chunks and annotation windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotations, intervals, manifest, triage
from ..runtime import checkpointed


@dataclass(frozen=True)
class Prepared:
    """Tables of the preparation job."""

    manifest: DataFrame
    chunks: DataFrame
    annotation_windows: DataFrame


def prepare(
    segments: DataFrame,
    messages: DataFrame,
    timeline: DataFrame,
    detections: DataFrame,
    *,
    window_seconds: int = 120,
    step_seconds: int = 60,
) -> Prepared:
    """Scored windows, triage chunks and the windows to annotate for all videos."""
    # One row per video, read by every step below.
    durations = checkpointed(manifest.video_durations([(segments, "end_s"), (messages, "t"), (timeline, "t")]))
    windows = intervals.sliding_windows(durations, window_seconds, step_seconds).select(
        "vod_id", "window_index", "start_s", "end_s"
    )
    clips = manifest.clip_manifest(windows, segments, timeline, detections)
    videos = durations.select(
        "vod_id", F.lit(0).cast("bigint").alias("vod_start"), F.ceil("duration_s").cast("bigint").alias("vod_end")
    )
    chunks = triage.triage_chunks(videos, segments, messages)
    keyed = clips.withColumn("clip_id", F.concat(F.lit("manifest_"), F.col("window_index").cast("string")))
    return Prepared(clips, chunks, annotations.annotation_windows(chunks, keyed))
