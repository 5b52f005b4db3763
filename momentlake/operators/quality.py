"""Data contracts: which rows may pass a stage, and what is wrong with the others."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profiles import CONTEXT_KINDS
from .scoring import AUDIO_TRIM, CORRECTED_TRIM, MODEL_TRIM
from .speakers import IDENTITIES

# Enumerations of the contracts.
OBSERVATION_TYPES = (*CONTEXT_KINDS, "guest_identity", "clip_quality_lesson", "other")
OBSERVATION_SOURCES = ("transcript", "chat", "speaker_attribution", "fusion", "llm_summary", "manual")
CLIP_FIELDS = (
    "start", "end", "title", "score", "objects_detected", "summary", "has_speech", "chat_intensity", "label",
)

Rule = tuple[str, Column]


def _missing(*names: str) -> list[Rule]:
    return [(f"{n}_missing", F.col(n).isNull()) for n in names]


def _below(name: str, low: float) -> Rule:
    return f"{name}_below_{low:g}", F.col(name) < low


def _outside(name: str, low: float, high: float) -> Rule:
    return f"{name}_outside_{low:g}_{high:g}", ~F.col(name).between(low, high)


def _empty(name: str) -> Rule:
    return f"{name}_empty", F.coalesce(F.size(name), F.lit(0)) == 0


def _not_in(name: str, values: tuple[str, ...]) -> Rule:
    return f"{name}_unknown", ~F.col(name).isin(*values)


def _window(start: str = "start_s", end: str = "end_s") -> list[Rule]:
    return [_below(start, 0), (f"{end}_not_positive", F.col(end) <= 0), (f"{end}_not_after_{start}", F.col(end) <= F.col(start))]


def contract(stage: str) -> list[Rule]:
    """Rules of a stage as (code, condition that breaks it)."""
    discovery = [
        *_missing("candidate_id", "start_s", "end_s", "narrative_type", "trigger", "payoff", "confidence"),
        *_window(), _empty("evidence_lines"), _outside("confidence", 0, 1),
    ]
    rules: dict[str, list[Rule]] = {
        "discovery": discovery,
        "stitched": [
            *[r for r in discovery if not r[0].startswith("candidate_id")], *_missing("stitched_id"),
            _empty("source_candidate_ids"), _empty("source_windows"), _empty("merge_reasons"),
        ],
        "scored": [
            *_missing("candidate_id", "start_s", "end_s", "final_score", "raw_score", "eligible"), *_window(),
            _outside("final_score", 0, 10), _outside("raw_score", 0, 10),
            _not_in("trim_source", (MODEL_TRIM, AUDIO_TRIM, CORRECTED_TRIM)),
        ],
        "final_selected": [
            *_missing("clip_id", "start_s", "end_s", "trim_start", "trim_end", "title", "narrative_type"),
            _below("rank", 1), *_window(), *_window("trim_start", "trim_end"),
            ("trim_outside_window", (F.col("trim_start") < F.col("start_s")) | (F.col("trim_end") > F.col("end_s"))),
            _outside("score", 0, 10), _outside("raw_score", 0, 10), _empty("evidence"),
            _not_in("trim_source", (MODEL_TRIM, AUDIO_TRIM, CORRECTED_TRIM)),
        ],
        "context": [
            *_missing("clip_start", "clip_end"), *_window("clip_start", "clip_end"),
            _below("total_dead_air_seconds", 0), _outside("dead_air_ratio", 0, 1),
            _outside("streamer_speaking_ratio", 0, 1), _outside("streamer_speaking_confidence", 0, 1),
            _not_in("primary_speaker_identity", IDENTITIES),
        ],
        "transcript_line": [*_missing("start_s", "end_s", "text"), _below("start_s", 0), ("end_s_before_start_s", F.col("end_s") < F.col("start_s"))],
        "speaker_turn": [*_missing("start_s", "end_s", "speaker_label"), *_window()],
        "recognition": [_not_in("identity", IDENTITIES), _outside("confidence", 0, 1), _outside("cosine_similarity", -1, 1)],
        "observation": [
            *_missing("vod_id", "claim", "timestamp_start", "timestamp_end"),
            *_window("timestamp_start", "timestamp_end"), _outside("confidence", 0, 1),
            _empty("evidence"), _empty("evidence_refs"), _not_in("type", OBSERVATION_TYPES),
            _not_in("source", OBSERVATION_SOURCES),
        ],
    }
    if stage not in rules:
        raise ValueError(f"unknown stage {stage}")
    return rules[stage]


def with_errors(rows: DataFrame, stage: str) -> DataFrame:
    """Adds ``errors``, the codes of the broken rules of ``stage``."""
    codes = [F.when(F.coalesce(broken, F.lit(False)), code) for code, broken in contract(stage)]
    return rows.withColumn("errors", F.array_compact(F.array(*codes)))


def split_by_contract(rows: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil the contract, and quarantined rows with their errors."""
    checked = with_errors(rows, stage)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def error_counts(rows: DataFrame, stage: str) -> DataFrame:
    """How often each rule of ``stage`` is broken."""
    return (
        with_errors(rows, stage).select(F.explode("errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))
    )


def _finding(rows: DataFrame, condition: Column, level: str, rule: str, detail: Column) -> DataFrame:
    return rows.where(F.coalesce(condition, F.lit(False))).select(
        "vod_id", F.lit(level).alias("level"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail")
    )


def check_manifest(manifests: DataFrame, clips: DataFrame) -> DataFrame:
    """Findings on clip manifests: wrong video, no clips, missing fields, bad ranges.

    ``manifests``: vod_id (expected), stated_vod_id.  ``clips``: vod_id, pos and
    the clip fields as text (NULL when missing), ``fields`` the names present.
    """
    some = clips.select("vod_id").distinct().withColumn("_some", F.lit(True))
    docs = manifests.join(some, "vod_id", "left")
    absent = F.array_sort(F.array_except(F.array(*[F.lit(f) for f in CLIP_FIELDS]), F.col("fields")))
    start, end = F.col("start").try_cast("double"), F.col("end").try_cast("double")
    where = F.concat(F.lit("clips["), F.col("pos").cast("string"), F.lit("]"))
    stated = F.trim("stated_vod_id")
    return reduce(
        DataFrame.unionAll,
        [
            _finding(docs, (stated != "") & (stated != F.col("vod_id").cast("string")), "error", "vod_id_mismatch", stated),
            _finding(docs, F.col("_some").isNull(), "error", "no_clips", F.lit("")),
            _finding(clips, F.size(absent) > 0, "error", "missing_keys", F.concat(where, F.lit(" "), F.array_join(absent, ","))),
            _finding(clips, end <= start, "error", "invalid_range", where),
            _finding(clips, start.isNull() | end.isNull(), "error", "non_numeric_range", where),
        ],
    )


def check_fusion(documents: DataFrame) -> DataFrame:
    """Findings on fusion documents: vod_id, has_meta, meta_id, has_segments, has_messages."""
    meta = F.trim(F.coalesce("meta_id", F.lit("")))
    ok = F.col("has_meta")
    return reduce(
        DataFrame.unionAll,
        [
            _finding(documents, ~ok, "error", "missing_vod_meta", F.lit("")),
            _finding(documents, ok & (meta != "") & (meta != F.col("vod_id").cast("string")), "error", "meta_id_mismatch", meta),
            _finding(documents, ok & ~F.col("has_segments"), "error", "missing_segments", F.lit("")),
            _finding(documents, ok & ~F.col("has_messages"), "warning", "missing_messages", F.lit("")),
        ],
    )


def check_speakers(artifacts: DataFrame, turns: DataFrame) -> DataFrame:
    """Findings on speaker artifacts: broken turns, wrong video, and a size note.

    ``artifacts``: vod_id (expected), stated_vod_id; ``turns`` the artifact's turns.
    """
    broken = with_errors(turns, "speaker_turn")
    sizes = turns.groupBy("vod_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("speaker_label").alias("k")
    )
    note = F.concat(F.lit("segments="), F.col("n").cast("string"), F.lit(", clusters="), F.col("k").cast("string"))
    return reduce(
        DataFrame.unionAll,
        [
            _finding(broken, F.size("errors") > 0, "error", "schema_invalid", F.array_join("errors", ",")),
            _finding(
                artifacts, F.trim("stated_vod_id") != F.col("vod_id").cast("string"), "error", "vod_id_mismatch",
                F.col("stated_vod_id"),
            ),
            _finding(sizes, F.lit(True), "info", "speaker_counts", note),
        ],
    )


def videos_without_clips(videos: DataFrame, selected: DataFrame) -> DataFrame:
    """Findings for videos with no selected clip."""
    lacking = videos.select("vod_id").distinct().join(selected.select("vod_id").distinct(), "vod_id", "left_anti")
    return _finding(lacking, F.lit(True), "error", "no_selected_clips", F.lit(""))
