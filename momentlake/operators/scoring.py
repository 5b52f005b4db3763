"""Rule-based clip scores with penalties, caps and rejections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp, duration_penalty, round_half_even, safe_double, safe_int, truthy_text

MIN_FINAL_SCORE = 3.0
# Where a trim can come from.
MODEL_TRIM, AUDIO_TRIM, CORRECTED_TRIM = "qwen", "rms_fallback", "python_corrected"


def criticism_penalty(suggested: Column) -> Column:
    """Sum of the sizes of all suggested penalties, of either sign, at most 5."""
    total = F.aggregate(
        F.coalesce(suggested, F.array().cast("array<double>")),
        F.lit(0.0),
        lambda acc, x: acc + F.coalesce(F.abs(x), F.lit(0.0)),
    )
    return F.least(F.lit(5.0), round_half_even(total, 4))


def typed_analysis(raw: DataFrame) -> DataFrame:
    """Types the loosely typed text fields of landed analyses.

    Missing payoff counts as having one; flags follow truthiness of the raw
    text, so the string ``false`` is true.
    """
    flag = lambda c, default: F.when(F.col(c).isNull(), F.lit(default)).otherwise(truthy_text(c))
    return (
        raw.withColumn("clip_worthiness", safe_double("clip_worthiness"))
        .withColumn("trim_start", safe_int("trim_start", F.lit(None).cast("bigint")))
        .withColumn("trim_end", safe_int("trim_end", F.lit(None).cast("bigint")))
        .withColumn("has_payoff", flag("has_payoff", True))
        .withColumn("requires_context", flag("requires_context", False))
        .withColumn("transactional", flag("transactional", False))
    )


def _traces(entries: list[tuple[Column, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, entry) for cond, entry in entries]))


def score_clips(clips: DataFrame) -> DataFrame:
    """Scores candidates from their analysis and context, in one projection.

    Columns read: start_s, end_s, clip_worthiness, trim_start, trim_end,
    has_payoff, requires_context, transactional, narrative_arc, trim_reason,
    platform_scores (map), platform_recommendations (array),
    suggested_penalties (array), dead_air_gaps (array of start/end/duration),
    dead_air_ratio, audio_dead_air, music_only, trim_source.  Adds the scores,
    the final trim, ``penalty_trace``, ``hard_gates``, ``rejection_reasons``
    and ``eligible``.
    """
    start, end = F.col("start_s"), F.col("end_s")
    false = F.lit(False)
    c = (
        clips.withColumn("raw_score", clamp(F.coalesce("clip_worthiness", F.lit(0.0)), 0, 10))
        .withColumn("_ts0", F.coalesce("trim_start", start))
        .withColumn("_te0", F.coalesce("trim_end", end))
        .withColumn("_outside", (F.col("_ts0") < start) | (F.col("_te0") > end))
        .withColumn("_cs", F.greatest(F.col("_ts0"), start))
        .withColumn("_ce", F.least(F.col("_te0"), end))
        .withColumn("_clamped", F.col("_outside") & (F.col("_ce") > F.col("_cs")))
        .withColumn("_lost", F.col("_outside") & (F.col("_ce") <= F.col("_cs")))
        .withColumn("final_trim_start", F.when(F.col("_clamped"), F.col("_cs")).otherwise(F.col("_ts0")))
        .withColumn("final_trim_end", F.when(F.col("_clamped"), F.col("_ce")).otherwise(F.col("_te0")))
        .withColumn("_payoff", F.coalesce("has_payoff", F.lit(True)))
        .withColumn("_longest_gap", F.coalesce(F.array_max(F.transform("dead_air_gaps", lambda g: g["duration"])), F.lit(0.0)))
        .withColumn("_criticism", criticism_penalty(F.col("suggested_penalties")))
    )
    ts, te = F.col("final_trim_start"), F.col("final_trim_end")
    c = c.withColumn("_length_points", duration_penalty(ts, te).cast("double")).withColumn(
        "_gap_in_trim",
        F.coalesce(
            F.exists(
                "dead_air_gaps",
                lambda g: (g["end"] > g["start"]) & (g["start"] < te) & (g["end"] > ts),
            ),
            false,
        ),
    )
    long_gap = F.col("_longest_gap") > 20
    silent = F.coalesce(F.col("dead_air_ratio") > 0.30, false)
    no_payoff = ~F.col("_payoff")
    context_needed = F.coalesce("requires_context", false)
    arc = F.trim(F.coalesce("narrative_arc", F.lit("")))
    transactional = F.coalesce("transactional", false) & (F.length(arc) < 20)
    reason = F.trim(F.coalesce("trim_reason", F.lit("")))
    unresolved = (end - start == 120) & (ts == start) & (te == end) & (F.length(reason) < 20)
    bad_platform = F.coalesce(
        F.exists(
            "platform_recommendations",
            lambda p: F.coalesce(F.try_element_at("platform_scores", p), F.lit(-1.0)) < 6,
        ),
        false,
    )
    bad_window = end <= start
    bad_trim = F.col("_te0") <= F.col("_ts0")
    audio_gap = F.coalesce("audio_dead_air", false)
    only_music = F.coalesce("music_only", false) & no_payoff

    def points(code: str, p: Column | float) -> Column:
        return F.struct(F.lit(code).alias("code"), (F.lit(float(p)) if isinstance(p, (int, float)) else p).alias("points"))

    def gate(code: str, action: str) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(action).alias("action"))

    penalties = _traces(
        [
            (F.col("_clamped"), points("trim_clamped_to_bounds", 0.5)),
            (long_gap, points("dead_air_single_gap_gt_20", 3)),
            (context_needed, points("context_required", 1.5)),
            (F.col("_length_points") > 0, points("duration_policy_penalty", F.col("_length_points"))),
            (F.col("_criticism") > 0, points("clip_criticism_penalty", F.col("_criticism"))),
            (audio_gap, points("audio_dead_air_signal", 1)),
            (only_music, points("audio_music_only_without_payoff", 1)),
        ]
    )
    gates = _traces(
        [
            (bad_window, gate("invalid_candidate_window", "reject")),
            (bad_trim, gate("invalid_trim_range", "reject")),
            (F.col("_lost"), gate("trim_out_of_bounds", "reject")),
            (long_gap, gate("dead_air_single_gap_gt_20", "cap<=6")),
            (silent, gate("dead_air_ratio_gt_30pct", "cap<=5")),
            (F.col("_gap_in_trim"), gate("dead_air_inside_trim", "cap<=3")),
            (F.col("_gap_in_trim"), gate("dead_air_inside_trim", "reject")),
            (no_payoff, gate("no_narrative_payoff", "cap<=5")),
            (no_payoff, gate("no_narrative_payoff", "reject")),
            (transactional, gate("transactional_without_narrative_arc", "cap<=4")),
            (transactional, gate("transactional_without_narrative_arc", "reject")),
            (unresolved, gate("full_window_unresolved", "cap<=5")),
            (unresolved, gate("full_window_unresolved", "reject")),
            (bad_platform, gate("platform_recommendation_invalid", "reject_bad_platform_recs")),
        ]
    )
    caps = F.least(
        F.lit(10.0),
        F.when(long_gap, 6.0),
        F.when(silent, 5.0),
        F.when(F.col("_gap_in_trim"), 3.0),
        F.when(no_payoff, 5.0),
        F.when(transactional, 4.0),
        F.when(unresolved, 5.0),
    )
    rejects = F.filter(F.col("hard_gates"), lambda g: g["action"].startswith("reject"))
    total = F.aggregate("penalty_trace", F.lit(0.0), lambda acc, p: acc + p["points"])
    final = round_half_even(clamp(F.least(F.col("raw_score") - total, F.col("_cap")), 0, 10), 4)
    source = F.coalesce(F.when(F.col("trim_source") != "", F.col("trim_source")), F.lit(MODEL_TRIM))
    helper_columns = [
        "_ts0", "_te0", "_outside", "_cs", "_ce", "_clamped", "_lost", "_payoff", "_longest_gap", "_criticism",
        "_length_points", "_gap_in_trim", "_cap",
    ]
    return (
        c.withColumn("penalty_trace", penalties)
        .withColumn("hard_gates", gates)
        .withColumn("_cap", caps)
        .withColumn("rejection_reasons", F.array_distinct(F.transform(rejects, lambda g: g["code"])))
        .withColumn("final_score", final)
        .withColumn(
            "eligible",
            (F.size("rejection_reasons") == 0)
            & (F.col("final_score") >= MIN_FINAL_SCORE)
            & (ts >= start)
            & (te > ts)
            & (te <= end),
        )
        .withColumn(
            "trim_source", F.when(source.isin(MODEL_TRIM, AUDIO_TRIM, CORRECTED_TRIM), source).otherwise(CORRECTED_TRIM)
        )
        .drop(*helper_columns)
    )


def gate_summary(scored: DataFrame) -> DataFrame:
    """Per video: scored clips and clips past the gate."""
    passed = F.col("eligible") & (F.col("final_score") >= MIN_FINAL_SCORE)
    return scored.groupBy("vod_id").agg(
        F.count(F.lit(1)).alias("scored_count"), F.count_if(passed).alias("passed_hard_gate")
    )


def rejected_clips(scored: DataFrame) -> DataFrame:
    """Clips that miss the gate, with their reasons (``below_score_threshold`` if none)."""
    passed = F.col("eligible") & (F.col("final_score") >= MIN_FINAL_SCORE)
    reasons = F.when(F.size("rejection_reasons") > 0, F.col("rejection_reasons")).otherwise(
        F.array(F.lit("below_score_threshold"))
    )
    return scored.where(~passed).withColumn("reason_codes", reasons)
