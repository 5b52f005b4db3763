"""Cheap triage: chunks, candidate repair, budgets and the review shortlist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clamp, clean_list, clean_text, round_half_even, safe_double, safe_int
from .intervals import numbered, overlap_join, overlapping_chunks, point_join, surrounding_times

# Defaults of the triage stage.
MAX_CANDIDATES = 60
REVIEW_RATIO, MIN_REVIEWED, MAX_REVIEWED = 0.20, 25, 50
SENTINEL_RATIO = 0.05
VISION_NEEDS = ("none", "verify_expression", "verify_scene", "critical")
TOP_REASON, SENTINEL_REASON = "text_top_rank", "sentinel_coverage"

# Rescue lanes in the order they are filled, with the reasons that
# admit a candidate besides the lane's own name.
LANES: dict[str, tuple[str, ...]] = {
    "chat_spike": ("chat", "chat_banter", "conversation"),
    "audio_signal": ("audio", "sound", "loud_reaction"),
    "yolo_visual_novelty": ("yolo", "visual_novelty", "verify_scene"),
    "gemma_audio_alert_or_laughter": (
        "audio_alert", "audio_alert_or_laughter", "alert_or_laughter", "donation_alert", "tts_alert", "laugh", "laughter",
    ),
    "gemma_game_audio_or_non_streamer_voice": (
        "game_audio", "non_streamer_voice", "non_streamer_speech", "game_audio_or_non_streamer_voice",
    ),
    "gemma_visual_reaction": (
        "visual_reaction", "reaction", "streamer_reaction", "face_visible", "streamer_visible", "laughing",
    ),
    "gemma_visual_payoff": ("visual_payoff", "payoff", "scene_change", "gameplay_event"),
}
SENTINEL_LANE = ("sentinel", "coverage")


def _clamped_trim(value: Column, start: Column, end: Column, default: Column) -> Column:
    number = safe_int(value, default)
    return F.when(value.isNull(), default).otherwise(F.greatest(start, F.least(end, number)))


def normalise_candidates(raw: DataFrame) -> DataFrame:
    """Repairs loosely typed triage candidates.

    ``raw``: vod_id, pos, fallback_start, fallback_end (bigint); start, end,
    trim_start, trim_end, triage_score, triage_confidence (text as replied);
    candidate_id, narrative_type, trigger, payoff, vision_need (text);
    evidence_lines, risk_flags, selection_reasons, annotation_refs (arrays).
    """
    fs = F.coalesce("fallback_start", F.lit(0)).cast("bigint")
    fe = F.when(F.col("fallback_end") > fs, F.col("fallback_end")).otherwise(fs + 1)
    start, end = safe_int("start", fs), safe_int("end", fe)
    r = (
        raw.withColumn("_fs", fs)
        .withColumn("_fe", fe)
        .withColumn("_s", start)
        .withColumn("_e", end)
        .withColumn("_bad", F.col("_e") <= F.col("_s"))
        .withColumn("start_s", F.when(F.col("_bad"), F.col("_fs")).otherwise(F.col("_s")))
        .withColumn("end_s", F.when(F.col("_bad"), F.col("_fe")).otherwise(F.col("_e")))
    )
    s, e = F.col("start_s"), F.col("end_s")
    r = r.withColumn("_ts", _clamped_trim(F.col("trim_start"), s, e, s)).withColumn(
        "_te", _clamped_trim(F.col("trim_end"), s, e, e)
    )
    usable = F.col("_te") > F.col("_ts")
    need = F.lower(clean_text("vision_need", "none"))
    stated = clean_list("evidence_lines")
    fallback_line = F.format_string("[%ds] triage candidate from %ds to %ds", s, s, e)
    return r.select(
        "vod_id",
        "pos",
        clean_text("candidate_id", F.format_string("triage_%d_%d", s, e)).alias("candidate_id"),
        "start_s",
        "end_s",
        F.when(usable, F.col("_ts")).otherwise(s).alias("trim_start"),
        F.when(usable, F.col("_te")).otherwise(e).alias("trim_end"),
        clean_text("narrative_type", "other").alias("narrative_type"),
        clean_text("trigger", "What starts the moment").alias("trigger"),
        clean_text("payoff", "What resolves or lands").alias("payoff"),
        F.when(F.size(stated) > 0, stated).otherwise(F.array(fallback_line)).alias("evidence_lines"),
        clean_list("risk_flags").alias("risk_flags"),
        round_half_even(clamp(safe_double("triage_score"), 0, 10), 4).alias("triage_score"),
        round_half_even(clamp(safe_double("triage_confidence"), 0, 1), 4).alias("triage_confidence"),
        F.when(need.isin(*VISION_NEEDS), need).otherwise("none").alias("vision_need"),
        clean_list("selection_reasons").alias("selection_reasons"),
        clean_list("annotation_refs").alias("annotation_refs"),
    )


def top_candidates(candidates: DataFrame, limit: int = MAX_CANDIDATES) -> DataFrame:
    """The best ``limit`` candidates per video by score, confidence, start and id.

    The limit runs before the shuffle, so a video sends at most ``limit`` rows
    per task.
    """
    order = [F.desc("triage_score"), F.desc("triage_confidence"), "start_s", "candidate_id", "pos"]
    rank = F.row_number().over(Window.partitionBy("vod_id").orderBy(*order))
    return candidates.withColumn("rank", rank).where(F.col("rank") <= limit)


def review_budget(total: Column, ratio: float, low: int, high: int) -> Column:
    """``ceil(total * ratio)`` kept between ``low`` and ``high`` and not above ``total``."""
    low, high = max(0, low), max(max(0, low), high)
    wanted = F.ceil(total * max(0.0, ratio))
    bounded = F.least(F.lit(high), F.greatest(F.lit(low), wanted))
    return F.greatest(F.lit(0), F.least(total, bounded)).cast("bigint")


def review_budgets(
    candidates: DataFrame, ratio: float = REVIEW_RATIO, low: int = MIN_REVIEWED, high: int = MAX_REVIEWED
) -> DataFrame:
    return (
        candidates.groupBy("vod_id")
        .agg(F.count(F.lit(1)).alias("candidates"))
        .withColumn("budget", review_budget(F.col("candidates"), ratio, low, high))
    )


def lowered_reasons(reasons: Column) -> Column:
    return F.transform(reasons, lambda r: F.lower(F.trim(r)))


def lane_reason(lowered: Column, lane: str, synonyms: tuple[str, ...]) -> Column:
    """The lane name if given among ``lowered_reasons``, else the first synonym in the alphabet, else NULL."""
    hits = F.array_intersect(lowered, F.array(*[F.lit(s) for s in synonyms]))
    return F.when(F.array_contains(lowered, lane), F.lit(lane)).otherwise(F.array_min(hits))


def _manifest_clips(manifest: DataFrame) -> DataFrame:
    start = F.col("start_s").cast("bigint")
    end = F.col("end_s").cast("bigint")
    return manifest.select(
        "vod_id",
        F.col("clip_id").cast("string").alias("clip_id"),
        start.alias("start_s"),
        F.when(end > start, end).otherwise(start + 1).alias("end_s"),
    )


def _sentinel_targets(manifest: DataFrame, budgets: DataFrame, ratio: float) -> DataFrame:
    """Per video the evenly spaced manifest clips that keep coverage, at most ``budget``."""
    clips = numbered(
        _manifest_clips(manifest),
        order=["start_s", "end_s", "clip_id"],
        block=F.floor(F.col("start_s") / 3600),
        out="idx",
    )
    sizes = clips.groupBy("vod_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.greatest(F.lit(1), F.rint(F.col("budget") * max(0.0, ratio)).cast("bigint"))
    k = F.least(F.col("n"), wanted)
    plan = budgets.where(F.col("budget") > 0).join(sizes, "vod_id").withColumn("k", k)
    spaced = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1),
        lambda i: F.rint(i * (F.col("n") - 1) / (F.col("k") - 1)).cast("bigint"),
    )
    middle = F.array(F.floor(F.col("n") / 2))
    picks = plan.select(
        "vod_id", "k", F.posexplode(F.when(F.col("k") == 1, middle).otherwise(spaced)).alias("turn", "idx")
    )
    return (
        picks.join(clips, ["vod_id", "idx"])
        .groupBy("vod_id")
        .agg(
            F.max("k").alias("k"),
            F.array_sort(F.collect_list(F.struct("turn", "start_s", "end_s", "clip_id"))).alias("targets"),
        )
    )


_PICKS = "array<struct<r:int,reason:string,turn:int,start_s:bigint>>"


def _pick(r: Column, reason: Column, turn: Column, start: Column) -> Column:
    return F.struct(
        r.cast("int").alias("r"), reason.cast("string").alias("reason"), turn.cast("int").alias("turn"),
        start.cast("bigint").alias("start_s"),
    )


def _unseen(picks: Column, start: Column) -> Column:
    return ~F.exists(picks, lambda p: p["start_s"] == start)


def vision_shortlist(
    candidates: DataFrame,
    manifest: DataFrame,
    *,
    budgets: DataFrame | None = None,
    sentinel_ratio: float = SENTINEL_RATIO,
    limit: int = MAX_CANDIDATES,
) -> DataFrame:
    """The candidates worth a closer look, at most ``budget`` per video.

    In turn: the top candidate, the best unseen one of each rescue lane,
    explicit sentinels, evenly spaced manifest clips (a matching candidate or a
    zero-score stand-in), and the rest by rank.  No start appears twice.  The
    ``limit`` best candidates of a video form one small array, so the turns are
    column expressions without any further shuffle.
    """
    top = top_candidates(candidates, limit)
    if budgets is None:
        budgets = review_budgets(top)
    # Reasons are lowered once a candidate, not once a lane.
    low = F.col("_low")
    lanes = F.array(*[lane_reason(low, lane, synonyms) for lane, synonyms in LANES.items()]).alias("lanes")
    sentinel = lane_reason(low, SENTINEL_REASON, SENTINEL_LANE).alias("sentinel")
    rows = top.withColumn("_low", lowered_reasons(F.col("selection_reasons"))).select(
        "vod_id", F.struct(F.col("rank").alias("r"), "start_s", lanes, sentinel).alias("c")
    )
    cands = rows.groupBy("vod_id").agg(F.sort_array(F.collect_list("c")).alias("cands"))
    no_cands = F.array().cast(cands.schema["cands"].dataType)
    videos = (
        budgets.where(F.col("budget") > 0)
        .select("vod_id", F.col("budget").cast("int").alias("budget"))
        .join(cands, "vod_id", "left")
        .join(_sentinel_targets(manifest, budgets, sentinel_ratio), "vod_id", "left")
        .withColumn("cands", F.coalesce("cands", no_cands))
        .withColumn("k", F.coalesce("k", F.lit(0)).cast("int"))
    )
    no_turn = F.lit(None).cast("int")
    first = F.transform(
        F.slice("cands", 1, 1), lambda c: _pick(c["r"], F.lit(TOP_REASON), no_turn, c["start_s"])
    ).cast(_PICKS)

    # Each turn is one fold whose state is the list of picks so far.
    def add_lane(acc: Column, lane: Column) -> Column:
        fits = F.filter("cands", lambda c: F.get(c["lanes"], lane).isNotNull() & _unseen(acc, c["start_s"]))
        found = F.transform(
            F.slice(fits, 1, 1), lambda c: _pick(c["r"], F.get(c["lanes"], lane), no_turn, c["start_s"])
        )
        return F.when(F.size(acc) < F.col("budget"), F.concat(acc, found)).otherwise(acc)

    step = videos.withColumn(
        "picks", F.aggregate(F.sequence(F.lit(0), F.lit(len(LANES) - 1)), first, add_lane)
    )

    def add_sentinel(acc: Column, c: Column) -> Column:
        ok = (
            c["sentinel"].isNotNull()
            & (acc["n"] < F.col("k"))
            & (F.size(acc["picks"]) < F.col("budget"))
            & _unseen(acc["picks"], c["start_s"])
        )
        pick = F.array(_pick(c["r"], F.lit(SENTINEL_REASON), no_turn, c["start_s"]))
        return F.struct(
            F.when(ok, F.concat(acc["picks"], pick)).otherwise(acc["picks"]).alias("picks"),
            F.when(ok, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
        )

    step = step.withColumn(
        "_acc", F.aggregate("cands", F.struct(F.col("picks"), F.lit(0).alias("n")), add_sentinel)
    )

    def add_spaced(acc: Column, t: Column) -> Column:
        same = F.filter(F.col("cands"), lambda c: c["start_s"] == t["start_s"])
        ok = (F.size(acc) < F.col("budget")) & _unseen(acc, t["start_s"])
        pick = F.array(_pick(F.get(same, 0)["r"], F.lit(SENTINEL_REASON), t["turn"], t["start_s"]))
        return F.when(ok, F.concat(acc, pick)).otherwise(acc)

    due = F.when(F.col("targets").isNotNull() & (F.col("_acc.n") < F.col("k")), F.col("targets"))
    step = step.withColumn("_due", F.coalesce(due, F.slice("targets", 1, 0))).withColumn(
        "picks", F.when(F.col("_due").isNull(), F.col("_acc.picks")).otherwise(
            F.aggregate("_due", F.col("_acc.picks"), add_spaced)
        )
    )

    def fill(acc: Column, c: Column) -> Column:
        ok = (F.size(acc) < F.col("budget")) & _unseen(acc, c["start_s"])
        return F.when(ok, F.concat(acc, F.array(_pick(c["r"], F.lit(TOP_REASON), no_turn, c["start_s"])))).otherwise(acc)

    step = step.withColumn("picks", F.aggregate("cands", F.col("picks"), fill))
    picked = step.select("vod_id", "targets", F.explode("picks").alias("p")).select(
        "vod_id",
        F.col("p.r").alias("rank"),
        F.col("p.reason").alias("selection_reason"),
        F.get(F.filter("targets", lambda t: t["turn"] == F.col("p.turn")), 0).alias("clip"),
    )
    joined = picked.join(top, ["vod_id", "rank"], "left")
    synthetic = F.col("candidate_id").isNull()
    start = F.coalesce("clip.start_s", "start_s")
    end = F.coalesce("clip.end_s", "end_s")
    ts, te = F.greatest(start, F.least(end, F.col("trim_start"))), F.greatest(start, F.least(end, F.col("trim_end")))
    sound = F.coalesce(te > ts, F.lit(False))
    none = F.array().cast("array<string>")
    return joined.select(
        "vod_id",
        F.when(synthetic, F.concat(F.lit("sentinel_"), F.col("clip.clip_id"))).otherwise(F.col("candidate_id")).alias(
            "candidate_id"
        ),
        F.when(synthetic, F.col("clip.clip_id")).otherwise(F.col("candidate_id")).alias("source_candidate_id"),
        start.alias("start_s"),
        end.alias("end_s"),
        F.when(sound, ts).otherwise(start).alias("trim_start"),
        F.when(sound, te).otherwise(end).alias("trim_end"),
        F.coalesce("triage_score", F.lit(0.0)).alias("triage_score"),
        F.coalesce("triage_confidence", F.lit(0.0)).alias("triage_confidence"),
        F.coalesce("vision_need", F.lit("none")).alias("vision_need"),
        "selection_reason",
        F.array_distinct(F.concat(F.coalesce("selection_reasons", none), F.array("selection_reason"))).alias(
            "selection_reasons"
        ),
        F.when(
            synthetic, F.array(F.format_string("[%ds] sentinel coverage from manifest clip %s", start, F.col("clip.clip_id")))
        ).otherwise(F.col("evidence_lines")).alias("evidence_lines"),
        F.coalesce("risk_flags", none).alias("risk_flags"),
        F.coalesce("annotation_refs", none).alias("annotation_refs"),
        F.col("clip.clip_id").alias("manifest_clip_id"),
    )


def reason_counts(candidates: DataFrame) -> DataFrame:
    """How often each selection reason occurs per video."""
    return (
        candidates.select("vod_id", F.explode("selection_reasons").alias("reason"))
        .groupBy("vod_id", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def best_manifest_match(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """For each candidate the manifest clip it overlaps most; ties, and clips
    without overlap, go to the nearest start, then to the first clip.

    ``manifest`` needs ``pos``.  Overlaps come from an interval join that spreads the clips of a busy time; only
    candidates without any fall back to the neighbouring clip starts.
    """
    end = lambda: F.when(F.col("end_s") > F.col("start_s"), F.col("end_s")).otherwise(F.col("start_s") + 1)
    cands = candidates.select("vod_id", F.col("start_s").alias("_cs"), end().alias("_ce")).distinct()
    clips = manifest.select(
        "vod_id", F.col("pos").alias("_mpos"), "clip_id", F.col("start_s").alias("_ms"), end().alias("_me")
    )
    shared = F.least("_ce", "_me") - F.greatest("_cs", "_ms")
    touching = (
        overlap_join(
            cands, clips, bucket=300, left_span=("_cs", "_ce"), right_span=("_ms", "_me"), spread_right_by=["_mpos", "clip_id"]
        )
        .groupBy("vod_id", "_cs", "_ce")
        .agg(
            F.min_by(
                F.struct("clip_id", shared.alias("overlap")),
                F.struct(-shared, F.abs(F.col("_cs") - F.col("_ms")), "_mpos"),
            ).alias("best")
        )
    )
    apart = cands.join(touching, ["vod_id", "_cs", "_ce"], "left_anti")
    near = surrounding_times(
        apart.select("vod_id", F.col("_cs").alias("t")), clips.select("vod_id", F.col("_ms").alias("t"))
    )
    by_start = clips.groupBy("vod_id", "_ms").agg(F.min_by(F.struct("_mpos", "clip_id"), "_mpos").alias("clip"))
    options = near.select("vod_id", F.col("t").alias("_cs"), F.explode(F.array("prev_mark", "next_mark")).alias("_ms"))
    nearest = (
        options.where(F.col("_ms").isNotNull())
        .join(by_start, ["vod_id", "_ms"])
        .groupBy("vod_id", "_cs")
        .agg(
            F.min_by(
                F.struct(F.col("clip.clip_id").alias("clip_id"), F.lit(0).cast("bigint").alias("overlap")),
                F.struct(F.abs(F.col("_cs") - F.col("_ms")), F.col("clip._mpos")),
            ).alias("best")
        )
    )
    found = touching.unionByName(apart.join(nearest, ["vod_id", "_cs"]).select("vod_id", "_cs", "_ce", "best"))
    keyed = candidates.withColumn("_cs", F.col("start_s")).withColumn("_ce", end())
    return (
        keyed.join(found, ["vod_id", "_cs", "_ce"], "left")
        .withColumn("manifest_clip_id", F.col("best.clip_id"))
        .withColumn("overlap_s", F.col("best.overlap"))
        .drop("_cs", "_ce", "best")
    )


def triage_chunks(
    videos: DataFrame, segments: DataFrame, messages: DataFrame, *, chunk_seconds: int = 600, overlap_seconds: int = 60
) -> DataFrame:
    """Overlapping chunks with their line and message counts, densities per minute
    and the chat-spike flag (5 messages, or 4 per minute).

    ``videos``: vod_id, vod_start, vod_end.  Rows are counted per second first.
    """
    chunks = overlapping_chunks(videos, chunk_seconds=chunk_seconds, overlap_seconds=overlap_seconds).select(
        "vod_id", "chunk_index", "chunk_start", "chunk_end"
    )
    per_second = (
        segments.select("vod_id", F.col("start_s").cast("bigint").alias("t"), F.lit(1).alias("l"), F.lit(0).alias("m"))
        .unionAll(messages.select("vod_id", F.col("t").cast("bigint").alias("t"), F.lit(0), F.lit(1)))
        .groupBy("vod_id", "t")
        .agg(F.sum("l").alias("l"), F.sum("m").alias("m"))
    )
    key = ["vod_id", "chunk_index", "chunk_start", "chunk_end"]
    hits = point_join(
        per_second, chunks, bucket=chunk_seconds, at="t", span=("chunk_start", "chunk_end"), closed=False
    ).select(*key, "l", "m")
    zero = F.lit(0).cast("bigint")
    counted = (
        hits.unionAll(chunks.select(*key, zero.alias("l"), zero.alias("m")))
        .groupBy(*key)
        .agg(F.sum("l").alias("transcript_count"), F.sum("m").alias("chat_count"))
    )
    minutes = F.greatest(F.lit(1), F.col("chunk_end") - F.col("chunk_start")) / 60.0
    return (
        counted.withColumn("transcript_density_per_min", round_half_even(F.col("transcript_count") / minutes, 6))
        .withColumn("chat_density_per_min", round_half_even(F.col("chat_count") / minutes, 6))
        .withColumn("has_chat_spike", (F.col("chat_count") >= 5) | (F.col("chat_density_per_min") >= 4.0))
    )


def chunk_manifest_starts(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Distinct sorted starts of the manifest clips that overlap each chunk.

    The list is bounded by the whole seconds a chunk and its clips span.
    """
    clips = _manifest_clips(manifest).select(
        "vod_id", F.col("start_s").alias("_ms"), F.col("end_s").alias("_me")
    ).distinct()
    key = ["vod_id", "chunk_index"]
    starts = (
        overlap_join(
            chunks.select(*key, "chunk_start", "chunk_end"), clips, bucket=600,
            left_span=("chunk_start", "chunk_end"), right_span=("_ms", "_me"),
        )
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("_ms")).alias("manifest_candidate_starts"))
    )
    empty = F.array().cast("array<bigint>")
    return chunks.join(starts, key, "left").withColumn(
        "manifest_candidate_starts", F.coalesce("manifest_candidate_starts", empty)
    ).withColumn("manifest_candidate_count", F.size("manifest_candidate_starts"))
