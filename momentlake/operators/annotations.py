"""Annotation windows over videos, and the replies that come back for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clamp, clean_list, clean_text, round_half_even, safe_double, safe_int
from ..runtime import checkpointed
from .intervals import overlap_join
from .triage import TOP_REASON, normalise_candidates

# Identifier format and event vocabularies.
WINDOW_ID_FORMAT = "gemma_%07d_%07d"
AUDIO_SIGNALS = ("donation_alert", "tts_alert", "laugh", "game_audio", "music", "non_streamer_speech")
VISUAL_SIGNALS = ("visual_payoff", "scene_change", "streamer_visible", "face_visible", "gameplay_event")
ALERT_SOUNDS = ("donation_alert", "tts_alert", "laugh")
REACTIONS = ("laughing", "surprised", "focused", "visual_payoff")


def _windows_over(spans: DataFrame, window_seconds: int, stride_seconds: int) -> DataFrame:
    """Sliding windows over ``[lo, hi)`` spans; the last one ends at ``hi``."""
    w, s = max(1, int(window_seconds)), max(1, int(stride_seconds))
    length = F.col("_hi") - F.col("_lo")
    last = F.least(F.greatest(F.lit(0), F.ceil((length - w) / s)), F.ceil(length / s) - 1)
    return (
        spans.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
        .withColumn("start_s", F.col("_lo") + F.col("_i") * s)
        .withColumn("end_s", F.least(F.col("start_s") + w, F.col("_hi")))
    )


def annotation_windows(
    chunks: DataFrame, manifest: DataFrame, *, window_seconds: int = 30, stride_seconds: int = 30, max_windows: int = 0
) -> DataFrame:
    """Windows to annotate: over every manifest clip, then over chunks with a chat
    spike.  Equal bounds are kept once, manifest first.

    Coverage windows over single manifest clips would repeat bounds that are
    there already, so they never add a row.
    """
    ms = F.greatest(F.lit(0), F.col("start_s").cast("bigint"))
    clips = manifest.select(
        "vod_id",
        F.lit(0).alias("_prio"),
        F.col("clip_id").cast("string").alias("manifest_clip_id"),
        F.lit(None).cast("bigint").alias("chunk_index"),
        F.lit("manifest_backed").alias("source"),
        F.struct(
            F.col("start_s").cast("bigint").alias("a"), F.col("end_s").cast("bigint").alias("b"),
            F.col("clip_id").cast("string").alias("c"),
        ).alias("_order"),
        ms.cast("bigint").alias("_lo"),
        F.greatest(ms + 1, F.col("end_s").cast("bigint")).cast("bigint").alias("_hi"),
    )
    busy = chunks.where("has_chat_spike").select(
        "vod_id",
        F.lit(1).alias("_prio"),
        F.lit(None).cast("string").alias("manifest_clip_id"),
        F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.lit("chat_spike").alias("source"),
        F.struct(
            F.col("chunk_index").cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit("").alias("c")
        ).alias("_order"),
        F.col("chunk_start").alias("_lo"),
        F.greatest(F.col("chunk_start") + 1, F.col("chunk_end")).alias("_hi"),
    )
    windows = (
        _windows_over(clips.unionByName(busy), window_seconds, stride_seconds)
        .groupBy("vod_id", "start_s", "end_s")
        .agg(
            F.min_by(F.struct("source", "manifest_clip_id", "chunk_index"), F.struct("_prio", "_order", "_i")).alias("o")
        )
        .select(
            "vod_id", F.format_string(WINDOW_ID_FORMAT, "start_s", "end_s").alias("window_id"), "start_s", "end_s", "o.*"
        )
    )
    if max_windows <= 0:
        return windows
    order = Window.partitionBy("vod_id").orderBy(
        "start_s", "end_s", "source", F.coalesce("manifest_clip_id", F.lit("")), F.coalesce("chunk_index", F.lit(-1))
    )
    return windows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max_windows).drop("_rank")


def normalise_annotations(raw: DataFrame) -> DataFrame:
    """Repairs annotation replies.

    ``raw``: vod_id, pos, start_s, end_s (bigint) of the window, window_id,
    audio_events and visual_events (arrays of text structs timestamp, type,
    confidence, evidence, speaker_guess), speaker and emotion fields as text,
    risk_flags, clip_relevance_notes, parse_ok (boolean), error.
    """
    start = F.col("start_s")
    end = F.when(F.col("end_s") > start, F.col("end_s")).otherwise(start + 1)
    unit = lambda c: clamp(safe_double(c), 0, 1)

    def event(e: Column, with_speaker: bool) -> Column:
        stamp = F.when(e["timestamp"].isNull(), start).otherwise(
            F.greatest(start, F.least(end, safe_int(e["timestamp"], start)))
        )
        fields = [
            stamp.alias("timestamp"),
            F.lower(clean_text(e["type"], "unknown")).alias("type"),
            round_half_even(unit(e["confidence"]), 4).alias("confidence"),
            clean_text(e["evidence"], "").alias("evidence"),
        ]
        if with_speaker:
            fields.append(F.lower(clean_text(e["speaker_guess"], "unknown")).alias("speaker_guess"))
        return F.struct(*fields)

    def events(name: str, with_speaker: bool) -> Column:
        present = F.filter(name, lambda e: e.isNotNull())
        return F.coalesce(F.transform(present, lambda e: event(e, with_speaker)), F.array())

    notes = F.transform(
        F.filter("clip_relevance_notes", lambda n: F.length(F.trim(n)) > 0),
        lambda n: clean_text(n, ""),
    )
    return raw.select(
        "vod_id",
        "pos",
        clean_text("window_id", F.format_string(WINDOW_ID_FORMAT, start, end)).alias("window_id"),
        "start_s",
        end.alias("end_s"),
        events("audio_events", True).alias("audio_events"),
        events("visual_events", False).alias("visual_events"),
        clean_text("primary_speaker", "unknown").alias("primary_speaker"),
        unit("streamer_led_likelihood").alias("streamer_led_likelihood"),
        F.coalesce("non_streamer_voice_present", F.lit(False)).alias("non_streamer_voice_present"),
        clean_text("non_streamer_voice_type", "unknown").alias("non_streamer_voice_type"),
        clean_text("streamer_affect", "unknown").alias("streamer_affect"),
        unit("organic_reaction_likelihood").alias("organic_reaction_likelihood"),
        unit("transactional_alert_likelihood").alias("transactional_alert_likelihood"),
        clean_text("emotion_evidence", "").alias("emotion_evidence"),
        F.coalesce(notes, F.array().cast("array<string>")).alias("clip_relevance_notes"),
        clean_list("risk_flags").alias("risk_flags"),
        F.coalesce("parse_ok", F.coalesce("error", F.lit("")) == "").alias("parse_ok"),
        "error",
    )


def windows_in(spans: DataFrame, annotations: DataFrame, *, closed: bool = False) -> DataFrame:
    """Annotations that overlap each span ``(vod_id, span_id, lo, hi)``; with
    ``closed`` also those that only touch it.

    Any number of annotations may share a window, so those of a busy bucket are spread by ``pos``.
    """
    windows = annotations.select(
        "vod_id",
        F.col("start_s").alias("_ws"),
        F.col("end_s").alias("_we"),
        F.col("pos").alias("_p"),
        F.struct(*[c for c in annotations.columns if c != "vod_id"]).alias("ann"),
    )
    return overlap_join(
        spans.select("vod_id", "span_id", "lo", "hi"), windows, bucket=600, left_span=("lo", "hi"),
        right_span=("_ws", "_we"), closed=closed, spread_right_by=["_p"],
    ).select("vod_id", "span_id", "ann")


def signal_counts(pairs: DataFrame) -> DataFrame:
    """Counts per span of each audio event type, visual event type and risk flag,
    with the place of the first one.  One pass: the signals of an annotation are
    one list."""

    def named(kind: str, types: Column) -> Column:
        return F.transform(types, lambda t, i: F.struct(F.lit(kind).alias("kind"), t.alias("type"), i.alias("i")))

    typed = lambda name: F.transform(name, lambda e: clean_text(e["type"], "unknown"))
    signals = F.concat(
        named("audio", typed("ann.audio_events")),
        named("visual", typed("ann.visual_events")),
        F.filter(named("risk", F.transform("ann.risk_flags", lambda t: F.trim(t))), lambda s: s["type"] != ""),
    )
    return (
        pairs.select("vod_id", "span_id", F.col("ann.pos").alias("pos"), F.explode(signals).alias("s"))
        .groupBy("vod_id", "span_id", F.col("s.kind").alias("kind"), F.col("s.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "s.i")).alias("first_seen"))
    )


def _first_order(rows: DataFrame, key: list[str], out: str) -> DataFrame:
    """The distinct items of each key as a list in the order of their first ``ord``."""
    distinct = rows.groupBy(*key, "item").agg(F.min("ord").alias("ord"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "item")))
    return distinct.groupBy(*key).agg(F.transform(listed, lambda x: x["item"]).alias(out))


def signal_summary(pairs: DataFrame) -> DataFrame:
    """One row per span with annotations: totals, largest likelihoods, alert and
    reaction flags, and the distinct references and evidence lines in order.

    Flags are taken from the event lists of each annotation; only the events
    that count as evidence become rows.  References and lines are made distinct
    before they are gathered: their number is bounded by the windows, seconds
    and event types of a span, however many annotations there are.
    """
    key = ["vod_id", "span_id"]
    any_event = lambda kind, types: F.exists(
        f"ann.{kind}_events", lambda e: clean_text(e["type"], "unknown").isin(*types)
    )
    refs = _first_order(pairs.select(*key, F.col("ann.window_id").alias("item"), F.struct("ann.pos").alias("ord")), key, "annotation_refs")
    totals = pairs.groupBy(*key).agg(
        F.count(F.lit(1)).alias("annotation_count"),
        F.count_if(~F.col("ann.parse_ok")).alias("parse_failures"),
        *[
            round_half_even(F.max(f"ann.{c}"), 4).alias(c)
            for c in ("streamer_led_likelihood", "transactional_alert_likelihood", "organic_reaction_likelihood")
        ],
        F.max(any_event("audio", ALERT_SOUNDS)).alias("has_audio_alert"),
        F.max(any_event("visual", REACTIONS)).alias("has_visual_reaction"),
    )

    def telling(kind: str, rank: int, types: tuple[str, ...]) -> Column:
        rows = F.transform(
            f"ann.{kind}_events",
            lambda e, i: F.struct(
                F.col("ann.pos").alias("pos"), F.lit(rank).alias("k"), i.alias("i"),
                clean_text(e["type"], "unknown").alias("type"), e["timestamp"].alias("t"),
            ),
        )
        hits = F.filter(rows, lambda r: r["type"].isin(*types))
        return F.transform(
            hits,
            lambda r: F.struct(
                F.concat(F.lit(f"{kind}:"), r["type"], F.lit("@"), r["t"].cast("string")).alias("line"),
                F.struct(r["pos"].alias("pos"), r["k"].alias("k"), r["i"].alias("i")).alias("ord"),
            ),
        )

    found = F.concat(telling("audio", 0, AUDIO_SIGNALS), telling("visual", 1, VISUAL_SIGNALS))
    lines = _first_order(
        pairs.select(*key, F.explode(found).alias("e")).select(*key, F.col("e.line").alias("item"), F.col("e.ord").alias("ord")),
        key, "evidence_lines",
    )
    return (
        totals.join(refs, key, "left")
        .join(lines, key, "left")
        .fillna(False, ["has_audio_alert", "has_visual_reaction"])
        .withColumn("evidence_lines", F.coalesce("evidence_lines", F.array().cast("array<string>")))
    )


def chunk_annotations(chunks: DataFrame, annotations: DataFrame) -> DataFrame:
    """Chunks with the references, notes and summary of the annotations that overlap them."""
    spans = chunks.select(
        "vod_id", F.col("chunk_index").alias("span_id"), F.col("chunk_start").alias("lo"), F.col("chunk_end").alias("hi")
    )
    pairs = windows_in(spans, annotations)
    key = ["vod_id", "span_id"]
    noted = pairs.select(*key, F.col("ann.pos").alias("p"), F.posexplode("ann.clip_relevance_notes").alias("i", "item"))
    notes = _first_order(noted.select(*key, "item", F.struct("p", "i").alias("ord")), key, "notes")
    found = signal_summary(pairs).join(notes, key, "left")
    none = F.array().cast("array<string>")
    return (
        chunks.withColumn("span_id", F.col("chunk_index"))
        .join(found, ["vod_id", "span_id"], "left")
        .drop("span_id")
        .fillna(0, ["annotation_count", "parse_failures"])
        .fillna(0.0, ["streamer_led_likelihood", "transactional_alert_likelihood", "organic_reaction_likelihood"])
        .fillna(False, ["has_audio_alert", "has_visual_reaction"])
        .withColumn("annotation_refs", F.coalesce("annotation_refs", none))
        .withColumn("notes", F.coalesce("notes", none))
        .withColumn("evidence_lines", F.coalesce("evidence_lines", none))
    )


def _same_windows(spans: DataFrame, annotations: DataFrame) -> DataFrame:
    """Adds ``span_id`` to each distinct span ``(vod_id, lo, hi)`` that touches a window: the first
    (lo, hi) of those that touch the same windows, and so have the same summary."""
    windows = annotations.select("vod_id", F.col("start_s").alias("_ws"), F.col("end_s").alias("_we")).distinct()
    touched = (
        overlap_join(spans, windows, bucket=600, left_span=("lo", "hi"), right_span=("_ws", "_we"), closed=True)
        .groupBy("vod_id", "lo", "hi")
        .agg(F.array_sort(F.collect_list(F.struct("_ws", "_we"))).alias("_windows"))
    )
    first = touched.groupBy("vod_id", "_windows").agg(F.min(F.struct("lo", "hi")).alias("span_id"))
    return checkpointed(touched.join(first, ["vod_id", "_windows"]).select("vod_id", "lo", "hi", "span_id"))


def fallback_candidates(clips: DataFrame, annotations: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Triage candidates made from clips and their annotations.

    Used for videos that have none in ``known``.  ``clips``: vod_id, pos,
    start_s, end_s, optional trim_start, trim_end, narrative_type, trigger, payoff, risk_flags.

    Annotations are summed up once for all clips that touch the same windows.
    """
    if known is not None:
        clips = clips.join(known.select("vod_id").distinct(), "vod_id", "left_anti")
    same = _same_windows(
        clips.select("vod_id", F.col("start_s").alias("lo"), F.col("end_s").alias("hi")).distinct(), annotations
    )
    alike = same.groupBy("vod_id", "span_id").agg(F.first("span_id.lo").alias("lo"), F.first("span_id.hi").alias("hi"))
    pairs = windows_in(alike, annotations, closed=True)
    risk = (
        signal_counts(pairs)
        .where(F.col("kind") == "risk")
        .groupBy("vod_id", "span_id")
        .agg(F.array_sort(F.collect_list(F.struct("first_seen", "type"))).alias("_r"))
        .select("vod_id", "span_id", F.col("_r.type").alias("_risks"))
    )
    summary = signal_summary(pairs).join(risk, ["vod_id", "span_id"], "left")
    placed = clips.join(same.withColumnsRenamed({"lo": "start_s", "hi": "end_s"}), ["vod_id", "start_s", "end_s"], "left")
    c = placed.join(summary, ["vod_id", "span_id"], "left")
    alert = F.coalesce("has_audio_alert", F.lit(False))
    reaction = F.coalesce("has_visual_reaction", F.lit(False))
    led = F.coalesce("streamer_led_likelihood", F.lit(0.0))
    paid = F.coalesce("transactional_alert_likelihood", F.lit(0.0))
    none = F.array().cast("array<string>")
    lines = F.coalesce("evidence_lines", none)
    evidence = F.concat(
        F.array(F.format_string("[%ds] clip window %d-%ds", "start_s", "start_s", "end_s")),
        lines,
        F.array_compact(
            F.array(
                F.when(alert, "gemma_audio_alert"),
                F.when(reaction, "gemma_visual_reaction"),
                F.when(led >= 0.6, "streamer_led_likelihood_high"),
                F.when(paid >= 0.6, "transactional_alert_likelihood_high"),
            )
        ),
    )
    score = F.least(
        F.lit(10.0),
        1.0 + F.when(alert, 2.5).otherwise(0.0) + F.when(reaction, 2.0).otherwise(0.0) + led * 2.0 + paid * 1.5,
    )
    confidence = F.least(F.lit(1.0), F.lit(0.35) + F.size(lines) * 0.1)

    def given(name: str) -> Column:
        return F.col(name).cast("string") if name in clips.columns else F.lit(None).cast("string")

    reasons = F.array_compact(
        F.array(
            F.lit(TOP_REASON),
            F.when(alert, "gemma_audio_alert_or_laughter"),
            F.when(reaction, "gemma_visual_reaction"),
        )
    )
    own_risks = F.coalesce("risk_flags", none) if "risk_flags" in clips.columns else none
    raw = c.select(
        "vod_id",
        "pos",
        F.col("start_s").alias("fallback_start"),
        F.col("end_s").alias("fallback_end"),
        F.col("start_s").cast("string").alias("start"),
        F.col("end_s").cast("string").alias("end"),
        F.coalesce(given("trim_start"), F.col("start_s").cast("string")).alias("trim_start"),
        F.coalesce(given("trim_end"), F.col("end_s").cast("string")).alias("trim_end"),
        score.cast("string").alias("triage_score"),
        confidence.cast("string").alias("triage_confidence"),
        F.concat(F.lit("triage_"), F.col("start_s").cast("string")).alias("candidate_id"),
        given("narrative_type").alias("narrative_type"),
        given("trigger").alias("trigger"),
        given("payoff").alias("payoff"),
        F.when(alert | reaction, "critical").otherwise("verify_expression").alias("vision_need"),
        evidence.alias("evidence_lines"),
        F.concat(own_risks, F.coalesce("_risks", none)).alias("risk_flags"),
        reasons.alias("selection_reasons"),
        F.coalesce("annotation_refs", none).alias("annotation_refs"),
    )
    return normalise_candidates(raw)
