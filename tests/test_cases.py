"""Small worked examples with hand-computed results."""

import json

import pytest
from pyspark.sql import functions as F

from momentlake.functions import names, scalars, text, titles
from momentlake.operators import (
    annotations,
    chat,
    context,
    frames,
    fusion,
    games,
    intervals,
    manifest,
    profiles,
    prompts,
    quality,
    scoring,
    selection,
    speakers,
    stitching,
    triage,
    trim,
)
from momentlake.plans.moments import ranked_moments
from momentlake.plans.prepare import prepare
from momentlake.runtime import checkpointed, salted_lookup
from momentlake.sources import chat as chat_source
from momentlake.sources import documents, logs, replies
from momentlake.streaming.chat import chat_stream, message_counts
from momentlake.streaming.moments import run_islands


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


CHAT = "vod_id bigint, pos bigint, t double, usr string, message string, emotes array<string>"
LINES = "vod_id bigint, pos bigint, start_s double, end_s double, text string, speaker_label string"


# Chat


def test_activity_windows_skip_empty_ones_and_the_last_edge(spark):
    df = spark.createDataFrame(
        [(1, 0, 1.0, "a", "", ["x", "y"]), (1, 1, 2.0, "a", "", ["y", "x"]), (1, 2, 29.0, "b", "", None), (1, 3, 90.0, "c", "", ["z"])],
        CHAT,
    )
    out = rows(chat.activity_windows(df), "window_start", "message_count", "unique_users", "peak_emote", "peak_emote_count")
    # Two uses each of x and y: x came first.  The message at 90 starts a window that is never opened.
    assert out == [(0, 3, 2, "x", 2)]


def test_all_messages_at_zero_give_no_window(spark):
    df = spark.createDataFrame([(1, 0, 0.0, "a", "", None)], CHAT)
    assert chat.activity_windows(df).count() == 0


def test_totals_are_zero_for_silent_videos(spark):
    df = spark.createDataFrame([(1, 0, 0.0, "a", "", ["x"])], CHAT)
    videos = spark.createDataFrame([(1,), (2,)], "vod_id bigint")
    out = rows(chat.totals(df, videos), "vod_id", "total_messages", "unique_chatters", "total_emotes")
    assert out == [(1, 1, 1, 1), (2, 0, 0, 0)]


def test_spike_counts_silent_bins(spark):
    messages = [(1, i, 100.0, "a", "", None) for i in range(25)] + [(1, 25, 199.0, "b", "", None)]
    out = chat.spikes(spark.createDataFrame(messages, CHAT)).collect()
    assert [(r.start_s, r.end_s, r.message_count) for r in out] == [(100, 110, 25)]
    assert out[0].intensity == pytest.approx((25 - 26 / 20) / ((626 / 20 - (26 / 20) ** 2) ** 0.5))


# Fusion


def test_excitement_points(spark):
    texts = ["LETS GO!!!", "NO WAY", "a calm and rather long sentence", "ok...", "GO"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    out = [r.x for r in df.select(fusion.excitement(F.col("text")).alias("x")).collect()]
    assert out == [45, 30, 0, 25, 10]


def test_ranked_moments_merge_spike_and_line(spark):
    messages = [(1, i, 100.0, "a", "", None) for i in range(25)] + [(1, 25, 199.0, "b", "", None)]
    lines = [(1, 0, 108.0, 112.0, "LETS GO!!!", "S"), (1, 1, 150.0, 152.0, "WHAT NOW", "S")]
    out = ranked_moments(spark.createDataFrame(messages, CHAT), spark.createDataFrame(lines, LINES)).collect()
    merged = next(r for r in out if r.start_s == 100)
    assert (merged.end_s, merged.signals, merged.members) == (112, ["chat_spike", "voice_excitement"], 2)
    assert {r["rank"] for r in out} == {1, 2}


# Manifest


def test_manifest_scores_speech_chat_and_objects(spark):
    windows = spark.createDataFrame([(1, 0, 0.0, 10.0), (1, 1, 10.0, 12.0)], "vod_id bigint, window_index bigint, start_s double, end_s double")
    lines = spark.createDataFrame([(1, 0, 0.0, 5.0, "hello", "S"), (1, 1, 6.0, 9.0, "  ", "S")], LINES)
    points = spark.createDataFrame([(1, 0, 0.0, 9.0), (1, 1, 4.0, 0.5), (1, 2, 10.0, 1.5)], "vod_id bigint, pos bigint, t double, chat_intensity double")
    seen = spark.createDataFrame([(1, 2, "Person"), (1, 3, "person"), (1, 3, "rock")], "vod_id bigint, second_s bigint, class_name string")
    out = manifest.clip_manifest(windows, lines, points, seen).orderBy("start_s").collect()
    # Speech 5/10; chat mean of 0.5 and 1 (the point at 0 does not count, 10 is on the edge); a person.
    assert out[0].score == pytest.approx(1 + 1.5 + 2.25 + 0.8)
    assert (out[0].objects_detected, out[0].label, out[0].title) == (["person", "rock"], "highlight", "Highlight clip 1")
    assert out[1].score == 4.0 and not out[1].has_speech and out[1].label == "context"


def test_manifest_uses_hints_without_transcript(spark):
    windows = spark.createDataFrame([(1, 0, 0.0, 10.0, 0.5)], "vod_id bigint, window_index bigint, start_s double, end_s double, hint double")
    none = spark.createDataFrame([], LINES)
    points = spark.createDataFrame([], "vod_id bigint, pos bigint, t double, chat_intensity double")
    seen = spark.createDataFrame([], "vod_id bigint, second_s bigint, class_name string")
    out = manifest.clip_manifest(windows, none, points, seen, speech_hint=F.col("hint")).first()
    assert (out.score, out.has_speech) == (2.5, True)


def test_window_generators(spark):
    video = spark.createDataFrame([(1, 95.0)], "vod_id bigint, duration_s double")
    assert rows(intervals.sliding_windows(video, 30, 30), "start_s", "end_s") == [(0, 30), (30, 60), (60, 90), (90, 95)]
    assert rows(intervals.coverage_windows(video, 30, 30), "start_s", "end_s") == [(0, 30), (30, 60), (60, 90), (65, 95)]
    span = spark.createDataFrame([(1, 0, 1300)], "vod_id bigint, vod_start bigint, vod_end bigint")
    assert rows(intervals.overlapping_chunks(span), "chunk_start", "chunk_end") == [(0, 600), (540, 1140), (1080, 1300)]


# Context


def test_dead_air_of_seventeen_seconds(spark):
    lines = spark.createDataFrame([(1, 0, 90.0, 95.0, "hey chat", "S"), (1, 1, 112.0, 118.0, "back", "S")], LINES)
    clips = context.clip_bounds(spark.createDataFrame([(1, "c", 100.0)], "vod_id bigint, clip_id string, t double"), "t", 20)
    out = context.dead_air(clips, lines).first()
    assert out.total_dead_air_seconds == 17.0 and out.dead_air_ratio == 17 / 40
    assert [tuple(g) for g in out.dead_air_gaps] == [(95.0, 112.0, 17.0)]


def test_read_aloud_by_prefix_and_by_words(spark):
    lines = spark.createDataFrame(
        [(1, 0, 0.0, 5.0, "she says I met the red race car", "S"), (1, 1, 5.0, 9.0, "owner at a local cafe", "S")], LINES
    )
    messages = spark.createDataFrame(
        [(1, 0, 1.0, "a", "I met the red race car owner at a local cafe yesterday", None),
         (1, 1, 2.0, "b", "yesterday my cafe owner met local people", None),
         (1, 2, 2.0, "c", "nothing of this sort was ever said here", None),
         (1, 3, 2.0, "d", "car owner", None)], CHAT,
    )
    clips = context.clip_bounds(spark.createDataFrame([(1, "c", 3.0)], "vod_id bigint, clip_id string, t double"), "t", 20)
    assert rows(context.read_aloud(clips, lines, messages), "usr") == [("a",), ("b",)]


def test_speaker_stats(spark):
    turns = spark.createDataFrame(
        [(1, 0, 0.0, 10.0, "S0", "Streamer", None, 0.9), (1, 1, 10.0, 30.0, "S1", "guest", "Robin", 0.5), (1, 2, 30.0, 31.0, "", None, None, None)],
        "vod_id bigint, pos bigint, start_s double, end_s double, speaker_label string, identity string, inferred_name string, confidence double",
    )
    clips = spark.createDataFrame([(1, "c", 0.0, 40.0), (1, "d", 100.0, 101.0)], "vod_id bigint, clip_id string, lo double, hi double")
    out = {r.clip_id: r for r in context.speaker_stats(clips, turns).collect()}
    c = out["c"]
    assert (c.primary_speaker_label, c.primary_speaker_identity, c.primary_speaker_name) == ("S1", "guest", "Robin")
    assert (c.streamer_speaking_seconds, c.streamer_speaking_ratio, c.streamer_speaking_confidence) == (10.0, 0.25, 0.9)
    assert c.off_streamer_voice_detected and out["d"].primary_speaker_label is None


# Scoring

_ANALYSIS = (
    "vod_id bigint, start_s bigint, end_s bigint, clip_worthiness double, trim_start bigint, trim_end bigint, has_payoff boolean, "
    "requires_context boolean, transactional boolean, narrative_arc string, trim_reason string, platform_scores map<string,double>, "
    "platform_recommendations array<string>, suggested_penalties array<double>, dead_air_gaps array<struct<start:double,end:double,duration:double>>, "
    "dead_air_ratio double, audio_dead_air boolean, music_only boolean, trim_source string"
)


def _scored(spark, **changes):
    base = dict(
        vod_id=1, start_s=100, end_s=220, clip_worthiness=9.0, trim_start=120, trim_end=160, has_payoff=True,
        requires_context=False, transactional=False, narrative_arc=None, trim_reason=None,
        platform_scores={"tiktok": 7.0, "twitch": 8.0}, platform_recommendations=["twitch"], suggested_penalties=[],
        dead_air_gaps=[], dead_air_ratio=0.0, audio_dead_air=None, music_only=None, trim_source=None,
    )
    base.update(changes)
    return scoring.score_clips(spark.createDataFrame([tuple(base.values())], _ANALYSIS)).first()


def test_clean_clip_is_eligible(spark):
    out = _scored(spark)
    assert (out.final_score, out.eligible, out.rejection_reasons, out.trim_source) == (9.0, True, [], "qwen")


@pytest.mark.parametrize(
    "changes,score,reasons",
    [
        (dict(dead_air_gaps=[(165.0, 190.0, 25.0)]), 6.0, []),
        (dict(dead_air_gaps=[(150.0, 158.0, 8.0)]), 3.0, ["dead_air_inside_trim"]),
        (dict(dead_air_ratio=0.31), 5.0, []),
        (dict(has_payoff=False), 5.0, ["no_narrative_payoff"]),
        (dict(requires_context=True), 7.5, []),
        (dict(transactional=True, narrative_arc="too short"), 4.0, ["transactional_without_narrative_arc"]),
        (dict(trim_start=100, trim_end=220), 5.0, ["full_window_unresolved"]),
        (dict(platform_recommendations=["reels"]), 9.0, ["platform_recommendation_invalid"]),
        (dict(trim_start=90, trim_end=150), 8.5, []),
        (dict(trim_start=230, trim_end=250), 9.0, ["trim_out_of_bounds"]),
        (dict(suggested_penalties=[-2.0, 1.5, None]), 5.5, []),
        (dict(audio_dead_air=True, music_only=True), 8.0, []),
        (dict(trim_start=120, trim_end=190), 8.0, []),
    ],
)
def test_scoring_rules(spark, changes, score, reasons):
    out = _scored(spark, **changes)
    assert out.final_score == score and out.rejection_reasons == reasons
    assert out.eligible == (not reasons)


def test_text_flag_false_is_truthy(spark):
    assert one(spark, scalars.truthy_text(F.lit("false"))) and not one(spark, scalars.truthy_text(F.lit("")))


def test_null_signal_is_zero(spark):
    assert one(spark, scalars.number_signal(F.lit(None), 10)) == 0.0
    assert one(spark, scalars.number_signal(F.lit(5), 10)) == 0.5


@pytest.mark.parametrize("value,digits,want", [(0.125, 2, 0.12), (0.375, 2, 0.38), (1.005, 2, 1.0), (2.5, 0, 2.0)])
def test_rounding_is_half_even(spark, value, digits, want):
    assert one(spark, scalars.round_half_even(F.lit(value), digits)) == want


def test_loudest_passage(spark):
    loud = [0.1] * 50 + [0.9] * 20 + [0.1] * 50
    point = [0.1] * 60 + [1.0] + [0.1] * 59
    df = spark.createDataFrame(
        [(1, "loud", 0, 120, 0, 120, loud), (1, "peak", 0, 120, 0, 120, point), (1, "none", 1000, 1120, 1000, 1120, None),
         (1, "short", 0, 120, 0, 120, [0.5] * 10), (1, "cut", 0, 120, 10, 50, loud)],
        "vod_id bigint, clip_id string, start_s bigint, end_s bigint, trim_start bigint, trim_end bigint, energies array<double>",
    )
    out = {r.clip_id: (r.trim_start, r.trim_end, r.trim_source) for r in trim.loudest_passage(df).collect()}
    assert out["loud"] == (50, 70, "rms_fallback")
    assert out["peak"] == (53, 68, "rms_fallback")  # one second, padded to 15
    assert out["none"] == (1038, 1083, "rms_fallback")
    assert out["short"] == (0, 120, "qwen") and out["cut"] == (10, 50, "qwen")


# Triage


@pytest.mark.parametrize("total,ratio,want", [(200, 0.2, 40), (300, 0.4, 50), (10, 0.2, 10), (0, 0.2, 0)])
def test_review_budget(spark, total, ratio, want):
    assert one(spark, triage.review_budget(F.lit(total), ratio, 25, 50)) == want


def test_malformed_candidate_is_repaired(spark):
    schema = (
        "vod_id bigint, pos bigint, fallback_start bigint, fallback_end bigint, start string, end string, trim_start string, "
        "trim_end string, triage_score string, triage_confidence string, candidate_id string, narrative_type string, trigger string, "
        "payoff string, vision_need string, evidence_lines array<string>, risk_flags array<string>, selection_reasons array<string>, "
        "annotation_refs array<string>"
    )
    raw = [(1, 0, 1234, 1294, "bad", None, None, None, "not-a-number", None, None, None, None, None, None, None, None, None, None)]
    out = triage.normalise_candidates(spark.createDataFrame(raw, schema)).first()
    assert (out.candidate_id, out.start_s, out.end_s, out.trim_start, out.trim_end) == ("triage_1234_1294", 1234, 1294, 1234, 1294)
    assert (out.narrative_type, out.triage_score, out.triage_confidence, out.vision_need) == ("other", 0.0, 0.0, "none")
    assert out.evidence_lines == ["[1234s] triage candidate from 1234s to 1294s"]


def test_annotation_windows_of_a_tail_clip(spark):
    clip = spark.createDataFrame([(1, "clip_tail", 0, 95)], "vod_id bigint, clip_id string, start_s bigint, end_s bigint")
    chunks = spark.createDataFrame([(1, 0, 0, 60, True)], "vod_id bigint, chunk_index bigint, chunk_start bigint, chunk_end bigint, has_chat_spike boolean")
    out = annotations.annotation_windows(chunks, clip)
    assert rows(out, "start_s", "end_s", "source") == [
        (0, 30, "manifest_backed"), (30, 60, "manifest_backed"), (60, 90, "manifest_backed"), (90, 95, "manifest_backed")
    ]
    assert rows(annotations.annotation_windows(chunks, clip, max_windows=2), "window_id") == [
        ("gemma_0000000_0000030",), ("gemma_0000030_0000060",)
    ]


def test_fallback_skips_videos_with_candidates(spark):
    clips = spark.createDataFrame([(1, 0, 0, 30), (2, 1, 0, 30)], "vod_id bigint, pos bigint, start_s bigint, end_s bigint")
    event = "array<struct<timestamp:string,type:string,confidence:string,evidence:string,speaker_guess:string>>"
    raw = spark.createDataFrame(
        [(2, 0, 30, 60, None, [("31", "Laugh", "1", "", "")], None, None, "0.7", None, None, None, "0", "0.1", None, [], [" risky"], None, None)],
        "vod_id bigint, pos bigint, start_s bigint, end_s bigint, window_id string, "
        f"audio_events {event}, visual_events {event}, primary_speaker string, streamer_led_likelihood string, "
        "non_streamer_voice_present boolean, non_streamer_voice_type string, streamer_affect string, organic_reaction_likelihood string, "
        "transactional_alert_likelihood string, emotion_evidence string, clip_relevance_notes array<string>, risk_flags array<string>, "
        "parse_ok boolean, error string",
    )
    known = spark.createDataFrame([(1,)], "vod_id bigint")
    out = annotations.fallback_candidates(clips, annotations.normalise_annotations(raw), known).collect()
    # The window only touches the clip's end, which counts here.
    assert [(r.vod_id, r.triage_score, r.vision_need, r.risk_flags) for r in out] == [(2, pytest.approx(1 + 2.5 + 1.4 + 0.15), "critical", ["risky"])]
    assert out[0].selection_reasons == ["text_top_rank", "gemma_audio_alert_or_laughter"]


def test_nearest_frames_fill_up(spark):
    windows = spark.createDataFrame([(1, "w", 100, 110)], "vod_id bigint, window_id string, start_s bigint, end_s bigint")
    stills = spark.createDataFrame([(1, t, f"frame_{t // 5:06d}.jpg") for t in (0, 5, 105)], "vod_id bigint, t bigint, path string")
    out = frames.nearest_frames(windows, stills, 2).orderBy("turn").collect()
    assert [r.path for r in out] == ["frame_000021.jpg", "frame_000000.jpg"]
    assert one(spark, frames.frame_time(F.lit("a/frame_000012.jpg"))) == 60


# Stitching, titles, selection


def test_adjacent_story_is_stitched(spark):
    df = spark.createDataFrame(
        [(1, 0, "cand_100", 100, 180, "chat_reveal", "Donation alert fires and chat laughs", "Streamer explains the inside joke", [" [118s] sound? "], 0.72),
         (1, 1, "cand_182", 182, 260, "chat_reveal", "New chatter asks what the alert means", "Streamer gives the background", ["[204s] context"], 0.81),
         (1, 2, "cand_400", 400, 460, "other", "", "", [], 0.2)],
        "vod_id bigint, pos bigint, candidate_id string, start_s bigint, end_s bigint, narrative_type string, trigger string, "
        "payoff string, evidence_lines array<string>, confidence double",
    )
    arc, alone = stitching.stitch(df).orderBy("start_s").collect()
    assert (arc.stitched_id, arc.confidence, arc.source_candidate_ids) == ("stitched_100_260_1", 0.81, ["cand_100", "cand_182"])
    assert arc.merge_reasons[:2] == ["temporal_gap<=20", "narrative_type_match:chat_reveal"]
    assert arc.evidence_lines == ["[118s] sound?", "[204s] context"] and arc.trigger.startswith("Donation")
    assert (alone.stitched_id, alone.merge_reasons, alone.evidence_lines) == ("stitched_400_460_2", ["single_candidate"], [stitching.NO_EVIDENCE])
    assert stitching.stitch(df, max_members=1).count() == 3


def test_title_forms(spark):
    norm = one(spark, titles.normalise_title(F.lit("  The moment she REALIZED chat was right!!! ")))
    assert norm == "the moment she realized chat was right"
    guard = lambda t, who, a, b: one(spark, titles.guard_title(F.lit(t), F.lit(who), F.lit(a), F.lit(b)))
    assert guard("Streamer reads chat", "guest", 'he says "we are so back now"', "laughing fit") == 'Laughing fit: "we are so back now"'
    assert guard("Streamer reads chat", "guest", 'the sign says "keep out now"', "a scare") == 'A scare: "keep out now"'
    own = (titles.Rewrite("{trigger}: {payoff}!", trigger=("door",)), titles.Rewrite("never", payoff=("absent",)))
    rewrite = lambda a, b: one(spark, titles.rewrite_for_other_voice(F.lit("kept"), F.lit(a), F.lit(b), own))
    assert rewrite("a door opens", "a scare") == "A door opens: A scare!"
    assert rewrite("a door opens", "") == rewrite("a window", "a scare") == "kept"
    assert guard("Streamer reads chat", "guest", "streamer opens a door", "a scare") == "A scare, after: Opens a door"
    assert guard("Streamer reads chat", "streamer", "x", "y") == "Streamer reads chat"
    assert guard("A vivid title", "guest", "x", "y") == "A vivid title"


def test_topics_out_of_nested_messages(spark):
    topic = lambda *t: one(spark, titles.chat_topic(*[F.lit(x) for x in t]))
    assert topic("chat message from 'Bob' at 118s: about the streak.") == "the streak"
    assert topic("chat message about chat message from 'Ann' about  a  raid") == "a raid"
    assert topic(None, "the message | chat message | She met the owner") == "She met the owner"
    assert topic("") == topic(" . ") == "a viewer story"


def test_fallback_selection(spark):
    df = spark.createDataFrame(
        [(1, "a", 0, 2.0, False), (1, "b", 1, 2.5, False), (1, "c", 2, 1.0, False), (2, "d", 0, 5.0, True), (2, "e", 1, 2.0, True)],
        "vod_id bigint, clip_id string, pos bigint, final_score double, eligible boolean",
    )
    assert rows(selection.eligible_clips(df, fallback_top_n=2), "clip_id", "is_fallback") == [("a", True), ("b", True), ("d", False)]
    assert rows(selection.eligible_clips(df), "clip_id") == [("d",)]


# Speakers


def test_alignment_needs_thirty_percent(spark):
    lines = spark.createDataFrame([(1, 0, 0.0, 10.0, "a", None), (1, 1, 10.0, 20.0, "b", None), (1, 2, 5.0, 5.0, "c", None)], LINES)
    turns = spark.createDataFrame([(1, 0, 0.0, 4.0, "S0"), (1, 1, 4.0, 8.0, "S1"), (1, 2, 18.0, 30.0, "S2")], "vod_id bigint, pos bigint, start_s double, end_s double, speaker_label string")
    assert rows(speakers.align_speakers(lines, turns), "pos", "speaker_label") == [(0, "S0"), (1, "UNKNOWN"), (2, "UNKNOWN")]


def test_recognition_thresholds(spark):
    clusters = spark.createDataFrame([(1, "A", [1.0, 0.0]), (1, "B", [0.0, 1.0]), (1, "C", [0.75, 0.661437827766])], "vod_id bigint, speaker_label string, embedding array<double>")
    profs = spark.createDataFrame([(0, "host_marlow", "streamer", [1.0, 0.0], 0.72, 0.8)], "pos bigint, profile_id string, role string, embedding array<double>, accept_similarity double, high_confidence_similarity double")
    turns = spark.createDataFrame([(1, x) for x in "ABCD"], "vod_id bigint, speaker_label string")
    out = {r.speaker_label: r for r in speakers.recognise_clusters(clusters, profs, turns).collect()}
    assert (out["A"].identity, out["A"].confidence, out["A"].profile_id) == ("streamer", 1.0, "host_marlow")
    assert (out["B"].identity, out["B"].cosine_similarity) == ("unknown", 0.0)
    assert out["C"].confidence == pytest.approx((0.75 - 0.72) / 0.28) and out["D"].cosine_similarity is None


def test_mixed_dimensions_are_reported(spark):
    df = spark.createDataFrame([("p", [1.0, 0.0]), ("p", [1.0]), ("q", [0.0, 2.0])], "profile_id string, embedding array<double>")
    out = {r.profile_id: r for r in speakers.enroll_profiles(df).collect()}
    assert out["p"].embedding is None and out["p"].error and out["q"].embedding == [0.0, 1.0]


def test_names_from_dialogue(spark):
    lines = spark.createDataFrame(
        [(1, 0, 10.0, 11.0, "hey Marlow", "S0"), (1, 1, 12.0, 13.0, "yeah thanks", "S1"), (1, 2, 20.0, 21.0, "I'm Nova", "S1"),
         (1, 3, 30.0, 31.0, "hey bob hey alice", "S0"), (1, 4, 60.0, 61.0, "later", "S1")], LINES,
    )
    messages = spark.createDataFrame([(1, 0, 29.0, "Marlow", "", None)], CHAT)
    out = speakers.merge_name_candidates(speakers.infer_names(lines, messages))
    assert rows(out, "speaker_label", "name", "confidence") == [("S1", "Marlow", 0.72), ("S1", "Nova", 0.95)]
    assert "chat usernames" in out.where("name = 'Marlow'").first().first_evidence
    assert one(spark, names.name_mentions(F.lit("hey Marlow, what do you think? I'm Nova"))) == ["Marlow", "Nova"]


# Profiles, games


def test_dispositions(spark):
    d = lambda c, conf, n: one(spark, profiles.disposition(F.lit(c), F.lit(conf), F.lit(n)))
    assert [d("good claim", 0.85, 2), d("maybe", 0.7, 1), d("weak", 0.4, 2), d("contains medical details", 0.95, 2), d("one line", 0.9, 1)] == [
        "accept", "queue", "reject", "reject", "reject"
    ]
    assert one(spark, text.is_sensitive(F.lit("new microphone")))


def test_game_of_a_time(spark):
    points = spark.createDataFrame([(1, i, float(t)) for i, t in enumerate((0, 39, 40, 150))], "vod_id bigint, pos bigint, t double")
    segs = spark.createDataFrame([(1, 0, 0.0, 40.0, None, "A"), (1, 1, 40.0, None, None, "B")], "vod_id bigint, pos bigint, start_s double, end_s double, game_id string, game_name string")
    assert rows(games.game_at(points, segs), "t", "game_name") == [(0.0, "A"), (39.0, "A"), (40.0, "B"), (150.0, "B")]


def test_formats(spark):
    assert one(spark, text.hms(F.lit(6271))) == "1:44:31" and one(spark, text.link_time(F.lit(6271))) == "1h44m31s"
    assert one(spark, text.link_time(F.lit(0))) == "0s" and one(spark, text.hms(F.lit(-5))) == "-0:00:05"
    assert one(spark, scalars.drift_offset(F.lit(6271))) == 6310


# Sources and sinks


def test_reply_forms(spark):
    forms = ['{"a": 1}', '```json\n{"a": 1}\n```', '{{"a": 1}}', '{"a": 1} and more', "", None]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, f string")
    out = df.select("i", replies.parse_reply(F.col("f")).alias("v")).select("i", F.try_variant_get("v", "$.a", "int").alias("a")).orderBy("i").collect()
    assert [r.a for r in out] == [1, 1, 1, None, None, None]


def test_detection_layouts(spark):
    docs = [
        {"results": {"frame_000002.jpg": {"timestamp_sec": 10, "detections": [{"class_name": "Cat"}, {"label": "dog"}]}}},
        {"5": ["cup", 3], "frame_7": "Pizza "},
        [{"second": 4, "objects": {"a": {"name": "Bird"}, "b": 1}}, ["cat"]],
    ]
    rows_ = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(3, '{"frame": 9, "labels": "Mouse"}\nbroken\n["fox"]')]
    out = documents.detections_from_documents(spark.createDataFrame(rows_, "vod_id bigint, doc string"))
    assert rows(out, "vod_id", "second_s", "labels") == [
        (0, 10, ["cat", "dog"]), (1, 5, ["cup"]), (1, 7, ["pizza"]), (2, 1, ["cat"]), (2, 4, ["b", "bird"]),
        (3, 2, ["fox"]), (3, 9, ["mouse"]),
    ]


def test_files_round_trip(spark, tmp_path):
    lines = tmp_path / "in"
    lines.mkdir()
    (lines / "a.jsonl").write_text('{"timestamp_in_seconds": 3, "message": {"body": "hi", "emotes": {"k": 1}}}\n{bad\n{"badges": [{"id": "moderator"}]}\n')
    read = chat_source.read_lines(spark, str(lines)).withColumn("vod_id", F.lit(1))
    assert rows(chat_source.chat_from_lines(read), "t", "usr", "message", "emotes", "is_moderator") == [
        (0.0, "unknown", "", [], True), (3.0, "unknown", "hi", ["k"], False)
    ]
    assert chat_source.read_documents(spark, str(lines)).count() == 1

    obs = spark.createDataFrame(
        [("s", "v", 0.0, 1.0, "inside_joke", "c", ["e"], "chat", 0.5, ["r"]), ("s", "v", 5.0, 1.0, "inside_joke", "c", [], "chat", 0.5, ["r"])],
        "streamer_id string, vod_id string, timestamp_start double, timestamp_end double, type string, claim string, evidence array<string>, source string, confidence double, evidence_refs array<string>",
    )
    bad = logs.append_observations(obs, str(tmp_path / "log"), "a")
    assert [sorted(r.errors) for r in bad.collect()] == [["evidence_empty", "timestamp_end_not_after_timestamp_start"]]
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1
    logs.append_observations(obs, str(tmp_path / "log"), "a")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1
    logs.append_observations(obs, str(tmp_path / "log"), "b")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2

    stage = str(tmp_path / "stage")
    table = spark.createDataFrame([(1, "a"), (2, "b")], "vod_id bigint, x string")
    logs.write_stage(table, stage)
    logs.write_stage(table.where("vod_id = 2").withColumn("x", F.lit("new")), stage)
    assert rows(spark.read.parquet(stage), "vod_id", "x") == [(1, "a"), (2, "new")]


def test_claims_are_merged_once(spark, tmp_path):
    """A retried batch changes nothing, also where a failed attempt left one streamer written; other streamers stay."""
    accepted = "streamer_id string, pos bigint, vod_id bigint, type string, claim string, confidence double, evidence_refs array<string>"
    one = spark.createDataFrame([("s", 1, 7, "inside_joke", "The cat", 0.6, ["a"]), ("t", 2, 7, "inside_joke", "A dog", 0.5, ["b"])], accepted)
    two = spark.createDataFrame([("s", 3, 8, "inside_joke", "the cat!", 0.9, ["c"]), ("s", 4, 8, "content_pattern", "raids", 0.4, ["d"])], accepted)
    path = str(tmp_path / "profile")
    columns = ("streamer_id", "added", "claim", "description", "confidence", "evidence_refs", "updated")
    logs.merge_claims(one.where("streamer_id = 's'"), path, "1")
    for batch, name in ((one, "1"), (one, "1"), (two, "2")):
        logs.merge_claims(batch, path, name)
    want = rows(logs.read_profile(spark, path), *columns)
    assert want == [
        ("s", True, "The cat", "the cat!", 0.9, ["a", "c"], True),
        ("s", True, "raids", "raids", 0.4, ["d"], False),
        ("t", True, "A dog", "A dog", 0.5, ["b"], False),
    ]
    for batch, name in ((two, "2"), (one, "1"), (two, "2")):
        logs.merge_claims(batch, path, name)
        assert rows(logs.read_profile(spark, path), *columns) == want


def test_streamed_islands_equal_the_batch(spark, tmp_path):
    """Shuffled arrival in many files within the allowed lateness: the islands of the batch run."""
    import random

    rng = random.Random(4)
    schema = "vod_id bigint, src int, pos bigint, start_s bigint, end_s bigint, score double, signal string, message_count bigint, text string"
    rows_ = []
    for i in range(240):
        start = rng.randrange(0, 1500)
        rows_.append((i % 3, i % 2, i, start, start + rng.randrange(0, 12), i / 10, rng.choice(["a", "b"]), rng.choice([None, i]), rng.choice([None, f"t{i}"])))
    rows_.sort(key=lambda r: r[3] + rng.randrange(0, 200))
    landed = str(tmp_path / "landed")
    for at in range(0, 240, 40):
        spark.createDataFrame(rows_[at : at + 40], schema).coalesce(1).write.mode("append").parquet(landed)
    spark.createDataFrame([(9, 0, 0, 9000, 9000, 0.0, "end", None, None)], schema).coalesce(1).write.mode("append").parquet(landed)
    args = (spark, landed, str(tmp_path / "out"), str(tmp_path / "state"), schema)
    out = run_islands(*args, files_at_once=1, late_seconds=400, side_seconds=500)
    columns = ("vod_id", "start_s", "end_s", "score", "signals", "text", "message_count", "members")
    batch = fusion.merge_moments(spark.createDataFrame(rows_, schema))
    assert out.where("kind = 'late'").count() == 0
    assert sorted(rows(out, *columns), key=str) == sorted(rows(batch, *columns), key=str)
    # Nothing is put out twice by a run without new files; a moment that belongs to a closed island is late.
    assert run_islands(*args, late_seconds=400, side_seconds=500).count() == out.count()
    n = out.count()
    late = [(0, 0, 500, 8700, 8700, 1.0, "a", None, "in time"), (0, 0, 501, rows_[5][3], rows_[5][3] + 1, 1.0, "a", None, "long dropped")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(landed)
    assert run_islands(*args, late_seconds=400, side_seconds=500).count() == n


def test_late_moments_go_to_the_side(spark, tmp_path):
    schema = "vod_id bigint, src int, pos bigint, start_s bigint, end_s bigint, score double, signal string, message_count bigint, text string"
    landed = str(tmp_path / "landed")
    args = (spark, landed, str(tmp_path / "out"), str(tmp_path / "state"), schema)
    for row in ((1, 0, 0, 100, 110, 1.0, "a", None, "first"), (1, 0, 1, 300, 310, 1.0, "a", 4, "second"), (1, 0, 2, 108, 120, 9.0, "b", None, "late"), (1, 0, 3, 900, 901, 1.0, "a", None, "third")):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(landed)
        out = run_islands(*args, late_seconds=60, side_seconds=1000)
    assert sorted(rows(out, "kind", "start_s", "end_s", "text", "members")) == [
        ("island", 100, 110, "first", 1), ("island", 300, 310, "second", 1), ("late", 108, 120, "late", 1)
    ]


def test_chat_stream(spark, tmp_path):
    folder = tmp_path / "vod_id=v1"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join('{"timestamp_in_seconds": %d}' % t for t in (1, 2, 35)))
    counts = message_counts(chat_stream(spark, str(tmp_path)))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("chat_counts").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.table("chat_counts"), "vod_id", "window_start", "message_count") == [("v1", 0, 2), ("v1", 30, 1)]


def test_contract_split(spark):
    turns = spark.createDataFrame([(0.0, 1.0, "S"), (2.0, 1.0, "S"), (0.0, 1.0, None)], "start_s double, end_s double, speaker_label string")
    good, bad = quality.split_by_contract(turns, "speaker_turn")
    assert good.count() == 1 and {tuple(r.errors) for r in bad.collect()} == {("end_s_not_after_start_s",), ("speaker_label_missing",)}
    with pytest.raises(ValueError):
        quality.contract("nothing")


def test_prepare_job(spark):
    lines = spark.createDataFrame([(1, 0, 10.0, 20.0, "hello there", "S"), (2, 0, 0.0, 70.0, "other", "S")], LINES)
    messages = spark.createDataFrame([(1, i, 30.0 + i, "a", "", None) for i in range(6)], CHAT)
    points = spark.createDataFrame([(1, 0, 10.0, 0.4)], "vod_id bigint, pos bigint, t double, chat_intensity double")
    seen = spark.createDataFrame([(1, 12, "cup")], "vod_id bigint, second_s bigint, class_name string")
    out = prepare(lines, messages, points, seen, window_seconds=30, step_seconds=30)
    assert out.manifest.groupBy("vod_id").count().count() == 2
    assert out.chunks.where("has_chat_spike").count() == 1
    assert out.annotation_windows.where("vod_id = 1").count() > 0


def test_name_prompts_keep_all_rows(spark):
    lines = spark.createDataFrame([(1, i, float(i), i + 1.0, f"line {i}", "S") for i in range(250)], LINES)
    messages = spark.createDataFrame([(1, i, float(i), "u", f"m{i}", None) for i in range(150)], CHAT)
    out = prompts.name_prompts(lines, messages)
    assert out.where("section = 'transcript'").count() == 250 and out.where("section = 'chat'").count() == 150
    assert out.orderBy(F.desc("section"), "pos").first().line == "[0.0s] S: line 0"


def test_spikes_of_a_very_busy_video(spark):
    bins = spark.range(8640).select(
        F.lit(1).cast("bigint").alias("vod_id"), F.col("id").alias("bin"),
        (400_000 + 40_000 * (F.col("id") == 77).cast("bigint") + F.col("id") % 3).alias("message_count"),
    )
    (spike,) = chat.bin_spikes(bins).collect()
    counts = [400_000 + 40_000 * (i == 77) + i % 3 for i in range(8640)]
    mean = sum(counts) / 8640
    assert spike.start_s == 770
    assert spike.intensity == pytest.approx((counts[77] - mean) / (sum((c - mean) ** 2 for c in counts) / 8640) ** 0.5)


def test_many_annotations_of_one_window(spark):
    raw = spark.range(100_000).select(
        F.lit(1).cast("bigint").alias("vod_id"), F.col("id").alias("pos"), F.lit(30).cast("bigint").alias("start_s"),
        F.lit(60).cast("bigint").alias("end_s"), F.lit("w1").alias("window_id"),
        F.array(F.struct((F.col("id") % 30 + 30).cast("string").alias("timestamp"), F.lit("laugh").alias("type"),
                         F.lit("0.5").alias("confidence"), F.lit("heard").alias("evidence"), F.lit("guest").alias("speaker_guess"))).alias("audio_events"),
        F.array().cast("array<struct<timestamp:string,type:string,confidence:string,evidence:string>>").alias("visual_events"),
        *[F.lit("0.2").alias(c) for c in ("primary_speaker", "streamer_led_likelihood", "non_streamer_voice_type", "streamer_affect",
                                          "organic_reaction_likelihood", "transactional_alert_likelihood", "emotion_evidence")],
        F.lit(False).alias("non_streamer_voice_present"), F.array(F.lit("loud")).alias("risk_flags"),
        F.array(F.concat(F.lit("note "), (F.col("id") % 5).cast("string"))).alias("clip_relevance_notes"),
        F.lit(True).alias("parse_ok"), F.lit("").alias("error"),
    )
    chunks = spark.createDataFrame([(1, 0, 0, 600)], "vod_id bigint, chunk_index bigint, chunk_start bigint, chunk_end bigint")
    (row,) = annotations.chunk_annotations(chunks, annotations.normalise_annotations(raw)).collect()
    assert (row.annotation_count, row.annotation_refs, row.notes) == (100_000, ["w1"], [f"note {i}" for i in range(5)])
    assert row.evidence_lines == [f"audio:laugh@{30 + i}" for i in range(30)]
    spans = chunks.select("vod_id", F.col("chunk_index").alias("span_id"), F.col("chunk_start").alias("lo"), F.col("chunk_end").alias("hi"))
    counts = annotations.signal_counts(annotations.windows_in(spans, annotations.normalise_annotations(raw)))
    assert {(r.kind, r.type): r.n for r in counts.collect()} == {("audio", "laugh"): 100_000, ("risk", "loud"): 100_000}


# Runtime


def test_salted_lookup_keeps_fact_rows(spark):
    fact = spark.createDataFrame([(0 if i < 70 else i, i) for i in range(100)], "k bigint, pos bigint")
    dim = spark.createDataFrame([(0, "hot"), (71, "one")], "k bigint, v string")
    assert salted_lookup(fact, dim, ["k"], spread_by=["pos"]).groupBy("v").count().where("v = 'hot'").first()["count"] == 70
    assert salted_lookup(fact, dim, ["k"], spread_by=["pos"], how="left_anti").count() == 29
    with pytest.raises(ValueError):
        salted_lookup(fact, dim, ["k"], spread_by=["pos"], how="full")


def test_checkpoint_uses_the_named_folder(spark):
    assert checkpointed(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir() is not None
