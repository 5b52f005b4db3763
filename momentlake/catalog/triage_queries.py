from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import annotations, frames, intervals, triage
from . import query


def _raw(spark, sf_dir):
    r = entity(spark, sf_dir, "triage_raw")
    none = F.array().cast("array<string>")
    return r.select(
        "vod_id", "pos", "fallback_start", "fallback_end",
        F.col("start_txt").alias("start"), F.col("end_txt").alias("end"),
        F.col("trim_start_txt").alias("trim_start"), F.col("trim_end_txt").alias("trim_end"),
        F.col("score_txt").alias("triage_score"), F.col("confidence_txt").alias("triage_confidence"),
        F.col("id_txt").alias("candidate_id"), F.col("narrative_txt").alias("narrative_type"),
        F.lit(None).cast("string").alias("trigger"), F.lit("lands").alias("payoff"),
        F.col("need_txt").alias("vision_need"), F.col("evidence").alias("evidence_lines"),
        none.alias("risk_flags"), F.col("reasons").alias("selection_reasons"), none.alias("annotation_refs"),
    )


def _candidates(spark, sf_dir):
    return triage.normalise_candidates(_raw(spark, sf_dir))


_CANDIDATES = """
    windows0 as (
        select *, coalesce(cast(trunc(try_cast(start_txt as double)) as bigint), fallback_start) as s,
               coalesce(cast(trunc(try_cast(end_txt as double)) as bigint), fallback_end) as e
        from triage_raw),
    windows1 as (
        select * replace (case when e <= s then fallback_start else s end as s,
                          case when e <= s then fallback_end else e end as e)
        from windows0),
    trims as (
        select *, case when trim_start_txt is null then s
                       else greatest(s, least(e, cast(trunc(try_cast(trim_start_txt as double)) as bigint))) end as ts0,
               case when trim_end_txt is null then e
                    else greatest(s, least(e, cast(trunc(try_cast(trim_end_txt as double)) as bigint))) end as te0
        from windows1),
    cleaned as (
        select *, list_filter(list_transform(evidence, lambda x: trim(x)), lambda x: x <> '') as ev,
               list_filter(list_transform(reasons, lambda x: trim(x)), lambda x: x <> '') as rs
        from trims),
    candidates0 as (
        select vod_id, pos, coalesce(nullif(trim(id_txt), ''), concat('triage_', s, '_', e)) as candidate_id,
               s as start_s, e as end_s, case when te0 > ts0 then ts0 else s end as trim_start,
               case when te0 > ts0 then te0 else e end as trim_end,
               coalesce(nullif(trim(narrative_txt), ''), 'other') as narrative_type,
               case when len(ev) > 0 then list_filter(ev, lambda x, i: list_position(ev, x) = i)
                    else [concat('[', s, 's] triage candidate from ', s, 's to ', e, 's')] end as evidence,
               list_filter(rs, lambda x, i: list_position(rs, x) = i) as reasons,
               greatest(0.0::double, least(10.0::double, coalesce(try_cast(score_txt as double), 0))) as triage_score,
               greatest(0.0::double, least(1.0::double, coalesce(try_cast(confidence_txt as double), 0)))
                   as triage_confidence,
               case when lower(trim(coalesce(need_txt, 'none'))) in ('verify_expression', 'verify_scene', 'critical')
                    then lower(trim(need_txt)) else 'none' end as vision_need
        from cleaned)"""

_ORDER = "triage_score desc, triage_confidence desc, start_s, candidate_id, pos"


@query(
    "triage_candidates",
    with_entities("triage_raw", f""",{_CANDIDATES}
    select vod_id, pos, candidate_id, start_s, end_s, trim_start, trim_end, narrative_type,
           array_to_string(evidence, '|') as evidence_lines, array_to_string(reasons, '|') as selection_reasons,
           triage_score, triage_confidence, vision_need, 'What starts the moment' as trigger, 'lands' as payoff
    from candidates0"""),
)
def triage_candidates(spark, sf_dir):
    return (
        _candidates(spark, sf_dir)
        .withColumn("evidence_lines", F.array_join("evidence_lines", "|"))
        .withColumn("selection_reasons", F.array_join("selection_reasons", "|"))
        .drop("risk_flags", "annotation_refs")
    )


@query(
    "top_triage_candidates",
    with_entities("triage_raw", f""",{_CANDIDATES}
    select vod_id, candidate_id, row_number() over (partition by vod_id order by {_ORDER}) as rank
    from candidates0 qualify rank <= 4"""),
)
def top_triage_candidates(spark, sf_dir):
    return triage.top_candidates(_candidates(spark, sf_dir), 4).select("vod_id", "candidate_id", "rank")


@query(
    "review_budgets",
    with_entities("triage_raw", """
    select vod_id, count(*) as candidates,
           cast(least(count(*), least(6, greatest(2, ceil(count(*) * 0.3::double)))) as bigint) as budget
    from triage_raw group by all"""),
)
def review_budgets(spark, sf_dir):
    return triage.review_budgets(_candidates(spark, sf_dir), 0.3, 2, 6)


@query(
    "selection_reason_counts",
    with_entities("triage_raw", f""",{_CANDIDATES}
    select vod_id, reason, count(*) as n from (select vod_id, unnest(reasons) as reason from candidates0) group by all"""),
)
def selection_reason_counts(spark, sf_dir):
    return triage.reason_counts(_candidates(spark, sf_dir))


def _manifest(spark, sf_dir):
    """Manifest clips of the candidate videos: one per candidate, on a 60 s grid."""
    start = F.floor(F.col("start_s") / 60) * 60
    return (
        entity(spark, sf_dir, "candidates")
        .select("vod_id", "pos", F.concat(F.lit("m"), F.col("pos").cast("string")).alias("clip_id"), start.alias("start_s"))
        .withColumn("end_s", F.col("start_s") + 60)
    )


_MANIFEST = """
    manifest as (
        select vod_id, pos, concat('m', pos) as clip_id, start_s // 60 * 60 as start_s, start_s // 60 * 60 + 60 as end_s
        from candidates)"""


def _lane_sql(lane: str, synonyms: tuple[str, ...]) -> str:
    words = ", ".join(f"'{w}'" for w in synonyms)
    return f"case when list_contains(low, '{lane}') then '{lane}' else list_sort(list_intersect(low, [{words}]))[1] end"


# The turns of the shortlist as steps of a walk: the top candidate, one step per lane, one per candidate for
# explicit sentinels, one per spaced clip, and one per candidate to fill up.
_LANE_STEPS, _SPACED_STEPS = len(triage.LANES), 10
_SHORTLIST = f"""{_CANDIDATES},{_MANIFEST},
    top as (
        select *, row_number() over (partition by vod_id order by {_ORDER}) as r,
               list_transform(reasons, lambda x: lower(trim(x))) as low
        from candidates0 qualify r <= 60),
    cands as (
        select vod_id, list({{'r': r, 's': start_s, 'lanes': lanes, 'sent': sent}} order by r) as cands
        from (select vod_id, r, start_s, [{", ".join(_lane_sql(n, w) for n, w in triage.LANES.items())}] as lanes,
                     {_lane_sql(triage.SENTINEL_REASON, triage.SENTINEL_LANE)} as sent from top)
        group by all),
    budgets as (
        select vod_id, cast(least(count(*), least(6, greatest(2, ceil(count(*) * 0.6::double)))) as bigint) as budget
        from candidates0 group by all),
    placed as (
        select *, row_number() over (partition by vod_id order by start_s, end_s, clip_id) - 1 as idx,
               count(*) over (partition by vod_id) as n
        from manifest),
    counts as (
        select vod_id, any_value(placed.n) as n,
               least(any_value(placed.n), greatest(1, cast(round_even(any_value(budget) * 0.4::double, 0) as bigint))) as k
        from placed join budgets using (vod_id) group by all),
    turns as (
        select *, case when k = 1 then n // 2 else cast(round_even(turn * (n - 1) / (k - 1)::double, 0) as bigint) end as idx
        from (select *, unnest(range(0, k)) as turn from counts)),
    targets as (
        select vod_id, any_value(t.k) as k,
               list({{'turn': turn, 's': p.start_s, 'e': p.end_s, 'clip': p.clip_id}} order by turn) as targets
        from turns t join placed p using (vod_id, idx) group by all),
    videos as (
        select vod_id, budget, cands, coalesce(k, 0) as k, targets
        from budgets join cands using (vod_id) left join targets using (vod_id) where budget > 0),
    walk as (
        select vod_id, budget, cands, k, targets, 0 as step, 0 as n,
               [{{'r': cands[1].r, 'reason': '{triage.TOP_REASON}', 'turn': null::bigint, 's': cands[1].s}}] as picks
        from videos
        union all
        select vod_id, budget, cands, k, targets, step + 1, n + case when kind = 'sentinel' and ok then 1 else 0 end,
               case when ok then list_append(picks, pick) else picks end
        from (
            select *, pick is not null and len(picks) < budget and (kind <> 'sentinel' or n < k) and (kind <> 'spaced' or n < k)
                   and not list_contains(list_transform(picks, lambda x: x.s), pick.s) as ok
            from (
                select *, case kind
                    when 'lane' then list_transform(list_filter(cands, lambda c: c.lanes[step + 1] is not null and
                            not list_contains(list_transform(picks, lambda x: x.s), c.s)),
                        lambda c: {{'r': c.r, 'reason': c.lanes[step + 1], 'turn': null::bigint, 's': c.s}})[1]
                    when 'sentinel' then list_transform(list_filter([cands[step + 1 - {_LANE_STEPS}]], lambda c: c.sent is not null),
                        lambda c: {{'r': c.r, 'reason': '{triage.SENTINEL_REASON}', 'turn': null::bigint, 's': c.s}})[1]
                    when 'spaced' then list_transform(list_filter([targets[step + 1 - {_LANE_STEPS + 60}]], lambda t: t.s is not null),
                        lambda t: {{'r': list_filter(cands, lambda c: c.s = t.s)[1].r, 'reason': '{triage.SENTINEL_REASON}',
                                  'turn': t.turn, 's': t.s}})[1]
                    else list_transform(list_filter([cands[step + 1 - {_LANE_STEPS + 60 + _SPACED_STEPS}]], lambda c: c.s is not null),
                        lambda c: {{'r': c.r, 'reason': '{triage.TOP_REASON}', 'turn': null::bigint, 's': c.s}})[1] end as pick
                from (
                    select *, case when step < {_LANE_STEPS} then 'lane' when step < {_LANE_STEPS + 60} then 'sentinel'
                              when step < {_LANE_STEPS + 60 + _SPACED_STEPS} then 'spaced' else 'fill' end as kind
                    from walk where step < {_LANE_STEPS + 120 + _SPACED_STEPS})))),
    picked as (
        select vod_id, targets, unnest(picks) as p from walk where step = {_LANE_STEPS + 120 + _SPACED_STEPS}),
    joined as (
        select p.vod_id, p.p.reason as selection_reason, t.* exclude (vod_id),
               list_filter(p.targets, lambda x: x.turn = p.p.turn)[1] as clip
        from picked p left join top t on t.vod_id = p.vod_id and t.r = p.p.r),
    spans as (
        select *, candidate_id is null as made, coalesce(clip.s, start_s) as a, coalesce(clip.e, end_s) as b from joined),
    trimmed as (
        select *, greatest(a, least(b, trim_start)) as ta, greatest(a, least(b, trim_end)) as tb from spans)"""


@query(
    "vision_shortlist",
    with_entities("triage_raw candidates", f""",{_SHORTLIST}
    select vod_id, case when made then concat('sentinel_', clip.clip) else candidate_id end as candidate_id,
           case when made then clip.clip else candidate_id end as source_candidate_id, a as start_s, b as end_s,
           case when tb > ta then ta else a end as trim_start, case when tb > ta then tb else b end as trim_end,
           coalesce(triage_score, 0.0::double) as triage_score, coalesce(triage_confidence, 0.0::double) as triage_confidence,
           coalesce(vision_need, 'none') as vision_need, selection_reason,
           array_to_string(case when list_contains(reasons, selection_reason) then reasons
               else list_append(coalesce(reasons, []), selection_reason) end, '|') as selection_reasons,
           case when made then concat('[', a, 's] sentinel coverage from manifest clip ', clip.clip)
                else array_to_string(evidence, '|') end as evidence_lines,
           '' as risk_flags, '' as annotation_refs, clip.clip as manifest_clip_id
    from trimmed""", recursive=True),
)
def vision_shortlist(spark, sf_dir):
    candidates = _candidates(spark, sf_dir)
    budgets = triage.review_budgets(candidates, 0.6, 2, 6)
    out = triage.vision_shortlist(candidates, _manifest(spark, sf_dir), budgets=budgets, sentinel_ratio=0.4)
    for c in ("selection_reasons", "evidence_lines", "risk_flags", "annotation_refs"):
        out = out.withColumn(c, F.array_join(c, "|"))
    return out


@query(
    "best_manifest_match",
    with_entities("candidates", f""",{_MANIFEST},
    shifted as (select vod_id, pos, start_s * 3 as start_s, start_s * 3 + 30 as end_s from candidates),
    ranked as (
        select c.vod_id, c.pos, m.clip_id,
               greatest(0, least(c.end_s, m.end_s) - greatest(c.start_s, m.start_s)) as overlap_s
        from shifted c join manifest m using (vod_id)
        qualify row_number() over (partition by c.vod_id, c.pos
                                   order by overlap_s desc, abs(c.start_s - m.start_s), m.pos) = 1)
    select vod_id, pos, clip_id as manifest_clip_id, overlap_s from ranked"""),
)
def best_manifest_match(spark, sf_dir):
    shifted = (
        entity(spark, sf_dir, "candidates")
        .select("vod_id", "pos", (F.col("start_s") * 3).alias("start_s"))
        .withColumn("end_s", F.col("start_s") + 30)
    )
    out = triage.best_manifest_match(shifted, _manifest(spark, sf_dir))
    return out.select("vod_id", "pos", "manifest_clip_id", "overlap_s")


_CHUNKS = """
    starts as (
        select vod_id, unnest(range(0, 90000, 540)) as chunk_start
        from (select distinct vod_id from chat)),
    chunks0 as (
        select vod_id, chunk_start // 540 as chunk_index, chunk_start, least(chunk_start + 600, 90000) as chunk_end
        from starts),
    line_counts as (
        select c.vod_id, c.chunk_index, count(*) as n from chunks0 c
        join speech s on s.vod_id = c.vod_id and s.start_s >= c.chunk_start and s.start_s < c.chunk_end group by all),
    chat_counts as (
        select c.vod_id, c.chunk_index, count(*) as n from chunks0 c
        join chat s on s.vod_id = c.vod_id and s.t >= c.chunk_start and s.t < c.chunk_end group by all),
    chunks as (
        select c.*, coalesce(l.n, 0) as transcript_count, coalesce(m.n, 0) as chat_count,
               (c.chunk_end - c.chunk_start) / 60.0::double as minutes
        from chunks0 c left join line_counts l using (vod_id, chunk_index)
        left join chat_counts m using (vod_id, chunk_index))"""


def _chunks(spark, sf_dir):
    messages = entity(spark, sf_dir, "chat")
    videos = messages.select("vod_id").distinct().select(
        "vod_id", F.lit(0).cast("bigint").alias("vod_start"), F.lit(90000).cast("bigint").alias("vod_end")
    )
    return triage.triage_chunks(videos, entity(spark, sf_dir, "speech"), messages)


@query(
    "triage_chunks",
    with_entities("chat speech", f""",{_CHUNKS}
    select vod_id, chunk_index, chunk_start, chunk_end, transcript_count, chat_count,
           round_even(transcript_count / minutes * 1000000.0, 0) / 1000000.0 as transcript_density_per_min,
           round_even(chat_count / minutes * 1000000.0, 0) / 1000000.0 as chat_density_per_min,
           chat_count >= 5 or round_even(chat_count / minutes * 1000000.0, 0) / 1000000.0 >= 4 as has_chat_spike
    from chunks"""),
)
def triage_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


def _clips(spark, sf_dir):
    """Clips on the chat videos, one per spoken line."""
    return entity(spark, sf_dir, "speech").select(
        "vod_id", "pos", F.col("pos").cast("string").alias("clip_id"), "start_s", "end_s"
    )


@query(
    "chunk_manifest_starts",
    with_entities("chat speech", f""",{_CHUNKS}
    select c.vod_id, c.chunk_index,
           coalesce(string_agg(distinct cast(s.start_s as varchar), ',' order by cast(s.start_s as varchar)), '') as starts,
           count(distinct s.start_s) as manifest_candidate_count
    from chunks c left join speech s on s.vod_id = c.vod_id and s.start_s < c.chunk_end and s.end_s > c.chunk_start
    group by all"""),
)
def chunk_manifest_starts(spark, sf_dir):
    out = triage.chunk_manifest_starts(_chunks(spark, sf_dir), _clips(spark, sf_dir))
    starts = F.array_sort(F.col("manifest_candidate_starts").cast("array<string>"))
    return out.select("vod_id", "chunk_index", F.array_join(starts, ",").alias("starts"), "manifest_candidate_count")


@query(
    "annotation_windows",
    with_entities("chat speech", f""",{_CHUNKS},
    spans as (
        select vod_id, 0 as prio, start_s as a, end_s as b, cast(pos as varchar) as c, 'manifest_backed' as source,
               cast(pos as varchar) as clip, null::bigint as chunk_index, start_s as lo, end_s as hi
        from speech
        union all
        select vod_id, 1, chunk_index, 0, '', 'chat_spike', null, chunk_index, chunk_start, chunk_end
        from chunks where chat_count >= 5 or chat_count / minutes >= 4),
    slid as (
        select *, unnest(range(0, (hi - lo + 29) // 30)) as i from spans),
    windows as (
        select *, lo + i * 30 as start_s, least(lo + i * 30 + 30, hi) as end_s from slid),
    kept as (
        select * from windows
        qualify row_number() over (partition by vod_id, start_s, end_s order by prio, a, b, c, i) = 1)
    select vod_id, concat('gemma_', lpad(cast(start_s as varchar), 7, '0'), '_', lpad(cast(end_s as varchar), 7, '0'))
               as window_id, start_s, end_s, source, clip as manifest_clip_id, chunk_index
    from kept"""),
)
def annotation_windows(spark, sf_dir):
    return annotations.annotation_windows(_chunks(spark, sf_dir), _clips(spark, sf_dir))


def _annotations(spark, sf_dir):
    a = entity(spark, sf_dir, "annotations_raw")
    kind = F.col("event_type")
    sound = (
        F.when(kind == "click", " Laugh ").when(kind == "purchase", "donation_alert").when(kind == "error", "music")
        .when(kind == "view", "")
    )
    text = lambda c: F.lit(c).cast("string")
    audio = F.array(
        F.struct(
            (F.col("t") + 45).cast("string").alias("timestamp"), sound.alias("type"),
            (F.col("v") / 100).cast("string").alias("confidence"), F.col("props").alias("evidence"),
            text(None).alias("speaker_guess"),
        ),
        F.struct(
            text("soon").alias("timestamp"), F.when(kind == "click", "game_audio").otherwise("hum").alias("type"),
            text("high").alias("confidence"), text(None).alias("evidence"), text(" Streamer").alias("speaker_guess"),
        ),
    )
    visual = F.array(
        F.struct(
            F.col("t").cast("string").alias("timestamp"),
            F.when(kind == "view", "visual_payoff").otherwise(" Surprised").alias("type"),
            text("0.5").alias("confidence"), text("seen").alias("evidence"), text(None).alias("speaker_guess"),
        )
    )
    none = F.lit(None).cast("string")
    raw = a.select(
        "vod_id", "pos", "start_s", "end_s", none.alias("window_id"),
        audio.alias("audio_events"),
        F.when(kind.isin("view", "signup"), visual).alias("visual_events"),
        none.alias("primary_speaker"),
        (F.col("v") / 200).cast("string").alias("streamer_led_likelihood"),
        F.lit(None).cast("boolean").alias("non_streamer_voice_present"),
        none.alias("non_streamer_voice_type"), none.alias("streamer_affect"),
        F.when(kind == "error", "unclear").otherwise("0.25").alias("organic_reaction_likelihood"),
        (F.col("v") / 50).cast("string").alias("transactional_alert_likelihood"),
        none.alias("emotion_evidence"),
        F.split(F.concat(F.lit("note "), kind, F.lit(", ,note")), ",").alias("clip_relevance_notes"),
        F.split(F.when(F.col("user_id") % 2 == 0, "possible_alert, late").otherwise("late,late"), ",").alias("risk_flags"),
        F.lit(None).cast("boolean").alias("parse_ok"),
        F.when(F.col("user_id") % 10 == 0, "timeout").alias("error"),
    )
    return annotations.normalise_annotations(raw)


_ANNOTATIONS = """
    anns as (
        select vod_id, pos, start_s, end_s, event_type, user_id,
               concat('gemma_', lpad(cast(start_s as varchar), 7, '0'), '_', lpad(cast(end_s as varchar), 7, '0'))
                   as window_id,
               least(t + 45, end_s) as a1_t,
               case event_type when 'click' then 'laugh' when 'purchase' then 'donation_alert' when 'error' then 'music'
                    else 'unknown' end as a1,
               round_even(least(1.0::double, v / 100.0::double) * 10000.0, 0) / 10000.0 as a1_conf, props as a1_ev,
               case event_type when 'click' then 'game_audio' else 'hum' end as a2,
               case event_type when 'view' then 'visual_payoff' when 'signup' then 'surprised' end as v1, t as v1_t,
               least(1.0::double, v / 200.0::double) as led,
               case event_type when 'error' then 0.0::double else 0.25::double end as organic,
               least(1.0::double, v / 50.0::double) as paid,
               case when user_id % 2 = 0 then ['possible_alert', 'late'] else ['late'] end as risks,
               user_id % 10 <> 0 as parse_ok
        from annotations_raw)"""


@query(
    "normalised_annotations",
    with_entities("annotations_raw", f""",{_ANNOTATIONS}
    select vod_id, pos, window_id, concat(a1_t, '|', a1, '|', a1_ev, '|unknown') as first_audio, a1_conf,
           concat(start_s, '|', a2, '||streamer') as second_audio,
           case when v1 is not null then concat(v1_t, '|', v1) end as visual, led as streamer_led_likelihood,
           organic as organic_reaction_likelihood, concat('note ', event_type, ';note') as notes,
           array_to_string(risks, ';') as risk_flags, parse_ok
    from anns"""),
)
def normalised_annotations(spark, sf_dir):
    a = _annotations(spark, sf_dir)

    def audio(i):
        e = F.col("audio_events")[i]
        return F.concat_ws("|", e["timestamp"].cast("string"), e["type"], e["evidence"], e["speaker_guess"])

    v = F.get("visual_events", 0)
    return a.select(
        "vod_id", "pos", "window_id", audio(0).alias("first_audio"),
        F.col("audio_events")[0]["confidence"].alias("a1_conf"), audio(1).alias("second_audio"),
        F.when(v.isNotNull(), F.concat_ws("|", v["timestamp"].cast("string"), v["type"])).alias("visual"),
        "streamer_led_likelihood", "organic_reaction_likelihood",
        F.array_join("clip_relevance_notes", ";").alias("notes"), F.array_join("risk_flags", ";").alias("risk_flags"),
        "parse_ok",
    )


_SUMMARY = """
    pairs as (
        select s.vod_id, s.span_id, a.* exclude (vod_id) from spans s
        join anns a on a.vod_id = s.vod_id and {overlap}),
    events as (
        select vod_id, span_id, pos, 0 as k, 0 as i, 'audio' as kind, a1 as type, a1_t as t from pairs union all
        select vod_id, span_id, pos, 0, 1, 'audio', a2, start_s from pairs union all
        select vod_id, span_id, pos, 1, 0, 'visual', v1, v1_t from pairs where v1 is not null),
    evidence as (
        select vod_id, span_id, concat(kind, ':', type, '@', t) as line, min(pos * 100 + k * 10 + i) as ord
        from events
        where (kind = 'audio' and type in ('laugh', 'donation_alert', 'music', 'game_audio'))
           or (kind = 'visual' and type = 'visual_payoff')
        group by 1, 2, 3
        ),
    evidence_lists as (
        select vod_id, span_id, list(line order by ord) as lines from evidence group by all),
    refs as (
        select vod_id, span_id, string_agg(window_id, ',' order by pos) as refs
        from (select vod_id, span_id, window_id, min(pos) as pos from pairs group by all) group by all),
    totals as (
        select vod_id, span_id, count(*) as annotation_count, count_if(not parse_ok)::bigint as parse_failures,
               round_even(max(led) * 10000.0, 0) / 10000.0 as led, round_even(max(paid) * 10000.0, 0) / 10000.0 as paid,
               round_even(max(organic) * 10000.0, 0) / 10000.0 as organic,
               bool_or(a1 in ('laugh', 'donation_alert')) as alert,
               bool_or(coalesce(v1 in ('visual_payoff', 'surprised'), false)) as reaction
        from pairs group by all),
    summary as (
        select t.*, r.refs, coalesce(e.lines, []) as lines
        from totals t join refs r using (vod_id, span_id) left join evidence_lists e using (vod_id, span_id))"""

_CHUNK_SPANS = "spans as (select vod_id, chunk_index as span_id, chunk_start as lo, chunk_end as hi from chunks)"
_CHUNK_OVERLAP = "a.start_s < s.hi and a.end_s > s.lo"


def _chunk_pairs(spark, sf_dir):
    spans = _chunks(spark, sf_dir).select(
        "vod_id", F.col("chunk_index").alias("span_id"), F.col("chunk_start").alias("lo"), F.col("chunk_end").alias("hi")
    )
    return annotations.windows_in(spans, _annotations(spark, sf_dir))


@query(
    "chunk_signal_counts",
    with_entities("chat speech annotations_raw", f""",{_CHUNKS},{_ANNOTATIONS},{_CHUNK_SPANS},
    {_SUMMARY.format(overlap=_CHUNK_OVERLAP)}
    select vod_id, span_id, kind, type, count(*) as n
    from (select vod_id, span_id, kind, type from events
          union all select vod_id, span_id, 'risk', unnest(risks) from pairs) group by all"""),
)
def chunk_signal_counts(spark, sf_dir):
    return annotations.signal_counts(_chunk_pairs(spark, sf_dir)).drop("first_seen")


@query(
    "chunk_signal_summary",
    with_entities("chat speech annotations_raw", f""",{_CHUNKS},{_ANNOTATIONS},{_CHUNK_SPANS},
    {_SUMMARY.format(overlap=_CHUNK_OVERLAP)}
    select vod_id, span_id, annotation_count, parse_failures, led as streamer_led_likelihood,
           paid as transactional_alert_likelihood, organic as organic_reaction_likelihood, refs as annotation_refs,
           alert as has_audio_alert, reaction as has_visual_reaction, array_to_string(lines, ',') as evidence_lines
    from summary"""),
)
def chunk_signal_summary(spark, sf_dir):
    out = annotations.signal_summary(_chunk_pairs(spark, sf_dir))
    return out.withColumn("annotation_refs", F.array_join("annotation_refs", ",")).withColumn(
        "evidence_lines", F.array_join("evidence_lines", ",")
    )


@query(
    "annotated_chunks",
    with_entities("chat speech annotations_raw", f""",{_CHUNKS},{_ANNOTATIONS},{_CHUNK_SPANS},
    {_SUMMARY.format(overlap=_CHUNK_OVERLAP)},
    note_rows as (
        select vod_id, span_id, note, min(ord) as ord
        from (select vod_id, span_id, concat('note ', event_type) as note, pos * 10 as ord from pairs
              union all select vod_id, span_id, 'note', pos * 10 + 1 from pairs) group by all),
    notes as (select vod_id, span_id, string_agg(note, ',' order by ord) as notes from note_rows group by all)
    select c.vod_id, c.chunk_index, c.chat_count, coalesce(annotation_count, 0) as annotation_count,
           coalesce(refs, '') as annotation_refs, coalesce(notes, '') as notes, coalesce(alert, false) as has_audio_alert
    from chunks c left join summary s on s.vod_id = c.vod_id and s.span_id = c.chunk_index
    left join notes n on n.vod_id = c.vod_id and n.span_id = c.chunk_index"""),
)
def annotated_chunks(spark, sf_dir):
    out = annotations.chunk_annotations(_chunks(spark, sf_dir), _annotations(spark, sf_dir))
    return out.select(
        "vod_id", "chunk_index", "chat_count", "annotation_count",
        F.array_join("annotation_refs", ",").alias("annotation_refs"), F.array_join("notes", ",").alias("notes"),
        "has_audio_alert",
    )


@query(
    "fallback_candidates",
    with_entities("speech annotations_raw", f""",{_ANNOTATIONS},
    spans as (select vod_id, pos as span_id, start_s as lo, end_s as hi from speech),
    {_SUMMARY.format(overlap="a.start_s <= s.hi and a.end_s >= s.lo")},
    risk_rows as (
        select vod_id, span_id, flag, min(pos * 10 + i) as ord
        from (select vod_id, span_id, pos, unnest(risks) as flag, unnest(range(0, len(risks))) as i from pairs)
        group by all),
    risks as (select vod_id, span_id, string_agg(flag, ',' order by ord) as risks from risk_rows group by all),
    scored as (
        select c.*, coalesce(alert, false) as alert, coalesce(reaction, false) as reaction, coalesce(led, 0) as led,
               coalesce(paid, 0) as paid, coalesce(lines, []) as lines, coalesce(refs, '') as refs,
               coalesce(risks, '') as risks
        from speech c left join summary s on s.vod_id = c.vod_id and s.span_id = c.pos
        left join risks r on r.vod_id = c.vod_id and r.span_id = c.pos)
    select vod_id, pos, concat('triage_', start_s) as candidate_id, start_s, end_s,
           array_to_string(list_distinct_in_order, ',') as evidence_lines, risks as risk_flags,
           round_even(least(10.0::double, 1 + case when alert then 2.5 else 0 end + case when reaction then 2 else 0 end
               + led * 2 + paid * 1.5) * 10000.0, 0) / 10000.0 as triage_score,
           round_even(least(1.0::double, 0.35 + len(lines) * 0.1) * 10000.0, 0) / 10000.0 as triage_confidence,
           case when alert or reaction then 'critical' else 'verify_expression' end as vision_need,
           concat('text_top_rank', case when alert then ',gemma_audio_alert_or_laughter' else '' end,
                  case when reaction then ',gemma_visual_reaction' else '' end) as selection_reasons,
           refs as annotation_refs
    from (select *, list_filter(list_concat([concat('[', start_s, 's] clip window ', start_s, '-', end_s, 's')], lines,
                    [case when alert then 'gemma_audio_alert' end,
                    case when reaction then 'gemma_visual_reaction' end,
                    case when led >= 0.6 then 'streamer_led_likelihood_high' end,
                    case when paid >= 0.6 then 'transactional_alert_likelihood_high' end]),
                    lambda x: x is not null) as list_distinct_in_order
          from scored)"""),
)
def fallback_candidates(spark, sf_dir):
    clips = entity(spark, sf_dir, "speech").select("vod_id", "pos", "start_s", "end_s")
    out = annotations.fallback_candidates(clips, _annotations(spark, sf_dir))
    for c in ("evidence_lines", "risk_flags", "selection_reasons", "annotation_refs"):
        out = out.withColumn(c, F.array_join(c, ","))
    return out.drop("trim_start", "trim_end", "narrative_type", "trigger", "payoff")


def _frames(spark, sf_dir):
    d = entity(spark, sf_dir, "detections")
    path = F.format_string("frames/frame_%06d.jpg", (F.col("second_s") / 5).cast("int"))
    return d.select("vod_id", path.alias("path")).withColumn("t", frames.frame_time(F.col("path"))).distinct()


_FRAMES = """
    stills as (
        select distinct vod_id, second_s as t, concat('frames/frame_', lpad(cast(second_s // 5 as varchar), 6, '0'), '.jpg')
                   as path
        from detections)"""


@query(
    "nearest_frames",
    with_entities("detections cuts", f""",{_FRAMES},
    targets as (
        select vod_id, pos as window_id, 0 as turn, t from cuts union all
        select vod_id, pos, 1, t + 20 from cuts union all select vod_id, pos, 2, t + 40 from cuts),
    firsts as (
        select g.vod_id, g.window_id, g.turn, s.path from targets g join stills s using (vod_id)
        qualify row_number() over (partition by g.vod_id, g.window_id, g.turn
                                   order by abs(s.t - g.t), s.t, s.path) = 1),
    options as (
        select vod_id, window_id, path, turn from firsts union all
        select w.vod_id, w.window_id, e.path, 100 + r
        from (select distinct vod_id, window_id from firsts) w
        join (select *, row_number() over (partition by vod_id order by t, path) as r from stills) e using (vod_id)
        where r <= 6),
    distinct_options as (select vod_id, window_id, path, min(turn) as ord from options group by all)
    select vod_id, window_id, row_number() over (partition by vod_id, window_id order by ord) - 1 as turn, path
    from distinct_options qualify turn < 3"""),
)
def nearest_frames(spark, sf_dir):
    windows = entity(spark, sf_dir, "cuts").select(
        "vod_id", F.col("pos").alias("window_id"), F.col("t").alias("start_s"), (F.col("t") + 40).alias("end_s")
    )
    return frames.nearest_frames(windows, _frames(spark, sf_dir), 3)


@query(
    "sampled_frames",
    with_entities("detections speech", """,
    there as (select distinct vod_id, second_s // 5 as frame_index from detections),
    clips as (select vod_id, pos as clip_id, start_s as s, end_s as e, end_s - start_s as len from speech),
    points as (
        select vod_id, clip_id, unnest(list) as t, unnest(range(0, len(list))) as turn
        from (select vod_id, clip_id, case when len <= 15 then range(s + 1, e, greatest(1, len // 6))
                     else list_transform(range(1, 7), lambda i: s + i * greatest(len // 7, 2)) end as list
              from clips)),
    hits as (
        select p.*, cast(round_even(p.t / 5.0::double, 0) as bigint) as frame_index from points p)
    select h.vod_id, h.clip_id, h.turn, h.t, h.frame_index from hits h semi join there using (vod_id, frame_index)
    qualify row_number() over (partition by h.vod_id, h.clip_id order by h.turn) <= 2"""),
)
def sampled_frames(spark, sf_dir):
    clips = entity(spark, sf_dir, "speech").withColumnRenamed("pos", "clip_id")
    there = entity(spark, sf_dir, "detections").select("vod_id", F.floor(F.col("second_s") / 5).alias("frame_index"))
    points = frames.sample_points(F.col("start_s"), F.col("end_s"), 6, 2)
    return frames.existing_samples(clips, points, there, 2)


@query(
    "extra_sampled_frames",
    with_entities("detections speech", """,
    there as (select distinct vod_id, second_s // 5 as frame_index from detections),
    points as (
        select vod_id, pos as clip_id, i - 1 as turn, start_s + i * greatest(1, (end_s - start_s) // 9) as t
        from speech, (select unnest(range(1, 9)) as i)),
    hits as (select *, cast(round_even(t / 5.0::double, 0) as bigint) as frame_index from points)
    select h.vod_id, h.clip_id, h.turn, h.t, h.frame_index from hits h semi join there using (vod_id, frame_index)"""),
)
def extra_sampled_frames(spark, sf_dir):
    clips = entity(spark, sf_dir, "speech").withColumnRenamed("pos", "clip_id")
    there = entity(spark, sf_dir, "detections").select("vod_id", F.floor(F.col("second_s") / 5).alias("frame_index"))
    points = frames.extra_sample_points(F.col("start_s"), F.col("end_s"), 8)
    return frames.existing_samples(clips, points, there)


@query(
    "numbered_lines",
    with_entities("speech", """
    select vod_id, pos, row_number() over (partition by vod_id order by start_s, pos) - 1 as line_no from speech"""),
)
def numbered_lines(spark, sf_dir):
    rows = entity(spark, sf_dir, "speech").select("vod_id", "pos", "start_s")
    return intervals.numbered(
        rows, order=["start_s", "pos"], block=F.floor(F.col("start_s") / 3600), out="line_no"
    ).select("vod_id", "pos", "line_no")
