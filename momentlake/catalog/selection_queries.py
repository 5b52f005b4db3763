from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import scoring, selection, trim
from ..plans.publish import published_clips as publish
from ..plans.publish import scored_arcs
from . import query
from .context_queries import _DEAD_AIR, _SPEAKERS
from .scoring_queries import _ENERGIES, _PASSAGES, _SCORED
from .scoring_queries import _clips as _scoring_clips
from .stitching_queries import _ARCS, _PAIRS
from .text_queries import _NORM

# The greedy scan over ranked rows with columns (vod_id, clip_id, i, norm, tok).
_WALK = """
    sizes as (select vod_id, max(i) as n from ranked group by all),
    walk as (
        select vod_id, 0::bigint as i, []::struct(id varchar, norm varchar, tok varchar[])[] as kept from sizes
        union all
        select w.vod_id, r.i,
               case when len(kept) < 20 and len(list_filter(kept, lambda k: r.norm <> '' and k.norm <> '' and (
                        contains(k.norm, r.norm) or contains(r.norm, k.norm) or (len(k.tok) > 0 and len(r.tok) > 0
                        and len(list_intersect(k.tok, r.tok))
                            / (len(k.tok) + len(r.tok) - len(list_intersect(k.tok, r.tok)))::double >= 0.75::double)))) = 0
                    then list_append(kept, {'id': r.clip_id::varchar, 'norm': r.norm, 'tok': r.tok}) else kept end
        from walk w join ranked r on r.vod_id = w.vod_id and r.i = w.i + 1),
    kept as (
        select vod_id, unnest(kept).id as clip_id, unnest(range(1, len(kept) + 1)) as rank
        from walk join sizes using (vod_id) where i = n)"""


@query(
    "distinct_titles",
    with_entities("titles", f""",{_NORM},
    ranked as (
        select *, row_number() over (partition by vod_id order by score desc, clip_id) as i from stems),
    {_WALK}
    select vod_id, cast(clip_id as bigint) as clip_id, rank from kept""", recursive=True),
)
def distinct_titles(spark, sf_dir):
    titles = entity(spark, sf_dir, "titles")
    return selection.distinct_titles(titles, order=[(-F.col("score")).alias("s")])


def _selectable(spark, sf_dir):
    """Scored clips with the fields that titles and explanations are made of."""
    p = F.col("pos")
    scored = scoring.score_clips(_scoring_clips(spark, sf_dir))
    words = entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", "narrative_type", F.col("trigger_text").alias("trigger"), F.col("payoff_text").alias("payoff"),
        F.col("confidence").cast("double").alias("confidence"),
    )
    return (
        scored.join(words, ["vod_id", "pos"])
        .withColumn("clip_id", F.concat(F.lit("c"), p.cast("string")))
        .withColumn("clip_point", F.when(p % 2 == 0, F.concat(F.lit("Point "), (p % 3).cast("string"), F.lit(" "), "trigger")))
        .withColumn("trim_start_reason", F.col("trim_reason"))
        .withColumn("trim_end_reason", F.lit(None).cast("string"))
        .withColumn("primary_speaker_identity", F.when(p % 5 == 0, "guest").otherwise("streamer"))
        .withColumn("primary_speaker_name", F.when(p % 5 == 0, "Kim"))
        .withColumn("streamer_speaking_ratio", p % 4 / 4)
        .withColumn("off_streamer_voice_detected", p % 5 == 0)
        .withColumn("platform_scores", F.create_map(F.lit("tiktok"), (p % 10).cast("double")))
        .withColumn("evidence_lines", F.array("trigger"))
    )


_SELECTED = _SCORED + """,
    words as (select vod_id, pos, narrative_type, trigger_text, payoff_text, confidence from candidates),
    rows as (select g.*, w.* exclude (vod_id, pos) from gated g join words w using (vod_id, pos)),
    states as (select vod_id, not bool_or(eligible and final_score >= 3) as is_fallback from rows group by all),
    spare as (
        select r.*, true as is_fallback from rows r join states s using (vod_id) where s.is_fallback
        qualify row_number() over (partition by vod_id order by final_score desc, pos) <= 3),
    prelim as (
        select r.*, false as is_fallback from rows r where eligible and final_score >= 3
        union all by name select * from spare),
    titled as (
        select * replace (case when pos % 5 = 0 and regexp_matches(title, '^(The moment|What happens when) ')
                   then concat(case payoff_text when 'the streamer laughs' then 'Laughs' when 'chat loses it' then 'Chat loses it'
                             else 'A viewer story lands' end, ', after: ', upper(trigger_text[1]), trigger_text[2:]) else title end as title)
        from (select *, concat('c', pos) as clip_id,
               case when pos % 2 = 0 then concat('Point ', pos % 3, ' ', trigger_text)
                    when narrative_type = 'chat_reveal'
                    then concat('What happens when chat drops a message about ', trigger_text, '?')
                    else concat('The moment ', trigger_text, ' led to ', payoff_text) end as title
        from prelim where te > ts and ts >= start_s and te <= end_s)),
    words2 as (select *, regexp_extract_all(lower(title), '[a-z0-9'']+') as w from titled),
    ranked as (
        select *, array_to_string(w, ' ') as norm,
               list_distinct(list_transform(list_filter(w, lambda x: length(x) >= 3), lambda x:
                   case when length(x) > 4 and suffix(x, 'ing') then left(x, length(x) - 3)
                        when length(x) > 4 and suffix(x, 'ed') then left(x, length(x) - 2)
                        when length(x) > 4 and suffix(x, 'es') then left(x, length(x) - 2)
                        when length(x) > 4 and suffix(x, 's') then left(x, length(x) - 1) else x end)) as tok,
               row_number() over (partition by vod_id order by final_score desc, pos) as i
        from words2),""" + _WALK


@query(
    "final_clips",
    with_entities("analyses candidates", f""",{_SELECTED}
    select r.vod_id, k.rank, r.clip_id, r.start_s, r.end_s, ts as trim_start, te as trim_end, final_score as score, title,
           narrative_type, concat_ws(',', case when recommends_tiktok then 'tiktok' end,
               case when recommends_shorts then 'shorts' end) as platforms,
           concat('Scored ', printf('%.1f', round_even(final_score * 10.0, 0) / 10.0),
               '/10 by rule; no better clip of the video has a title like this.') as why_selected,
           concat('trigger: ', trigger_text, ' -> payoff: ', payoff_text) as narrative_arc,
           concat('Start: ', case when trim_reason = '' then 'model boundary' else trim_reason end,
                  '; End: model boundary') as trim_rationale,
           concat(te - ts, 's ', case when te - ts between 25 and 60 then 'optimal (25-60s band)'
                when te - ts between 20 and 24 or te - ts between 61 and 75 then 'acceptable with minor duration penalty'
                when te - ts between 15 and 19 or te - ts between 76 and 90 then 'risky duration band'
                else 'poor duration fit' end) as duration_fit,
           case when recommends_tiktok or recommends_shorts then concat('Suits ', concat_ws(', ',
               case when recommends_tiktok then 'tiktok' end, case when recommends_shorts then 'shorts' end))
               else 'No platform stands out' end as platform_fit,
           concat_ws(',', case when requires_context then 'context_required' end,
               case when confidence < 0.7 then 'low_discovery_confidence' end,
               case when not (recommends_tiktok or recommends_shorts) then 'no_platform_recommendation' end) as risks,
           is_fallback, final_score as normalized_score, (pos % 10)::double as tiktok_score,
           case when pos % 5 = 0 then 'guest' else 'streamer' end as voice, case when pos % 5 = 0 then 'Kim' end as voice_name,
           (pos % 4 / 4.0)::double as streamer_speaking_ratio, pos % 5 = 0 as off_streamer_voice_detected
    from ranked r join kept k on k.vod_id = r.vod_id and k.clip_id = r.clip_id""", recursive=True),
)
def final_clips(spark, sf_dir):
    out = selection.final_clips(_selectable(spark, sf_dir), fallback_top_n=3)
    return out.select(
        "vod_id", "rank", "clip_id", "start_s", "end_s", "trim_start", "trim_end", "score", "title", "narrative_type",
        F.array_join("platform_recommendations", ",").alias("platforms"), "why_selected", "narrative_arc",
        "trim_rationale", "duration_fit", "platform_fit", F.array_join("risks", ",").alias("risks"), "is_fallback",
        "normalized_score", F.col("platform_scores")["tiktok"].alias("tiktok_score"), F.col("speaker.identity").alias("voice"),
        F.col("speaker.name").alias("voice_name"), "speaker.streamer_speaking_ratio", "speaker.off_streamer_voice_detected",
    )


_MODEL = """
    model as (
        select o_custkey as vod_id, o_orderkey as pos,
               case when o_orderkey % 5 > 0 then (o_orderkey * 37) % 900 + (o_orderkey % 3) * 4 end as start_s,
               case when o_orderkey % 2 = 0 then (o_orderkey * 37) % 900 end as trim_start,
               case when o_orderkey % 4 > 0 then concat('because ', o_orderpriority) else '' end as why,
               case when o_orderkey % 3 > 0 then concat('strong ', o_orderstatus) end as strengths
        from orders)"""


@query(
    "ranking_overlay",
    with_entities("candidates", f""",{_MODEL},
    keys as (
        select vod_id, start_s as k, pos * 2 as o, why, strengths from model where start_s is not null union all
        select vod_id, trim_start, pos * 2 + 1, why, strengths from model where trim_start is not null),
    exact as (select * from keys qualify row_number() over (partition by vod_id, k order by o desc) = 1),
    ranged as (
        select c.vod_id, c.pos, m.why, m.strengths from candidates c
        join model m on m.vod_id = c.vod_id and m.start_s between c.start_s and c.end_s
        qualify row_number() over (partition by c.vod_id, c.pos order by m.pos) = 1)
    select c.vod_id, c.candidate_id as clip_id, c.start_s,
           coalesce(nullif(case when e.k is not null then e.why else r.why end, ''), 'own words') as why,
           nullif(case when e.k is not null then e.strengths else r.strengths end, '') as strengths
    from candidates c left join exact e on e.vod_id = c.vod_id and e.k = c.start_s
    left join ranged r on r.vod_id = c.vod_id and r.pos = c.pos"""),
)
def ranking_overlay(spark, sf_dir):
    from ..adapters import table

    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = (k * 37) % 900
    model = o.select(
        F.col("o_custkey").alias("vod_id"), k.alias("pos"),
        F.when(k % 5 > 0, start + (k % 3) * 4).alias("start_s"),
        F.when(k % 2 == 0, start).alias("trim_start"),
        F.when(k % 4 > 0, F.concat(F.lit("because "), "o_orderpriority")).otherwise("").alias("why"),
        F.when(k % 3 > 0, F.concat(F.lit("strong "), "o_orderstatus")).alias("strengths"),
    )
    clips = entity(spark, sf_dir, "candidates").select(
        "vod_id", F.col("candidate_id").alias("clip_id"), "start_s", "end_s", F.lit("own words").alias("why")
    )
    return selection.overlay_ranking(clips, model, ["why", "strengths"]).drop("end_s")


@query(
    "review_overlay",
    with_entities("analyses", """
    select vod_id, pos, case when pos % 3 = 0 and pos % 4 <> 0 then 9.0::double else clip_worthiness end as clip_worthiness,
           case when pos % 3 = 0 and pos % 4 <> 0 and pos % 2 = 0 then 'reviewed arc' else narrative_arc end as narrative_arc,
           pos % 3 = 0 and pos % 4 <> 0 as reviewed
    from analyses"""),
)
def review_overlay(spark, sf_dir):
    p = F.col("pos")
    a = entity(spark, sf_dir, "analyses").select("vod_id", "pos", "clip_worthiness", "narrative_arc")
    reviews = a.select(
        "vod_id", "pos", F.lit(9.0).alias("clip_worthiness"), F.when(p % 2 == 0, "reviewed arc").alias("narrative_arc"),
        F.when((p % 4 == 0) | (p % 3 > 0), "timeout").alias("error"),
    )
    return selection.overlay_reviews(a, reviews, ["clip_worthiness", "narrative_arc"], ["vod_id", "pos"])


@query(
    "top_clips_for_audio",
    with_entities("analyses", """
    select vod_id, pos, clip_worthiness, row_number() over (partition by vod_id order by clip_worthiness desc, pos) as rank
    from analyses qualify rank <= 3"""),
)
def top_clips_for_audio(spark, sf_dir):
    return selection.top_for_audio(entity(spark, sf_dir, "analyses"), 3).select("vod_id", "pos", "clip_worthiness", "rank")


@query(
    "rescored_selection",
    with_entities("analyses candidates", f""",{_SELECTED},
    again as (
        select r.vod_id, r.clip_id, k.rank, r.is_fallback,
               case when r.pos % 4 = 0 then 2.0::double else final_score end as final_score, eligible
        from ranked r join kept k on k.vod_id = r.vod_id and k.clip_id = r.clip_id)
    select vod_id, clip_id, row_number() over (partition by vod_id order by rank) as rank, final_score
    from again where is_fallback or (eligible and final_score >= 3)""", recursive=True),
)
def rescored_selection(spark, sf_dir):
    rows = _selectable(spark, sf_dir)
    chosen = selection.final_clips(rows, fallback_top_n=3).select("vod_id", "clip_id", "rank", "is_fallback")
    lowered = F.when(F.col("pos") % 4 == 0, 2.0).otherwise(F.col("final_score"))
    rescored = rows.withColumn("final_score", lowered).join(chosen, ["vod_id", "clip_id"])
    kept, _ = selection.regate(rescored)
    return kept.select("vod_id", "clip_id", "rank", "final_score")


# The check of the whole job, made of the check SQL of its steps: stitching with two shared words, the analysis of the most
# worthy source, silence and voices around an arc, scores, titles, trims by loudness, scores again.
_ARC_PAIRS = _PAIRS.replace("narrative_type, ' line ', trigger_text, ' shared line'", "narrative_type, ' ', trigger_text").replace(">= 5", ">= 2")
_ARC_SCORED = (
    _SCORED.replace("gap_len * 2 as longest", "longest_gap as longest")
    .replace("from analyses", "from rows0")
    .replace(
        "gap_len > 0 and start_s + 30 < te and start_s + 30 + longest > ts as gap_in_trim",
        "len(list_filter(gl, lambda g: g.e > g.s and g.s < te and g.e > ts)) > 0 as gap_in_trim",
    )
)
_SCORED_AGAIN = re.sub(r"\b(rows0|trims|clamped|rules|traced|scored|gated)\b", r"\1_again", _ARC_SCORED)

_PUBLISHED = f"""{_ARC_PAIRS},{re.sub(r"\bwalk\b", "arc_walk", _ARCS)},
    named as (select *, concat('stitched_', start_s, '_', end_s, '_', arc_no) as clip_id from arcs),
    clips as (
        select vod_id, clip_id, greatest(0.0::double, start_s - w) as lo,
               greatest(greatest(0.0::double, start_s - w) + 1, start_s + w) as hi
        from (select *, greatest(15, end_s - start_s)::double as w from named)),
    speech as (select * from segments),{_DEAD_AIR},{_SPEAKERS},
    gap_lists as (
        select vod_id, clip_id, list({{'s': prev_end::double, 'e': start_s::double}}) as gl, max(start_s - prev_end) as longest
        from gaps group by vod_id, clip_id),
    reps as (
        select g.vod_id, g.g, a.* exclude (vod_id, pos, start_s, end_s, gap_len, dead_air_ratio), a.pos % 7 as source_no
        from groups g join analyses a on a.vod_id = g.vod_id and a.pos = g.pos
        qualify row_number() over (partition by g.vod_id, g.g order by a.clip_worthiness desc, g.start_s, g.end_s, g.pos) = 1),
    rows0 as (
        select n.vod_id, n.clip_id, n.arc_no as pos, n.start_s, n.end_s, n.narrative_type, n.trigger, n.payoff,
               r.* exclude (vod_id, g), coalesce(l.longest, 0) as longest_gap, coalesce(l.gl, []) as gl,
               round_even(least(1.0::double, coalesce(s.total, 0.0::double) / greatest(c.hi - c.lo, 1.0)) * 1000000.0, 0)
                   / 1000000.0 as dead_air_ratio,
               coalesce(v.primary_speaker_identity, 'unknown') as identity
        from named n join reps r on r.vod_id = n.vod_id and r.g = n.g
        join clips c on c.vod_id = n.vod_id and c.clip_id = n.clip_id
        join stats v on v.vod_id = n.vod_id and v.clip_id = n.clip_id
        left join gap_lists l on l.vod_id = n.vod_id and l.clip_id = n.clip_id
        left join silence s on s.vod_id = n.vod_id and s.clip_id = n.clip_id),{_ARC_SCORED},
    states as (select vod_id, not bool_or(eligible and final_score >= 3) as is_fallback from gated group by all),
    spare as (
        select r.*, true as is_fallback from gated r join states s using (vod_id) where s.is_fallback
        qualify row_number() over (partition by vod_id order by final_score desc, pos) <= 3),
    prelim as (
        select r.*, false as is_fallback from gated r where eligible and final_score >= 3
        union all by name select * from spare),
    titled as (
        select * replace (case when identity <> 'streamer' then concat(case payoff when 'the streamer laughs' then 'Laughs'
                   when 'chat loses it' then 'Chat loses it' else 'A viewer story lands' end, ', after: ',
                   upper(trigger[1]), trigger[2:]) else title end as title)
        from (select *, case when narrative_type = 'chat_reveal'
                    then concat('What happens when chat drops a message about ', trigger, '?')
                    else concat('The moment ', trigger, ' led to ', payoff) end as title
        from prelim where te > ts and ts >= start_s and te <= end_s)),
{_SELECTED[_SELECTED.index("    words2 as") :]},
    chosen as (select r.*, k.rank from ranked r join kept k on k.vod_id = r.vod_id and k.clip_id = r.clip_id),{_ENERGIES},
    lists as (
        select vod_id, clip_id, list(coalesce(energy, 0.0::double) order by sec) as e
        from (select d.*, energy, max(case when energy is not null then sec end) over (partition by vod_id, clip_id) as last
              from (select vod_id, clip_id, unnest(range(start_s, end_s)) as sec from chosen
                    where ts = start_s and te = end_s and end_s - start_s = 120) d left join energies using (vod_id, sec))
        where sec <= last group by vod_id, clip_id),{_PASSAGES},
    trimmed as (
        select c.vod_id, c.clip_id, rank, is_fallback, title,
               case when due and n >= 15 then start_s + a when due and n is null
                    then greatest(start_s, (start_s + end_s) // 2 - 22) else ts end as ts2,
               case when due and n >= 15 then start_s + b when due and n is null
                    then least(end_s, (start_s + end_s) // 2 + 23) else te end as te2,
               case when due and (n >= 15 or n is null) then 'rms_fallback' else 'qwen' end as source2
        from (select *, ts = start_s and te = end_s and end_s - start_s = 120 as due from chosen) c
        left join audio using (vod_id, clip_id)),
    rows0_again as (
        select r.* replace (ts2 as trim_start, te2 as trim_end), source2, rank, is_fallback, title
        from rows0 r join trimmed using (vod_id, clip_id)),{_SCORED_AGAIN}
    select vod_id, row_number() over (partition by vod_id order by rank) as rank, clip_id, start_s, end_s,
           ts as trim_start, te as trim_end, source2 as trim_source, final_score as score, raw_score, title,
           printf('%d:%02d:%02d', start_s // 3600, start_s % 3600 // 60, start_s % 60) as start_s_hms,
           concat('https://video.example/v/', vod_id, '?t=', case when start_s = 0 then '0s' else concat(
               case when start_s >= 3600 then concat(start_s // 3600, 'h') else '' end,
               case when start_s % 3600 >= 60 then concat(start_s % 3600 // 60, 'm') else '' end,
               case when start_s % 60 > 0 then concat(start_s % 60, 's') else '' end) end) as vod_url, is_fallback
    from gated_again where is_fallback or (eligible and final_score >= 3)"""


@query("published_clips", with_entities("candidates analyses segments turns samples", "," + _PUBLISHED, recursive=True))
def published_clips(spark, sf_dir):
    candidates = entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", "candidate_id", "start_s", "end_s", "narrative_type", F.col("trigger_text").alias("trigger"),
        F.col("payoff_text").alias("payoff"), F.array("trigger_text").alias("evidence_lines"),
        F.col("confidence").cast("double").alias("confidence"), "worthiness",
    )
    analyses = (
        _scoring_clips(spark, sf_dir)
        .select(
            "vod_id", F.concat(F.lit("cand_"), F.col("pos").cast("string")).alias("candidate_id"), "clip_worthiness",
            "trim_start", "trim_end", "has_payoff", "requires_context", "transactional", "narrative_arc", "trim_reason",
            "platform_scores", "platform_recommendations", "suggested_penalties", "audio_dead_air", "music_only",
            "trim_source", F.col("trim_reason").alias("trim_start_reason"),
        )
        .withColumn("trim_end_reason", F.lit(None).cast("string"))
        .withColumn("clip_point", F.lit(None).cast("string"))
    )
    scored = scored_arcs(candidates, analyses, entity(spark, sf_dir, "segments"), entity(spark, sf_dir, "turns"))
    energies = trim.second_energies(entity(spark, sf_dir, "samples"))
    out = publish(scored, energies, "https://video.example/v")
    return out.select(
        "vod_id", "rank", "clip_id", "start_s", "end_s", "trim_start", "trim_end", "trim_source", "score", "raw_score",
        "title", "start_s_hms", "vod_url", "is_fallback",
    )
