from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import stitching
from . import query


def _candidates(spark, sf_dir):
    return entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", "candidate_id", "start_s", "end_s", "narrative_type",
        F.col("trigger_text").alias("trigger"), F.col("payoff_text").alias("payoff"),
        F.array(F.concat(F.lit("line "), "trigger_text"), F.lit("shared line")).alias("evidence_lines"),
        F.col("confidence").cast("double").alias("confidence"), "worthiness",
    )


@query(
    "discoveries",
    with_entities("analyses", """
    select vod_id, pos, concat('cand_', start_s) as candidate_id, start_s, end_s,
           case when pos % 4 = 0 then 'unknown' else 'story' end as narrative_type,
           case when pos % 5 = 0 then 'Model did not provide explicit trigger' else 'a trigger' end as trigger,
           case when pos % 3 = 0 then 'a payoff' when has_payoff then 'True'
                else 'Model did not provide explicit payoff' end as payoff,
           case when pos % 6 = 0 then 'No direct evidence provided by model output'
                else concat_ws('|', case when pos % 6 > 2 then 'because' end, case when pos % 6 > 1 then
                     concat('narrative_arc: ', narrative_arc) end, concat('clip_point: ', 'point ', pos)) end as evidence_lines,
           case when pos % 7 = 0 then greatest(0.0::double, least(1.0::double, (pos % 40) / 20.0::double))
                when clip_worthiness <= 0 then 0.3::double else least(1.0::double, clip_worthiness / 10.0::double) end
               as confidence
    from analyses"""),
)
def discoveries(spark, sf_dir):
    p = F.col("pos")
    a = entity(spark, sf_dir, "analyses")
    raw = (
        a.withColumn("narrative_type", F.when(p % 4 > 0, "story").otherwise(""))
        .withColumn("reason", F.when(p % 6 > 2, "because"))
        .withColumn("narrative_arc", F.when(p % 6 > 1, F.col("narrative_arc")).otherwise(""))
        .withColumn("trigger", F.when(p % 5 > 0, "a trigger"))
        .withColumn("payoff", F.when(p % 3 == 0, "a payoff"))
        .withColumn("clip_point", F.when(p % 6 > 0, F.concat(F.lit("  point "), p.cast("string"))))
        .withColumn("confidence", F.when(p % 7 == 0, (p % 40) / 20))
    )
    return stitching.discoveries(raw).withColumn("evidence_lines", F.array_join("evidence_lines", "|"))


@query(
    "running_discovery_context",
    with_entities("candidates", """,
    rows as (select vod_id, pos, start_s // 5 as batch, candidate_id, confidence from candidates),
    batches as (select distinct vod_id, batch from rows),
    upto as (
        select b.vod_id, b.batch, r.candidate_id, r.confidence,
               row_number() over (partition by b.vod_id, b.batch order by r.confidence desc, r.pos) as k
        from batches b join rows r on r.vod_id = b.vod_id and r.batch <= b.batch)
    select vod_id, batch, count(*) as analysed, count_if(confidence >= 0.7)::bigint as confident,
           string_agg(candidate_id, ',' order by k) filter (k <= 5) as top_candidates
    from upto group by all"""),
)
def running_discovery_context(spark, sf_dir):
    rows = _candidates(spark, sf_dir).withColumn("batch", F.floor(F.col("start_s") / 5))
    out = stitching.running_context(rows)
    return out.withColumn("top_candidates", F.array_join("top_candidates", ","))


_PAIRS = """
    toks as (
        select vod_id, pos, candidate_id, start_s, end_s, narrative_type as kind, worthiness, confidence,
               list_distinct(list_filter(regexp_extract_all(lower(concat(trigger_text, ' ', payoff_text, ' ',
                   narrative_type, ' line ', trigger_text, ' shared line')), '[a-z0-9'']+'), lambda w: length(w) >= 3
                   and w not in ('the', 'chat', 'streamer'))) as tok,
               trigger_text, payoff_text
        from candidates),
    pairs0 as (
        select l.vod_id, l.pos as l_pos, r.pos as r_pos, l.candidate_id as l_candidate_id,
               r.candidate_id as r_candidate_id, l.start_s as l_start_s, l.end_s as l_end_s, r.start_s as r_start_s,
               r.end_s as r_end_s, r.start_s - l.end_s as gap_s, l.kind = r.kind as type_match, l.kind,
               list_sort(list_intersect(l.tok, r.tok)) as shared
        from toks l join toks r on l.vod_id = r.vod_id and r.start_s >= l.start_s and r.start_s <= l.end_s + 45
             and (r.start_s, r.end_s, r.pos) > (l.start_s, l.end_s, l.pos)),
    pairs as (
        select *, len(shared) as shared_count,
               case when gap_s <= 20 then 2 else 1 end + case when type_match then 2 else 0 end
                   + case when len(shared) >= 5 then 2 when len(shared) > 0 then 1 else 0 end as score,
               gap_s <= 20 and (type_match or len(shared) >= 5) as strict_rule,
               concat_ws(';', case when gap_s <= 20 then 'temporal_gap<=20' else 'temporal_bridge_gap<=45' end,
                   case when type_match then concat('narrative_type_match:', kind) end,
                   case when len(shared) >= 5 then concat('shared_tokens:', array_to_string(shared, ','))
                        when len(shared) > 0 then concat('weak_shared_tokens:', array_to_string(shared, ',')) end)
                   as reasons
        from pairs0),
    decided as (select *, strict_rule or score >= 4 as merged from pairs)"""

# Several words are shared by design of the adapter, so five of them are asked for.
_MIN_SHARED = 5


def _pairs(spark, sf_dir):
    return stitching.stitch_pairs(_candidates(spark, sf_dir), min_shared=_MIN_SHARED)


@query(
    "stitch_pairs",
    with_entities("candidates", f""",{_PAIRS}
    select vod_id, l_pos, r_pos, gap_s, type_match, shared_count, cast(score as bigint) as score, strict_rule,
           score >= 4 as graph_rule, merged, reasons
    from decided"""),
)
def stitch_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "vod_id", "l_pos", "r_pos", "gap_s", "type_match", "shared_count", "score", "strict_rule", "graph_rule",
        "merged", F.array_join("reasons", ";").alias("reasons"),
    )


_ARCS = """
    edges as (
        select *, row_number() over (partition by vod_id order by score desc, gap_s, l_start_s, l_end_s, l_pos,
                                     r_start_s, r_end_s, r_pos) as step
        from decided where merged and greatest(l_end_s, r_end_s) - least(l_start_s, r_start_s) <= 240),
    last_steps as (select vod_id, max(step) as n from edges group by all),
    walk as (
        select vod_id, 0::bigint as step, []::bigint[] as used, []::bigint[] as won from last_steps
        union all
        select w.vod_id, e.step,
               case when list_contains(used, l_pos) or list_contains(used, r_pos) then used
                    else list_concat(used, [l_pos, r_pos]) end,
               case when list_contains(used, l_pos) or list_contains(used, r_pos) then won
                    else list_append(won, e.step) end
        from walk w join edges e on e.vod_id = w.vod_id and e.step = w.step + 1),
    accepted as (
        select vod_id, unnest(won) as step from walk join last_steps using (vod_id) where step = n),
    joined as (select e.* from edges e join accepted using (vod_id, step)),
    groups as (
        select t.*, coalesce(j.l_pos, t.pos) as g, j.reasons
        from toks t left join joined j on j.vod_id = t.vod_id and t.pos in (j.l_pos, j.r_pos)),
    arcs0 as (
        select vod_id, g, min(start_s) as start_s, max(end_s) as end_s, max(confidence)::double as confidence,
               coalesce(min(reasons), 'single_candidate') as merge_reasons,
               string_agg(candidate_id, ',' order by start_s, end_s, pos) as sources, count(*) as members,
               first(kind order by start_s, end_s, pos) as narrative_type,
               first(trigger_text order by worthiness desc, start_s, end_s, pos) as trigger,
               first(payoff_text order by worthiness desc, start_s, end_s, pos) as payoff,
               first(struct_pack(a := start_s, b := end_s, c := pos) order by start_s, end_s, pos) as first_member
        from groups group by vod_id, g),
    arcs as (
        select *, row_number() over (partition by vod_id order by start_s, first_member.b, first_member.c) as arc_no
        from arcs0)"""


def _arcs(spark, sf_dir):
    return stitching.stitch(_candidates(spark, sf_dir), min_shared=_MIN_SHARED)


@query(
    "story_arcs",
    with_entities("candidates", f""",{_PAIRS},{_ARCS}
    select vod_id, concat('stitched_', start_s, '_', end_s, '_', arc_no) as stitched_id, arc_no, start_s, end_s,
           narrative_type, trigger, payoff, confidence, sources, merge_reasons from arcs""", recursive=True),
)
def story_arcs(spark, sf_dir):
    return _arcs(spark, sf_dir).select(
        "vod_id", "stitched_id", "arc_no", "start_s", "end_s", "narrative_type", "trigger", "payoff", "confidence",
        F.array_join("source_candidate_ids", ",").alias("sources"), F.array_join("merge_reasons", ";").alias("merge_reasons"),
    )


# Groups of up to three: the scan keeps every group with its span.
_THREES = """
    edges as (
        select *, row_number() over (partition by vod_id order by score desc, gap_s, l_start_s, l_end_s, l_pos,
                                     r_start_s, r_end_s, r_pos) as step
        from decided where merged and greatest(l_end_s, r_end_s) - least(l_start_s, r_start_s) <= 240),
    last_steps as (select vod_id, max(step) as n from edges group by all),
    walk as (
        select vod_id, 0::bigint as step, []::struct(m bigint[], lo bigint, hi bigint)[] as gs from last_steps
        union all
        select vod_id, step,
               case when list_contains(a.m, r_pos) or len(a.m) + len(b.m) > 3
                         or greatest(a.hi, b.hi) - least(a.lo, b.lo) > 240 then gs
                    else list_append(list_filter(gs, lambda x: not list_contains(x.m, l_pos) and not list_contains(x.m, r_pos)),
                                     {'m': list_concat(a.m, b.m), 'lo': least(a.lo, b.lo), 'hi': greatest(a.hi, b.hi)}) end
        from (
            select w.vod_id, e.step, gs, l_pos, r_pos,
                   coalesce(list_filter(gs, lambda x: list_contains(x.m, l_pos))[1],
                            {'m': [l_pos], 'lo': l_start_s::bigint, 'hi': l_end_s::bigint}) as a,
                   coalesce(list_filter(gs, lambda x: list_contains(x.m, r_pos))[1],
                            {'m': [r_pos], 'lo': r_start_s::bigint, 'hi': r_end_s::bigint}) as b
            from walk w join edges e on e.vod_id = w.vod_id and e.step = w.step + 1)),
    grown as (select vod_id, unnest(gs) as g from walk join last_steps using (vod_id) where step = n),
    placed as (select vod_id, list_min(g.m) as g, unnest(g.m) as pos from grown),
    arcs as (
        select t.vod_id, min(start_s) as start_s, max(end_s) as end_s, count(*) as members,
               string_agg(candidate_id, ',' order by start_s, end_s, t.pos) as sources
        from toks t left join placed p on p.vod_id = t.vod_id and p.pos = t.pos
        group by t.vod_id, coalesce(p.g, t.pos))"""


@query(
    "story_arcs_of_three",
    with_entities("candidates", f""",{_PAIRS},{_THREES}
    select vod_id, start_s, end_s, members, sources from arcs""", recursive=True),
)
def story_arcs_of_three(spark, sf_dir):
    arcs = stitching.stitch(_candidates(spark, sf_dir), min_shared=_MIN_SHARED, max_members=3)
    return arcs.select(
        "vod_id", "start_s", "end_s", F.size("source_candidate_ids").cast("bigint").alias("members"),
        F.array_join("source_candidate_ids", ",").alias("sources"),
    )


@query(
    "arc_representatives",
    with_entities("candidates", f""",{_PAIRS},{_ARCS},
    ranked as (
        select a.vod_id, concat('stitched_', a.start_s, '_', a.end_s, '_', a.arc_no) as stitched_id, g.candidate_id,
               g.worthiness as clip_worthiness
        from arcs a join groups g on g.vod_id = a.vod_id and g.g = a.g
        qualify row_number() over (partition by a.vod_id, a.g order by g.worthiness desc, g.start_s, g.end_s, g.pos) = 1)
    select * from ranked""", recursive=True),
)
def arc_representatives(spark, sf_dir):
    analyses = entity(spark, sf_dir, "candidates").select(
        "vod_id", "candidate_id", F.col("worthiness").alias("clip_worthiness")
    )
    return stitching.representative_analyses(_arcs(spark, sf_dir), analyses)


@query(
    "stitch_report",
    with_entities("candidates", f""",{_PAIRS},
    counts as (
        select vod_id, merged, regexp_extract(reasons, '^[^;]*') as primary_reason, count(*) as pairs,
               min((l_start_s, l_end_s, l_pos, r_start_s, r_end_s, r_pos)) as f
        from decided group by all)
    select vod_id, merged, primary_reason, pairs,
           row_number() over (partition by vod_id, merged order by pairs desc, f) as rank
    from counts qualify rank <= 8"""),
)
def stitch_report(spark, sf_dir):
    return stitching.stitch_report(_pairs(spark, sf_dir))


@query(
    "notable_stitch_pairs",
    with_entities("candidates", f""",{_PAIRS}
    select vod_id, merged, l_pos, r_pos, cast(score as bigint) as score, gap_s,
           row_number() over (partition by vod_id, merged order by score desc, gap_s, l_start_s, l_end_s, l_pos,
                              r_start_s, r_end_s, r_pos) as rank
    from decided where merged or score >= 3 qualify rank <= 3"""),
)
def notable_stitch_pairs(spark, sf_dir):
    out = stitching.notable_pairs(_pairs(spark, sf_dir), 3)
    return out.select("vod_id", "merged", "l_pos", "r_pos", "score", "gap_s", "rank")
