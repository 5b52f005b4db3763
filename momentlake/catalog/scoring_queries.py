from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..functions import scalars
from ..operators import scoring, trim
from . import query


def _clips(spark, sf_dir):
    a = entity(spark, sf_dir, "analyses")
    gap = F.struct(
        (F.col("start_s") + 30).cast("double").alias("start"),
        (F.col("start_s") + 30 + F.col("gap_len") * 2).cast("double").alias("end"),
        (F.col("gap_len") * 2).cast("double").alias("duration"),
    )
    recommended = F.array_compact(
        F.array(F.when(F.col("recommends_tiktok"), "tiktok"), F.when(F.col("recommends_shorts"), "shorts"))
    )
    return (
        a.withColumn("platform_scores", F.create_map(
            F.lit("tiktok"), F.col("tiktok_score").cast("double"), F.lit("shorts"), F.col("shorts_score").cast("double")
        ))
        .withColumn("platform_recommendations", recommended)
        .withColumn("suggested_penalties", F.array(F.col("penalty_a").cast("double"), F.col("penalty_b").cast("double")))
        .withColumn("dead_air_gaps", F.when(F.col("gap_len") > 0, F.array(gap)).otherwise(
            F.array().cast("array<struct<start:double,end:double,duration:double>>")
        ))
        .withColumn("dead_air_ratio", F.col("dead_air_ratio").cast("double"))
        .withColumn("trim_source", F.when(F.col("pos") % 7 == 0, "rms_fallback").when(F.col("pos") % 7 == 1, "other"))
    )


_SCORED = """
    trims as (
        select *, trim_start < start_s or trim_end > end_s as outside,
               greatest(trim_start, start_s) as cs, least(trim_end, end_s) as ce, gap_len * 2 as longest
        from analyses),
    clamped as (
        select *, case when outside and ce > cs then cs else trim_start end as ts,
               case when outside and ce > cs then ce else trim_end end as te,
               outside and ce > cs as did_clamp, outside and ce <= cs as lost,
               least(5.0::double, round_even((abs(penalty_a) + abs(penalty_b))::double * 10000.0, 0) / 10000.0) as crit,
               least(10.0::double, greatest(0.0::double, clip_worthiness)) as raw_score
        from trims),
    rules as (
        select *, case when te - ts <= 0 then 3 when te - ts <= 60 then 0 when te - ts <= 75 then 1
                       when te - ts <= 90 then 2 else 3 end as dur_points,
               longest > 20 as long_gap, dead_air_ratio::double > 0.30::double as silent,
               gap_len > 0 and start_s + 30 < te and start_s + 30 + longest > ts as gap_in_trim,
               not has_payoff as no_payoff,
               transactional and length(trim(narrative_arc)) < 20 as bad_trans,
               end_s - start_s = 120 and ts = start_s and te = end_s and length(trim(trim_reason)) < 20 as unresolved,
               (recommends_tiktok and tiktok_score < 6) or (recommends_shorts and shorts_score < 6) as bad_platform,
               end_s <= start_s as bad_window, trim_end <= trim_start as bad_trim
        from clamped),
    traced as (
        select *,
            concat_ws(',', case when did_clamp then 'trim_clamped_to_bounds' end,
                case when long_gap then 'dead_air_single_gap_gt_20' end,
                case when requires_context then 'context_required' end,
                case when dur_points > 0 then 'duration_policy_penalty' end,
                case when crit > 0 then 'clip_criticism_penalty' end,
                case when audio_dead_air then 'audio_dead_air_signal' end,
                case when music_only and no_payoff then 'audio_music_only_without_payoff' end) as penalties,
            case when did_clamp then 0.5::double else 0 end + case when long_gap then 3 else 0 end
                + case when requires_context then 1.5::double else 0 end + dur_points + crit
                + case when audio_dead_air then 1 else 0 end + case when music_only and no_payoff then 1 else 0 end
                as total,
            least(10.0::double, case when long_gap then 6 else 10 end, case when silent then 5 else 10 end,
                case when gap_in_trim then 3 else 10 end, case when no_payoff then 5 else 10 end,
                case when bad_trans then 4 else 10 end, case when unresolved then 5 else 10 end) as cap,
            concat_ws(',', case when bad_window then 'invalid_candidate_window' end,
                case when bad_trim then 'invalid_trim_range' end, case when lost then 'trim_out_of_bounds' end,
                case when gap_in_trim then 'dead_air_inside_trim' end, case when no_payoff then 'no_narrative_payoff' end,
                case when bad_trans then 'transactional_without_narrative_arc' end,
                case when unresolved then 'full_window_unresolved' end,
                case when bad_platform then 'platform_recommendation_invalid' end) as reasons,
            concat_ws(',', case when bad_window then 'invalid_candidate_window:reject' end,
                case when bad_trim then 'invalid_trim_range:reject' end, case when lost then 'trim_out_of_bounds:reject' end,
                case when long_gap then 'dead_air_single_gap_gt_20:cap<=6' end,
                case when silent then 'dead_air_ratio_gt_30pct:cap<=5' end,
                case when gap_in_trim then 'dead_air_inside_trim:cap<=3,dead_air_inside_trim:reject' end,
                case when no_payoff then 'no_narrative_payoff:cap<=5,no_narrative_payoff:reject' end,
                case when bad_trans then 'transactional_without_narrative_arc:cap<=4,transactional_without_narrative_arc:reject' end,
                case when unresolved then 'full_window_unresolved:cap<=5,full_window_unresolved:reject' end,
                case when bad_platform then 'platform_recommendation_invalid:reject_bad_platform_recs' end) as gates
        from rules),
    scored as (
        select *, round_even(greatest(0.0::double, least(10.0::double, least(raw_score - total, cap))) * 10000.0, 0)
                      / 10000.0 as final_score
        from traced),
    gated as (
        select *, reasons = '' and final_score >= 3 and ts >= start_s and te > ts and te <= end_s as eligible from scored)"""


@query(
    "scored_clips",
    with_entities("analyses", f""",{_SCORED}
    select vod_id, pos, start_s, end_s, raw_score, final_score, eligible, penalties, gates, reasons,
           ts as final_trim_start, te as final_trim_end,
           case pos % 7 when 0 then 'rms_fallback' when 1 then 'python_corrected' else 'qwen' end as trim_source
    from gated"""),
)
def scored_clips(spark, sf_dir):
    out = scoring.score_clips(_clips(spark, sf_dir))
    return out.select(
        "vod_id", "pos", "start_s", "end_s", "raw_score", "final_score", "eligible",
        F.array_join(F.transform("penalty_trace", lambda p: p["code"]), ",").alias("penalties"),
        F.array_join(F.transform("hard_gates", lambda g: F.concat(g["code"], F.lit(":"), g["action"])), ",").alias("gates"),
        F.array_join("rejection_reasons", ",").alias("reasons"),
        "final_trim_start", "final_trim_end", "trim_source",
    )


@query(
    "gate_summary",
    with_entities("analyses", f""",{_SCORED}
    select vod_id, count(*) as scored_count, count_if(eligible and final_score >= 3)::bigint as passed_hard_gate
    from gated group by all"""),
)
def gate_summary(spark, sf_dir):
    return scoring.gate_summary(scoring.score_clips(_clips(spark, sf_dir)))


@query(
    "rejected_clips",
    with_entities("analyses", f""",{_SCORED}
    select vod_id, pos, final_score, case when reasons = '' then 'below_score_threshold' else reasons end as reason_codes
    from gated where not (eligible and final_score >= 3)"""),
)
def rejected_clips(spark, sf_dir):
    out = scoring.rejected_clips(scoring.score_clips(_clips(spark, sf_dir)))
    return out.select("vod_id", "pos", "final_score", F.array_join("reason_codes", ",").alias("reason_codes"))


@query(
    "duration_penalties",
    with_entities("analyses", """
    select vod_id, pos, 0::bigint + case when d <= 0 then 3 when d <= 60 then 0 when d <= 75 then 1 when d <= 90 then 2 else 3 end
               as penalty,
           0::bigint + case when d between 25 and 60 then 0 when d between 20 and 24 or d between 61 and 75 then 1
                when d between 15 and 19 or d between 76 and 90 then 2 else 3 end as banded_penalty,
           concat(d, 's ', case when d between 25 and 60 then 'optimal (25-60s band)'
                when d between 20 and 24 or d between 61 and 75 then 'acceptable with minor duration penalty'
                when d between 15 and 19 or d between 76 and 90 then 'risky duration band'
                else 'poor duration fit' end) as duration_fit
    from (select vod_id, pos, trim_end - trim_start as d from analyses)"""),
)
def duration_penalties(spark, sf_dir):
    s, e = F.col("trim_start"), F.col("trim_end")
    return entity(spark, sf_dir, "analyses").select(
        "vod_id",
        "pos",
        scalars.duration_penalty(s, e).alias("penalty"),
        scalars.banded_duration_penalty(s, e).alias("banded_penalty"),
        scalars.duration_fit(e - s).alias("duration_fit"),
    )


@query(
    "criticism_penalties",
    with_entities("analyses", """
    select vod_id, pos,
           least(5.0::double, round_even((abs(penalty_a) + abs(penalty_b))::double * 10000.0, 0) / 10000.0) as penalty
    from analyses"""),
)
def criticism_penalties(spark, sf_dir):
    given = F.array(F.col("penalty_a").cast("double"), F.col("penalty_b").cast("double"))
    return entity(spark, sf_dir, "analyses").select(
        "vod_id", "pos", scoring.criticism_penalty(given).alias("penalty")
    )


# Loose text fields, as a model reply may hold them.
_LOOSE = """
    loose as (
        select vod_id, pos, case pos % 4 when 0 then 'n/a' when 1 then cast(clip_worthiness as varchar)
                                 when 2 then concat(pos % 9, '.5') end as w,
               case pos % 3 when 0 then 'abc' when 1 then concat(trim_start, '.9') end as ts,
               case pos % 5 when 0 then 'false' when 1 then '' when 2 then 'yes' when 3 then '0' end as p
        from analyses)"""


@query(
    "typed_analysis_fields",
    with_entities("analyses", f""",{_LOOSE}
    select vod_id, pos, coalesce(try_cast(w as double), 0.0::double) as clip_worthiness,
           cast(trunc(try_cast(ts as double)) as bigint) as trim_start,
           case when p is null then true else p not in ('', '0') end as has_payoff,
           case when p is null then false else p not in ('', '0') end as requires_context
    from loose"""),
)
def typed_analysis_fields(spark, sf_dir):
    a = entity(spark, sf_dir, "analyses")
    p = F.col("pos")
    loose = a.select(
        "vod_id",
        "pos",
        F.when(p % 4 == 0, "n/a").when(p % 4 == 1, F.col("clip_worthiness").cast("string"))
        .when(p % 4 == 2, F.concat((p % 9).cast("string"), F.lit(".5"))).alias("clip_worthiness"),
        F.when(p % 3 == 0, "abc").when(p % 3 == 1, F.concat(F.col("trim_start").cast("string"), F.lit(".9"))).alias("trim_start"),
        F.lit("7.2").alias("trim_end"),
        F.when(p % 5 == 0, "false").when(p % 5 == 1, "").when(p % 5 == 2, "yes").when(p % 5 == 3, "0").alias("has_payoff"),
    ).withColumn("requires_context", F.col("has_payoff")).withColumn("transactional", F.lit(None).cast("string"))
    return scoring.typed_analysis(loose).select(
        "vod_id", "pos", "clip_worthiness", "trim_start", "has_payoff", "requires_context"
    )


_ENERGIES = """
    energies as (select vod_id, sec, sqrt(avg((x * x)::double)) as energy from samples group by all)"""


# The passage (a, b) of each list e of energies.
_PASSAGES = """
    levels as (
        select *, len(e) as n, list_position(e, list_max(e)) - 1 as peak,
               list_sort(e)[len(e) // 4 + 1] as floor_e, list_max(e) as top_e
        from lists),
    runs as (
        select *,
            coalesce(list_max(list_filter(range(0, n), lambda i: i < peak
                and e[i + 1] <= floor_e + (top_e - floor_e) * 0.15::double)) + 1, 0) as s1,
            coalesce(list_min(list_filter(range(0, n), lambda i: i > peak
                and e[i + 1] <= floor_e + (top_e - floor_e) * 0.15::double)), n) as t1,
            coalesce(list_max(list_filter(range(0, n), lambda i: i < peak
                and e[i + 1] <= floor_e + (top_e - floor_e) * 0.05::double)) + 1, 0) as s2,
            coalesce(list_min(list_filter(range(0, n), lambda i: i > peak
                and e[i + 1] <= floor_e + (top_e - floor_e) * 0.05::double)), n) as t2
        from levels),
    widened as (
        select *, case when t1 - s1 < 15 and t2 - s2 > t1 - s1 then s2 else s1 end as s3,
               case when t1 - s1 < 15 and t2 - s2 > t1 - s1 then t2 else t1 end as t3
        from runs),
    padded as (
        select *, case when t3 - s3 < 15 then greatest(0, s3 - (15 - t3 + s3) // 2) else s3 end as s4,
               case when t3 - s3 < 15 then least(n, t3 + (15 - t3 + s3) - (15 - t3 + s3) // 2) else t3 end as t4
        from widened),
    filled as (
        select *, case when t4 - s4 < 15 and s4 = 0 then least(n, t4 + 15 - t4 + s4) else t4 end as t5,
               case when t4 - s4 < 15 and s4 <> 0 and t4 = n then greatest(0, s4 - (15 - t4 + s4)) else s4 end as s5
        from padded),
    audio as (
        select vod_id, clip_id, n, case when t5 - s5 > 60 then greatest(0, (s5 + t5) // 2 - 30) else s5 end as a,
               case when t5 - s5 > 60 then least(n, (s5 + t5) // 2 + 30) else t5 end as b
        from filled)"""


@query("second_energies", with_entities("samples", f",{_ENERGIES} select * from energies"))
def second_energies(spark, sf_dir):
    return trim.second_energies(entity(spark, sf_dir, "samples"))


@query(
    "loudest_passages",
    with_entities("samples", f""",{_ENERGIES},
    lists as (
        select vod_id, vod_id as clip_id, list(energy order by sec) as e
        from (select g.vod_id, g.sec, coalesce(energy, 0.0::double) as energy
              from (select vod_id, unnest(range(0, max(sec) + 1)) as sec from energies group by vod_id) g
              left join energies using (vod_id, sec))
        group by all),
    {_PASSAGES},
    clips as (
        select s_suppkey as vod_id, s_suppkey as clip_id, 0::bigint as start_s,
               case when s_suppkey % 5 = 4 then 100 else 120 end as end_s,
               case when s_suppkey % 7 = 3 then 10 else 0 end as trim_start,
               case when s_suppkey % 5 = 4 then 100 else 120 end as trim_end
        from supplier)
    select c.vod_id, clip_id, start_s, end_s::bigint as end_s,
           case when due and n >= 15 then start_s + a when due and n is null then 38 else trim_start end as trim_start,
           case when due and n >= 15 then start_s + b when due and n is null then 83 else trim_end end as trim_end,
           case when due and (n >= 15 or n is null) then 'rms_fallback' else 'qwen' end as trim_source
    from (select *, trim_start = start_s and trim_end = end_s and end_s - start_s = 120 as due from clips) c
    left join audio using (vod_id, clip_id)"""),
)
def loudest_passages(spark, sf_dir):
    from ..adapters import table

    k = F.col("s_suppkey")
    end = F.when(k % 5 == 4, 100).otherwise(120).cast("bigint")
    clips = table(spark, sf_dir, "supplier").select(
        k.alias("vod_id"),
        k.alias("clip_id"),
        F.lit(0).cast("bigint").alias("start_s"),
        end.alias("end_s"),
        F.when(k % 7 == 3, 10).otherwise(0).cast("bigint").alias("trim_start"),
        end.alias("trim_end"),
    )
    energies = trim.second_energies(entity(spark, sf_dir, "samples"))
    return trim.loudest_passage(trim.attach_energies(clips, energies))
