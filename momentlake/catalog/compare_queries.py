from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import compare
from . import query

_RUNS = """
    runs as (
        select 'base' as run, vod_id, pos, clip_worthiness as score, trim_start, trim_end,
               case when pos % 5 > 0 then concat('Title, ', pos % 3, '!') else ' ' end as clip_point,
               case when pos % 6 = 0 then 'rms_fallback' else 'qwen' end as trim_source
        from analyses
        union all
        select 'next', vod_id, pos, clip_worthiness / 2, trim_start + 1, trim_end, concat('title ', pos % 4), 'qwen'
        from analyses where has_payoff),
    titled as (
        select run, vod_id, count(*) as n, count(distinct replace(replace(lower(clip_point), ',', ''), '!', '')) as k
        from runs where trim(clip_point) <> '' group by all),
    metrics as (
        select run, vod_id, count(*) as selected_count, round_even(avg(score) * 10000.0, 0) / 10000.0 as score_mean,
               min(score) as score_min, max(score) as score_max,
               round_even(avg(trim_end - trim_start) * 10000.0, 0) / 10000.0 as trim_width_mean,
               median(trim_end - trim_start)::double as trim_width_median, min(trim_end - trim_start) as trim_width_min,
               max(trim_end - trim_start) as trim_width_max, coalesce(any_value(n) - any_value(k), 0) as duplicate_title_count,
               coalesce(round_even((any_value(n) - any_value(k)) / any_value(n)::double * 10000.0, 0) / 10000.0, 0)
                   as duplicate_title_rate,
               count_if(trim_source = 'rms_fallback')::bigint as rms_fallback_count,
               round_even(count_if(trim_source = 'rms_fallback') / count(*)::double * 10000.0, 0) / 10000.0 as rms_fallback_rate
        from runs left join titled using (run, vod_id) group by run, vod_id)"""


def _runs(spark, sf_dir):
    a = entity(spark, sf_dir, "analyses")
    p = F.col("pos")
    base = a.select(
        F.lit("base").alias("run"), "vod_id", F.col("clip_worthiness").alias("score"), "trim_start", "trim_end",
        F.when(p % 5 > 0, F.concat(F.lit("Title, "), (p % 3).cast("string"), F.lit("!"))).otherwise(" ").alias("clip_point"),
        F.when(p % 6 == 0, "rms_fallback").otherwise("qwen").alias("trim_source"),
    )
    after = a.where("has_payoff").select(
        F.lit("next"), "vod_id", F.col("clip_worthiness") / 2, F.col("trim_start") + 1, "trim_end",
        F.concat(F.lit("title "), (p % 4).cast("string")), F.lit("qwen"),
    )
    return compare.run_metrics(base.unionAll(after))


@query("run_metrics", with_entities("analyses", f",{_RUNS} select * from metrics"))
def run_metrics(spark, sf_dir):
    return _runs(spark, sf_dir)


_TALL = " union all ".join(
    f"select run, vod_id, '{m}' as metric, {m}::double as v from metrics" for m in compare.METRICS
)


@query(
    "run_metric_deltas",
    with_entities("analyses", f""",{_RUNS}, tall as ({_TALL})
    select vod_id, metric, coalesce(max(v) filter (run = 'base'), 0) as baseline,
           coalesce(max(v) filter (run = 'next'), 0) as candidate,
           round_even((coalesce(max(v) filter (run = 'next'), 0) - coalesce(max(v) filter (run = 'base'), 0)) * 10000.0, 0)
               / 10000.0 as delta
    from tall group by vod_id, metric"""),
)
def run_metric_deltas(spark, sf_dir):
    m = _runs(spark, sf_dir)
    return compare.compare_metrics(m.where("run = 'base'").drop("run"), m.where("run = 'next'").drop("run"))


# The baseline are the candidates; the other sets keep, shift or drop some of them.
_SETS = """
    base as (select distinct vod_id, start_s, end_s from candidates),
    windows as (select distinct vod_id, start_s // 30 * 30 as start_s, start_s // 30 * 30 + 30 as end_s from candidates),
    triage as (select distinct vod_id, start_s + pos % 3 as start_s, end_s from candidates),
    shortlist as (select distinct vod_id, start_s, end_s from candidates where narrative_type = 'story'),
    final as (select distinct vod_id, start_s, end_s from candidates where worthiness >= 5)"""


def _sets(spark, sf_dir):
    c = entity(spark, sf_dir, "candidates")
    grid = F.floor(F.col("start_s") / 30) * 30
    return c, {
        "windows": c.select("vod_id", grid.alias("start_s"), (grid + 30).alias("end_s")),
        "triage": c.select("vod_id", (F.col("start_s") + F.col("pos") % 3).alias("start_s"), "end_s"),
        "shortlist": c.where("narrative_type = 'story'"),
        "final": c.where("worthiness >= 5"),
    }


@query(
    "recall_coverage",
    with_entities("candidates", f""",{_SETS},
    flags as (
        select b.*, (vod_id, start_s, end_s) in (select (vod_id, start_s, end_s) from windows) as w,
               (vod_id, start_s, end_s) in (select (vod_id, start_s, end_s) from triage) as t,
               (vod_id, start_s, end_s) in (select (vod_id, start_s, end_s) from shortlist) as s,
               (vod_id, start_s, end_s) in (select (vod_id, start_s, end_s) from final) as f
        from base b)
    select vod_id, count(*) as baseline_count,
           round_even(count_if(w) / count(*)::double * 10000.0, 0) / 10000.0 as windows_coverage,
           round_even(count_if(t) / count(*)::double * 10000.0, 0) / 10000.0 as triage_coverage,
           round_even(count_if(s) / count(*)::double * 10000.0, 0) / 10000.0 as shortlist_coverage,
           round_even(count_if(f) / count(*)::double * 10000.0, 0) / 10000.0 as final_coverage
    from flags group by all"""),
)
def recall_coverage(spark, sf_dir):
    base, sets = _sets(spark, sf_dir)
    return compare.coverage(base, sets)


@query(
    "missing_clip_keys",
    with_entities("candidates", f",{_SETS} select * from base except select * from final"),
)
def missing_clip_keys(spark, sf_dir):
    base, sets = _sets(spark, sf_dir)
    return compare.missing_keys(base, sets["final"])


@query(
    "shared_clip_keys",
    with_entities("candidates", f",{_SETS} select * from base intersect select * from triage"),
)
def shared_clip_keys(spark, sf_dir):
    base, sets = _sets(spark, sf_dir)
    return compare.shared_keys(base, sets["triage"])


def _nearest(name: str) -> str:
    return f"""
    near_{name} as (
        select m.vod_id, m.start_s, m.end_s, c.start_s as s, c.end_s as e from missed m join {name} c using (vod_id)
        qualify row_number() over (partition by m.vod_id, m.start_s, m.end_s order by
            abs(c.start_s - m.start_s) + abs(c.end_s - m.end_s), abs(c.start_s - m.start_s), abs(c.end_s - m.end_s),
            c.start_s desc, c.end_s desc) = 1)"""


@query(
    "missed_clip_neighbours",
    with_entities("candidates", f""",{_SETS},
    missed as (select * from base except select * from final),
    {_nearest('windows')},{_nearest('triage')},{_nearest('shortlist')}
    select m.*, w.s as windows_start, w.e as windows_end, t.s as triage_start, t.e as triage_end,
           l.s as shortlist_start, l.e as shortlist_end
    from missed m left join near_windows w using (vod_id, start_s, end_s)
    left join near_triage t using (vod_id, start_s, end_s) left join near_shortlist l using (vod_id, start_s, end_s)"""),
)
def missed_clip_neighbours(spark, sf_dir):
    base, sets = _sets(spark, sf_dir)
    missed = compare.missing_keys(base, sets["final"])
    return compare.nearest_keys(missed, {n: sets[n] for n in ("windows", "triage", "shortlist")})


@query(
    "run_deltas",
    with_entities("analyses", """,
    stats as (
        select vod_id, sum(clip_worthiness) + 0.7 as runtime, count(*) as calls,
               case when vod_id % 3 > 0 then cast(sum(gap_len) as bigint) end as images
        from analyses group by vod_id)
    select vod_id, cast(floor(runtime * 2) as bigint) - cast(floor(runtime) as bigint) as runtime_delta_seconds,
           case when vod_id % 4 > 0 then 3::bigint end as call_delta, -images // 1 + images * 2 as image_delta
    from stats"""),
)
def run_deltas(spark, sf_dir):
    v = F.col("vod_id")
    stats = entity(spark, sf_dir, "analyses").groupBy("vod_id").agg(
        (F.sum("clip_worthiness") + 0.7).alias("runtime"), F.count(F.lit(1)).alias("calls"), F.sum("gap_len").alias("images")
    )
    baseline = stats.select(
        "vod_id", compare.first_number(F.lit(None), F.col("runtime")).alias("runtime_seconds"), "calls",
        F.when(v % 3 > 0, F.col("images")).alias("images"),
    )
    run = stats.select(
        "vod_id", (F.col("runtime") * 2).alias("runtime_seconds"), F.when(v % 4 > 0, F.col("calls") + 3).alias("calls"),
        (F.col("images") * 2).alias("images"),
    )
    return compare.run_deltas(baseline, run)
