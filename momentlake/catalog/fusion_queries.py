from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import chat, fusion, intervals
from ..plans.moments import ranked_moments as ranked_moments_plan
from ..runtime import shared_folder
from ..streaming.moments import run_islands
from . import query
from .chat_queries import _EMOTES, _SPIKE_CTES

_EXCITED = """
    excited as (
        select * from (
            select *, case when upper(text) = text and lower(text) <> text and length(text) > 5 then 20 else 0 end
                + case when contains(text, '!!!') or contains(text, '???') or contains(text, '...') then 15 else 0 end
                + case when len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) < 5
                       then 10 else 0 end as excitement
            from {src})
        where excitement > 25)"""

_MOMENTS = f"""
    {_SPIKE_CTES.format(w=600)}, {_EXCITED.format(src="speech")},
    moments as (
        select vod_id, 0 as src, start_s as pos, start_s, end_s, least(100.0, intensity * 20) as score,
               'chat_spike' as signal, message_count, cast(null as varchar) as text
        from spikes
        union all
        select vod_id, 1, pos, start_s, end_s, cast(least(100, 50 + excitement) as double), 'voice_excitement',
               null, text
        from excited),
    flagged as (
        select *, max(end_s) over (partition by vod_id order by start_s, src, pos
                                   rows between unbounded preceding and 1 preceding) as end_before
        from moments),
    numbered as (
        select *, sum(case when end_before is null or start_s >= end_before + 5 then 1 else 0 end)
                  over (partition by vod_id order by start_s, src, pos) as island
        from flagged),
    merged as (
        select vod_id, island, min(start_s) as start_s, max(end_s) as end_s, max(score) as score,
               string_agg(distinct signal, ',' order by signal) as signals,
               count(*) as members
        from numbered group by all),
    firsts as (
        select vod_id, island, text, message_count from numbered
        qualify row_number() over (partition by vod_id, island order by start_s, src, pos) = 1)
"""


@query(
    "excited_lines",
    with_entities(
        "speech", "," + _EXCITED.format(src="speech") + """
    select vod_id, pos, text, cast(excitement as bigint) as excitement,
           cast(least(100, 50 + excitement) as double) as score
    from excited"""),
)
def excited_lines(spark, sf_dir):
    return fusion.excited_lines(entity(spark, sf_dir, "speech")).select(
        "vod_id", "pos", "text", "excitement", "score"
    )


@query(
    "document_excitement",
    with_entities("titles", """
    select clip_id, 0::bigint + case when upper(title) = title and lower(title) <> title and length(title) > 5 then 20 else 0 end
        + case when contains(title, '!!!') or contains(title, '???') or contains(title, '...') then 15 else 0 end
        + case when len(list_filter(regexp_split_to_array(title, '\\s+'), lambda w: w <> '')) < 5
               then 10 else 0 end as excitement
    from titles"""),
)
def document_excitement(spark, sf_dir):
    return entity(spark, sf_dir, "titles").select("clip_id", fusion.excitement(F.col("title")).alias("excitement"))


@query(
    "moment_signals",
    with_entities(
        "chat speech", "," + _MOMENTS + """
    select vod_id, src::bigint as src, pos, start_s, end_s, score, signal, message_count, text from moments"""),
)
def moment_signals(spark, sf_dir):
    spikes = chat.spikes(entity(spark, sf_dir, "chat"), 600)
    return fusion.moment_signals(spikes, entity(spark, sf_dir, "speech"))


@query(
    "ranked_moments",
    with_entities(
        "chat speech", "," + _MOMENTS + """
    select m.vod_id, start_s, end_s, score, signals, text, message_count, members,
           row_number() over (partition by m.vod_id order by score desc, start_s) as rank
    from merged m join firsts using (vod_id, island)"""),
)
def ranked_moments(spark, sf_dir):
    moments = ranked_moments_plan(entity(spark, sf_dir, "chat"), entity(spark, sf_dir, "speech"), bin_seconds=600)
    return moments.withColumn("signals", F.array_join("signals", ","))


@query(
    "streamed_moments",
    with_entities(
        "chat speech", "," + _MOMENTS + """
    select m.vod_id, start_s, end_s, score, signals, text, message_count, members
    from merged m join firsts using (vod_id, island)"""),
)
def streamed_moments(spark, sf_dir):
    """Moments that land in files in the order of a hash, merged by a stream: as the batch run over all of them."""
    spikes = chat.spikes(entity(spark, sf_dir, "chat"), 600)
    moments = fusion.moment_signals(spikes, entity(spark, sf_dir, "speech"))
    landed, out, state = (shared_folder(spark, name) for name in ("landed", "islands", "stream"))
    moments.repartition(4, F.xxhash64("pos", "src")).write.parquet(landed)
    late = 100_000
    # The last file holds one moment after all others, which closes the islands before it.
    end = spark.read.parquet(landed).agg(F.coalesce(F.max("end_s"), F.lit(0)).alias("e"))
    last = end.select(
        F.lit(-1).alias("vod_id"), F.lit(0).alias("src"), F.lit(0).alias("pos"), (F.col("e") + 2 * late).alias("start_s"),
        (F.col("e") + 2 * late).alias("end_s"), F.lit(0.0).alias("score"), F.lit("end").alias("signal"),
        F.lit(None).alias("message_count"), F.lit(None).alias("text"),
    )
    kinds = moments.schema
    last.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds]).write.mode("append").parquet(landed)
    found = run_islands(spark, landed, out, state, kinds.simpleString()[7:-1].replace(":", " "), files_at_once=2, late_seconds=late)
    return found.where("kind = 'island'").drop("kind").withColumn("signals", F.array_join("signals", ","))


_SCENES = """
    scenes as (
        select vod_id, pos, label, t as start_s,
               row_number() over (partition by vod_id order by t, pos) - 1 as scene_index,
               coalesce(lead(t) over (partition by vod_id order by t, pos), t + 300) as end_s
        from cuts)"""


@query("scene_intervals", with_entities("cuts", f""",
    {_SCENES} select *, end_s - start_s as duration_s from scenes"""))
def scene_intervals(spark, sf_dir):
    return intervals.scenes_from_cuts(entity(spark, sf_dir, "cuts"))


@query(
    "timeline_fusion",
    with_entities("chat speech cuts", f""",
    {_EMOTES}, {_SCENES},
    last as (select vod_id, max(t) as last_t from chat group by all),
    activity as (
        select vod_id, t // 600 * 600 as window_start, count(*) as n from chat group by all),
    kept as (select a.* from activity a join last using (vod_id) where window_start < last_t),
    near as (
        select s.vod_id, s.pos, min(c.scene_index) as scene_index
        from speech s join scenes c on c.vod_id = s.vod_id and abs(s.start_s - c.start_s) <= 2
        group by all),
    counts as (
        select s.vod_id, s.pos, emote, count(*) as n, min(u.pos * 1000 + idx) as first_use
        from speech s join uses u on u.vod_id = s.vod_id and u.t between s.start_s - 15 and s.start_s + 15
        group by all),
    top as (
        select vod_id, pos, string_agg(emote, ',' order by n desc, first_use) as top_emotes
        from (select * from counts
              qualify row_number() over (partition by vod_id, pos order by n desc, first_use) <= 5)
        group by all)
    select s.vod_id, s.pos, s.start_s as t, s.text, near.scene_index is not null as scene_change, near.scene_index,
           case when k.n is null then 0.0::double else least(10.0::double, k.n / 600.0::double) end as chat_intensity,
           coalesce(top_emotes, '') as top_emotes
    from speech s
    left join kept k on k.vod_id = s.vod_id and k.window_start = s.start_s // 600 * 600
    left join near on near.vod_id = s.vod_id and near.pos = s.pos
    left join top on top.vod_id = s.vod_id and top.pos = s.pos"""),
)
def timeline_fusion(spark, sf_dir):
    scenes = intervals.scenes_from_cuts(entity(spark, sf_dir, "cuts"))
    out = fusion.timeline(
        entity(spark, sf_dir, "speech"), entity(spark, sf_dir, "chat"), scenes, window_seconds=600
    )
    return out.withColumn("top_emotes", F.array_join("top_emotes", ","))


@query(
    "spike_overlap_intensity",
    with_entities("chat speech", "," + _SPIKE_CTES.format(w=600) + """
    select s.vod_id, s.pos, s.start_s, s.end_s, coalesce(max(p.intensity), 0.0) as chat_intensity
    from speech s left join spikes p on p.vod_id = s.vod_id and p.start_s < s.end_s and p.end_s > s.start_s
    group by s.vod_id, s.pos, s.start_s, s.end_s"""),
)
def spike_overlap_intensity(spark, sf_dir):
    spikes = chat.spikes(entity(spark, sf_dir, "chat"), 600)
    return fusion.spike_intensity(entity(spark, sf_dir, "speech"), spikes).select(
        "vod_id", "pos", "start_s", "end_s", "chat_intensity"
    )
