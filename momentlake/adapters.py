"""Shapes the star-schema and text tables into livestream entities.

Each adapter is one SQL text that Spark and DuckDB read alike, so a query and
its check start from the same rows.  Adapters keep every row and every
character of their inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_SECOND_OF_DAY = "cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as bigint)"

ADAPTERS: dict[str, str] = {
    # One chat message per event; the day of the month is the video.
    "chat": f"""
        select cast(day(ts) as bigint) as vod_id, event_id as pos, {_SECOND_OF_DAY} as t,
               concat('user', cast(user_id as string)) as usr, props as message,
               case when value > 100 then split(concat(event_type, ',hype,', event_type), ',')
                    when value > 50 then split(event_type, ',') end as emotes
        from {{events}}""",
    # Short spoken lines on the same videos as `chat`.
    "speech": """
        select cast(day(o_orderdate) as bigint) as vod_id, o_orderkey as pos,
               (o_orderkey * 37) % 86400 as start_s,
               (o_orderkey * 37) % 86400 + 5 + o_custkey % 40 as end_s,
               case when o_orderstatus = 'O' then lower(o_orderpriority)
                    when o_totalprice > 300000 then concat(o_orderpriority, '!!!')
                    else o_orderpriority end as text,
               concat('SPEAKER_0', cast(o_custkey % 4 as string)) as speaker_label
        from {orders}""",
    # Diarized turns that only partly overlap the spoken lines.
    "turns": """
        select cast(day(o_orderdate) as bigint) as vod_id, o_orderkey as pos,
               (o_orderkey * 41) % 86400 as start_s,
               (o_orderkey * 41) % 86400 + 3 + o_custkey % 25 as end_s,
               concat('SPEAKER_0', cast(o_custkey % 4 as string)) as speaker_label,
               case cast(o_custkey % 4 as int) when 0 then 'streamer' when 1 then 'guest'
                    when 2 then 'Chatter' else null end as identity,
               case when o_custkey % 4 = 1 then 'Robin' end as inferred_name,
               cast((o_orderkey % 100) as double) / 100 as confidence
        from {orders}""",
    # Whole conversations laid on a time line, one line after the other.
    "segments": """
        select conv_id as vod_id, turn as pos, cast(s0 as bigint) as start_s,
               cast(s0 + dur as bigint) as end_s, text, role as speaker_label
        from (select *, coalesce(sum(dur + (turn % 4) * 3) over (
                    partition by conv_id order by turn
                    rows between unbounded preceding and 1 preceding), 0) as s0
              from (select *, greatest(1, cast(floor(length(text) / 15.0) as int)) as dur
                    from {conversations}) a) b""",
    # Chat lines that repeat whole conversation turns a little later.
    "echo_chat": """
        select conv_id as vod_id, turn as pos, cast(turn * 40 as bigint) as t,
               concat('viewer_', role) as usr, text as message
        from {conversations}""",
    "detections": f"""
        select cast(day(ts) as bigint) as vod_id, event_id as pos,
               cast(floor({_SECOND_OF_DAY} / 5.0) as bigint) * 5 as second_s,
               case event_type when 'click' then 'Person' when 'view' then 'laptop'
                    when 'purchase' then 'cup' when 'signup' then ' cat ' else 'clock' end as class_name,
               cast(floor(value) as bigint) % 100 / 100.0 as confidence
        from {{events}}""",
    # Cut times of scenes; the market segment gives the scene its label.
    "cuts": """
        select 1 + c_custkey % 30 as vod_id, c_custkey as pos, (c_custkey * 577) % 86400 as t,
               case c_mktsegment when 'BUILDING' then 'interaction' when 'MACHINERY' then 'highlight'
                    when 'HOUSEHOLD' then 'quiet' when 'FURNITURE' then 'intro' else 'other' end as label
        from {customer}""",
    # Discovery candidates: ten or so short clips per video.
    "candidates": """
        select o_custkey as vod_id, o_orderkey as pos,
               concat('cand_', cast(o_orderkey as string)) as candidate_id,
               (o_orderkey * 37) % 900 as start_s,
               (o_orderkey * 37) % 900 + 20 + (o_orderkey * 7919) % 61 as end_s,
               case o_orderstatus when 'F' then 'story' when 'O' then 'chat_reveal' else 'reaction' end
                   as narrative_type,
               lower(concat(o_orderpriority, case when o_totalprice > 250000
                     then ' big donation alert' else ' quick laugh' end)) as trigger_text,
               case when o_totalprice > 350000 then 'chat loses it' when o_totalprice > 150000
                    then 'the streamer laughs' else 'a viewer story lands' end as payoff_text,
               cast(floor(o_totalprice / 5000) as bigint) % 101 / 100.0 as confidence,
               cast(cast(floor(o_totalprice / 1000) as bigint) % 11 as double) as worthiness
        from {orders}""",
    # Landed model analyses of the same candidates.
    "analyses": """
        select o_custkey as vod_id, o_orderkey as pos,
               (o_orderkey * 37) % 900 as start_s,
               case when o_custkey % 5 = 0 then (o_orderkey * 37) % 900 + 120
                    else (o_orderkey * 37) % 900 + 20 + (o_orderkey * 7919) % 61 end as end_s,
               cast(cast(floor(o_totalprice / 1000) as bigint) % 13 as double) as clip_worthiness,
               case when o_custkey % 5 = 0 then (o_orderkey * 37) % 900
                    else (o_orderkey * 37) % 900 + o_orderkey % 12 - 3 end as trim_start,
               case when o_custkey % 5 = 0 then (o_orderkey * 37) % 900 + 120
                    else (o_orderkey * 37) % 900 + 18 + (o_orderkey * 7919) % 61 + o_orderkey % 7 end as trim_end,
               o_orderstatus <> 'P' as has_payoff, o_orderkey % 6 = 0 as requires_context,
               o_orderkey % 9 = 0 as transactional,
               case when o_orderkey % 2 = 0 then 'short arc'
                    else 'a setup that builds to a clear reveal' end as narrative_arc,
               case when o_orderkey % 3 = 0 then 'trimmed to the reaction beat' else '' end as trim_reason,
               o_orderkey % 10 as tiktok_score, o_orderkey % 8 as shorts_score,
               o_orderkey % 4 = 1 as recommends_tiktok, o_orderkey % 11 = 1 as recommends_shorts,
               (o_orderkey % 5 - 2) * 0.5 as penalty_a, (o_orderkey % 7) * 0.25 as penalty_b,
               o_orderkey % 13 as gap_len, o_orderkey % 17 * 2.0 / 100 as dead_air_ratio,
               o_orderkey % 10 = 3 as audio_dead_air, o_orderkey % 14 = 5 as music_only
        from {orders}""",
    # Whole documents as clip titles; the crawl source is the video.
    "titles": """
        select source as vod_id, doc_id as clip_id, text as title,
               cast(n_chars % 1000 as double) / 100 as score
        from {documents}""",
    "claims": """
        select d.lang as streamer_id, d.source as vod_id, d.doc_id as pos, d.text as claim,
               (d.doc_id % 100) / 100.0 as confidence, 1 + d.doc_id % 3 as n_evidence,
               case when coalesce(l.quality, 0) = 1 then 'inside_joke' else 'content_pattern' end as kind
        from {documents} d left join {labels} l on d.doc_id = l.doc_id""",
    "turn_embeddings": """
        select vec_id % 5 as vod_id, cast(label as bigint) as speaker, vec_id as pos,
               1 + vec_id % 5 as dur, embedding
        from {embeddings}""",
    # Short exchanges in which people introduce themselves or call each other by name.
    "dialogue": """
        select o_custkey as vod_id, o_orderkey as pos, (o_orderkey * 3) % 40 + 6 * (o_orderkey % 5) as start_s,
               concat('SPEAKER_0', cast(o_orderkey % 3 as string)) as speaker_label,
               case cast(o_orderkey % 7 as int)
                   when 0 then concat('Hey Robin', cast(o_orderkey % 4 as string), ' did you see that')
                   when 1 then concat('I am Robin', cast(o_orderkey % 3 as string), ' and this is fun')
                   when 2 then concat('thanks Alex, thank you sam', cast(o_orderkey % 2 as string), ' for the raid')
                   when 3 then 'ALEX here, my name is alex'
                   when 4 then concat('ok kim', cast(o_orderkey % 3 as string), ', what do you think')
                   when 5 then 'no names today' else 'hi hello Kim hey kim' end as text
        from {orders}""",
    "dialogue_chat": """
        select o_custkey as vod_id, o_orderkey as pos,
               case when o_orderkey % 2 = 0 then ' Kim1' when o_orderkey % 3 = 0 then 'ROBIN0' else 'viewer' end as usr
        from {orders}""",
    # Triage candidates as loosely typed replies.
    "triage_raw": """
        select o_custkey as vod_id, o_orderkey as pos, (o_orderkey * 37) % 900 as fallback_start,
               (o_orderkey * 37) % 900 + 60 as fallback_end,
               case when o_orderkey % 11 = 0 then 'bad' else cast((o_orderkey * 37) % 900 as string) end as start_txt,
               case when o_orderkey % 13 > 0 then cast((o_orderkey * 37) % 900 + (o_orderkey % 9 - 1) * 10 as string) end
                   as end_txt,
               case when o_orderkey % 5 > 0 then concat(cast((o_orderkey * 37) % 900 + o_orderkey % 30 - 5 as string), '.7') end
                   as trim_start_txt,
               case when o_orderkey % 4 > 0 then cast((o_orderkey * 37) % 900 + o_orderkey % 70 as string) end as trim_end_txt,
               case when o_orderkey % 17 = 0 then 'not-a-number'
                    else cast(cast(floor(o_totalprice / 1000) as bigint) % 13 as string) end as score_txt,
               case when o_orderkey % 19 > 0 then concat('0.', cast(o_custkey % 97 as string)) end as confidence_txt,
               case when o_orderkey % 3 = 0 then concat('  cand ', cast(o_orderkey as string), ' ')
                    when o_orderkey % 3 = 1 then '  ' end as id_txt,
               case o_orderstatus when 'F' then ' story ' when 'O' then '' end as narrative_txt,
               case when o_orderkey % 4 = 0 then ' Critical' when o_orderkey % 4 = 1 then 'maybe'
                    when o_orderkey % 4 = 2 then 'verify_scene' end as need_txt,
               split(case o_orderpriority when '1-URGENT' then 'Chat_Spike, laugh' when '2-HIGH' then 'sound,audio, '
                    when '3-MEDIUM' then 'coverage' when '5-LOW' then 'scene_change,reaction,reaction'
                    else 'text_top_rank,visual_novelty' end, ',') as reasons,
               split(case when o_orderkey % 6 = 0 then ' a line, ,a line,b' else ' ' end, ',') as evidence
        from {orders}""",
    # One annotation window per chat event.
    "annotations_raw": f"""
        select cast(day(ts) as bigint) as vod_id, event_id as pos,
               {_SECOND_OF_DAY} - {_SECOND_OF_DAY} % 30 as start_s, {_SECOND_OF_DAY} - {_SECOND_OF_DAY} % 30 + 30 as end_s,
               {_SECOND_OF_DAY} as t, event_type, props, cast(floor(value) as bigint) as v, user_id
        from {{events}}""",
    # Signed audio samples, 120 seconds per video.
    "samples": """
        select l_suppkey as vod_id, l_partkey % 120 as sec,
               cast(round((l_tax - 0.04) * 100) as bigint) * (1 + l_partkey % 7) as x
        from {lineitem}""",
    "game_segments": """
        select 1 + s_suppkey % 30 as vod_id, s_suppkey as pos, (s_suppkey * 7919) % 86400 as start_s,
               case when s_suppkey % 4 = 0 then null else (s_suppkey * 7919) % 86400 + 9000 + s_suppkey * 11 end
                   as end_s,
               concat('g', cast(s_nationkey as string)) as game_id, n_name as game_name
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
}


def _uses(sql: str) -> list[str]:
    return [t for t in TABLES if "{" + t + "}" in sql]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter ``name`` as a DataFrame over the parquet tables in ``sf_dir``."""
    sql = ADAPTERS[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in _uses(sql)})


def with_entities(names: str, body: str, recursive: bool = False) -> str:
    """Check SQL: the named adapters as common table expressions before ``body``."""
    ctes = []
    for name in names.split():
        sql = ADAPTERS[name]
        for t in TABLES:
            sql = sql.replace("{" + t + "}", t)
        ctes.append(f"{name} as ({sql})")
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(ctes) + "\n" + body
