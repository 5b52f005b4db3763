from __future__ import annotations

from ..adapters import entity, with_entities
from ..operators import chat
from . import query

_EMOTES = """
    uses as (
        select vod_id, t, pos, u.i as idx, emotes[u.i] as emote
        from (select *, unnest(range(1, len(emotes) + 1)) as i from chat where emotes is not null) u)"""


@query(
    "chat_activity_windows",
    with_entities("chat", f""",
    {_EMOTES},
    base as (
        select vod_id, t // 600 * 600 as window_start, count(*) as message_count,
               count(distinct usr) as unique_users
        from chat group by all),
    last as (select vod_id, max(t) as last_t from chat group by all),
    counts as (
        select vod_id, t // 600 * 600 as window_start, emote, count(*) as n, min(pos * 1000 + idx) as first_use
        from uses group by all),
    peaks as (
        select * from counts
        qualify row_number() over (partition by vod_id, window_start order by n desc, first_use) = 1)
    select b.vod_id, b.window_start, b.window_start + 600 as window_end, message_count, unique_users,
           p.emote as peak_emote, coalesce(p.n, 0) as peak_emote_count
    from base b join last using (vod_id) left join peaks p using (vod_id, window_start)
    where b.window_start < last_t"""),
)
def chat_activity_windows(spark, sf_dir):
    return chat.activity_windows(entity(spark, sf_dir, "chat"), 600)


@query(
    "chat_totals",
    with_entities("chat", """
    select vod_id, count(*) as total_messages, count(distinct usr) as unique_chatters,
           cast(sum(coalesce(len(emotes), 0)) as bigint) as total_emotes
    from chat group by all"""),
)
def chat_totals(spark, sf_dir):
    return chat.totals(entity(spark, sf_dir, "chat"))


_SPIKE_CTES = """
    bins as (select vod_id, t // {w} as bin, count(*) as c from chat group by all),
    stats as (
        select vod_id, max(bin) + 1 as n, cast(sum(c) as hugeint) as s, cast(sum(c::hugeint * c) as hugeint) as q
        from bins group by all),
    spikes as (
        select vod_id, bin * {w} as start_s, (bin + 1) * {w} as end_s,
               (c * n - s) / sqrt(cast(n * q - s * s as double)) as intensity, c as message_count
        from bins join stats using (vod_id)
        where n * q - s * s > 0 and (c * n - s) / sqrt(cast(n * q - s * s as double)) > 2)"""


@query("chat_spikes", with_entities("chat", "," + _SPIKE_CTES.format(w=600) + "select * from spikes"))
def chat_spikes(spark, sf_dir):
    return chat.spikes(entity(spark, sf_dir, "chat"), 600)


@query(
    "chat_top_emotes",
    with_entities("chat", f""",
    {_EMOTES},
    counts as (select vod_id, emote, count(*) as uses, min(pos * 1000 + idx) as first_use from uses group by all)
    select vod_id, row_number() over (partition by vod_id order by uses desc, first_use) as rank, emote, uses
    from counts qualify rank <= 3"""),
)
def chat_top_emotes(spark, sf_dir):
    return chat.top_emotes(entity(spark, sf_dir, "chat"), 3)


@query(
    "emotes_around_lines",
    with_entities("chat speech", f""",
    {_EMOTES},
    points as (select distinct vod_id, start_s as t from speech),
    counts as (
        select p.vod_id, p.t, emote, count(*) as uses, min(pos * 1000 + idx) as first_use
        from points p join uses u on u.vod_id = p.vod_id and u.t between p.t - 120 and p.t + 120
        group by all)
    select vod_id, t, row_number() over (partition by vod_id, t order by uses desc, first_use) as rank, emote, uses
    from counts qualify rank <= 5"""),
)
def emotes_around_lines(spark, sf_dir):
    from pyspark.sql import functions as F

    points = entity(spark, sf_dir, "speech").select("vod_id", F.col("start_s").alias("t"))
    return chat.emotes_around(points, entity(spark, sf_dir, "chat"), radius_seconds=120)
