from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..functions import titles as T
from . import query

_NORM = """
    words as (
        select vod_id, clip_id, score, regexp_extract_all(lower(title), '[a-z0-9'']+') as w from titles),
    stems as (
        select vod_id, clip_id, score, array_to_string(w, ' ') as norm,
               list_distinct(list_transform(list_filter(w, lambda x: length(x) >= 3), lambda x:
                   case when length(x) > 4 and suffix(x, 'ing') then left(x, length(x) - 3)
                        when length(x) > 4 and suffix(x, 'ed') then left(x, length(x) - 2)
                        when length(x) > 4 and suffix(x, 'es') then left(x, length(x) - 2)
                        when length(x) > 4 and suffix(x, 's') then left(x, length(x) - 1) else x end)) as tok
        from words)"""


@query(
    "normalised_titles",
    with_entities("titles", f""",{_NORM}
    select clip_id, norm, len(tok) as token_count, array_to_string(list_sort(tok), ' ') as tokens from stems"""),
)
def normalised_titles(spark, sf_dir):
    tok = T.title_tokens(F.col("title"))
    return entity(spark, sf_dir, "titles").select(
        "clip_id",
        T.normalise_title(F.col("title")).alias("norm"),
        F.size(tok).alias("token_count"),
        F.array_join(F.array_sort(tok), " ").alias("tokens"),
    )


@query(
    "compare_titles",
    with_entities("titles", r"""
    select clip_id, trim(regexp_replace(regexp_replace(lower(title), '[!-/:-@\[-`{-~]', '', 'g'), '\s+', ' ', 'g'))
               as compare_title
    from titles"""),
)
def compare_titles(spark, sf_dir):
    return entity(spark, sf_dir, "titles").select("clip_id", T.compare_title(F.col("title")).alias("compare_title"))


_TALK = """
    talk as (
        select vod_id, pos, case cast(pos % 6 as int)
                   when 0 then concat('chat message from ''viewer', pos % 7, ''' about a ', narrative_type, ' run. ')
                   when 1 then concat('Chat message at ', start_s, 's: ''', trigger_text, '''|second idea')
                   when 2 then concat(' | message | about the ', payoff_text, ' ;')
                   when 3 then concat('someone talks about chat message from bob about ', trigger_text)
                   when 4 then 'chat message' else concat('plain  ', trigger_text) end as said,
               trigger_text, payoff_text, narrative_type
        from candidates)"""


def _talk(spark, sf_dir):
    p, c = F.col("pos"), F.lit
    s = lambda x: x.cast("string")
    said = (
        F.when(p % 6 == 0, F.concat(c("chat message from 'viewer"), s(p % 7), c("' about a "), "narrative_type", c(" run. ")))
        .when(p % 6 == 1, F.concat(c("Chat message at "), s(F.col("start_s")), c("s: '"), "trigger_text", c("'|second idea")))
        .when(p % 6 == 2, F.concat(c(" | message | about the "), "payoff_text", c(" ;")))
        .when(p % 6 == 3, F.concat(c("someone talks about chat message from bob about "), "trigger_text"))
        .when(p % 6 == 4, "chat message")
        .otherwise(F.concat(c("plain  "), "trigger_text"))
    )
    return entity(spark, sf_dir, "candidates").withColumn("said", said)


@query(
    "chat_topics",
    with_entities("candidates", f""",{_TALK}
    select vod_id, pos, case cast(pos % 6 as int) when 0 then concat('a ', narrative_type, ' run')
                   when 1 then trigger_text when 2 then concat('the ', payoff_text)
                   when 3 then 'a viewer story' when 4 then 'a viewer story'
                   else concat('plain ', trigger_text) end as topic
    from talk"""),
)
def chat_topics(spark, sf_dir):
    return _talk(spark, sf_dir).select("vod_id", "pos", T.chat_topic(F.col("said")).alias("topic"))


@query(
    "generated_titles",
    with_entities("candidates", f""",{_TALK}
    select vod_id, pos, case
        when pos % 4 = 0 and narrative_type = 'chat_reveal' and pos % 6 = 3
            then concat('What happens when chat drops a message about ', trigger_text, '?')
        when pos % 4 = 0 then trim(said)
        when narrative_type = 'chat_reveal'
            then concat('What happens when chat drops a message about ', trigger_text, '?')
        else concat('The moment ', trigger_text, ' led to ', lower(payoff_text)) end as title
    from talk"""),
)
def generated_titles(spark, sf_dir):
    point = F.when(F.col("pos") % 4 == 0, F.col("said"))
    title = T.generate_title(point, F.col("narrative_type"), F.col("trigger_text"), F.col("payoff_text"))
    return _talk(spark, sf_dir).select("vod_id", "pos", title.alias("title"))


@query(
    "guarded_titles",
    with_entities("candidates", """
    select vod_id, pos,
           case when pos % 3 = 0 then title when pos % 3 = 1 then title
                else concat(case payoff_text when 'the streamer laughs' then 'Laughs' when 'chat loses it' then 'Chat loses it'
                                 else 'A viewer story lands' end, ', after: ', upper(trigger_text[1]), trigger_text[2:]) end as title
    from (select *, concat('The moment ', trigger_text, ' led to ', payoff_text) as title from candidates)"""),
)
def guarded_titles(spark, sf_dir):
    who = F.when(F.col("pos") % 3 == 1, "Streamer").when(F.col("pos") % 3 == 2, "guest")
    title = F.concat(F.lit("The moment "), "trigger_text", F.lit(" led to "), "payoff_text")
    return entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", T.guard_title(title, who, F.col("trigger_text"), F.col("payoff_text")).alias("title")
    )
