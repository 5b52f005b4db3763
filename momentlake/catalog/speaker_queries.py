from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..functions import names as name_functions
from ..functions.scalars import round_half_even
from ..operators import speakers
from . import query


@query(
    "speaker_alignment",
    with_entities("speech turns", """,
    pairs as (
        select s.vod_id, s.pos, t.speaker_label,
               least(s.end_s, t.end_s) - greatest(s.start_s, t.start_s) as shared, s.end_s - s.start_s as len
        from speech s join turns t on t.vod_id = s.vod_id and t.start_s < s.end_s and s.start_s < t.end_s
        qualify row_number() over (partition by s.vod_id, s.pos
                                   order by shared desc, t.start_s, t.end_s, t.speaker_label) = 1)
    select s.vod_id, s.pos, s.start_s, s.end_s, s.text,
           case when shared / len::double >= 0.3::double then p.speaker_label else 'UNKNOWN' end as speaker_label
    from speech s left join pairs p on p.vod_id = s.vod_id and p.pos = s.pos"""),
)
def speaker_alignment(spark, sf_dir):
    return speakers.align_speakers(entity(spark, sf_dir, "speech"), entity(spark, sf_dir, "turns"))


@query(
    "non_overlapping_turns",
    with_entities("turns", """,
    ordered as (
        select *, max(end_s) over (partition by vod_id order by start_s, end_s, pos
                                   rows between unbounded preceding and 1 preceding) as busy
        from turns)
    select vod_id, pos, speaker_label, greatest(start_s, coalesce(busy, start_s)) as start_s, end_s
    from ordered where end_s > greatest(start_s, coalesce(busy, start_s))"""),
)
def non_overlapping_turns(spark, sf_dir):
    out = speakers.non_overlapping_turns(entity(spark, sf_dir, "turns"))
    return out.select("vod_id", "pos", "speaker_label", "start_s", "end_s")


_PICKED = """
    ranked as (
        select *, row_number() over (partition by vod_id, speaker order by dur desc, pos) as rank,
               sum(dur) over (partition by vod_id, speaker order by dur desc, pos
                              rows between unbounded preceding and current row) as acc
        from turn_embeddings where dur >= 1.5),
    picked as (select * from ranked),
    cluster_dims as (
        select vod_id, speaker, i, avg(v::double) as m, count(*) as turns_used
        from (select vod_id, speaker, unnest(embedding) as v, unnest(range(0, len(embedding))) as i from picked)
        group by all),
    clusters as (
        select vod_id, speaker, list(m order by i) as embedding, min(turns_used) as turns_used
        from cluster_dims group by all)"""

_PROFILES = """
    unit as (
        select speaker, list_transform(embedding, lambda x: x::double
                   / sqrt(list_sum(list_transform(embedding, lambda y: y::double * y::double)))) as v
        from turn_embeddings),
    profile_dims as (
        select speaker, i, avg(x) as m, count(*) as samples
        from (select speaker, unnest(v) as x, unnest(range(0, len(v))) as i from unit) group by all),
    profile_means as (
        select speaker, list(m order by i) as m, min(samples) as samples from profile_dims group by all),
    profiles as (
        select speaker as profile_id, samples, list_transform(m, lambda x: x
                   / sqrt(list_sum(list_transform(m, lambda y: y * y)))) as embedding
        from profile_means)"""


def _turn_rows(spark, sf_dir):
    return entity(spark, sf_dir, "turn_embeddings").withColumn(
        "speaker_label", F.concat(F.lit("voice"), F.col("speaker").cast("string"))
    )


def _profile_rows(spark, sf_dir):
    samples = entity(spark, sf_dir, "turn_embeddings").withColumn("profile_id", F.col("speaker"))
    enrolled = speakers.enroll_profiles(samples)
    role = F.when(F.col("profile_id") % 3 == 0, "streamer").when(F.col("profile_id") % 3 == 1, "guest").otherwise("dj")
    return enrolled.select(
        F.col("profile_id").alias("pos"),
        "profile_id",
        role.alias("role"),
        "embedding",
        F.lit(0.3).alias("accept_similarity"),
        F.when(F.col("profile_id") % 2 == 0, 0.5).alias("high_confidence_similarity"),
    )


def _dims(column):
    return F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size(column) - 1).alias("i"), F.col(column).alias("x")))


@query(
    "cluster_embeddings",
    with_entities("turn_embeddings", f""",{_PICKED}
    select vod_id, concat('voice', speaker) as speaker_label, turns_used, i,
           round_even(m * 1000000.0, 0) / 1000000.0 as value
    from cluster_dims"""),
)
def cluster_embeddings(spark, sf_dir):
    out = speakers.cluster_embeddings(_turn_rows(spark, sf_dir))
    return out.select("vod_id", "speaker_label", "turns_used", F.posexplode("embedding").alias("i", "value")).withColumn(
        "value", round_half_even("value", 6)
    )


@query(
    "enrolled_profiles",
    with_entities("turn_embeddings", f""",{_PROFILES}
    select profile_id, samples, unnest(range(0, len(embedding))) as i,
           unnest(list_transform(embedding, lambda x: round_even(x * 1000000.0, 0) / 1000000.0)) as value
    from profiles"""),
)
def enrolled_profiles(spark, sf_dir):
    samples = entity(spark, sf_dir, "turn_embeddings").withColumn("profile_id", F.col("speaker"))
    out = speakers.enroll_profiles(samples)
    return out.select("profile_id", "samples", F.posexplode("embedding").alias("i", "value")).withColumn(
        "value", round_half_even("value", 6)
    )


_RECOGNISED = f"""{_PICKED},{_PROFILES},
    scores as (
        select c.vod_id, c.speaker, p.profile_id, list_cosine_similarity(c.embedding, p.embedding) as s
        from clusters c join profiles p on c.vod_id % 2 = p.profile_id % 2
        qualify row_number() over (partition by c.vod_id, c.speaker order by s desc, p.profile_id) = 1),
    thresholds as (
        select *, 0.3::double as a, case when profile_id % 2 = 0 then 0.5 else 0.8 end as h,
               case profile_id % 3 when 0 then 'streamer' when 1 then 'guest' else 'unknown' end as role
        from scores),
    labels as (select distinct vod_id, speaker from turn_embeddings),
    recognition as (
        select l.vod_id, concat('voice', l.speaker) as speaker_label,
               case when s >= a then role else 'unknown' end as identity,
               case when s >= h then greatest(0.85::double, least(1.0::double, (s - a) / (1 - a)))
                    when s >= a then least(1.0::double, (s - a) / (1 - a)) else 0.0::double end as confidence,
               case when s >= a or s >= 0 then s end as cosine_similarity,
               case when s >= a then profile_id end as profile_id
        from labels l left join thresholds using (vod_id, speaker))"""


def _recognition(spark, sf_dir):
    turns = _turn_rows(spark, sf_dir)
    # Two streamers: the videos and the voices with even and with odd numbers.
    clusters = speakers.cluster_embeddings(turns).withColumn("streamer_id", F.col("vod_id") % 2)
    profiles = _profile_rows(spark, sf_dir).withColumn("streamer_id", F.col("profile_id") % 2)
    return speakers.recognise_clusters(clusters, profiles, turns)


@query(
    "speaker_recognition",
    with_entities("turn_embeddings", f""",{_RECOGNISED}
    select vod_id, speaker_label, identity, round_even(confidence * 1000000.0, 0) / 1000000.0 as confidence,
           round_even(cosine_similarity * 1000000.0, 0) / 1000000.0 as cosine_similarity, profile_id
    from recognition"""),
)
def speaker_recognition(spark, sf_dir):
    return (
        _recognition(spark, sf_dir)
        .withColumn("confidence", round_half_even("confidence", 6))
        .withColumn("cosine_similarity", round_half_even("cosine_similarity", 6))
    )


_MENTIONS = r"""
    found as (
        select vod_id, pos, start_s, speaker_label, text,
            list_concat(
                regexp_extract_all(text, '(?i)\b(?:hey|hi|hello|thanks|thank you)\s+([A-Za-z][A-Za-z0-9_]{1,31})\b', 1),
                regexp_extract_all(text, '(?i)\b([A-Za-z][A-Za-z0-9_]{1,31})\s*,\s*what do you think\b', 1)) as calls,
            regexp_extract_all(text, '(?i)\b(?:i am|i''m|my name is)\s+([A-Za-z][A-Za-z0-9_]{1,31})\b', 1) as s1,
            regexp_extract_all(text, '(?i)\b(?:i am|i''m|my name is)\s+([A-Za-z][A-Za-z0-9_]{1,31})\b', 0) as g1,
            regexp_extract_all(text, '(?i)\bthis is\s+([A-Za-z][A-Za-z0-9_]{1,31})\b', 1) as s2,
            regexp_extract_all(text, '(?i)\bthis is\s+([A-Za-z][A-Za-z0-9_]{1,31})\b', 0) as g2,
            regexp_extract_all(text, '(?i)\b([A-Za-z][A-Za-z0-9_]{1,31})\s+here\b', 1) as s3,
            regexp_extract_all(text, '(?i)\b([A-Za-z][A-Za-z0-9_]{1,31})\s+here\b', 0) as g3
        from dialogue)"""

_CLUES = _MENTIONS + """,
    intros as (
        select vod_id, pos, speaker_label, start_s, unnest(list_concat(s1, s2, s3)) as name,
               unnest(list_concat(g1, g2, g3)) as phrase, unnest(range(0, len(s1) + len(s2) + len(s3))) as i
        from found),
    users as (select distinct vod_id, lower(trim(usr)) as usr from dialogue_chat),
    nexts as (
        select *, lead(speaker_label) over w as next_label, lead(start_s) over w as next_start,
               list_filter(calls, lambda n, i: list_position(calls, n) = i) as called
        from found window w as (partition by vod_id order by pos)),
    replies as (
        select *, unnest(called) as name, unnest(range(0, len(called))) as i from nexts
        where len(called) > 0 and next_label <> speaker_label and next_start - start_s between 0 and 8),
    clues as (
        select vod_id, speaker_label, name,
               case when regexp_matches(lower(phrase), 'i am|i''m|my name is') then 0.95::double else 0.85::double end
                   as confidence,
               concat('self-identification at ', printf('%.1f', start_s::double), 's: ''', phrase, '''') as evidence,
               pos * 10000 + i as ord
        from intros
        union all
        select r.vod_id, next_label, name,
               case when len(called) > 1 then 0.72::double - 0.12::double else 0.72::double end,
               concat('addressed by name ''', name, ''' at ', printf('%.1f', start_s::double), 's; ', next_label,
                      ' responds within 8s',
                      case when u.usr is not null then ' (name also appears in chat usernames)' else '' end),
               pos * 10000 + 1000 + i
        from replies r left join users u on u.vod_id = r.vod_id and u.usr = lower(name)),
    named as (
        select vod_id, speaker_label, lower(name) as name_key, max(confidence) as confidence,
               arg_min(name, ord) as name, arg_min(evidence, ord) as first_evidence,
               count(distinct evidence) as evidence_count, min(ord) as first_ord
        from clues group by all),
    names as (
        select vod_id, speaker_label, name, confidence, first_evidence, evidence_count,
               row_number() over (partition by vod_id, speaker_label order by confidence desc, first_ord) as rank
        from named)"""


def _clues(spark, sf_dir):
    return speakers.infer_names(entity(spark, sf_dir, "dialogue"), entity(spark, sf_dir, "dialogue_chat"))


@query(
    "name_mentions",
    with_entities("dialogue", f""",{_MENTIONS},
    everything as (select vod_id, pos, list_concat(calls, s1, s2, s3) as n from found)
    select vod_id, pos, array_to_string(list_filter(n, lambda x, i:
               list_position(list_transform(n, lambda y: lower(y)), lower(x)) = i), ',') as names
    from everything"""),
)
def name_mentions(spark, sf_dir):
    names = name_functions.name_mentions(F.col("text"))
    return entity(spark, sf_dir, "dialogue").select("vod_id", "pos", F.array_join(names, ",").alias("names"))


@query(
    "name_clues",
    with_entities("dialogue dialogue_chat", f""",{_CLUES}
    select vod_id, speaker_label, name, confidence, evidence from clues"""),
)
def name_clues(spark, sf_dir):
    return _clues(spark, sf_dir).drop("ord")


@query("name_candidates", with_entities("dialogue dialogue_chat", f",{_CLUES} select * from names"))
def name_candidates(spark, sf_dir):
    return speakers.merge_name_candidates(_clues(spark, sf_dir))


@query(
    "name_evidence",
    with_entities("dialogue dialogue_chat", f""",{_CLUES}
    select distinct vod_id, speaker_label, lower(name) as name_key, evidence from clues"""),
)
def name_evidence(spark, sf_dir):
    return speakers.name_evidence(_clues(spark, sf_dir)).drop("first_ord")


_LABELLED = """
    voices as (
        select vod_id, speaker_label, case right(speaker_label, 1) when '0' then 'streamer' else 'guest' end as identity,
               0.9::double as confidence
        from (select distinct vod_id, speaker_label from dialogue) where right(speaker_label, 1) <> '2')"""


def _known_voices(lines):
    return (
        lines.select("vod_id", "speaker_label")
        .distinct()
        .where(F.substring("speaker_label", -1, 1) != "2")
        .select(
            "vod_id",
            "speaker_label",
            F.when(F.substring("speaker_label", -1, 1) == "0", "streamer").otherwise("guest").alias("identity"),
            F.lit(0.9).alias("confidence"),
            F.lit(None).cast("string").alias("profile_id"),
        )
    )


@query(
    "speaker_cluster_summary",
    with_entities("dialogue dialogue_chat", f""",{_CLUES},{_LABELLED},
    totals as (
        select vod_id, speaker_label, cast(sum(3 + pos % 4) as double) as total_speech_seconds,
               count(*) as segment_count
        from dialogue group by all),
    best as (
        select vod_id, speaker_label, arg_min(name, rank) as top_name, count(*) as name_count from names group by all)
    select vod_id, speaker_label, total_speech_seconds, segment_count,
           coalesce(identity, 'unknown') as primary_identity,
           coalesce(confidence, 0.0::double) as primary_identity_confidence, top_name,
           coalesce(name_count, 0) as name_count
    from totals left join voices using (vod_id, speaker_label) left join best using (vod_id, speaker_label)"""),
)
def speaker_cluster_summary(spark, sf_dir):
    lines = entity(spark, sf_dir, "dialogue")
    turns = lines.withColumn("end_s", F.col("start_s") + 3 + F.col("pos") % 4)
    names = speakers.merge_name_candidates(_clues(spark, sf_dir))
    return speakers.cluster_summary(turns, _known_voices(lines), names)


@query(
    "enriched_turns",
    with_entities("dialogue dialogue_chat", f""",{_CLUES},{_LABELLED}
    select d.vod_id, d.pos, d.speaker_label, v.identity, v.confidence as identity_confidence,
           n.name as inferred_name
    from dialogue d left join voices v using (vod_id, speaker_label)
    left join names n on n.vod_id = d.vod_id and n.speaker_label = d.speaker_label and n.rank = 1
         and n.confidence >= 0.7"""),
)
def enriched_turns(spark, sf_dir):
    lines = entity(spark, sf_dir, "dialogue")
    names = speakers.merge_name_candidates(_clues(spark, sf_dir))
    return speakers.enrich_turns(lines, _known_voices(lines), names).select(
        "vod_id", "pos", "speaker_label", "identity", "identity_confidence", "inferred_name"
    )
