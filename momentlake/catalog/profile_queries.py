from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, table, with_entities
from ..functions import text as X
from ..operators import profiles
from ..runtime import checkpointed, shared_folder
from ..sources import logs
from . import query

_NORM = r"""
    normed as (
        select *, trim(trim(regexp_replace(lower(claim), '\s+', ' ', 'g')), '"''.,;:!?()[]{} ') as norm from claims)"""


def _observations(spark, sf_dir):
    c = entity(spark, sf_dir, "claims")
    evidence = F.transform(F.sequence(F.lit(1).cast("bigint"), "n_evidence"), lambda i: F.concat(F.lit("line "), i.cast("string")))
    ref = F.concat(F.lit("vod:"), "vod_id", F.lit("@"), F.col("pos").cast("string"))
    return c.select(
        "streamer_id", "vod_id", "pos", F.col("kind").alias("type"), "claim", evidence.alias("evidence"),
        F.col("confidence").cast("double").alias("confidence"), F.array(ref).alias("evidence_refs"),
        F.lit("transcript").alias("source"), F.lit(0.0).alias("timestamp_start"), F.lit(1.0).alias("timestamp_end"),
    )


@query(
    "normalised_claims",
    with_entities("claims", f""",{_NORM}
    select pos, norm, regexp_matches(norm, 'medical|diagnosis|address|phone|ssn|doxx|legal name') as sensitive from normed"""),
)
def normalised_claims(spark, sf_dir):
    claim = F.col("claim")
    return entity(spark, sf_dir, "claims").select(
        "pos", X.normalise_claim(claim).alias("norm"), X.is_sensitive(claim).alias("sensitive")
    )


_DEDUPED = _NORM + """,
    deduped as (
        select * from normed
        qualify row_number() over (partition by streamer_id, kind, norm
                                   order by confidence desc, n_evidence desc, pos) = 1)"""


@query(
    "deduped_observations",
    with_entities("claims", f""",{_DEDUPED}
    select streamer_id, kind as type, pos, confidence::double as confidence from deduped"""),
)
def deduped_observations(spark, sf_dir):
    out = profiles.dedupe_observations(_observations(spark, sf_dir), ["streamer_id"])
    return out.select("streamer_id", "type", "pos", "confidence")


_DISPOSED = _DEDUPED + """,
    disposed as (
        select *, case when regexp_matches(norm, 'medical|diagnosis|address|phone|ssn|doxx|legal name') then 'reject'
                       when confidence >= 0.8 and n_evidence >= 2 then 'accept'
                       when confidence >= 0.6 and confidence < 0.8 then 'queue' else 'reject' end as disposition
        from deduped)"""


def _disposed(spark, sf_dir):
    deduped = profiles.dedupe_observations(_observations(spark, sf_dir), ["streamer_id"])
    return profiles.partition_observations(deduped)


@query(
    "observation_disposition",
    with_entities("claims", f",{_DISPOSED} select streamer_id, pos, disposition from disposed"),
)
def observation_disposition(spark, sf_dir):
    return _disposed(spark, sf_dir).select("streamer_id", "pos", "disposition")


_MERGED = f""",{_DISPOSED},
    stored as (
        select streamer_id, pos, kind, concat('"', claim, '"') as claim, 'old words' as description, n_evidence * 0.3::double as confidence,
               trim(trim(regexp_replace(lower(concat('"', claim, '"')), '\\s+', ' ', 'g')), '"''.,;:!?()[]{{}} ') as norm
        from claims where kind = 'inside_joke'),
    last_stored as (
        select * from stored qualify row_number() over (partition by streamer_id, kind, norm order by pos desc) = 1),
    accepted as (select * from disposed where disposition = 'accept' and norm <> ''),
    merged as (
        select coalesce(s.streamer_id, a.streamer_id) as streamer_id, coalesce(s.kind, a.kind) as kind,
               coalesce(s.pos, a.pos) as pos, s.pos is null as added, coalesce(s.claim, a.claim) as claim,
               case when s.pos is null or a.confidence > s.confidence then a.claim else s.description end as description,
               case when s.pos is null and a.kind = 'inside_joke' then concat('Observed in VOD ', a.vod_id) end as context,
               case when s.pos is null and a.kind <> 'inside_joke' then 'neutral' end as impact,
               greatest(coalesce(s.confidence, 0), coalesce(a.confidence, 0))::double as confidence,
               concat_ws(',', case when s.pos is not null then concat('ref', s.pos) end,
                         case when a.pos is not null then concat('vod:', a.vod_id, '@', a.pos) end) as evidence_refs,
               s.pos is not null and a.pos is not null as updated
        from last_stored s full join accepted a on a.streamer_id = s.streamer_id and a.kind = s.kind and a.norm = s.norm)
    select * from merged
    union all
    select streamer_id, kind, pos, false, claim, description, null, null, confidence, concat('ref', pos), false
    from stored where (streamer_id, kind, pos) not in (select streamer_id, kind, pos from last_stored)"""


def _stored(spark, sf_dir):
    c = entity(spark, sf_dir, "claims").where("kind = 'inside_joke'")
    return c.select(
        "streamer_id", "pos", "kind", F.concat(F.lit('"'), "claim", F.lit('"')).alias("claim"), F.lit("old words").alias("description"),
        F.lit(None).cast("string").alias("context"), F.lit(None).cast("string").alias("impact"),
        (F.col("n_evidence") * 0.3).alias("confidence"),
        F.array(F.concat(F.lit("ref"), F.col("pos").cast("string"))).alias("evidence_refs"), F.lit(False).alias("updated"),
    )


@query("profile_upsert", with_entities("claims", _MERGED))
def profile_upsert(spark, sf_dir):
    accepted = _disposed(spark, sf_dir).where("disposition = 'accept'")
    out = profiles.upsert_claims(_stored(spark, sf_dir), accepted)
    return out.withColumn("evidence_refs", F.array_join("evidence_refs", ","))


@query("stored_profile", with_entities("claims", _MERGED))
def stored_profile(spark, sf_dir):
    """Claims stored by a first batch and merged with a second one, which is retried: as merged once."""
    folder = shared_folder(spark, "profile")
    none = F.array().cast("array<string>")
    first = _stored(spark, sf_dir).withColumns({"added": F.lit(False), "batches": none})
    first.write.partitionBy("streamer_id").parquet(folder)
    # Both merges read it more than once: the texts are normalised for the first only.
    accepted = checkpointed(_disposed(spark, sf_dir).where("disposition = 'accept'"))
    for _ in range(2):
        logs.merge_claims(accepted, folder, "tuesday")
    return logs.read_profile(spark, folder).drop("batches").withColumn("evidence_refs", F.array_join("evidence_refs", ","))


@query(
    "recent_observations",
    with_entities("claims", """
    select streamer_id, pos from claims
    qualify row_number() over (partition by streamer_id order by pos desc) <= 50"""),
)
def recent_observations(spark, sf_dir):
    return profiles.recent_observations(_observations(spark, sf_dir), 50).select("streamer_id", "pos")


@query(
    "clip_observations",
    with_entities("analyses candidates", """,
    clips as (
        select c.vod_id, c.pos, case when c.pos % 3 > 0 then c.trigger_text end as joke,
               case when c.pos % 4 > 0 then concat('trigger: ', c.trigger_text) else '' end as arc,
               a.trim_start::double as s, a.trim_end::double as e, a.clip_worthiness as score
        from candidates c join analyses a on a.vod_id = c.vod_id and a.pos = c.pos),
    spans as (select * replace (case when e > s then e else s + 1 end as e) from clips),
    obs as (
        select vod_id, pos * 2 as pos, s, e, 'inside_joke' as type, joke as claim, score from spans where joke is not null
        union all select vod_id, pos * 2 + 1, s, e, 'content_pattern', arc, score from spans where arc <> '')
    select vod_id, pos, s as timestamp_start, e as timestamp_end, type, claim,
           concat('title: untitled clip|window: ', printf('%.3f', s), '-', printf('%.3f', e)) as evidence,
           least(1.0::double, score / 10.0::double) as confidence,
           concat('vod:', vod_id, '@', printf('%.3f', s), '-', printf('%.3f', e)) as evidence_refs
    from obs
    qualify row_number() over (partition by vod_id, type, claim order by least(10, score) desc, pos) = 1"""),
)
def clip_observations(spark, sf_dir):
    a = entity(spark, sf_dir, "analyses").select("vod_id", "pos", "trim_start", "trim_end", F.col("clip_worthiness").alias("score"))
    none = F.lit(None).cast("string")
    clips = entity(spark, sf_dir, "candidates").join(a, ["vod_id", "pos"]).select(
        "vod_id", "pos", "start_s", "end_s", "trim_start", "trim_end", "score",
        F.lit("").alias("clip_point"), none.alias("title"), none.alias("label"),
        F.when(F.col("pos") % 3 > 0, F.col("trigger_text")).alias("inside_joke"),
        F.when(F.col("pos") % 4 > 0, F.concat(F.lit("trigger: "), "trigger_text")).otherwise("").alias("narrative_arc"),
    )
    out = profiles.dedupe_observations(profiles.clip_observations(clips), ["vod_id"])
    return out.drop("source").withColumn("evidence", F.array_join("evidence", "|")).withColumn(
        "evidence_refs", F.array_join("evidence_refs", "|")
    )


_FACTS = """
    facts as (
        select c_mktsegment as streamer_id, c_custkey as pos,
               case cast(c_custkey % 5 as int) when 0 then 'voice_profile' when 1 then 'personality_trait'
                    when 2 then 'inside_joke' when 3 then 'content_pattern' else 'community_chatter' end as kind,
               cast(c_nationkey as bigint) * 4 / 100.0 as confidence, c_custkey % 7 > 0 as has_ref,
               c_custkey % 50 as message_count, c_name as label
        from customer),
    kept as (select * from facts where confidence >= 0.65 and has_ref)"""


def _facts(spark, sf_dir):
    k = F.col("c_custkey")
    kind = (
        F.when(k % 5 == 0, "voice_profile").when(k % 5 == 1, "personality_trait").when(k % 5 == 2, "inside_joke")
        .when(k % 5 == 3, "content_pattern").otherwise("community_chatter")
    )
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("streamer_id"), k.alias("pos"), kind.alias("kind"),
        (F.col("c_nationkey") * 4 / 100).alias("confidence"),
        F.when(k % 7 > 0, F.array(F.lit("ref"))).otherwise(F.array().cast("array<string>")).alias("evidence_refs"),
        (k % 50).alias("message_count"), none.alias("last_seen"), F.col("c_name").alias("label"),
        F.concat(F.lit("about  "), "c_name").alias("description"), none.alias("role"), F.lit("neutral").alias("impact"),
    )


@query(
    "profile_context_facts",
    f"with {_FACTS} select streamer_id, kind, pos from kept",
)
def profile_context_facts(spark, sf_dir):
    return profiles.context_facts(_facts(spark, sf_dir)).select("streamer_id", "kind", "pos")


@query(
    "profile_context",
    f"""with {_FACTS}
    select streamer_id, list_position(['voice_profile', 'personality_trait', 'inside_joke', 'content_pattern',
               'community_chatter'], kind)::bigint as section, kind, pos,
           concat('- ', replace(kind, '_', ' '), ': ', case kind when 'voice_profile' then label
               when 'personality_trait' then concat('about ', label)
               when 'inside_joke' then concat(label, ': about ', label)
               when 'content_pattern' then concat('[neutral] ', label, ' — about ', label)
               else concat(label, ', msgs=', message_count) end,
               ', conf=', printf('%.2f', confidence::double), ', ref=ref') as line
    from kept""",
)
def profile_context(spark, sf_dir):
    return profiles.profile_context(_facts(spark, sf_dir))


@query(
    "streamer_identity",
    r"""
    with meta as (
        select c_custkey as id, case when c_custkey % 3 = 0 then concat('  ', c_name, '!! ') else ' ' end as channel,
               case when c_custkey % 4 = 0 then concat(c_mktsegment, ' Live') end as uploader,
               case when c_custkey % 5 = 0 then 'Forced  Name' when c_custkey % 5 = 1 then ' ' end as forced
        from customer),
    ids as (
        select *, case when trim(channel) <> '' then channel when trim(uploader) <> '' then uploader end as stated from meta),
    clean as (
        select *, coalesce(trim(regexp_replace(regexp_replace(lower(trim(stated)), '[^a-z0-9_-]+', '_', 'g'), '_+', '_', 'g'), '_'),
                           'unknown_streamer') as m,
               case when trim(forced) <> '' then 'forced_name' end as f
        from ids)
    select id, coalesce(f, m) as streamer_id, m as metadata_streamer_id,
           case when f is not null then 'override' when m <> 'unknown_streamer' then 'metadata' else 'fallback' end as source,
           coalesce(f <> m and m <> 'unknown_streamer', false) as override_mismatch,
           case when f <> m and m <> 'unknown_streamer'
                then concat('streamer_id override mismatch: override=''', f, ''' metadata=''', m, '''') end as warning
    from clean""",
)
def streamer_identity(spark, sf_dir):
    k = F.col("c_custkey")
    fields = {
        "channel": F.when(k % 3 == 0, F.concat(F.lit("  "), "c_name", F.lit("!! "))).otherwise(" "),
        "uploader": F.when(k % 4 == 0, F.concat("c_mktsegment", F.lit(" Live"))),
    }
    forced = F.when(k % 5 == 0, "Forced  Name").when(k % 5 == 1, " ")
    return (
        table(spark, sf_dir, "customer")
        .select(k.alias("id"), X.streamer_identity(fields, forced).alias("s"))
        .select("id", "s.streamer_id", "s.metadata_streamer_id", "s.source", "s.override_mismatch", "s.warning")
    )
