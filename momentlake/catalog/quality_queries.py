from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, table, with_entities
from ..operators import quality
from ..runtime import shared_folder
from ..sources import logs
from . import query


def _loose_arcs(spark, sf_dir):
    """Candidates with some values out of contract."""
    p = F.col("pos")
    none = F.array().cast("array<string>")
    return entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", F.when(p % 9 > 0, F.col("candidate_id")).alias("candidate_id"),
        F.when(p % 10 == 0, -F.col("start_s")).otherwise(F.col("start_s")).alias("start_s"),
        F.when(p % 8 == 0, F.col("start_s")).otherwise(F.col("end_s")).alias("end_s"),
        "narrative_type", F.col("trigger_text").alias("trigger"), F.col("payoff_text").alias("payoff"),
        (F.col("confidence") + F.when(p % 7 == 0, 0.9).otherwise(0.0)).cast("double").alias("confidence"),
        F.when(p % 6 == 0, none).otherwise(F.array("trigger_text")).alias("evidence_lines"),
    )


_ARCS = """
    loose as (
        select pos, case when pos % 9 > 0 then candidate_id end as cid,
               case when pos % 10 = 0 then -start_s else start_s end as s,
               case when pos % 8 = 0 then start_s else end_s end as e,
               confidence::double + case when pos % 7 = 0 then 0.9::double else 0.0::double end as c, pos % 6 = 0 as bare
        from candidates),
    checked as (
        select pos, concat_ws(',', case when cid is null then 'candidate_id_missing' end,
                   case when s < 0 then 'start_s_below_0' end, case when e <= 0 then 'end_s_not_positive' end,
                   case when e <= s then 'end_s_not_after_start_s' end, case when bare then 'evidence_lines_empty' end,
                   case when c < 0 or c > 1 then 'confidence_outside_0_1' end) as errors
        from loose)"""


@query(
    "contract_errors",
    with_entities("candidates", f",{_ARCS} select pos, errors from checked where errors <> ''"),
)
def contract_errors(spark, sf_dir):
    _, bad = quality.split_by_contract(_loose_arcs(spark, sf_dir), "discovery")
    return bad.select("pos", F.array_join("errors", ",").alias("errors"))


@query(
    "contract_passes",
    with_entities("candidates", f",{_ARCS} select pos from checked where errors = ''"),
)
def contract_passes(spark, sf_dir):
    good, _ = quality.split_by_contract(_loose_arcs(spark, sf_dir), "discovery")
    return good.select("pos")


@query(
    "contract_error_counts",
    with_entities("candidates", f""",{_ARCS}
    select error, count(*) as n from (select unnest(string_split(errors, ',')) as error from checked where errors <> '')
    group by all"""),
)
def contract_error_counts(spark, sf_dir):
    return quality.error_counts(_loose_arcs(spark, sf_dir), "discovery")


@query(
    "turn_contract_counts",
    with_entities("turns", """
    select case when speaker_label = 'SPEAKER_03' then 'speaker_label_missing' else 'end_s_not_after_start_s' end as error,
           count(*) as n
    from turns where speaker_label = 'SPEAKER_03' or (pos % 5 = 0 and speaker_label <> 'SPEAKER_03') group by all
    """),
)
def turn_contract_counts(spark, sf_dir):
    p = F.col("pos")
    label = F.when(F.col("speaker_label") != "SPEAKER_03", F.col("speaker_label"))
    end = F.when((p % 5 == 0) & label.isNotNull(), F.col("start_s")).otherwise(F.col("end_s"))
    rows = entity(spark, sf_dir, "turns").select(
        label.alias("speaker_label"), (F.col("start_s") + 1).alias("start_s"), (end + 1).alias("end_s")
    )
    return quality.error_counts(rows, "speaker_turn")


@query(
    "manifest_findings",
    with_entities("candidates", """,
    docs as (select c_custkey as vod_id, case when c_custkey % 4 = 0 then 'other' when c_custkey % 4 = 1 then ' '
                    else cast(c_custkey as varchar) end as stated from customer)
    select vod_id, 'error' as level, 'vod_id_mismatch' as rule, stated as detail from docs where stated = 'other'
    union all
    select vod_id, 'error', 'no_clips', '' from docs where vod_id not in (select vod_id from candidates)
    union all
    select vod_id, 'error', 'missing_keys', concat('clips[', pos, '] label,title') from candidates where pos % 5 = 0
    union all
    select vod_id, 'error', 'invalid_range', concat('clips[', pos, ']') from candidates where pos % 7 = 0 and pos % 6 > 0
    union all
    select vod_id, 'error', 'non_numeric_range', concat('clips[', pos, ']') from candidates where pos % 6 = 0"""),
)
def manifest_findings(spark, sf_dir):
    from ..adapters import table

    k, p = F.col("c_custkey"), F.col("pos")
    docs = table(spark, sf_dir, "customer").select(
        k.alias("vod_id"), F.when(k % 4 == 0, "other").when(k % 4 == 1, " ").otherwise(k.cast("string")).alias("stated_vod_id")
    )
    every = F.array(*[F.lit(f) for f in quality.CLIP_FIELDS])
    clips = entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos",
        F.when(p % 6 == 0, "soon").otherwise(F.col("start_s").cast("string")).alias("start"),
        F.when(p % 7 == 0, F.col("start_s")).otherwise(F.col("end_s")).cast("string").alias("end"),
        F.when(p % 5 == 0, F.array_except(every, F.array(F.lit("title"), F.lit("label")))).otherwise(every).alias("fields"),
    )
    return quality.check_manifest(docs, clips)


@query(
    "fusion_findings",
    """
    with d as (
        select c_custkey as vod_id, c_custkey % 9 > 0 as has_meta,
               case when c_custkey % 5 = 0 then 'x' when c_custkey % 5 = 1 then '' else cast(c_custkey as varchar) end as meta_id,
               c_custkey % 7 > 0 as has_segments, c_custkey % 3 > 0 as has_messages
        from customer)
    select vod_id, 'error' as level, 'missing_vod_meta' as rule, '' as detail from d where not has_meta
    union all select vod_id, 'error', 'meta_id_mismatch', meta_id from d where has_meta and meta_id = 'x'
    union all select vod_id, 'error', 'missing_segments', '' from d where has_meta and not has_segments
    union all select vod_id, 'warning', 'missing_messages', '' from d where has_meta and not has_messages""",
)
def fusion_findings(spark, sf_dir):
    from ..adapters import table

    k = F.col("c_custkey")
    docs = table(spark, sf_dir, "customer").select(
        k.alias("vod_id"), (k % 9 > 0).alias("has_meta"),
        F.when(k % 5 == 0, "x").when(k % 5 == 1, "").otherwise(k.cast("string")).alias("meta_id"),
        (k % 7 > 0).alias("has_segments"), (k % 3 > 0).alias("has_messages"),
    )
    return quality.check_fusion(docs)


@query(
    "speaker_findings",
    with_entities("turns", """
    select vod_id, 'error' as level, 'schema_invalid' as rule, 'end_s_not_after_start_s' as detail from turns where pos % 50 = 0
    union all
    select distinct vod_id, 'error', 'vod_id_mismatch', 'v' from turns where vod_id % 2 = 0
    union all
    select vod_id, 'info', 'speaker_counts', concat('segments=', count(*), ', clusters=', count(distinct speaker_label))
    from turns group by vod_id"""),
)
def speaker_findings(spark, sf_dir):
    turns = entity(spark, sf_dir, "turns").withColumn("start_s", F.col("start_s") + 1).withColumn(
        "end_s", F.when(F.col("pos") % 50 == 0, F.col("start_s")).otherwise(F.col("end_s") + 1)
    )
    v = F.col("vod_id")
    artifacts = turns.select("vod_id").distinct().withColumn(
        "stated_vod_id", F.when(v % 2 == 0, "v").otherwise(v.cast("string"))
    )
    return quality.check_speakers(artifacts, turns)


@query(
    "videos_without_clips",
    with_entities("candidates", """
    select c_custkey as vod_id, 'error' as level, 'no_selected_clips' as rule, '' as detail from customer
    where c_custkey not in (select vod_id from candidates where worthiness >= 9)"""),
)
def videos_without_clips(spark, sf_dir):
    from ..adapters import table

    videos = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vod_id"))
    return quality.videos_without_clips(videos, entity(spark, sf_dir, "candidates").where("worthiness >= 9"))


# The rows of other stages, made from candidates with some values out of contract, and what breaks them.
_LOOSE = """
    loose as (
        select pos, narrative_type, trigger_text, payoff_text, confidence,
               case when pos % 10 = 0 then -start_s else start_s end as s,
               case when pos % 8 = 0 then case when pos % 10 = 0 then -start_s else start_s end else end_s end as e
        from candidates)"""
_SPAN_ERRORS = {"start_s_below_0": "s < 0", "end_s_not_positive": "e <= 0", "end_s_not_after_start_s": "e <= s"}


def _counts_sql(errors: dict[str, str]) -> str:
    counted = " union all ".join(f"select '{name}' as error, count(*) as n from loose where {broken}" for name, broken in errors.items())
    return with_entities("candidates", f",{_LOOSE} select error, n from ({counted}) where n > 0")


def _loose(spark, sf_dir):
    p = F.col("pos")
    start = F.when(p % 10 == 0, -F.col("start_s")).otherwise(F.col("start_s"))
    return entity(spark, sf_dir, "candidates").select(
        "pos", "narrative_type", F.col("trigger_text").alias("trigger"), F.col("payoff_text").alias("payoff"), "confidence",
        start.alias("start_s"), F.when(p % 8 == 0, start).otherwise(F.col("end_s")).alias("end_s"), "candidate_id",
    )


def _unless(n, value):
    return F.when(F.col("pos") % n > 0, value)


def _list_unless(n):
    return F.when(F.col("pos") % n > 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))


@query(
    "stitched_contract_counts",
    _counts_sql({
        "stitched_id_missing": "pos % 9 = 0", **_SPAN_ERRORS, "evidence_lines_empty": "pos % 6 = 0",
        "source_candidate_ids_empty": "pos % 5 = 0", "source_windows_empty": "pos % 4 = 0", "merge_reasons_empty": "pos % 3 = 0",
        "confidence_outside_0_1": "confidence::double + case when pos % 7 = 0 then 0.9::double else 0.0::double end > 1",
    }),
)
def stitched_contract_counts(spark, sf_dir):
    rows = _loose(spark, sf_dir).select(
        "*", _unless(9, F.lit("arc")).alias("stitched_id"), _list_unless(6).alias("evidence_lines"),
        _list_unless(5).alias("source_candidate_ids"), _list_unless(4).alias("source_windows"), _list_unless(3).alias("merge_reasons"),
    ).withColumn("confidence", (F.col("confidence") + F.when(F.col("pos") % 7 == 0, 0.9).otherwise(0.0)).cast("double"))
    return quality.error_counts(rows, "stitched")


@query(
    "scored_contract_counts",
    _counts_sql({
        "candidate_id_missing": "pos % 9 = 0", "eligible_missing": "pos % 5 = 0", **_SPAN_ERRORS,
        "final_score_outside_0_10": "pos % 13 > 10", "raw_score_outside_0_10": "pos % 12 > 10", "trim_source_unknown": "pos % 4 = 0",
    }),
)
def scored_contract_counts(spark, sf_dir):
    p = F.col("pos")
    rows = _loose(spark, sf_dir).select(
        _unless(9, F.col("candidate_id")).alias("candidate_id"), "start_s", "end_s", (p % 13).alias("final_score"),
        (p % 12).alias("raw_score"), _unless(5, F.lit(True)).alias("eligible"),
        F.when(p % 4 == 0, "by hand").otherwise(quality.MODEL_TRIM).alias("trim_source"),
    )
    return quality.error_counts(rows, "scored")


@query(
    "final_contract_counts",
    _counts_sql({
        "clip_id_missing": "pos % 9 = 0", "title_missing": "pos % 5 = 0", "rank_below_1": "pos % 3 = 0", **_SPAN_ERRORS,
        "trim_start_below_0": "s - case when pos % 7 = 0 then 1 else 0 end < 0", "trim_end_not_positive": "e <= 0",
        "trim_end_not_after_trim_start": "e <= s - case when pos % 7 = 0 then 1 else 0 end", "trim_outside_window": "pos % 7 = 0",
        "score_outside_0_10": "pos % 13 > 10", "evidence_empty": "pos % 6 = 0", "trim_source_unknown": "pos % 4 = 0",
    }),
)
def final_contract_counts(spark, sf_dir):
    p = F.col("pos")
    rows = _loose(spark, sf_dir).select(
        _unless(9, F.col("candidate_id")).alias("clip_id"), "start_s", "end_s", "narrative_type",
        (F.col("start_s") - F.when(p % 7 == 0, 1).otherwise(0)).alias("trim_start"), F.col("end_s").alias("trim_end"),
        _unless(5, F.col("trigger")).alias("title"), (p % 3).alias("rank"), (p % 13).alias("score"), F.lit(5.0).alias("raw_score"),
        _list_unless(6).alias("evidence"), F.when(p % 4 == 0, "by hand").otherwise(quality.CORRECTED_TRIM).alias("trim_source"),
    )
    return quality.error_counts(rows, "final_selected")


@query(
    "context_contract_counts",
    _counts_sql({
        "clip_start_missing": "pos % 11 = 0", "clip_start_below_0": "s < 0 and pos % 11 > 0", "clip_end_not_positive": "e <= 0",
        "clip_end_not_after_clip_start": "e <= s and pos % 11 > 0", "total_dead_air_seconds_below_0": "pos % 5 = 0",
        "dead_air_ratio_outside_0_1": "pos % 11 > 8", "streamer_speaking_ratio_outside_0_1": "pos % 10 > 8",
        "streamer_speaking_confidence_outside_0_1": "pos % 12 > 8", "primary_speaker_identity_unknown": "pos % 6 = 0",
    }),
)
def context_contract_counts(spark, sf_dir):
    p = F.col("pos")
    rows = _loose(spark, sf_dir).select(
        _unless(11, F.col("start_s")).alias("clip_start"), F.col("end_s").alias("clip_end"), (p % 5 - 1).alias("total_dead_air_seconds"),
        (p % 11 / 8).alias("dead_air_ratio"), (p % 10 / 8).alias("streamer_speaking_ratio"),
        (p % 12 / 8).alias("streamer_speaking_confidence"),
        F.when(p % 6 == 0, "nobody").otherwise("streamer").alias("primary_speaker_identity"),
    )
    return quality.error_counts(rows, "context")


@query(
    "recognition_contract_counts",
    _counts_sql({
        "identity_unknown": "pos % 6 = 0", "confidence_outside_0_1": "pos % 10 > 8", "cosine_similarity_outside_-1_1": "pos % 21 > 16 or pos % 21 = 0",
    }),
)
def recognition_contract_counts(spark, sf_dir):
    p = F.col("pos")
    rows = _loose(spark, sf_dir).select(
        F.when(p % 6 == 0, "nobody").otherwise("guest").alias("identity"), (p % 10 / 8).alias("confidence"),
        F.when(p % 21 == 0, -1.5).otherwise((p % 21 - 8) / 8).alias("cosine_similarity"),
    )
    return quality.error_counts(rows, "recognition")


@query(
    "appended_observations",
    """
    with batch as (
        select c_custkey as pos, concat_ws(',', case when c_custkey % 9 = 0 then 'claim_missing' end,
               case when c_custkey % 8 = 0 then 'timestamp_end_not_after_timestamp_start' end,
               case when c_custkey % 7 = 0 then 'confidence_outside_0_1' end, case when c_custkey % 5 = 0 then 'evidence_empty' end,
               case when c_custkey % 4 = 0 then 'type_unknown' end) as errors
        from customer)
    select pos, errors = '' as accepted, errors from batch""",
)
def appended_observations(spark, sf_dir):
    """A batch appended to the observation log, and again as a retry would: rows read back from it, and the quarantined ones."""
    p = F.col("c_custkey")
    batch = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("streamer_id"), p.alias("pos"), (p % 50).alias("vod_id"),
        F.when(p % 9 > 0, F.col("c_name")).alias("claim"), (p % 1000 + 1).alias("timestamp_start"),
        (p % 1000 + 1 + F.when(p % 8 == 0, 0).otherwise(10)).alias("timestamp_end"),
        F.when(p % 7 == 0, 1.5).otherwise(0.5).alias("confidence"),
        F.when(p % 5 > 0, F.array(F.lit("said"))).otherwise(F.array().cast("array<string>")).alias("evidence"),
        F.array(F.lit("ref")).alias("evidence_refs"), F.when(p % 4 == 0, "rumour").otherwise("inside_joke").alias("type"),
        F.lit("manual").alias("source"),
    )
    folder = shared_folder(spark, "observations")
    logs.append_observations(batch, folder, "monday")
    refused = logs.append_observations(batch, folder, "monday")
    taken = spark.read.parquet(folder).select("pos", F.lit(True).alias("accepted"), F.lit("").alias("errors"))
    return taken.unionByName(refused.select("pos", F.lit(False).alias("accepted"), F.array_join("errors", ",").alias("errors")))
