from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, table, with_entities
from ..functions import scalars
from ..functions import text as X
from ..operators import manifest, prompts, selection
from ..runtime import shared_folder
from ..sources import chat as chat_source
from ..sources import documents, logs, replies
from ..sources.envelopes import read_elements
from . import query
from .profile_queries import _observations
from .triage_queries import _CHUNKS, _chunks

# The documents read here are written by Spark from the given tables: pages of a fixed number of rows, so
# that no document grows with a conversation.
PAGE_ROWS = 8


def _pages(rows, **items):
    """Per page vod_id, ``first``, the number of its first row, and lists of ``items`` in order."""
    page = F.floor(F.col("pos") / PAGE_ROWS)
    listed = F.array_sort(F.collect_list(F.struct("pos", *[c.alias(n) for n, c in items.items()])))
    paged = rows.groupBy("vod_id", page.alias("page")).agg(listed.alias("l"))
    return paged.select(
        "vod_id", (F.col("page") * PAGE_ROWS).alias("first"), *[F.col(f"l.{n}").alias(n) for n in items]
    )


@query(
    "chat_lines_source",
    with_entities("chat", """
    select vod_id, pos, t::double as t, case when pos % 9 = 0 then 'unknown' else usr end as usr, message,
           case when emotes is null then '' else array_to_string(list_sort(list_distinct(emotes)), ',') end as emotes,
           pos % 3 = 0 as is_subscriber, pos % 3 = 1 as is_moderator
    from chat where pos % 11 > 0"""),
)
def chat_lines_source(spark, sf_dir):
    p = F.col("pos")
    emotes = F.array_distinct("emotes")
    badge = F.when(p % 3 == 0, "subscriber").when(p % 3 == 1, "moderator").otherwise("vip")
    good = F.to_json(
        F.struct(
            F.col("t").alias("timestamp_in_seconds"),
            F.when(p % 9 > 0, F.struct(F.col("usr").alias("display_name"))).alias("commenter"),
            F.struct(
                F.col("message").alias("body"),
                F.map_from_arrays(emotes, F.transform(emotes, lambda e: F.lit("1"))).alias("emotes"),
            ).alias("message"),
            F.array(F.struct(badge.alias("id"))).alias("badges"),
        )
    )
    lines = entity(spark, sf_dir, "chat").select(
        "vod_id", "pos", F.when(p % 11 == 0, F.concat(F.lit("{broken "), p.cast("string"))).otherwise(good).alias("line")
    )
    out = chat_source.chat_from_lines(lines)
    return out.withColumn("emotes", F.array_join(F.array_sort("emotes"), ","))


@query(
    "comment_pages_source",
    with_entities("segments", r"""
    select vod_id, pos, start_s::double as t, case when pos % 4 = 0 then 'unknown' else speaker_label end as usr,
           concat(text, case when pos % 2 = 0 then ' Kappa' else '' end) as message,
           case when pos % 2 = 0 then ' Kappa' end as emotes
    from segments"""),
)
def comment_pages_source(spark, sf_dir):
    p = F.col("pos")
    plain = F.struct(F.col("text"), F.lit(None).cast("string").alias("emoticon"))
    emote = F.struct(F.lit(" Kappa").alias("text"), F.lit("25").alias("emoticon"))
    comment = F.struct(
        F.col("start_s").alias("content_offset_seconds"),
        F.when(p % 4 > 0, F.struct(F.col("speaker_label").alias("display_name"))).alias("commenter"),
        F.struct(
            F.struct(F.when(p % 2 == 0, F.array(plain, emote)).otherwise(F.array(plain)).alias("fragments")).alias("body")
        ).alias("message"),
    )
    pages = _pages(entity(spark, sf_dir, "segments"), comments=comment).select(
        "vod_id", "first", F.to_json(F.struct("comments")).alias("doc")
    )
    return chat_source.chat_from_comment_pages(pages).withColumn("emotes", F.array_join("emotes", ","))


@query(
    "legacy_chat_source",
    with_entities("segments", """
    select vod_id, pos, start_s::double as t, case when pos % 3 = 0 then 'e1,e2' when pos % 3 = 1 then '' else 'e3' end as emotes
    from segments"""),
)
def legacy_chat_source(spark, sf_dir):
    p = F.col("pos")
    frag = lambda e: F.struct(F.when(F.lit(e is not None), F.struct(F.lit(e).alias("id"))).alias("emote"))
    fragments = (
        F.when(p % 3 == 0, F.array(frag("e1"), frag(None), frag("e2"))).when(p % 3 == 1, F.array(frag(None)))
        .otherwise(F.array(frag("e3")))
    )
    message = F.struct(F.col("start_s").alias("content_offset_seconds"), F.struct(fragments.alias("fragments")).alias("message"))
    docs = _pages(entity(spark, sf_dir, "segments"), m=message).select("vod_id", "first", F.to_json("m").alias("doc"))
    return chat_source.chat_from_legacy(docs).withColumn("emotes", F.array_join("emotes", ","))


def _enveloped(rows, items, first, second):
    """Pages in one of three shapes by video; a quarter of the videos have a document of no known shape as well."""
    v = F.col("vod_id")
    listed = _pages(rows, l=items)
    inner = F.struct(F.struct(F.col("l").alias(first)).alias(second))
    doc = F.when(v % 3 == 0, F.to_json("l")).when(v % 3 == 1, F.to_json(F.struct(F.col("l").alias(first)))).otherwise(F.to_json(inner))
    strange = rows.where(v % 4 == 3).select("vod_id").distinct()
    return listed.select("vod_id", "first", doc.alias("doc")).unionByName(
        strange.select("vod_id", F.lit(0).alias("first"), F.lit('{"other": 1}').alias("doc"))
    )


def _transcripts(spark, sf_dir):
    item = F.struct(
        F.col("start_s").cast("double").alias("start"), F.col("end_s").cast("double").alias("end"), "text",
        F.when(F.col("pos") % 2 == 0, -0.5).otherwise(0.75).alias("confidence"), "speaker_label",
    )
    return documents.transcript_from_envelope(_enveloped(entity(spark, sf_dir, "segments"), item, "segments", "transcript"))


@query(
    "transcript_source",
    with_entities("segments", """
    select vod_id, pos, start_s::double as start_s, end_s::double as end_s, text, speaker_label,
           round_even(case when pos % 2 = 0 then exp(-0.5) else 0.75 end * 1000000.0, 0) / 1000000.0 as confidence,
           pos % 2 = 0 as confidence_was_log
    from segments"""),
)
def transcript_source(spark, sf_dir):
    lines, _ = _transcripts(spark, sf_dir)
    return lines.withColumn("confidence", scalars.round_half_even("confidence", 6))


@query(
    "transcript_source_errors",
    with_entities("segments", """
    select distinct vod_id, 'unsupported transcript document' as error from segments where vod_id % 4 = 3"""),
)
def transcript_source_errors(spark, sf_dir):
    _, bad = _transcripts(spark, sf_dir)
    return bad


@query(
    "split_envelope_source",
    with_entities("segments", """
    select vod_id, pos, start_s::double as start_s, end_s::double as end_s, text, speaker_label from segments"""),
)
def split_envelope_source(spark, sf_dir):
    """Documents of three shapes, one after the other in few files that are read in splits."""
    v = F.col("vod_id")
    item = F.struct("vod_id", "pos", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text", "speaker_label")
    pages = _pages(entity(spark, sf_dir, "segments"), segments=item)
    meta = F.struct(F.lit("} segments: [{").alias("title"), F.array(F.struct(F.lit(1).alias("x"))).alias("windows"))
    doc = (
        F.when(v % 3 == 0, F.to_json("segments")).when(v % 3 == 1, F.to_json(F.struct(meta.alias("meta"), "segments")))
        .otherwise(F.to_json(F.struct(F.struct("segments", meta.alias("meta")).alias("transcript"))))
    )
    folder = shared_folder(spark, "envelopes")
    pages.select(doc.alias("value")).write.text(folder)
    found = read_elements(spark, folder, [(), ("segments",), ("transcript", "segments")])
    line = F.from_json("item", "vod_id bigint, pos bigint, start double, end double, text string, speaker_label string")
    return found.select(line.alias("s")).select(
        "s.vod_id", "s.pos", F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"), "s.text", "s.speaker_label"
    )


@query(
    "chat_envelope_source",
    with_entities("echo_chat", """
    select vod_id, pos, t::double as t, usr, message from echo_chat"""),
)
def chat_envelope_source(spark, sf_dir):
    item = F.struct(F.col("t").alias("timestamp"), F.col("usr").alias("username"), "message")
    docs = _enveloped(entity(spark, sf_dir, "echo_chat"), item, "messages", "chat")
    return chat_source.chat_from_envelope(docs)


def _detection_documents(spark, sf_dir):
    """Per video and hour one document of one of five layouts."""
    d = entity(spark, sf_dir, "detections").withColumn("hour", F.floor(F.col("second_s") / 3600)).withColumn("part", F.col("hour") % 5)
    found = F.struct(F.col("class_name").alias("class_name"), F.lit(0.5).alias("confidence"))
    per = d.groupBy("vod_id", "hour", "part", "second_s").agg(
        F.sort_array(F.collect_list(found)).alias("found"), F.sort_array(F.collect_list("class_name")).alias("names")
    )
    part, s = F.col("part"), F.col("second_s")
    name = F.format_string("frame_%06d.jpg", s.cast("int"))
    detector = F.struct(name.alias("k"), F.to_json(F.struct(s.alias("timestamp_sec"), F.col("found").alias("detections"))).alias("x"))
    keyed = F.struct(s.cast("string").alias("k"), F.to_json("names").alias("x"))
    record = F.to_json(F.struct(s.alias("frame_idx"), F.transform("found", lambda f: F.struct(F.lit("").alias("label"), f["class_name"].alias("name"))).alias("objects")))
    pair = F.when(part == 0, detector).when(part == 1, keyed).otherwise(F.struct(name.alias("k"), record.alias("x")))
    rows = per.groupBy("vod_id", "hour", "part").agg(F.sort_array(F.collect_list(pair)).alias("l"))
    as_object = F.concat(
        F.lit("{"), F.array_join(F.transform("l", lambda p: F.concat(F.lit('"'), p["k"], F.lit('":'), p["x"])), ","), F.lit("}")
    )
    listed = F.array_join(F.transform("l", lambda p: p["x"]), ",")
    doc = (
        F.when(part == 0, F.concat(F.lit('{"results":'), as_object, F.lit("}")))
        .when(part == 1, as_object)
        .when(part == 2, F.concat(F.lit("["), listed, F.lit("]")))
        .when(part == 3, F.concat(F.lit('{"total":1,"frames":['), listed, F.lit("]}")))
        .otherwise(F.concat(F.array_join(F.transform("l", lambda p: p["x"]), "\n"), F.lit("\n[]")))
    )
    return rows.select("vod_id", "part", doc.alias("doc"))


@query(
    "detection_documents_source",
    with_entities("detections", """
    select vod_id, second_s, string_agg(distinct lower(trim(class_name)), ',' order by lower(trim(class_name))) as labels
    from detections group by all"""),
)
def detection_documents_source(spark, sf_dir):
    out = documents.detections_from_documents(_detection_documents(spark, sf_dir)).where("size(labels) > 0")
    return out.withColumn("labels", F.array_join("labels", ","))


def _fusion_documents(spark, sf_dir):
    """Pages of fusion documents; a third of the videos have windows of their own."""
    v = F.col("vod_id")
    line = F.struct(F.col("start_s").alias("t0"), F.col("end_s").alias("end"), F.when(F.col("pos") % 3 > 0, F.col("text")).otherwise("  ").alias("text"))
    point = F.struct(F.col("start_s").alias("time"), (F.col("pos") * 0.4).alias("chat_intensity"))
    window = F.struct(F.col("start_s").alias("start_seconds"), F.col("end_s").alias("end_seconds"), F.concat(F.lit("w"), F.col("pos").cast("string")).alias("title"))
    pages = _pages(entity(spark, sf_dir, "segments"), segments=line, timeline=point, windows=window)
    latest = F.array_max("segments.end")
    doc = F.struct(
        F.struct((latest + 5).alias("duration_seconds")).alias("vod_meta"),
        F.struct("segments", latest.alias("duration_seconds")).alias("transcript"),
        "timeline",
        F.when(v % 3 == 0, F.col("windows")).alias("windows"),
    )
    return documents.split_fusion(pages.select("vod_id", "first", F.to_json(doc).alias("doc")))


@query(
    "fusion_lines_source",
    with_entities("segments", """
    select vod_id, pos, text, start_s::double as start_s, end_s::double as end_s from segments where pos % 3 > 0"""),
)
def fusion_lines_source(spark, sf_dir):
    return _fusion_documents(spark, sf_dir)["lines"]


@query(
    "fusion_points_source",
    with_entities("segments", """
    select vod_id, pos, start_s::double as t, least(1.0::double, pos * 0.4::double) as chat_intensity from segments where start_s > 0"""),
)
def fusion_points_source(spark, sf_dir):
    return _fusion_documents(spark, sf_dir)["points"]


@query(
    "fusion_windows_source",
    with_entities("segments", """
    select vod_id, pos as window_index, case when start_s = 0 then pos else start_s end::double as start_s,
           end_s::double as end_s, concat('w', pos) as title, null::varchar as summary, '' as labels,
           0.0::double as speech_hint, 0.0::double as chat_hint
    from segments where vod_id % 3 = 0"""),
)
def fusion_windows_source(spark, sf_dir):
    return _fusion_documents(spark, sf_dir)["windows"].withColumn("labels", F.array_join("labels", ","))


def _signal_windows(spark, sf_dir):
    """Windows that carry their own signals under changing names, in pages of documents."""
    p = F.col("pos")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    objects = (
        F.when(p % 4 == 0, '"objects":["Cup "," laptop","cup"]').when(p % 4 == 1, '"objects":[],"objects_detected":" Face"')
        .when(p % 4 == 2, '"detections":{"a":{"class_name":"Chair"},"plant":1}').otherwise('"objects":null')
    )
    speech = (
        F.when(p % 3 == 0, '"speech":0,"speech_ratio":0.25').when(p % 3 == 1, '"speech":"yes"').otherwise('"transcript":[1,2]')
    )
    chat = F.when(p % 5 == 0, '"chat":true').when(p % 5 == 1, '"chat":"","message_count":30').otherwise('"chat_intensity":0.125')
    window = text(
        '{"start":', (p * 40 + 1).cast("string"), ',"end":', (p * 40 + 31).cast("string"), ",", objects, ",", speech, ",", chat,
        F.when(p % 2 == 0, ',"summary":"told"').otherwise(""), "}",
    )
    pages = _pages(entity(spark, sf_dir, "segments"), clips=window)
    doc = text('{"clips":[', F.array_join("clips", ","), "]}")
    return documents.split_fusion(pages.select("vod_id", "first", doc.alias("doc")))["windows"]


_SIGNAL_WINDOWS = """
    carried as (
        select vod_id, pos as window_index, pos * 40 + 1.0::double as start_s, pos * 40 + 31.0::double as end_s,
               case when pos % 2 = 0 then 'told' end as summary,
               case cast(pos % 4 as int) when 0 then ['cup', 'laptop'] when 1 then ['face'] when 2 then ['chair', 'plant']
                    else [] end::varchar[] as labels,
               case cast(pos % 3 as int) when 0 then 0.25::double when 1 then 1.0::double else 2.0::double / 30.0::double end as speech,
               case when pos % 5 = 0 then 1.0::double when pos % 5 = 1 then 0.25::double else 0.125::double end as chat
        from segments)"""


@query(
    "carried_window_signals",
    with_entities("segments", f""",{_SIGNAL_WINDOWS}
    select vod_id, window_index, start_s, end_s, null::varchar as title, summary, array_to_string(labels, ',') as labels,
           speech as speech_hint, chat as chat_hint from carried"""),
)
def carried_window_signals(spark, sf_dir):
    return _signal_windows(spark, sf_dir).withColumn("labels", F.array_join("labels", ","))


@query(
    "carried_signal_manifest",
    with_entities("segments detections", f""",{_SIGNAL_WINDOWS},
    seen as (
        select c.vod_id, window_index, lower(trim(class_name)) as label
        from carried c join detections d on d.vod_id = c.vod_id and d.second_s between floor(start_s) and floor(end_s)
        union select vod_id, window_index, unnest(labels) from carried),
    found as (
        select vod_id, window_index, string_agg(label, ',' order by label) as objects,
               sum(case label when 'cup' then 5 when 'laptop' then 8 when 'face' then 10 when 'person' then 8 else 0 end) as tenths
        from seen group by all),
    scored as (
        select c.*, coalesce(objects, '') as objects,
               1.0::double + speech * 3 + chat * 3 + least(2.0::double, coalesce(tenths, 0) / 10.0::double) as raw
        from carried c left join found using (vod_id, window_index))
    select vod_id, window_index, objects as objects_detected,
           round_even(greatest(0.0::double, least(10.0::double, raw)) * 100.0, 0) / 100.0 as score, speech > 0 as has_speech,
           round_even(chat * 1000.0, 0) / 1000.0 as chat_intensity
    from scored"""),
)
def carried_signal_manifest(spark, sf_dir):
    none = entity(spark, sf_dir, "segments").select("vod_id", "pos", "start_s", "end_s", "text").where("false")
    points = entity(spark, sf_dir, "segments").select("vod_id", F.col("start_s").alias("t"), F.lit(0.0).alias("chat_intensity")).where("false")
    out = manifest.clip_manifest(_signal_windows(spark, sf_dir), none, points, entity(spark, sf_dir, "detections"))
    return out.select("vod_id", "window_index", F.array_join("objects_detected", ",").alias("objects_detected"), "score", "has_speech", "chat_intensity")


@query(
    "fusion_durations_source",
    with_entities("segments", "select vod_id, max(end_s)::double + 5 as duration_s from segments group by all"),
)
def fusion_durations_source(spark, sf_dir):
    return _fusion_documents(spark, sf_dir)["durations"]


_METADATA = """
    outputs as (
        select page_id, url, regexp_extract(rtrim(url, '/'), '[^/]*$') as vod_id, page_id % 4 as k, length(html) as d
        from pages)"""


def _videos(spark, sf_dir):
    k = F.col("page_id") % 4
    meta = F.struct(
        F.when(k != 2, F.concat(F.lit("Page "), F.col("page_id").cast("string"))).alias("title"),
        F.length("html").alias("duration"), F.lit("someone").alias("uploader"),
        F.when(k == 1, "Chess").alias("game"), F.when(k == 2, "Art").alias("category"),
        F.when(k == 1, "g1").alias("game_id"), F.array(F.lit("Live"), F.lit("Chess"), F.lit("Live")).alias("categories"),
    )
    output = F.when(k == 3, "no metadata\n{broken").otherwise(F.concat(F.lit("[info] start\n{broken\n  "), F.to_json(meta), F.lit("\n{}")))
    return documents.videos_from_metadata(table(spark, sf_dir, "pages").select("url", output.alias("output")))


@query(
    "video_metadata_source",
    f"""
    with {_METADATA}
    select vod_id, url, case when k < 2 then concat('Page ', page_id) else concat('VOD_', vod_id) end as title,
           case when k < 3 then d else 0 end as duration_s, case when k < 3 then 'someone' else 'unknown' end as streamer,
           case when k < 3 then 'mp4' end as format, case k when 1 then 'Chess' when 2 then 'Art' end as game_name,
           case k when 0 then 'Live,Chess' when 1 then 'Live,Chess' when 2 then 'Live,Chess,Art' else '' end as categories
    from outputs""",
)
def video_metadata_source(spark, sf_dir):
    return _videos(spark, sf_dir).drop("resolution", "fps", "game_id").withColumn(
        "categories", F.array_join("categories", ",")
    )


@query(
    "metadata_game_segments",
    f"""
    with {_METADATA}
    select vod_id, 0.0::double as start_s, d::double as end_s, case k when 1 then 'g1' end as game_id,
           case k when 1 then 'Chess' else 'Art' end as game_name, 'yt_dlp' as source,
           case k when 1 then 1.0::double else 0.7::double end as confidence
    from outputs where k in (1, 2)""",
)
def metadata_game_segments(spark, sf_dir):
    return documents.metadata_game_segments(_videos(spark, sf_dir))


@query(
    "observation_log_source",
    with_entities("claims", """
    select streamer_id, pos, vod_id, kind as type, confidence::double as confidence from claims
    where pos % 7 > 0 and confidence <= 0.9
    qualify row_number() over (partition by streamer_id order by pos desc) <= 100"""),
)
def observation_log_source(spark, sf_dir):
    obs = _observations(spark, sf_dir)
    high = F.when(F.col("confidence") > 0.9, F.col("confidence") + 1).otherwise(F.col("confidence"))
    line = F.to_json(F.struct(*[c for c in obs.columns if c not in ("streamer_id", "pos")]))
    lines = obs.withColumn("confidence", high).select(
        "streamer_id", "pos", F.when(F.col("pos") % 7 == 0, F.substring(line, 1, 20)).otherwise(line).alias("line")
    )
    return logs.load_recent_observations(lines, 100).select("streamer_id", "pos", "vod_id", "type", "confidence")


@query(
    "voice_profile_source",
    """
    with kept as (
        select vec_id % 50 as k, embedding from embeddings where vec_id % 50 <> 7
        qualify row_number() over (partition by vec_id % 50 order by vec_id) = 1)
    select concat('p/', k) as path, concat('id', k) as profile_id, unnest(range(0, len(embedding)))::bigint as i,
           unnest(list_transform(embedding, lambda x: round_even(x::double * 10000.0, 0) / 10000.0)) as value,
           0.5::double as accept_similarity
    from kept""",
)
def voice_profile_source(spark, sf_dir):
    k = F.col("vec_id") % 50
    doc = F.to_json(
        F.struct(
            F.concat(F.lit("id"), k.cast("string")).alias("profile_id"), "embedding",
            F.struct(F.lit(0.5).alias("accept_similarity")).alias("thresholds"),
        )
    )
    docs = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("p/"), k.cast("string")).alias("path"), F.col("vec_id").alias("pos"),
        F.when(k == 7, "{").otherwise(doc).alias("doc"),
    )
    known = logs.profiles_from_documents(docs)
    paths = docs.select("path").distinct()
    refs = paths.select(F.lit("s").alias("streamer_id"), "path")
    return logs.referenced_profiles(known, refs, paths).select(
        "path", "profile_id", F.posexplode("embedding").alias("i", "value"), "accept_similarity"
    ).withColumn("value", F.bround(F.col("value") * 10000.0) / 10000.0)


@query(
    "model_reply_source",
    with_entities("analyses", """
    select vod_id, pos, case when pos % 6 < 5 then clip_worthiness end as clip_worthiness,
           case when pos % 6 < 5 then has_payoff end as has_payoff
    from analyses"""),
)
def model_reply_source(spark, sf_dir):
    p = F.col("pos")
    body = F.to_json(F.struct("clip_worthiness", "has_payoff"))
    raw = (
        F.when(p % 6 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(p % 6 == 1, F.concat(F.lit("{"), body, F.lit("}")))
        .when(p % 6 == 2, F.concat(F.lit("  {"), body))
        .when(p % 6 == 3, F.concat(F.lit("```\n"), body))
        .when(p % 6 == 4, body)
        .otherwise(F.concat(F.lit("Sure: "), body))
    )
    v = replies.parse_reply(raw)
    return entity(spark, sf_dir, "analyses").select("vod_id", "pos", v.alias("v")).select(
        "vod_id", "pos", F.try_variant_get("v", "$.clip_worthiness", "double").alias("clip_worthiness"),
        F.try_variant_get("v", "$.has_payoff", "boolean").alias("has_payoff"),
    )


@query(
    "sectioned_reply_source",
    with_entities("candidates", """
    select pos, concat('12.5|donation at 12.5s;0.0|', trigger_text) as audio,
           case when pos % 3 > 0 then concat(start_s, '.0|face at ', start_s, 's') else '' end as visual,
           case pos % 4 when 0 then 'streamer' when 1 then 'non_streamer' when 2 then 'mixed' else 'unknown' end as primary_speaker,
           case when pos % 4 = 0 then 0.8::double else 0.0::double end as streamer_led_likelihood,
           pos % 4 = 1 as non_streamer_voice_present,
           case when pos % 2 = 0 then 'surprised' else 'flat' end as streamer_affect,
           case when pos % 2 = 0 then 0.3::double else 0.0::double end as organic_reaction_likelihood,
           case when pos % 4 = 0 then 0.4::double when pos % 2 = 1 then 0.3::double else 0.0::double end
               as transactional_alert_likelihood,
           case when pos % 5 = 0 then 'possible_alert_reaction,speaker_uncertain' else '' end as risk_flags
    from candidates"""),
)
def sectioned_reply_source(spark, sf_dir):
    p, c = F.col("pos"), F.lit
    who = (
        F.when(p % 4 == 0, "streamer is led at 0.8, transactional 0.4").when(p % 4 == 1, "a non_streamer voice, streamer quiet")
        .when(p % 4 == 2, "Mixed voices of the streamer").otherwise("unknown")
    )
    reply = F.concat(
        c("AUDIO_EVENTS:\ndonation at 12.5s\nExample: x\n"), "trigger_text",
        F.when(p % 3 > 0, F.concat(c("\n\nVISUAL_EVENTS:\nNone\n  face at "), F.col("start_s").cast("string"), c("s"))).otherwise(""),
        c("\n\nSPEAKER:\n"), who,
        c("\n\nEMOTION:\n"), F.when(p % 2 == 0, "Surprised and genuine").otherwise("flat, a donation alert"),
        F.when(p % 5 == 0, c("\n\nRISK_FLAGS:\nPossible alert reaction; speaker uncertain")).otherwise(""),
    )
    out = replies.parse_sections(entity(spark, sf_dir, "candidates").select("pos", reply.alias("reply")))
    events = lambda name: F.array_join(
        F.transform(name, lambda e: F.concat(F.format_string("%.1f", e["timestamp"]), F.lit("|"), e["raw"])), ";"
    )
    return out.select(
        "pos", events("audio_events").alias("audio"), events("visual_events").alias("visual"), "primary_speaker",
        "streamer_led_likelihood", "non_streamer_voice_present", "streamer_affect", "organic_reaction_likelihood",
        "transactional_alert_likelihood", F.array_join("risk_flags", ",").alias("risk_flags"),
    )


@query(
    "exported_documents",
    with_entities("candidates", """
    select vod_id, concat('{"vod_id":', vod_id, ',"pos":', pos, ',"start_s":', start_s, ',"narrative_type":"', narrative_type, '"}')
               as doc
    from candidates"""),
)
def exported_documents(spark, sf_dir):
    return logs.as_documents(entity(spark, sf_dir, "candidates"), ["vod_id", "pos", "start_s", "narrative_type"])


# Small projections.


@query(
    "normalised_signals",
    with_entities("analyses", """
    select pos, case when pos % 5 = 0 then 0.0::double when (pos % 40 - 4) / 2.0::double <= 1
                     then greatest(0.0::double, (pos % 40 - 4) / 2.0::double)
                     else least(1.0::double, (pos % 40 - 4) / 2.0::double / 10) end as number_signal,
           case when trim(trim_reason) <> '' then 1.0::double else 0.0::double end as text_signal,
           case when has_payoff then 1.0::double else 0.0::double end as flag_signal,
           least(1.0::double, pos % 9 / 4.0::double) as list_signal
    from analyses"""),
)
def normalised_signals(spark, sf_dir):
    p = F.col("pos")
    number = F.when(p % 5 > 0, (p % 40 - 4) / 2.0)
    items = F.when(p % 9 > 0, F.sequence(F.lit(1).cast("bigint"), p % 9))
    return entity(spark, sf_dir, "analyses").select(
        "pos",
        scalars.number_signal(number, 10).alias("number_signal"),
        scalars.text_signal("trim_reason").alias("text_signal"),
        scalars.flag_signal("has_payoff").alias("flag_signal"),
        scalars.collection_signal(items, 4).alias("list_signal"),
    )


_AUDIO = """
    audio as (
        select vod_id, pos, start_s, concat('- ', trigger_text, chr(10), chr(10), case cast(pos % 5 as int)
                   when 0 then 'Dead air and a LONG silence, confidence: 0.8'
                   when 1 then 'Laughter, then she yells. Confidence about 7'
                   when 2 then 'mostly music, speech absent' when 3 then '• speech over music' else 'no confidence given' end) as a
        from candidates)"""


def _audio(spark, sf_dir):
    p = F.col("pos")
    note = (
        F.when(p % 5 == 0, "Dead air and a LONG silence, confidence: 0.8").when(p % 5 == 1, "Laughter, then she yells. Confidence about 7")
        .when(p % 5 == 2, "mostly music, speech absent").when(p % 5 == 3, "• speech over music").otherwise("no confidence given")
    )
    return entity(spark, sf_dir, "candidates").select(
        "vod_id", "pos", "start_s", F.concat(F.lit("- "), "trigger_text", F.lit("\n\n"), note).alias("a")
    )


@query(
    "audio_flags",
    with_entities("candidates", f""",{_AUDIO}
    select pos, a as summary, concat(regexp_replace(split_part(a, chr(10), 1), '^- ', ''), '|', ltrim(split_part(a, chr(10), 3), '• '))
               as key_events, pos % 5 = 0 as dead_air_detected, pos % 5 = 1 or contains(a, 'laugh') as laughter_detected,
           pos % 5 = 1 as raised_voice_detected, pos % 5 = 2 as music_only,
           case pos % 5 when 0 then 0.8::double when 1 then 1.0::double else 0.5::double end as confidence
    from audio"""),
)
def audio_flags(spark, sf_dir):
    flags = X.audio_flags(F.col("a"), F.lit(None).cast("double"))
    return _audio(spark, sf_dir).select("pos", flags.alias("f")).select("pos", "f.*").withColumn(
        "key_events", F.array_join("key_events", "|")
    )


@query(
    "attached_audio",
    with_entities("candidates analyses", f""",{_AUDIO},
    latest as (
        select * from audio qualify row_number() over (partition by vod_id, start_s order by pos desc) = 1)
    select x.vod_id, x.pos, l.a as audio_analysis, l.pos % 5 = 2 as music_only
    from analyses x left join latest l on l.vod_id = x.vod_id and l.start_s = x.start_s"""),
)
def attached_audio(spark, sf_dir):
    audio = _audio(spark, sf_dir).select(
        "vod_id", "pos", "start_s", F.col("a").alias("audio_analysis"),
        X.audio_flags(F.col("a"), F.lit(None).cast("double"))["music_only"].alias("music_only"),
    )
    analyses = entity(spark, sf_dir, "analyses").select("vod_id", "pos", "start_s")
    return selection.attach_audio(analyses, audio).drop("start_s")


@query(
    "time_formats",
    with_entities("speech", """,
    times as (select vod_id, pos, start_s - pos % 2 * 50000 as s from speech),
    parts as (select *, abs(s) // 3600 as h, abs(s) % 3600 // 60 as m, abs(s) % 60 as r from times)
    select vod_id, pos, concat(case when s < 0 then '-' else '' end, h, ':', lpad(m::varchar, 2, '0'), ':', lpad(r::varchar, 2, '0')) as hms,
           concat('https://video.example/v/', vod_id, '?t=', case when s = 0 then '0s' else concat(
               case when h > 0 then concat(h, 'h') else '' end, case when m > 0 then concat(m, 'm') else '' end,
               case when r > 0 then concat(r, 's') else '' end) end) as link,
           cast(floor(s + s * 0.005::double + 8) as bigint) as player_s
    from parts"""),
)
def time_formats(spark, sf_dir):
    s = F.col("start_s") - F.col("pos") % 2 * 50000
    return entity(spark, sf_dir, "speech").select(
        "vod_id", "pos", X.hms(s).alias("hms"),
        X.video_link("https://video.example/v/", F.col("vod_id"), s).alias("link"),
        scalars.drift_offset(s).alias("player_s"),
    )


@query(
    "enrolment_ranges",
    with_entities("speech", """
    select pos, 0::bigint as i, start_s::double as start, end_s::double as "end", null as error from speech
    union all select pos, 1, start_s::double, case when pos % 2 = 0 then null else 0.5::double end,
        case when pos % 2 = 0 then 'not a number' when start_s > 0 then 'end<=start' end from speech
    union all select pos, 2, null, null, 'no range' from speech where pos % 3 = 0"""),
)
def enrolment_ranges(spark, sf_dir):
    p = F.col("pos")
    spec = F.concat(
        F.lit(" "), F.col("start_s").cast("string"), F.lit("-"), F.col("end_s").cast("string"), F.lit(" , "),
        F.col("start_s").cast("string"), F.when(p % 2 == 0, "-x").otherwise("-0.5"),
        F.when(p % 3 == 0, ",whole").otherwise(", "),
    )
    return (
        entity(spark, sf_dir, "speech")
        .select("pos", F.posexplode(X.enrolment_ranges(spec)).alias("i", "r"))
        .select("pos", F.col("i").cast("bigint").alias("i"), "r.start", "r.end", "r.error")
    )


@query(
    "export_files",
    with_entities("analyses candidates", r"""
    select a.vod_id, a.pos, concat('clip_rank', a.pos % 20, '_', replace(trim(regexp_replace(
               concat(c.trigger_text, ' & "', c.payoff_text, '" é!'), '[^\p{L}\p{N}_\s-]', '', 'g')), ' ', '_'), '_', a.trim_start, 's.mp4')
               as file_name
    from analyses a join candidates c on c.vod_id = a.vod_id and c.pos = a.pos where a.clip_worthiness >= 7"""),
)
def export_files(spark, sf_dir):
    words = entity(spark, sf_dir, "candidates").select("vod_id", "pos", "trigger_text", "payoff_text")
    title = F.concat("trigger_text", F.lit(' & "'), "payoff_text", F.lit('" é!'))
    analyses = entity(spark, sf_dir, "analyses").withColumn("score", F.col("clip_worthiness"))
    return (
        selection.exportable_clips(analyses).join(words, ["vod_id", "pos"])
        .select("vod_id", "pos", X.clip_file_name(F.col("pos") % 20, title, F.col("trim_start")).alias("file_name"))
    )


@query(
    "video_ids",
    r"""
    select page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') as url_id,
           case page_id % 4 when 0 then 'stated' when 1 then concat('v', page_id)
                            when 2 then cast(12345678 + page_id as varchar) end as artifact_id
    from pages""",
)
def video_ids(spark, sf_dir):
    k = F.col("page_id")
    path = (
        F.when(k % 4 == 1, F.concat(F.lit("/out/phase4_v"), k.cast("string"), F.lit("/result.json")))
        .when(k % 4 == 2, F.concat(F.lit("/out/run_"), (k + 12345678).cast("string"), F.lit(".json"))).otherwise("/out/a.json")
    )
    stated = F.when(k % 4 == 0, " stated ").otherwise(" ")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.vod_id_of_url(F.col("url")).alias("url_id"), X.vod_id_of_artifact(stated, path).alias("artifact_id")
    )


@query(
    "analysis_log",
    with_entities("analyses", """
    select vod_id, pos, concat('Clip at ', start_s, 's (clip_id=', start_s, '): score=',
        case when pos % 2 = 0 then concat(pos % 10, '/10 (revised from ', pos % 7, ')') else concat(pos % 7, '/10') end,
        ', energy=', case when pos % 4 = 0 then '9' else '5' end, '/10, interest=?/10, expr=?, narrative=story, payoff=',
        has_payoff, ', trim=', trim_start, '-', trim_end, 's, reason=', trim_reason, '->, arc=', narrative_arc,
        ', point=, reason=', case when pos % 2 = 0 then 'second look' else 'first look' end) as entry
    from analyses"""),
)
def analysis_log(spark, sf_dir):
    p, none = F.col("pos"), F.lit(None).cast("string")
    rows = entity(spark, sf_dir, "analyses").select(
        "vod_id", "pos", "start_s", (p % 7).alias("clip_worthiness"), F.lit(5).alias("emotional_energy"),
        none.alias("visual_interest"), none.alias("primary_expression"), F.when(p % 2 == 0, p % 10).alias("revised_clip_worthiness"),
        F.when(p % 4 == 0, 9).alias("revised_emotional_energy"), none.alias("revised_visual_interest"), none.alias("revised_expression"),
        F.lit("story").alias("narrative_type"), "has_payoff", "trim_start", "trim_end", F.col("trim_reason").alias("trim_start_reason"),
        none.alias("trim_end_reason"), "narrative_arc", none.alias("clip_point"), F.lit("first look").alias("reason"),
        F.lit("second look").alias("revised_reason"),
    )
    return prompts.analysis_log(rows)


@query(
    "triage_prompt_parts",
    with_entities("chat speech", f""",{_CHUNKS}
    select vod_id, chunk_index, 'bounds' as section, chunk_start as ord_s, 0::bigint as pos,
           concat('{{"chunk_start":', chunk_start, ',"chunk_end":', chunk_end, '}}') as body from chunks
    union all
    select c.vod_id, c.chunk_index, 'transcript', s.start_s, s.pos,
           concat('{{"start":', s.start_s, ',"end":', s.end_s, ',"text":"', s.text, '"}}')
    from chunks c join speech s on s.vod_id = c.vod_id and s.start_s >= c.chunk_start and s.start_s < c.chunk_end
    union all
    select c.vod_id, c.chunk_index, 'chat', m.t, m.pos,
           concat('{{"timestamp":', m.t, ',"user":"', m.usr, '","message":"', replace(m.message, '"', '\\"'), '"}}')
    from chunks c join chat m on m.vod_id = c.vod_id and m.t >= c.chunk_start and m.t < c.chunk_end"""),
)
def triage_prompt_parts(spark, sf_dir):
    return prompts.triage_prompt_parts(_chunks(spark, sf_dir), entity(spark, sf_dir, "speech"), entity(spark, sf_dir, "chat"))


@query(
    "name_prompts",
    with_entities("segments echo_chat", """
    select vod_id, 'transcript' as section, pos, concat('[', printf('%.1f', start_s::double), 's] ', speaker_label, ': ', text) as line
    from segments
    union all
    select vod_id, 'chat', pos, concat('[', printf('%.1f', t::double), 's] @', usr, ': ', message) from echo_chat"""),
)
def name_prompts(spark, sf_dir):
    return prompts.name_prompts(entity(spark, sf_dir, "segments"), entity(spark, sf_dir, "echo_chat"))
