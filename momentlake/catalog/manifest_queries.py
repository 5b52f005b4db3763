from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, with_entities
from ..operators import chat, crossref, fusion, intervals, manifest, objects
from ..runtime import checkpointed
from . import query
from .chat_queries import _SPIKE_CTES
from .fusion_queries import _SCENES

# The timeline of these queries: one point per spoken line, with the strongest chat spike it overlaps.
_TIMELINE = _SPIKE_CTES.format(w=600) + """,
    timeline as (
        select s.vod_id, s.pos, s.start_s as t, coalesce(max(p.intensity), 0.0) as chat_intensity
        from speech s left join spikes p on p.vod_id = s.vod_id and p.start_s < s.end_s and p.end_s > s.start_s
        group by s.vod_id, s.pos, s.start_s),
    durations as (
        select vod_id, cast(max(t) as double) as duration_s
        from (select vod_id, end_s as t from speech union all select vod_id, t from chat) group by all)"""

_WINDOWS = """
    grid as (
        select vod_id, duration_s, unnest(range(0, cast(ceil(duration_s / 300) as bigint) + 1)) as window_index
        from durations),
    windows as (
        select vod_id, window_index, window_index * 300 as start_s,
               least(window_index * 300 + 600, duration_s) as end_s
        from grid
        where window_index * 300 < duration_s
          and (window_index = 0 or (window_index - 1) * 300 + 600 < duration_s))"""

_SIGNALS = """
    speech_sums as (
        select w.vod_id, w.window_index, sum(least(w.end_s, s.end_s) - greatest(w.start_s, s.start_s)) as sec
        from windows w join speech s on s.vod_id = w.vod_id and s.start_s < w.end_s and w.start_s < s.end_s
        group by all),
    chat_means as (
        select w.vod_id, w.window_index, avg(least(1.0::double, chat_intensity)) as chat
        from windows w join timeline p on p.vod_id = w.vod_id and p.t between w.start_s and w.end_s
        where p.t > 0 group by all),
    labels as (select distinct vod_id, second_s, lower(trim(class_name)) as label from detections),
    seen as (
        select distinct w.vod_id, w.window_index, label
        from windows w join labels d on d.vod_id = w.vod_id
             and d.second_s between cast(floor(w.start_s) as bigint) and cast(floor(w.end_s) as bigint)),
    object_sums as (
        select vod_id, window_index, string_agg(label, ',' order by label) as objects, count(*) as n_objects,
               cast(sum(case label when 'person' then 8 when 'laptop' then 8 when 'cup' then 5 else 0 end) as bigint)
                   as tenths
        from seen group by all),
    signals as (
        select w.*, least(1.0::double, coalesce(sec, 0) / greatest(0.001::double, w.end_s - w.start_s)) as speech,
               coalesce(chat, 0.0::double) as chat, coalesce(objects, '') as objects,
               coalesce(n_objects, 0) as n_objects, coalesce(tenths, 0) as tenths
        from windows w left join speech_sums using (vod_id, window_index)
        left join chat_means using (vod_id, window_index) left join object_sums using (vod_id, window_index))"""


def _timeline(spark, sf_dir):
    spikes = chat.spikes(entity(spark, sf_dir, "chat"), 600)
    lines = fusion.spike_intensity(entity(spark, sf_dir, "speech"), spikes)
    return lines.select("vod_id", "pos", F.col("start_s").alias("t"), "chat_intensity")


def _durations(spark, sf_dir):
    # One row per video, read several times by the windows made of it.
    return checkpointed(
        manifest.video_durations([(entity(spark, sf_dir, "speech"), "end_s"), (entity(spark, sf_dir, "chat"), "t")])
    )


def _windows(spark, sf_dir):
    return intervals.sliding_windows(_durations(spark, sf_dir), 600, 300).select(
        "vod_id", "window_index", "start_s", "end_s"
    )


@query("video_durations", with_entities("chat speech", "," + _TIMELINE + "select * from durations"))
def video_durations(spark, sf_dir):
    return _durations(spark, sf_dir)


@query(
    "known_durations",
    with_entities("chat speech", """,
    stated as (select c_custkey as vod_id, case when c_custkey % 3 = 0 then 0 else 1000 + c_custkey end as d from customer),
    seen as (select vod_id, max(t) as t from (select vod_id, end_s as t from speech union all select vod_id, t from chat) group by all)
    select coalesce(a.vod_id, b.vod_id) as vod_id,
           cast(case when d > 0 then d else coalesce(t, 0) end as double) as duration_s
    from stated a full join seen b on a.vod_id = b.vod_id"""),
)
def known_durations(spark, sf_dir):
    from ..adapters import table

    k = F.col("c_custkey")
    stated = table(spark, sf_dir, "customer").select(
        k.alias("vod_id"), F.when(k % 3 == 0, 0).otherwise(1000 + k).alias("duration_s")
    )
    return manifest.first_known_durations(
        stated, [(entity(spark, sf_dir, "speech"), "end_s"), (entity(spark, sf_dir, "chat"), "t")]
    )


@query("sliding_windows", with_entities("chat speech", f",{_TIMELINE},{_WINDOWS} select * from windows"))
def sliding_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


@query(
    "window_speech_ratio",
    with_entities("chat speech detections", f""",{_TIMELINE},{_WINDOWS},{_SIGNALS}
    select vod_id, start_s, end_s, round_even(speech * 1000000.0, 0) / 1000000.0 as speech_norm from signals"""),
)
def window_speech_ratio(spark, sf_dir):
    from ..functions.scalars import round_half_even

    out = manifest.speech_ratio(_windows(spark, sf_dir), entity(spark, sf_dir, "speech"))
    return out.withColumn("speech_norm", round_half_even("speech_norm", 6))


@query(
    "window_chat_intensity",
    with_entities("chat speech detections", f""",{_TIMELINE},{_WINDOWS},{_SIGNALS}
    select vod_id, start_s, end_s, round_even(chat * 1000000.0, 0) / 1000000.0 as chat_norm from signals"""),
)
def window_chat_intensity(spark, sf_dir):
    from ..functions.scalars import round_half_even

    out = manifest.chat_intensity(_windows(spark, sf_dir), _timeline(spark, sf_dir))
    return out.withColumn("chat_norm", round_half_even("chat_norm", 6))


@query(
    "window_objects",
    with_entities("chat speech detections", f""",{_TIMELINE},{_WINDOWS},{_SIGNALS}
    select vod_id, start_s, end_s, objects as objects_detected, tenths as useful_tenths
    from signals where n_objects > 0"""),
)
def window_objects(spark, sf_dir):
    out = manifest.window_objects(_windows(spark, sf_dir), entity(spark, sf_dir, "detections"))
    return out.withColumn("objects_detected", F.array_join("objects_detected", ","))


@query(
    "clip_manifest",
    with_entities("chat speech detections", f""",{_TIMELINE},{_WINDOWS},{_SIGNALS},
    bonuses as (
        select *, least(3.0::double, speech * 3) as sb, least(3.0::double, chat * 3) as cb,
               least(2.0::double, tenths / 10.0::double) as ob,
               case when speech <= 0 and chat <= 0 and tenths = 0 then 2.0::double else 0.0::double end as ep
        from signals),
    scored as (
        select *, 1.0::double + sb + cb + ob - ep as raw,
               round_even(greatest(0.0::double, least(10.0::double, 1.0::double + sb + cb + ob - ep)) * 100.0, 0)
                   / 100.0 as score
        from bonuses),
    labelled as (
        select *, case when score >= 8 then 'hype' when score >= 5 then 'highlight'
                       when speech <= 0 and chat < 0.15 and n_objects = 0 then 'dead' else 'context' end as label
        from scored)
    select vod_id, window_index, cast(start_s as double) as start_s, end_s,
           concat(upper(label[1]), label[2:], ' clip ', window_index + 1) as title, score,
           objects as objects_detected,
           case when label = 'dead' then 'Low activity window with minimal speech, chat, or detectable objects.'
                else concat('Speech ', printf('%.2f', round_even(speech * 100.0, 0) / 100.0), ', chat ',
                            printf('%.2f', round_even(chat * 100.0, 0) / 100.0), ', objects ', n_objects,
                            ' contribute to a ', label, ' moment.') end as summary,
           speech > 0 as has_speech, round_even(chat * 1000.0, 0) / 1000.0 as chat_intensity, label,
           round_even(sb * 1000.0, 0) / 1000.0 as speech_bonus, round_even(cb * 1000.0, 0) / 1000.0 as chat_bonus,
           round_even(ob * 1000.0, 0) / 1000.0 as object_bonus, ep as empty_penalty,
           round_even(raw * 1000.0, 0) / 1000.0 as raw_score
    from labelled"""),
)
def clip_manifest(spark, sf_dir):
    out = manifest.clip_manifest(
        _windows(spark, sf_dir),
        entity(spark, sf_dir, "speech"),
        _timeline(spark, sf_dir),
        entity(spark, sf_dir, "detections"),
    )
    return out.withColumn("objects_detected", F.array_join("objects_detected", ","))


@query(
    "coverage_manifest",
    with_entities("chat speech", f""",{_TIMELINE},
    tops as (select vod_id, cast(ceil(duration_s) as bigint) as total from durations),
    starts as (
        select vod_id, total, unnest(range(0, greatest(0, total - 60) + 1, 45)) as start_s from tops
        union select vod_id, total, greatest(0, total - 60) from tops),
    windows as (select vod_id, start_s, least(start_s + 60, total) as end_s from starts),
    lines as (
        select w.*, s.pos, trim(s.text) as line, least(w.end_s, s.end_s) - greatest(w.start_s, s.start_s) as sec
        from windows w join speech s on s.vod_id = w.vod_id and s.start_s < w.end_s and w.start_s < s.end_s),
    spoken as (
        select vod_id, start_s, end_s, sum(sec) as sec,
               string_agg(line, ' ' order by pos) as preview
        from lines group by all),
    chats as (
        select w.vod_id, w.start_s, w.end_s, avg(chat_intensity) as chat
        from windows w join timeline p on p.vod_id = w.vod_id and p.t between w.start_s and w.end_s group by all),
    joined as (
        select w.*, coalesce(sec, 0) as sec, coalesce(chat, 0) as chat, preview
        from windows w left join spoken using (vod_id, start_s, end_s)
        left join chats using (vod_id, start_s, end_s))
    select vod_id, start_s, end_s, concat('Candidate ', start_s, 's-', end_s, 's') as title,
           round_even(least(10.0::double,
               least(6.0::double, sec / greatest(1.0::double, end_s - start_s) * 8) + least(3.0::double, chat * 2)
               + case when end_s - start_s between 25 and 90 then 1.0::double else 0.0::double end) * 100.0, 0)
               / 100.0 as score,
           coalesce(preview, 'No transcript preview') as summary, sec > 2 as has_speech,
           round_even(chat * 1000.0, 0) / 1000.0 as chat_intensity, 'window_candidate' as label
    from joined"""),
)
def coverage_manifest(spark, sf_dir):
    return manifest.coverage_manifest(
        _durations(spark, sf_dir),
        entity(spark, sf_dir, "speech"),
        _timeline(spark, sf_dir),
        window_seconds=60,
        step_seconds=45,
    )


@query(
    "object_categories",
    with_entities("detections", """
    select lower(trim(class_name)) as label,
           case lower(trim(class_name)) when 'person' then 'person' when 'laptop' then 'device'
                when 'cup' then 'food/drink' when 'cat' then 'pet' when 'clock' then 'object' end as category,
           case lower(trim(class_name)) when 'person' then 'person' when 'laptop' then 'device/screen'
                when 'cup' then 'food' when 'cat' then 'animal' end as topic_category,
           count(*) as uses
    from detections group by all"""),
)
def object_categories(spark, sf_dir):
    label = F.lower(F.trim("class_name"))
    rows = entity(spark, sf_dir, "detections").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("uses"))
    return rows.select(
        "label",
        objects.category(F.col("label")).alias("category"),
        objects.category(F.col("label"), "topic").alias("topic_category"),
        "uses",
    )


@query(
    "labels_per_second",
    with_entities("detections", """
    select vod_id, second_s, string_agg(distinct lower(trim(class_name)), ',' order by lower(trim(class_name))) as labels
    from detections group by all"""),
)
def labels_per_second(spark, sf_dir):
    out = objects.seconds_with_labels(entity(spark, sf_dir, "detections"))
    return out.withColumn("labels", F.array_join("labels", ","))


@query(
    "confident_detections",
    with_entities("detections", """
    select vod_id, pos, second_s, class_name, confidence from detections where confidence >= 0.35"""),
)
def confident_detections(spark, sf_dir):
    named = entity(spark, sf_dir, "detections").withColumn(
        "frame_name", F.format_string("frame_%06d.jpg", (F.col("second_s") / 5).cast("int"))
    )
    out = objects.confident_detections(named.drop("second_s").withColumn("confidence", F.col("confidence").cast("double")))
    return out.select("vod_id", "pos", "second_s", "class_name", "confidence")


_SCENE_CROSSREF = """
    kept as (
        select vod_id, scene_index, start_s, end_s, end_s - start_s as duration_s, label
        from scenes where end_s - start_s >= 30),
    frames as (
        select vod_id, second_s, count(*) as num_objects, bool_or(lower(class_name) = 'person') as person,
               bool_or(lower(class_name) = 'laptop') as device, bool_or(lower(class_name) = 'cup') as food,
               bool_or(lower(class_name) = 'cat') as pet, bool_or(lower(class_name) = 'clock') as object
        from detections group by all),
    seen as (
        select k.vod_id, k.scene_index, cast(sum(num_objects) as bigint) as n, bool_or(person) as person,
               bool_or(device) as device, bool_or(food) as food, bool_or(pet) as pet, bool_or(object) as object
        from kept k join frames f on f.vod_id = k.vod_id and f.second_s < k.end_s and {grid}
        group by all),
    per_second as (
        select vod_id, t, chat_intensity as v from timeline
        qualify row_number() over (partition by vod_id, t order by pos desc) = 1),
    chats as (
        select k.vod_id, k.scene_index, avg(v) as chat
        from kept k join per_second p on p.vod_id = k.vod_id and p.t between k.start_s and k.end_s
        where v > 0 group by all),
    lines as (
        select k.vod_id, k.scene_index, string_agg(trim(s.text), ' ' order by s.pos) as preview
        from kept k join speech s on s.vod_id = k.vod_id and s.start_s between k.start_s and k.end_s group by all),
    joined as (
        select k.*, coalesce(n, 0) as n, coalesce(person, false) as person, coalesce(device, false) as device,
               coalesce(food, false) as food, coalesce(pet, false) as pet, coalesce(object, false) as object,
               coalesce(chat, 0) as chat, preview
        from kept k left join seen using (vod_id, scene_index) left join chats using (vod_id, scene_index)
        left join lines using (vod_id, scene_index)),
    scored as (select *, {score} as score from joined),
    ranked as (
        select *, row_number() over (partition by vod_id order by score desc, scene_index) as rank from scored)
    select vod_id, scene_index, start_s, end_s, duration_s, label, score,
           concat_ws(',', case when device then 'device' end, case when food then 'food/drink' end,
                     case when object then 'object' end, case when person then 'person' end,
                     case when pet then 'pet' end) as visual_categories,
           n as objects_detected, round_even(chat * 100.0, 0) / 100.0 as avg_chat_intensity,
           preview is not null as has_speech, coalesce(preview, label) as summary, rank,
           start_s as clip_start, start_s + least(120, greatest(30, duration_s)) as clip_end
    from ranked where rank <= 10"""

_CATEGORY_SCORE = """
    (case when person then 2 else 0 end + case when person and label in ('interaction', 'intro', 'outro') then 2
     else 0 end + case when food then 4 else 0 end + case when device then 2 else 0 end
     + case when pet then 6 else 0 end + case when chat > 0.5 then 3 when chat > 0.1 then 1.5::double else 0 end
     + case label when 'interaction' then 1 when 'intro' then 3 when 'highlight' then 5 else 0 end
     + case when preview is not null then 1.5::double else 0 end
     + case when duration_s between 30 and 120 then 1 else 0 end)"""

_DENSITY_SCORE = """
    (case when person and label in ('interaction', 'intro', 'outro') then 4 else 0 end
     + case when food then 3 else 0 end + case when pet then 5 else 0 end
     + case when person::int + device::int + food::int + pet::int + object::int >= 2 then 2 else 0 end
     + case when n > 20 then 2 else 0 end
     + case when chat > 0.5 then 3 when chat > 0.1 then 1 else 0 end
     + case label when 'interaction' then 3 when 'intro' then 2 when 'highlight' then 4 when 'quiet' then -1 else 0 end
     + case when preview is not null then 2 else 0 end
     + case when duration_s between 30 and 90 then 1 else 0 end)::double"""


def _scene_crossref(spark, sf_dir, scheme):
    out = crossref.scene_candidates(
        intervals.scenes_from_cuts(entity(spark, sf_dir, "cuts")),
        entity(spark, sf_dir, "detections").withColumn("class_name", F.trim("class_name")),
        _timeline(spark, sf_dir),
        entity(spark, sf_dir, "speech"),
        scheme=scheme,
    )
    return out.withColumn("visual_categories", F.array_join("visual_categories", ","))





def _crossref_sql(grid: str, score: str) -> str:
    body = f""",{_SCENES},{_TIMELINE},{_SCENE_CROSSREF.format(grid=grid, score=score)}"""
    sql = with_entities("chat speech cuts detections", body)
    return sql.replace("lower(class_name)", "lower(trim(class_name))")


@query(
    "scene_crossref_by_category",
    _crossref_sql("f.second_s >= k.start_s - k.start_s % 5 and (f.second_s - (k.start_s - k.start_s % 5)) % 5 = 0",
                  _CATEGORY_SCORE),
)
def scene_crossref_by_category(spark, sf_dir):
    return _scene_crossref(spark, sf_dir, "category")


@query(
    "scene_crossref_by_density",
    _crossref_sql("f.second_s >= k.start_s and (f.second_s - k.start_s) % 5 = 0", _DENSITY_SCORE),
)
def scene_crossref_by_density(spark, sf_dir):
    return _scene_crossref(spark, sf_dir, "density")


_EMOTION = """case when text like '%URGENT%' then 'Excited' when text like '%HIGH%' then 'funny'
    when text like '%medium%' then 'sad' when text like '%low%' then 'bored' end"""
_TOPIC = """case when text like '%URGENT%' then 'Dinner and coffee' when text like '%HIGH%' then 'watch the dog'
    when text like '%MEDIUM%' then 'people' when text like '%LOW%' then 'zzz' end"""


@query(
    "topic_crossref",
    with_entities("speech detections", f""",
    segs as (select *, {_TOPIC} as topic, {_EMOTION} as emotion, text like '%!!!' as novelty from speech),
    frames as (
        select vod_id, second_s, count(*) as num_objects, bool_or(lower(trim(class_name)) = 'person') as person,
               bool_or(lower(trim(class_name)) = 'laptop') as device, bool_or(lower(trim(class_name)) = 'cup') as food,
               bool_or(lower(trim(class_name)) = 'cat') as pet
        from detections group by all),
    seen as (
        select s.vod_id, s.pos, s.start_s, s.end_s, s.topic, s.emotion, s.novelty, count(*) as frames_sampled,
               cast(sum(num_objects) as bigint) as objects_detected, bool_or(person) as person,
               bool_or(device) as device, bool_or(food) as food, bool_or(pet) as pet
        from segs s join frames f on f.vod_id = s.vod_id and f.second_s >= s.start_s and f.second_s < s.end_s
             and (f.second_s - s.start_s) % 5 = 0
        group by all),
    visual as (
        select *,
            case when food and topic = 'Dinner and coffee' then 3.0::double else 0 end
            + case when person and topic in ('Dinner and coffee', 'people') then 2.0::double else 0 end
            + case when device and topic = 'watch the dog' then 2.0::double else 0 end
            + case when pet and topic = 'watch the dog' then 3.0::double else 0 end
            + case when person and emotion in ('Excited', 'funny') then 2.0::double else 0 end
            + case when person and emotion = 'sad' then 1.5::double else 0 end
            + case when novelty then 1.0::double else 0 end as v,
            case emotion when 'Excited' then 4 when 'funny' then 5 when 'sad' then 2 else 1 end as emotion_weight
        from seen),
    scored as (
        select *, round_even((v + emotion_weight * 0.5::double + frames_sampled / 6.0::double) * 10.0, 0) / 10.0 as score
        from visual),
    ranked as (select *, row_number() over (partition by vod_id order by score desc, pos) as rank from scored)
    select vod_id, pos, start_s, end_s, topic, emotion,
           concat_ws(',', case when pet then 'animal' end, case when device then 'device/screen' end,
                     case when food then 'food' end, case when person then 'person' end) as visual_categories,
           round_even(v * 10.0, 0) / 10.0 as visual_score, cast(emotion_weight as bigint) as emotion_weight, score,
           frames_sampled, objects_detected, rank, start_s as clip_start,
           start_s + least(120, greatest(30, end_s - start_s)) as clip_end
    from ranked where rank <= 10"""),
)
def topic_crossref(spark, sf_dir):
    segs = (
        entity(spark, sf_dir, "speech")
        .withColumn("topic", F.expr(_TOPIC))
        .withColumn("emotion", F.expr(_EMOTION))
        .withColumn("novelty", F.expr("text like '%!!!'"))
    )
    detections = entity(spark, sf_dir, "detections").withColumn("class_name", F.trim("class_name"))
    out = crossref.topic_candidates(segs, detections)
    return out.withColumn("visual_categories", F.array_join("visual_categories", ","))
