"""Transcript, fusion, metadata and detection documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp, let
from ..functions.text import vod_id_of_url
from .chat import elements, first_position, is_list

_SEGMENT = "struct<start:double,end:double,text:string,confidence:double,speaker_label:string>"


def transcript_from_envelope(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transcript lines of a bare list, ``{segments}`` or ``{transcript: {segments}}``,
    and the documents of any other shape.

    ``documents``: vod_id, doc and, for pages of a longer list, ``first``.  A negative confidence is a log-probability and
    becomes a probability, with ``confidence_was_log`` set.
    """
    items = f"array<{_SEGMENT}>"
    wrapped = F.from_json("doc", f"struct<segments:{items},transcript:struct<segments:{items}>>")
    segments = F.when(is_list(F.col("doc")), F.from_json("doc", items)).otherwise(
        F.coalesce(wrapped["segments"], wrapped["transcript"]["segments"])
    )
    read = documents.withColumn("_s", segments)
    log = F.col("s.confidence") < 0
    lines = (
        elements(read, F.col("_s"), "pos", "s")
        .where("s is not null")
        .select(
            "vod_id", "pos", F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"), F.col("s.text").alias("text"),
            F.when(log, F.exp("s.confidence")).otherwise(F.col("s.confidence")).alias("confidence"),
            F.coalesce(log, F.lit(False)).alias("confidence_was_log"),
            F.col("s.speaker_label").alias("speaker_label"),
        )
    )
    return lines, read.where("_s is null").select("vod_id", F.lit("unsupported transcript document").alias("error"))


# Loosely typed documents are read as VARIANT values.


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_object(v: Column) -> Column:
    return F.coalesce(_kind(v).startswith("OBJECT"), F.lit(False))


def _is_array(v: Column) -> Column:
    return F.coalesce(_kind(v).startswith("ARRAY"), F.lit(False))


def _is_text(v: Column) -> Column:
    return F.coalesce(_kind(v) == "STRING", F.lit(False))


def _items(v: Column) -> Column:
    return F.when(_is_array(v), v).cast("array<variant>")


def _entries(v: Column) -> Column:
    return F.when(_is_object(v), v).cast("map<string,variant>")


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(F.when(_is_object(v), v), f"$.{name}", "variant")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def strict_json(text: Column) -> Column:
    """The text as a VARIANT value; NULL unless it is exactly one JSON value."""
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.when(one, F.try_parse_json(text))


def _first(v: Column, names: tuple[str, ...]) -> Column:
    """The first field that is not missing, null, false, zero or empty."""
    fields = F.array(*[_field(v, n) for n in names])

    def truthy(x: Column) -> Column:
        return let(_text(x), lambda t: t.isNotNull() & ~t.isin("", "0", "0.0", "false", "[]", "{}"))

    return F.get(F.filter(fields, lambda x: x.isNotNull() & F.coalesce(truthy(x), F.lit(False))), 0)


# Alternative field names, best first.
_SECOND_FIELDS = ("timestamp_sec", "frame", "frame_idx", "frame_index", "second", "timestamp")
_LABEL_LISTS = ("objects", "labels", "classes", "detections")
_LABEL_FIELDS = ("label", "name", "class", "class_name")
_OBJECT_FIELDS = ("objects", "objects_detected", "detections")
_SPEECH_FIELDS = ("speech", "speech_score", "speech_ratio", "speech_activity", "transcript")
_CHAT_FIELDS = ("chat", "chat_activity", "chat_messages", "message_count", "chat_intensity")
CHAT_FULL_SCALE = 120.0
_START_FIELDS, _END_FIELDS = ("start", "start_seconds", "t0"), ("end", "end_seconds", "t1")


def _labels(v: Column) -> Column:
    """Labels of a text, a list of texts and objects, or an object of labelled entries."""
    clean = lambda t: F.lower(F.trim(t))
    of_item = lambda x: F.when(_is_text(x), clean(_text(x))).when(
        _is_object(x), clean(_text(_first(x, _LABEL_FIELDS)))
    )
    of_entry = lambda e: F.coalesce(clean(_text(_first(e["value"], _LABEL_FIELDS))), clean(e["key"]))

    def found(x: Column) -> Column:
        return F.coalesce(
            F.transform(_items(x), of_item),
            F.transform(F.map_entries(_entries(x)), of_entry),
            F.when(_is_text(x), F.array(clean(_text(x)))),
            F.array().cast("array<string>"),
        )

    return F.filter(let(v, found), lambda x: x.isNotNull() & (x != ""))


def frame_second(name: Column) -> Column:
    """Second of a frame key: the number itself, else its last group of digits, else 0."""
    last = F.try_element_at(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1))
    return F.coalesce(name.try_cast("double").try_cast("bigint"), last.try_cast("bigint"), F.lit(0).cast("bigint"))


def detections_from_documents(documents: DataFrame) -> DataFrame:
    """Sorted distinct labels per second from detection documents of many layouts.

    ``documents``: vod_id, doc.  Understood are lists of records, objects keyed
    by frame or second, both also inside ``results`` or ``frames``, and one
    record per line.  A record's second is the first of several fields, else its
    key or place.
    """
    def unwrapped(v: Column) -> Column:
        return let(v, lambda x: F.coalesce(_field(x, "results"), _field(x, "frames"), x))

    def record(place: Column, v: Column) -> Column:
        return F.struct(place.cast("bigint").alias("fallback"), v.alias("v"))

    def records(v: Column) -> Column:
        return (
            F.when(_is_array(v), F.transform(_items(v), lambda x, i: record(i, x)))
            .when(
                _is_object(v),
                F.transform(F.map_entries(_entries(v)), lambda e: record(frame_second(e["key"]), e["value"])),
            )
            .otherwise(F.array(record(F.lit(0), v)))
        )

    per_line = F.transform(F.split("doc", "\n"), lambda line, i: record(i, strict_json(line)))
    whole = documents.withColumn("v", unwrapped(unwrapped(strict_json(F.col("doc")))))  # results may hold frames
    rows = whole.select("vod_id", F.explode(F.when(F.col("v").isNull(), per_line).otherwise(records(F.col("v")))).alias("r"))
    v, fallback = F.col("r.v"), F.col("r.fallback")

    def second(x: Column) -> Column:
        stated = F.try_variant_get(_first(x, _SECOND_FIELDS), "$", "double").try_cast("bigint")
        return F.when(_is_object(x), F.coalesce(stated, fallback)).otherwise(fallback)

    def labels(x: Column) -> Column:
        return F.when(_is_object(x), _labels(_first(x, _LABEL_LISTS))).otherwise(_labels(x))

    return (
        rows.where(v.isNotNull())
        .select("vod_id", let(v, second).alias("second_s"), F.explode_outer(let(v, labels)).alias("label"))
        .groupBy("vod_id", "second_s")
        .agg(F.array_sort(F.collect_set("label")).alias("labels"))
    )


def _number(v: Column, names: tuple[str, ...], default: Column) -> Column:
    return F.coalesce(safe_number(_first(v, names)), default)


def _signal(v: Column, full_scale: Column) -> Column:
    """0..1 from a value of any kind: numbers up to 1 as they are, larger ones and sizes of lists and
    objects by ``full_scale``, text and flags by whether they say anything."""
    scale = F.greatest(full_scale, F.lit(1.0))
    number = safe_number(v)
    size = F.coalesce(F.size(_items(v)), F.size(_entries(v))).cast("double")
    found = (
        F.when(_kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
        .when(_is_text(v), (F.length(F.trim(_text(v))) > 0).cast("double"))
        .when(_is_array(v) | _is_object(v), size / scale)
        .when(number <= 1, number)
        .otherwise(number / scale)
    )
    return clamp(F.coalesce(found, F.lit(0.0)), 0, 1)


def safe_number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def split_fusion(documents: DataFrame) -> dict[str, DataFrame]:
    """Windows, transcript lines, timeline points and stated durations of fusion documents.

    ``documents``: vod_id, doc and, for pages of longer lists, ``first``; a video has one duration, the largest
    stated in its pages.  Windows come from ``windows``, ``segments`` or
    ``clips`` and carry their own title, summary and labels, and speech and chat
    hints (0..1) for videos without transcript or timeline.  Blank lines and lines without length are left out; points without
    a time, or at exactly 0, are too.
    """
    docs = documents.select("vod_id", first_position(documents).alias("first"), strict_json(F.col("doc")).alias("v"))
    v, row = F.col("v"), F.col("r")
    zero = F.lit(0.0)
    listed = F.coalesce(_items(v), _items(_first(v, ("windows", "segments", "clips"))))
    windows = (
        elements(docs, F.filter(listed, _is_object), "window_index", "r")
        .withColumn("start_s", _number(row, _START_FIELDS, F.col("window_index").cast("double")))
        .withColumn("end_s", _number(row, _END_FIELDS, F.col("start_s")))
        .withColumn("title", F.try_variant_get(row, "$.title", "string"))
        .withColumn("summary", F.try_variant_get(row, "$.summary", "string"))
        .withColumn("labels", F.array_sort(F.array_distinct(_labels(_first(row, _OBJECT_FIELDS)))))
        .withColumn("speech_hint", _signal(_first(row, _SPEECH_FIELDS), F.abs(F.col("end_s") - F.col("start_s"))))
        .withColumn("chat_hint", _signal(_first(row, _CHAT_FIELDS), F.lit(CHAT_FULL_SCALE)))
        .drop("r")
    )
    spoken = _field(v, "transcript")
    segments = F.coalesce(_items(spoken), _items(_field(spoken, "segments")))
    lines = (
        elements(docs, F.filter(segments, _is_object), "pos", "r")
        .withColumn("text", _text(_field(row, "text")))
        .withColumn("start_s", _number(row, _START_FIELDS, zero))
        .withColumn("end_s", _number(row, _END_FIELDS, F.col("start_s")))
        .where((F.col("end_s") > F.col("start_s")) & (F.col("text").isNull() | (F.trim("text") != "")))
        .drop("r")
    )
    points = (
        elements(docs, F.filter(_items(_field(v, "timeline")), _is_object), "pos", "r")
        .withColumn("t", safe_number(_first(row, ("timestamp", "time", "ts"))))
        .where(F.col("t") >= 0)
        .withColumn(
            "chat_intensity", F.greatest(zero, F.least(F.lit(1.0), F.coalesce(safe_number(_field(row, "chat_intensity")), zero)))
        )
        .drop("r")
    )
    durations = docs.groupBy("vod_id").agg(
        F.max(F.greatest(
            F.coalesce(safe_number(_first(v, ("duration_seconds",))), zero),
            F.coalesce(safe_number(_field(_field(v, "vod_meta"), "duration_seconds")), zero),
            F.coalesce(safe_number(_field(spoken, "duration_seconds")), zero),
        )).alias("duration_s"),
    )
    return {"windows": windows, "lines": lines, "points": points, "durations": durations}


_META = (
    "struct<title:string,duration:double,uploader:string,resolution:string,fps:double,ext:string,game:string,"
    "game_name:string,category:string,game_id:string,categories:array<string>,_bad:string>"
)


def videos_from_metadata(outputs: DataFrame) -> DataFrame:
    """Video rows from downloader output: the first line that is a JSON object.

    ``outputs``: url, output.  Without such a line only the id and a stock title
    are known.
    """
    objects = F.filter(
        F.transform(
            F.filter(F.transform(F.split("output", "\n"), lambda x: F.trim(x)), lambda x: x.startswith("{")),
            lambda x: F.from_json(x, _META, {"columnNameOfCorruptRecord": "_bad"}),
        ),
        lambda m: m["_bad"].isNull(),
    )
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    m = outputs.withColumn("vod_id", vod_id_of_url(F.col("url"))).withColumn("m", F.get(objects, 0))
    known = F.col("m").isNotNull()
    game = F.coalesce(filled("m.game"), filled("m.game_name"), filled("m.category"))
    none = F.array().cast("array<string>")
    categories = F.array_distinct(
        F.array_compact(F.concat(F.coalesce("m.categories", none), F.array(F.col("_game"), F.col("m.category"))))
    )
    duration = F.coalesce(F.col("m.duration").cast("bigint"), F.lit(0))
    return m.withColumn("_game", game).select(
        "vod_id",
        F.coalesce("m.title", F.concat(F.lit("VOD_"), "vod_id")).alias("title"),
        duration.alias("duration_s"),
        "url",
        F.coalesce("m.uploader", F.lit("unknown")).alias("streamer"),
        F.col("m.resolution").alias("resolution"),
        F.col("m.fps").alias("fps"),
        F.when(known, F.coalesce("m.ext", F.lit("mp4"))).alias("format"),
        F.col("m.game_id").alias("game_id"),
        F.col("_game").alias("game_name"),
        F.coalesce(categories, none).alias("categories"),
    )


def metadata_game_segments(videos: DataFrame) -> DataFrame:
    """One whole-video game segment per video whose game is known."""
    return videos.where(F.col("game_name").isNotNull()).select(
        "vod_id",
        F.lit(0.0).alias("start_s"),
        F.when(F.col("duration_s") > 0, F.col("duration_s").cast("double")).alias("end_s"),
        "game_id",
        "game_name",
        F.lit("yt_dlp").alias("source"),
        F.when(F.coalesce(F.col("game_id"), F.lit("")) != "", 1.0).otherwise(0.7).alias("confidence"),
    )

