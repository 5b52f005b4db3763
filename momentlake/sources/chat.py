"""Chat sources: line-delimited exports, comment pages and legacy messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = (
    "struct<timestamp_in_seconds:double,commenter:struct<display_name:string>,"
    "message:struct<body:string,emotes:map<string,string>>,badges:array<struct<id:string>>,_bad:string>"
)
_FRAGMENTS = "array<struct<text:string,emoticon:string>>"
_COMMENT = (
    "struct<content_offset_seconds:double,commenter:struct<display_name:string>,"
    f"message:struct<body:struct<fragments:{_FRAGMENTS}>>>"
)
_LEGACY = (
    "struct<content_offset_seconds:double,"
    "message:struct<fragments:array<struct<emote:struct<id:string>>>>>"
)
_PLAIN = "struct<timestamp:double,user:string,username:string,message:string>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as rows (path, doc)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with the place they come from: (path, pos, line).

    ``pos`` grows within a file: files are split at byte offsets, and lines keep
    their order inside a split.
    """
    lines = spark.read.text(path)
    offset = F.col("_metadata.file_block_start")
    # The low bits count the lines of a split, the offset orders the splits.
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        (offset * F.lit(1 << 20) + inside).alias("pos"),
        F.col("value").alias("line"),
    )


def chat_from_lines(lines: DataFrame) -> DataFrame:
    """Messages from one JSON object per line (vod_id, pos, line); unreadable lines are skipped."""
    parsed = F.from_json("line", _LINE, {"columnNameOfCorruptRecord": "_bad"})
    badge = F.get("m.badges", 0)["id"]
    return (
        lines.withColumn("m", parsed)
        .where((F.trim("line") != "") & F.col("m").isNotNull() & F.col("m._bad").isNull())
        .select(
            "vod_id",
            "pos",
            F.coalesce("m.timestamp_in_seconds", F.lit(0.0)).alias("t"),
            F.coalesce("m.commenter.display_name", F.lit("unknown")).alias("usr"),
            F.coalesce("m.message.body", F.lit("")).alias("message"),
            F.coalesce(F.map_keys("m.message.emotes"), F.array().cast("array<string>")).alias("emotes"),
            F.coalesce(badge == "subscriber", F.lit(False)).alias("is_subscriber"),
            F.coalesce(badge == "moderator", F.lit(False)).alias("is_moderator"),
        )
    )


def first_position(documents: DataFrame) -> Column:
    """Where the positions of a document's elements start: at 0, or at ``first`` for pages of a longer list."""
    return F.coalesce("first", F.lit(0)).cast("bigint") if "first" in documents.columns else F.lit(0).cast("bigint")


def elements(documents: DataFrame, items: Column, *columns: str) -> DataFrame:
    """One row per element of a list: vod_id, its position and value (named by ``columns``)."""
    listed = documents.select("vod_id", first_position(documents).alias("_first"), F.posexplode(items).alias("_i", columns[1]))
    return listed.select("vod_id", (F.col("_first") + F.col("_i")).alias(columns[0]), columns[1])


def chat_from_comment_pages(pages: DataFrame) -> DataFrame:
    """Messages from pages of comments with text fragments (vod_id, doc and, for pages after the first one, ``first``).

    Texts of a comment are joined; fragments with an emoticon are its emotes,
    NULL if there are none.
    """
    comments = F.from_json("doc", f"struct<comments:array<{_COMMENT}>>")["comments"]
    pieces = F.coalesce(F.col("c.message.body.fragments"), F.array().cast(_FRAGMENTS))
    text = lambda f: F.coalesce(f["text"], F.lit(""))
    emotes = F.transform(F.filter(pieces, lambda f: F.coalesce(f["emoticon"], F.lit("")) != ""), text)
    return elements(pages, comments, "pos", "c").select(
        "vod_id",
        "pos",
        F.coalesce("c.content_offset_seconds", F.lit(0.0)).alias("t"),
        F.coalesce("c.commenter.display_name", F.lit("unknown")).alias("usr"),
        F.array_join(F.transform(pieces, text), "").alias("message"),
        F.when(F.size(emotes) > 0, emotes).alias("emotes"),
    )


def chat_from_legacy(documents: DataFrame) -> DataFrame:
    """Messages of the older export (vod_id, doc, ``first`` of a page): time and emote ids of the fragments."""
    messages = F.from_json("doc", f"array<{_LEGACY}>")
    ids = F.transform("m.message.fragments", lambda f: f["emote"]["id"])
    return elements(documents, messages, "pos", "m").select(
        "vod_id",
        "pos",
        F.col("m.content_offset_seconds").alias("t"),
        F.coalesce(F.filter(ids, lambda i: i.isNotNull()), F.array().cast("array<string>")).alias("emotes"),
    )


def is_list(doc: Column) -> Column:
    return F.ltrim(doc).startswith("[")


def chat_from_envelope(documents: DataFrame) -> DataFrame:
    """Messages of a bare list, ``{messages}`` or ``{chat: {messages}}``; none for other documents.
    ``documents``: vod_id, doc and, for pages, ``first``."""
    items = f"array<{_PLAIN}>"
    wrapped = F.from_json("doc", f"struct<messages:{items},chat:struct<messages:{items}>>")
    messages = F.when(is_list(F.col("doc")), F.from_json("doc", items)).otherwise(
        F.coalesce(wrapped["messages"], wrapped["chat"]["messages"])
    )
    return (
        elements(documents, messages, "pos", "m")
        .where("m is not null")
        .select(
            "vod_id", "pos", F.coalesce("m.timestamp", F.lit(0.0)).alias("t"),
            F.coalesce(F.when(F.col("m.user") != "", F.col("m.user")), F.col("m.username")).alias("usr"),
            F.col("m.message").alias("message"),
        )
    )
