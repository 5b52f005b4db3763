"""Chat that keeps arriving: landing messages and counting them per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.chat import chat_from_lines


def chat_stream(spark: SparkSession, path: str) -> DataFrame:
    """Messages of line-delimited chat files as they land in ``path/vod_id=<id>/``."""
    lines = (
        spark.readStream.schema("value string, vod_id string")
        .format("text")
        .load(path)
        .select(
            F.col("vod_id"),
            F.lit(0).cast("bigint").alias("pos"),
            F.col("value").alias("line"),
        )
    )
    return chat_from_lines(lines).drop("pos")


def message_counts(messages: DataFrame, *, window_seconds: int = 30, late_seconds: int = 60) -> DataFrame:
    """Messages per video and tumbling window of media time, as an update stream.

    Media seconds are read as seconds of an epoch, so the watermark drops state
    of windows more than ``late_seconds`` behind the newest message.
    """
    timed = messages.withColumn("at", F.timestamp_seconds(F.col("t")))
    return (
        timed.withWatermark("at", f"{late_seconds} seconds")
        .groupBy("vod_id", F.window("at", f"{window_seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("message_count"))
        .select("vod_id", F.unix_seconds("w.start").alias("window_start"), "message_count")
    )
