"""Text rows for model prompts and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import point_join


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("?"))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def analysis_log(analyses: DataFrame) -> DataFrame:
    """One log line per analysed clip; revised values replace the first ones.

    Columns read: vod_id, pos, start_s, clip_worthiness, emotional_energy,
    visual_interest, primary_expression, their ``revised_`` forms, narrative_type,
    has_payoff, trim_start, trim_end, trim_start_reason, trim_end_reason,
    narrative_arc, clip_point, reason, revised_reason.
    """
    revised = F.col("revised_clip_worthiness").isNotNull()

    def value(name: str, revised_name: str) -> Column:
        return F.when(revised & F.col(revised_name).isNotNull(), F.col(revised_name).cast("string")).otherwise(_shown(name))

    score = F.when(
        revised,
        F.concat(_shown("revised_clip_worthiness"), F.lit("/10 (revised from "), _shown("clip_worthiness"), F.lit(")")),
    ).otherwise(F.concat(_shown("clip_worthiness"), F.lit("/10")))
    reason = F.when(revised & F.col("revised_reason").isNotNull(), _text("revised_reason")).otherwise(_text("reason"))
    line = F.concat(
        F.lit("Clip at "), _shown("start_s"), F.lit("s (clip_id="), _shown("start_s"), F.lit("): score="), score,
        F.lit(", energy="), value("emotional_energy", "revised_emotional_energy"),
        F.lit("/10, interest="), value("visual_interest", "revised_visual_interest"),
        F.lit("/10, expr="), value("primary_expression", "revised_expression"),
        F.lit(", narrative="), _shown("narrative_type"), F.lit(", payoff="), _shown("has_payoff"),
        F.lit(", trim="), _shown("trim_start"), F.lit("-"), _shown("trim_end"),
        F.lit("s, reason="), _text("trim_start_reason"), F.lit("->"), _text("trim_end_reason"),
        F.lit(", arc="), _text("narrative_arc"), F.lit(", point="), _text("clip_point"), F.lit(", reason="), reason,
    )
    return analyses.select("vod_id", "pos", line.alias("entry"))


def triage_prompt_parts(chunks: DataFrame, segments: DataFrame, messages: DataFrame) -> DataFrame:
    """The parts of each chunk's triage prompt as rows (vod_id, chunk_index, section,
    ord_s, pos, body): one ``bounds`` row, then transcript and chat rows as JSON.

    A busy chunk may hold any number of messages, so a prompt is never gathered
    into one value here; a writer sorts the rows of a chunk.
    """
    spans = chunks.select("vod_id", "chunk_index", "chunk_start", "chunk_end")
    bounds = spans.select(
        "vod_id", "chunk_index", F.lit("bounds").alias("section"), F.col("chunk_start").alias("ord_s"),
        F.lit(0).cast("bigint").alias("pos"),
        F.to_json(F.struct("chunk_start", "chunk_end")).alias("body"),
    )

    def inside(rows: DataFrame, at: str, section: str, payload: Column) -> DataFrame:
        return point_join(
            rows, spans, bucket=600, at=at, span=("chunk_start", "chunk_end"), closed=False, spread_by=["pos"]
        ).select("vod_id", "chunk_index", F.lit(section).alias("section"), F.col(at).alias("ord_s"), "pos", F.to_json(payload).alias("body"))

    lines = inside(
        segments.select("vod_id", "pos", "start_s", "end_s", "text"), "start_s", "transcript",
        F.struct(F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text"),
    )
    chat = inside(
        messages.select("vod_id", "pos", "t", "usr", "message"), "t", "chat",
        F.struct(F.col("t").alias("timestamp"), F.col("usr").alias("user"), "message"),
    )
    return reduce(DataFrame.unionAll, [bounds, lines, chat])


def name_prompts(lines: DataFrame, messages: DataFrame) -> DataFrame:
    """Evidence for resolving speaker names as rows (vod_id, section, pos, line): all
    ``transcript`` lines and ``chat`` messages of each video."""
    one = lambda c: F.format_string("%.1f", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    spoken = F.concat(
        F.lit("["), one("start_s"), F.lit("s] "), F.coalesce("speaker_label", F.lit("UNKNOWN")), F.lit(": "), _text("text")
    )
    typed = F.concat(
        F.lit("["), one("t"), F.lit("s] @"), F.coalesce("usr", F.lit("unknown")), F.lit(": "), _text("message")
    )
    rows = lambda df, section, line: df.select("vod_id", F.lit(section).alias("section"), "pos", line.alias("line"))
    return rows(lines, "transcript", spoken).unionAll(rows(messages, "chat", typed))
