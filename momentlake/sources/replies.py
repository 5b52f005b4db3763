"""Landed model replies: JSON with decoration, and sectioned text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import let
from .documents import strict_json


def strip_fences(raw: Column) -> Column:
    """Reply text without surrounding code fences."""
    text = F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")
    opened = F.regexp_replace(text, r"^```[^\n]*(\n|$)", "")
    closed = F.regexp_replace(opened, r"(^|\n)[^\S\n]*```[^\n]*$", "")
    return F.when(text.startswith("```"), closed).otherwise(text)


def parse_reply(raw: Column) -> Column:
    """The reply as a VARIANT value, NULL if it is not JSON.

    A doubled opening brace (a copied template) is read with one brace, with or
    without the last character.
    """

    def parse(text: Column) -> Column:
        inner = text.substr(F.lit(2), F.length(text))
        single = F.coalesce(
            strict_json(inner), strict_json(inner.substr(F.lit(1), F.length(inner) - 1))
        )
        doubled = F.when(text.startswith("{{"), single)
        return F.coalesce(doubled, strict_json(text))

    return let(strip_fences(raw), parse)


# Vocabularies of the sectioned replies.
_SPEAKERS = ("streamer", "non_streamer", "mixed", "unknown")
_AFFECTS = ("amused", "surprised", "confused", "flat", "performative", "focused")
_RISKS = ("possible_alert_reaction", "game_audio_dominant", "visual_context_required", "speaker_uncertain")


def _section(text: Column, name: str, following: tuple[str, ...]) -> Column:
    """Trimmed body of a section, NULL if it is not there; it ends before one of
    ``following`` or at the end of the reply."""
    ends = "|".join([rf"\n\n{f}:" for f in following] + ["$"])
    pattern = rf"(?s){name}:\s*(.*?)(?={ends})"
    body = F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)^\s+|\s+$", "")
    return F.when(text.contains(f"{name}:"), body)


def _event_lines(body: Column) -> Column:
    lines = F.transform(F.split(body, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    kept = F.filter(lines, lambda x: (x != "") & ~x.startswith("Example") & ~x.startswith("None"))
    seconds = lambda x: F.coalesce(
        F.regexp_extract(x, r"(\d+[\.\d]*)s", 1).try_cast("double"), F.lit(0.0)
    )
    rows = F.transform(kept, lambda x: F.struct(seconds(x).alias("timestamp"), x.alias("raw")))
    return F.coalesce(rows, F.array().cast("array<struct<timestamp:double,raw:string>>"))


def _number_after(body: Column, words: str) -> Column:
    return F.coalesce(F.regexp_extract(body, rf"(?i){words}.*?(\d+(?:\.\d+)?)", 1).try_cast("double"), F.lit(0.0))


def _has(body: Column, words: str) -> Column:
    return F.coalesce(body.rlike(f"(?i){words}"), F.lit(False))


def parse_sections(replies: DataFrame, text: str = "reply") -> DataFrame:
    """Splits sectioned replies into events, likelihoods, affect and risk flags.

    Event rows keep their line as ``raw`` only; they carry no type.  The last
    speaker word found wins, and "streamer" is also found inside "non_streamer".
    """
    t = F.coalesce(F.col(text), F.lit(""))
    r = (
        replies.withColumn("_a", _section(t, "AUDIO_EVENTS", ("VISUAL_EVENTS", "SPEAKER")))
        .withColumn("_v", _section(t, "VISUAL_EVENTS", ("SPEAKER", "EMOTION")))
        .withColumn("_s", _section(t, "SPEAKER", ("EMOTION", "RISK_FLAGS")))
        .withColumn("_e", _section(t, "EMOTION", ("RISK_FLAGS",)))
        .withColumn("_k", _section(t, "RISK_FLAGS", ()))
    )
    s, e, k = F.col("_s"), F.col("_e"), F.col("_k")
    speaker = F.coalesce(*[F.when(_has(s, w), w) for w in reversed(_SPEAKERS)], F.lit("unknown"))
    affect = F.coalesce(*[F.when(_has(e, w), w) for w in _AFFECTS], F.lit("unknown"))
    paid = _number_after(s, "transactional")
    flags = F.array_compact(F.array(*[F.when(_has(k, f.replace("_", " ")), f) for f in _RISKS]))
    return r.select(
        *replies.columns,
        _event_lines(F.col("_a")).alias("audio_events"),
        _event_lines(F.col("_v")).alias("visual_events"),
        speaker.alias("primary_speaker"),
        _number_after(s, "streamer.*?led").alias("streamer_led_likelihood"),
        _has(s, "non_streamer|chat_tts|game_character").alias("non_streamer_voice_present"),
        affect.alias("streamer_affect"),
        F.when(_has(e, "organic|genuine|natural"), 0.3).otherwise(0.0).alias("organic_reaction_likelihood"),
        F.when(_has(e, "alert|donation|tts|transactional"), F.greatest(paid, F.lit(0.3)))
        .otherwise(paid)
        .alias("transactional_alert_likelihood"),
        F.coalesce(e, F.lit("")).alias("emotion_evidence"),
        flags.alias("risk_flags"),
    )
