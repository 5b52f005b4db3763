"""Identifiers, claims, time formats and other short text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clamp, let

# Words a claim must not hold, and characters stripped from its ends.
SENSITIVE_WORDS = ("medical", "diagnosis", "address", "phone", "ssn", "doxx", "legal name")
_CLAIM_EDGE = "\"'.,;:!?()[]{} "
UNKNOWN_STREAMER = "unknown_streamer"
# Metadata fields that can name the streamer, best first.
STREAMER_FIELDS = (
    "streamer_id", "streamer", "channel", "channel_name", "channel_login", "user_login", "broadcaster_login",
    "display_name", "uploader_id", "uploader", "owner",
)


def normalise_claim(text: Column) -> Column:
    """Lower case, single spaces, no quotes, punctuation or brackets at the ends."""
    squeezed = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " ")
    return F.btrim(F.btrim(squeezed), F.lit(_CLAIM_EDGE))


def is_sensitive(text: Column) -> Column:
    """Whether a claim holds a sensitive word anywhere, also inside other words."""
    return normalise_claim(text).rlike("|".join(SENSITIVE_WORDS))


def sanitise_id(value: Column) -> Column:
    cleaned = F.regexp_replace(F.lower(F.trim(value)), r"[^a-z0-9_-]+", "_")
    cleaned = F.btrim(F.regexp_replace(cleaned, r"_+", "_"), F.lit("_"))
    return let(cleaned, lambda c: F.when(c != "", c).otherwise(UNKNOWN_STREAMER))


def streamer_identity(fields: dict[str, Column], override: Column) -> Column:
    """Struct with the resolved streamer id, its source and a mismatch warning.

    ``fields`` maps metadata field names to columns; the first non-blank one in
    the fixed order counts, and a non-blank override wins over it.
    """
    stated = [F.when(F.trim(fields[f]) != "", fields[f]) for f in STREAMER_FIELDS if f in fields]
    none = F.lit(None).cast("string")
    meta = F.coalesce(sanitise_id(F.coalesce(*stated, none)), F.lit(UNKNOWN_STREAMER))
    forced = F.when(F.trim(override) != "", sanitise_id(override))
    known = meta != UNKNOWN_STREAMER
    mismatch = F.coalesce(known & (forced != meta), F.lit(False))
    return F.struct(
        F.coalesce(forced, meta).alias("streamer_id"),
        meta.alias("metadata_streamer_id"),
        forced.alias("override_streamer_id"),
        F.when(forced.isNotNull(), "override").when(known, "metadata").otherwise("fallback").alias("source"),
        mismatch.alias("override_mismatch"),
        F.when(
            mismatch,
            F.concat(
                F.lit("streamer_id override mismatch: override='"), forced, F.lit("' metadata='"), meta, F.lit("'")
            ),
        ).alias("warning"),
    )


def slug(name: Column) -> Column:
    s = F.btrim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), F.lit("-"))
    return let(s, lambda c: F.when(c != "", c).otherwise("game"))


def plain_name(name: Column) -> Column:
    """Name in lower case with underscores as spaces and single spaces."""
    return F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("_"), F.lit(" ")), r"(?U)\s+", " "))


def hms(seconds: Column) -> Column:
    """``H:MM:SS``, with a sign for negative times."""
    s = F.abs(seconds.cast("bigint"))
    text = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return F.when(seconds < 0, F.concat(F.lit("-"), text)).otherwise(text)


def link_time(seconds: Column) -> Column:
    """``1h44m31s`` without zero parts; ``0s`` at the start."""
    s = F.abs(seconds.cast("bigint"))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("string"), F.lit(unit))).otherwise("")
    return F.when(s == 0, "0s").otherwise(F.concat(part(h, "h"), part(m, "m"), part(r, "s")))


def video_link(base: Column | str, vod_id: Column, seconds: Column) -> Column:
    """Deep link ``<base>/<vod>?t=<time>``; the base address comes from the caller."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), vod_id.cast("string"), F.lit("?t="), link_time(seconds))


def vod_id_of_url(url: Column) -> Column:
    """Last path part of an address."""
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def vod_id_of_artifact(stated: Column, path: Column) -> Column:
    """The stated id, else the ``phase4_<id>`` folder of the path, else its first run of 8 or more digits."""
    own = F.when(F.trim(stated) != "", F.trim(stated))
    folder = F.regexp_extract(path, r"(?:^|/)phase4_([^/]+)/[^/]*$", 1)
    digits = F.regexp_extract(path, r"(\d{8,})", 1)
    return F.coalesce(own, F.when(folder != "", folder), F.when(digits != "", digits))


def clip_file_name(rank: Column, title: Column, start: Column, max_title: int | None = None) -> Column:
    """``clip_rank<r>_<title>_<start>s.mp4`` with the safe characters of the title, at most ``max_title`` of them."""
    safe = F.replace(F.trim(F.regexp_replace(title, r"(?U)[^\w\s-]", "")), F.lit(" "), F.lit("_"))
    return F.concat(
        F.lit("clip_rank"), rank.cast("string"), F.lit("_"), safe if max_title is None else safe.substr(1, max_title), F.lit("_"),
        start.cast("bigint").cast("string"), F.lit("s.mp4"),
    )


def enrolment_ranges(spec: Column) -> Column:
    """``"30-90,300-360"`` as structs (start, end, error), one per non-empty part."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")

    def one(p: Column) -> Column:
        start = F.regexp_extract(p, r"^([^-]*)-", 1).try_cast("double")
        end = F.regexp_extract(p, r"^[^-]*-(.*)$", 1).try_cast("double")
        error = (
            F.when(~p.contains("-"), "no range")
            .when(start.isNull() | end.isNull(), "not a number")
            .when(end <= start, "end<=start")
        )
        return F.struct(start.alias("start"), end.alias("end"), error.alias("error"))

    return F.transform(parts, one)


def clip_text(value: Column, max_len: int | None = None) -> Column:
    """Single-spaced text; with ``max_len`` cut with an ellipsis."""
    single = F.trim(F.regexp_replace(value, r"(?U)\s+", " "))
    if max_len is None:
        return single
    return let(
        single,
        lambda t: F.when(F.length(t) <= max_len, t).otherwise(F.concat(F.rtrim(t.substr(1, max_len - 1)), F.lit("…"))),
    )


def distinct_ignoring_case(items: Column) -> Column:
    """Non-blank items, case-insensitively distinct, first spelling and order kept."""
    keyed = F.transform(items, lambda x: F.struct(x.alias("x"), F.lower(F.trim(x)).alias("k")))
    return let(
        F.filter(keyed, lambda p: p["k"] != ""),
        lambda ps: F.transform(
            F.filter(ps, lambda p, i: F.array_position(F.transform(ps, lambda q: q["k"]), p["k"]) == i + 1),
            lambda p: p["x"],
        ),
    )


def audio_flags(analysis: Column, stated_confidence: Column) -> Column:
    """Flags and confidence read from a free-form audio description.

    The confidence is the stated one, else the first number after the last
    "confidence", else 0.5.
    """
    text = F.coalesce(analysis, F.lit(""))
    low = F.lower(text)
    # The words of each flag below.
    any_of = lambda words: low.rlike("|".join(words))
    lines = F.filter(F.split(text, r"\r\n|\r|\n"), lambda x: F.trim(F.replace(x, F.lit("\t"), F.lit(" "))) != "")
    tail = F.element_at(F.split(low, "confidence"), -1)
    number = F.when(low.contains("confidence"), F.regexp_extract(tail, r"(\d+(?:\.\d+)?)", 1).try_cast("double"))
    return F.struct(
        text.alias("summary"),
        F.transform(lines, lambda x: F.btrim(x, F.lit("- •\t "))).alias("key_events"),
        any_of(("dead air", "long silence", "extended silence", "silence gap")).alias("dead_air_detected"),
        any_of(("laugh", "giggle", "cackle")).alias("laughter_detected"),
        any_of(("shout", "yell", "raised voice", "screams")).alias("raised_voice_detected"),
        (low.contains("music") & low.contains("speech") & any_of(("no speech", "mostly music"))).alias("music_only"),
        clamp(F.coalesce(stated_confidence, number, F.lit(0.5)), 0, 1).alias("confidence"),
    )
