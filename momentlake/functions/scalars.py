"""Numeric and boolean column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def round_half_even(c: Column | str, digits: int) -> Column:
    """Rounds half to even after scaling by a power of ten.

    Agrees with Python's ``round`` but for values whose scaled product is only
    a tie because the product itself was rounded (2.675 gives 2.68, not 2.67).
    """
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def clamp(c: Column | str, low: float, high: float) -> Column:
    """The value kept between ``low`` and ``high``; it must not be NULL."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), _col(c)))


def safe_double(c: Column | str, default: float = 0.0) -> Column:
    """The value as a double, or ``default`` where it is missing or malformed."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(float(default)))


def safe_int(c: Column | str, default: Column | int = 0) -> Column:
    """The value truncated towards zero, or ``default``."""
    fallback = F.lit(default).cast("bigint") if isinstance(default, int) else default
    return F.coalesce(_col(c).try_cast("double").try_cast("bigint"), fallback)


def truthy_text(c: Column | str) -> Column:
    """Truth of a loosely typed reply field held as text: any non-empty string is
    true (also ``"false"``), while JSON null, false and zero are not."""
    text = _col(c)
    falsy = text.isNull() | text.isin("", "0", "0.0", "[]", "{}", "null")
    return ~falsy


def clean_text(c: Column | str, default: Column | str) -> Column:
    """Trimmed text, or ``default`` where nothing is left."""
    fallback = F.lit(default) if isinstance(default, str) else default
    trimmed = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    return F.coalesce(F.nullif(trimmed, F.lit("")), fallback)


def clean_list(c: Column | str) -> Column:
    """Trimmed, non-empty items in first-seen order, each once; never NULL."""
    items = F.transform(_col(c), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    kept = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


# Normalising a signal of any kind to 0..1.


def number_signal(c: Column | str, full_scale: float) -> Column:
    """Values up to 1 are clamped, larger ones divided by ``full_scale``."""
    v = F.coalesce(_col(c).cast("double"), F.lit(0.0))
    return clamp(F.when(v <= 1.0, v).otherwise(v / max(full_scale, 1.0)), 0, 1)


def text_signal(c: Column | str) -> Column:
    return F.when(F.coalesce(F.length(F.trim(_col(c))), F.lit(0)) > 0, 1.0).otherwise(0.0)


def flag_signal(c: Column | str) -> Column:
    return F.when(_col(c), 1.0).otherwise(0.0)


def collection_signal(c: Column | str, full_scale: float) -> Column:
    size = F.coalesce(F.size(_col(c)), F.lit(0))
    return clamp(size / max(full_scale, 1.0), 0, 1)


# Clip length rules.


def duration_penalty(trim_start: Column, trim_end: Column) -> Column:
    """Points for long clips: none up to 60 s, then 1, 2 and 3 above 60, 75 and 90 s."""
    length = trim_end - trim_start
    return (
        F.when(length <= 0, 3).when(length <= 60, 0).when(length <= 75, 1).when(length <= 90, 2).otherwise(3)
    )


def banded_duration_penalty(trim_start: Column, trim_end: Column) -> Column:
    """Variant that also marks short clips: 25-60 s is free, each band outside costs more."""
    length = trim_end - trim_start
    return (
        F.when(length.between(25, 60), 0)
        .when(length.between(20, 24) | length.between(61, 75), 1)
        .when(length.between(15, 19) | length.between(76, 90), 2)
        .otherwise(3)
    )


def duration_fit(length: Column) -> Column:
    """Wording of how well a clip length fits; whole-second bands, gaps are poor."""
    # The bands and their wording.
    words = (
        F.when(length.between(25, 60), "optimal (25-60s band)")
        .when(length.between(20, 24) | length.between(61, 75), "acceptable with minor duration penalty")
        .when(length.between(15, 19) | length.between(76, 90), "risky duration band")
        .otherwise("poor duration fit")
    )
    return F.concat(length.cast("string"), F.lit("s "), words)


def drift_offset(transcript_seconds: Column, rate: float = 0.005, shift: int = 8) -> Column:
    """Player position of a transcript position that drifts by ``rate`` and lags ``shift`` seconds."""
    return F.floor(transcript_seconds + transcript_seconds * rate + shift)
