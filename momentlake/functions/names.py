"""Finding people's names in spoken text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = "([A-Za-z][A-Za-z0-9_]{1,31})"

# Phrases that name the speaker, and phrases that address someone.
SELF_PATTERNS = (
    rf"(?iU)\b(?:i am|i'm|my name is)\s+{_NAME}\b",
    rf"(?iU)\bthis is\s+{_NAME}\b",
    rf"(?iU)\b{_NAME}\s+here\b",
)
ADDRESS_PATTERNS = (
    rf"(?iU)\b(?:hey|hi|hello|thanks|thank you)\s+{_NAME}\b",
    rf"(?iU)\b{_NAME}\s*,\s*what do you think\b",
)


def _strip(name: Column) -> Column:
    return F.btrim(F.trim(name), F.lit(".,!?\"'"))


def _all_names(text: Column, patterns: tuple[str, ...]) -> Column:
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns])
    return F.filter(F.transform(found, _strip), lambda n: n != "")


def addressed_names(text: Column) -> Column:
    """Names of people spoken to, each spelling once, in pattern order."""
    return F.array_distinct(_all_names(F.coalesce(text, F.lit("")), ADDRESS_PATTERNS))


def introductions(text: Column) -> Column:
    """Self-introductions as structs (name, phrase, confidence): 0.95 for "i am" and
    its like, else 0.85."""
    text = F.coalesce(text, F.lit(""))

    def one(pattern: str) -> Column:
        pairs = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("name"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("phrase"),
        )
        return F.transform(
            pairs,
            lambda p: F.struct(
                _strip(p["name"]).alias("name"),
                p["phrase"].alias("phrase"),
                F.when(F.lower(p["phrase"]).rlike("i am|i'm|my name is"), 0.95).otherwise(0.85).alias("confidence"),
            ),
        )

    return F.filter(F.concat(*[one(p) for p in SELF_PATTERNS]), lambda x: x["name"] != "")


def name_mentions(text: Column) -> Column:
    """All names mentioned, case-insensitively distinct in first-seen order."""
    found = _all_names(F.coalesce(text, F.lit("")), ADDRESS_PATTERNS + SELF_PATTERNS)
    # Keep an item when no earlier one is equal up to case.
    return F.filter(
        found,
        lambda n, i: F.array_position(F.transform(found, lambda x: F.lower(x)), F.lower(n)) == i + 1,
    )
