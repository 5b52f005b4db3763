"""Games: category segments, which game is on, and game knowledge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import distinct_ignoring_case, plain_name, slug
from ..runtime import salted_lookup
from .intervals import point_join, running_max_before

_SEGMENT = "struct<start_s:double,end_s:double,game_id:string,game_name:string,source:string,confidence:double>"


def category_segments(videos: DataFrame, overrides: DataFrame) -> DataFrame:
    """Game segments per video, by precedence: override segments, override name,
    metadata segments (an end at or before the start becomes open), game name.

    ``videos``: vod_id, duration_s, game_name, game_id, segments.
    ``overrides``: vod_id, o_game_name, o_game_id, o_segments.
    """
    whole = lambda name, game_id, source: F.array(
        F.struct(
            F.lit(0.0).alias("start_s"), F.col("duration_s").cast("double").alias("end_s"), game_id.alias("game_id"),
            name.alias("game_name"), F.lit(source).alias("source"), F.lit(1.0).alias("confidence"),
        ).cast(_SEGMENT)
    )
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    closed = F.transform(
        "segments",
        lambda s: F.struct(
            s["start_s"].alias("start_s"),
            F.when((s["end_s"] <= s["start_s"]), None).otherwise(s["end_s"]).alias("end_s"),
            s["game_id"].alias("game_id"), s["game_name"].alias("game_name"), s["source"].alias("source"),
            s["confidence"].alias("confidence"),
        ),
    )
    by_start = F.transform(
        F.array_sort(F.transform(closed, lambda s, i: F.struct(s["start_s"].alias("a"), i.alias("i"), s.alias("s")))),
        lambda x: x["s"],
    )
    chosen = (
        F.when(F.size("o_segments") > 0, F.col("o_segments"))
        .when(
            filled("o_game_name").isNotNull() | filled("o_game_id").isNotNull(),
            whole(F.coalesce(filled("o_game_name"), filled("game_name"), F.lit("unknown")), F.col("o_game_id"), "manual"),
        )
        .when(F.size("segments") > 0, by_start)
        .when(filled("game_name").isNotNull(), whole(F.col("game_name"), F.col("game_id"), "vod_meta"))
    )
    return (
        videos.join(overrides, "vod_id", "left")
        .select("vod_id", F.posexplode(chosen).alias("pos", "s"))
        .select("vod_id", "pos", "s.*")
    )


def game_at(points: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds the game segment on at time ``t``: of those that contain it, the
    earliest start, then the first row.  Segments without an end stay open.

    Resolved once per distinct time; open segments end with the last point of
    the video.  A segment is on from its start, or from the latest end of the
    segments before it where that is later, so the spans in which each is on do
    not overlap and a time meets at most one of them.
    """
    times = points.select("vod_id", "t").distinct()
    last = times.groupBy("vod_id").agg(F.max("t").alias("_last"))
    spans = (
        segments.join(last, "vod_id")
        .withColumn("_hi", F.coalesce(F.col("end_s").cast("double"), F.greatest(F.col("start_s"), F.col("_last")) + 1.0))
        .withColumn("_hi", F.least("_hi", F.col("_last") + 1.0))
        .where((F.col("start_s") <= F.col("_last")) & (F.col("start_s") < F.col("_hi")))
        .select("vod_id", F.col("start_s").alias("_lo"), "pos", "_hi", "game_id", "game_name")
    )
    shown = (
        running_max_before(spans, order=["_lo", "pos"], value="_hi", out="_until")
        .withColumn("_from", F.greatest(F.col("_lo").cast("double"), "_until"))
        .where(F.col("_from") < F.col("_hi"))
        .select("vod_id", "_from", "_hi", "game_id", "game_name")
    )
    found = point_join(times, shown, bucket=3600, at="t", span=("_from", "_hi"), closed=False).select(
        "vod_id", "t", "game_id", "game_name"
    )
    return salted_lookup(points, found, ["vod_id", "t"], spread_by=["pos"])


def pick_search_hit(hits: DataFrame) -> DataFrame:
    """Per wanted name the hit with the same plain name, else the first one.

    ``hits``: wanted, pos, name, ...
    """
    same = plain_name(F.col("name")) == plain_name(F.col("wanted"))
    fields = [c for c in hits.columns if c != "wanted"]
    return (
        hits.groupBy("wanted")
        .agg(F.min_by(F.struct(*fields), F.struct((~same).alias("other"), "pos")).alias("h"))
        .select("wanted", "h.*")
    )


def _objective(text: Column, limit: int | None = None) -> Column:
    """The text without closing punctuation; with ``limit`` cut at a word."""
    if limit is None:
        return F.rtrim(text, F.lit(".,;: "))
    cut = F.regexp_replace(text.substr(1, limit), r"(?s) [^ ]*$", "")
    return F.rtrim(F.when(F.length(text) > limit, cut).otherwise(text), F.lit(".,;: "))


def game_profiles(catalogue: DataFrame, articles: DataFrame) -> DataFrame:
    """Game profiles from a game catalogue and encyclopedia articles.

    ``catalogue``: game_name, game_id, summary, storyline, genres, keywords,
    themes, modes, franchises (arrays), updated_at.  ``articles``: game_name,
    title, extract, url.  A game known to only one source is kept.
    """
    none = F.array().cast("array<string>")
    items = lambda c: F.coalesce(F.col(c), none)
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    both = catalogue.withColumn("_c", F.lit(True)).join(articles.withColumn("_a", F.lit(True)), "game_name", "full")
    # The lists are cleaned one by one before they are merged.
    terms = F.concat(*[distinct_ignoring_case(items(c)) for c in ("keywords", "themes", "modes", "franchises")])
    made = (
        both.withColumn("summary", F.coalesce(filled("summary"), filled("storyline"), filled("extract"), F.lit("")))
        .withColumn("genres", distinct_ignoring_case(items("genres")))
        .withColumn("common_terms", distinct_ignoring_case(terms))
    )
    hints = distinct_ignoring_case(
        F.concat(
            F.transform(
                "genres",
                lambda g: F.concat(F.lit("Look for moments related to "), F.lower(g), F.lit(" gameplay.")),
            ),
            F.transform(
                "common_terms", lambda t: F.concat(F.lit("Watch for references to "), F.lower(t), F.lit("."))
            ),
        )
    )
    return made.withColumn("_hints", hints).select(
        "game_name",
        F.col("game_id").cast("string").alias("game_id"),
        slug(F.col("game_name")).alias("slug"),
        "summary",
        "genres",
        "common_terms",
        _objective(F.trim("summary")).alias("core_objective"),
        F.when(F.size("_hints") > 0, F.col("_hints"))
        .otherwise(F.array(F.lit("Use only directly observed on-screen evidence.")))
        .alias("clip_eval_hints"),
        F.col("updated_at").alias("source_updated_at"),
        F.array_compact(F.array(F.when(F.col("_c"), "igdb"), F.when(F.col("_a"), "wikipedia"))).alias("sources"),
    )


def is_fresh(stored_updated: Column, upstream_updated: Column, refreshed_at: Column, now: Column, days: int = 30) -> Column:
    """Whether a stored profile needs no refresh: its source is not older than
    upstream, or, if either time is unknown, it was refreshed at most ``days``
    whole days ago.  ``refreshed_at`` is ISO text; unreadable text is stale."""
    at = F.try_to_timestamp(refreshed_at)
    age = F.floor((F.unix_seconds(now) - F.unix_seconds(at)) / 86400)
    return F.coalesce(upstream_updated <= stored_updated, age <= days, F.lit(False))


def cache_status(
    cached: Column, fresh: Column, probed: Column, any_source: Column, force_refresh: bool = False
) -> Column:
    """What became of a lookup: a cache hit, a refresh or a fallback.

    ``probed`` says whether upstream could be asked, ``any_source`` whether a
    source answered.
    """
    usable = cached & F.lit(not force_refresh)
    return (
        F.when(usable & probed & fresh, "cache_hit_fresh")
        .when(usable & ~probed, "cache_hit_no_freshness_probe")
        .when(any_source, "refreshed")
        .when(cached, "stale_fallback")
        .otherwise("minimal_profile")
    )


def clip_game_context(points: DataFrame, segments: DataFrame, profiles: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Per point a text on the game that is on; with ``max_chars`` cut with dots."""
    on = game_at(points, segments)
    known = profiles.select("game_name", F.col("summary").alias("_summary"), F.lit(True).alias("_known"))
    joined = salted_lookup(on, known, ["game_name"], spread_by=["pos"])
    filled = lambda c, before: F.when(F.col(c) != "", F.concat(F.lit(before), F.col(c)))
    text = F.concat_ws(
        "\n",
        F.lit("Game background"),
        filled("game_name", "Active game: "),
        filled("game_id", "Game ID: "),
        F.when(F.col("_known"), F.concat(F.lit("Profile: "), "game_name")).otherwise("No profile."),
        filled("_summary", ""),
    )
    out = joined.select("vod_id", "pos", "t", "game_name", text.alias("game_context"))
    if max_chars is None:
        return out
    dotted = F.concat(F.col("game_context").substr(1, max(0, max_chars - 3)), F.lit("..."))
    return out.withColumn("game_context", F.when(F.length("game_context") <= max_chars, F.col("game_context")).otherwise(dotted))


def run_game_lines(segments: DataFrame, statuses: DataFrame) -> DataFrame:
    """One line per game segment with its span, source and cache status.

    Lines stay rows in order of ``pos``; ``statuses``: game_name, cache_status.
    """
    number = lambda c: F.format_string("%.1f", c)
    end = F.when(F.col("end_s").isNull(), "end").otherwise(F.concat(number(F.col("end_s").cast("double")), F.lit("s")))
    line = F.concat(
        F.lit("- "), F.coalesce("game_name", F.lit("unknown")), F.lit(" ("), number(F.col("start_s").cast("double")),
        F.lit("s-"), end, F.lit(", source="), F.coalesce("source", F.lit("unknown")), F.lit(", cache_status="),
        F.coalesce("cache_status", F.lit("unknown")), F.lit(")"),
    )
    return segments.join(statuses, "game_name", "left").select("vod_id", "pos", line.alias("line"))


def run_game_warnings(segments: DataFrame, statuses: DataFrame) -> DataFrame:
    """What the lookups of a run's games warned of, one row per video, game and
    warning.  ``statuses``: game_name, warnings (array of text)."""
    games = segments.select("vod_id", "game_name").distinct()
    warned = statuses.select("game_name", F.posexplode("warnings").alias("i", "warning"))
    return games.join(warned.where(F.trim("warning") != ""), "game_name").select("vod_id", "game_name", "i", "warning")
