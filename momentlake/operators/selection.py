"""Final selection: near-duplicate titles, ranking, explanations, reconciling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import titles as T
from ..functions.scalars import duration_fit, round_half_even
from ..runtime import checkpointed, salted_lookup
from .scoring import MIN_FINAL_SCORE
from .title_index import TitleIndex

MAX_CLIPS = 20
BATCH = 64

FEEDBACK = "Reach the payoff early, and leave the reaction in the cut."


def distinct_titles(
    clips: DataFrame, *, order: list[Column], title: str = "title", max_clips: int = MAX_CLIPS, batch: int = BATCH
) -> DataFrame:
    """Per video the first ``max_clips`` clips in ``order`` whose title resembles no
    clip kept before.  ``clips``: vod_id, clip_id and a title of any length.

    Equals a scan of each video in order.  Texts are written once; rounds hold
    ids.  A round takes the best ``batch`` open clips of every video, scans
    those as one small array against the at most ``max_clips`` kept ones, and
    then drops the open clips that resemble a newly kept one, which an index of
    the open titles finds.  Videos that a round completes are never indexed.  Clips are
    compared with kept clips only, never with each other.
    """
    norm = T.normalise_title(F.col(title))
    keyed = clips.select(
        "vod_id", "clip_id", F.struct(*order, F.col("clip_id")).alias("_ord"), norm.alias("norm"),
        T.title_tokens(F.col(title)).alias("tok"),
    )
    # Clips with equal normal forms are alike to the same clips: only the first can be kept.
    first = F.min_by(F.struct("clip_id", "norm", "tok", "_ord"), "_ord").alias("c")
    group = F.when(F.col("norm") == "", F.concat(F.lit("#"), F.col("clip_id").cast("string"))).otherwise(
        F.sha2("norm", 256)
    )
    texts = checkpointed(keyed.groupBy("vod_id", group.alias("_g")).agg(first).select("vod_id", "c.*"))
    open_clips = texts.select("vod_id", "clip_id", "_ord")
    kept_type = "array<" + keyed.select(F.struct("clip_id", "norm", "tok", "_ord").alias("s")).schema["s"].dataType.simpleString() + ">"
    kept: DataFrame | None = None
    index: TitleIndex | None = None

    def alike(k: Column, c: Column) -> Column:
        return T.similar_titles(k["norm"], k["tok"], c["norm"], c["tok"])

    def scan(acc: Column, c: Column) -> Column:
        fits = (F.size(acc) < max_clips) & ~F.exists(acc, lambda k: alike(k, c))
        return F.when(fits, F.concat(acc, F.array(c))).otherwise(acc)

    while True:
        ranked = open_clips.withColumn(
            "_r", F.row_number().over(Window.partitionBy("vod_id").orderBy("_ord"))
        ).where(F.col("_r") <= batch)
        head = ranked.join(texts.drop("_ord"), ["vod_id", "clip_id"]).groupBy("vod_id").agg(
            F.array_sort(
                F.collect_list(F.struct("_r", F.struct("clip_id", "norm", "tok", "_ord").alias("c")))
            ).alias("_head"),
            F.max("_ord").alias("_last"),
        )
        none = F.array().cast(kept_type)
        if kept is None:
            state = head.withColumn("kept", none)
        else:
            state = kept.join(head, "vod_id", "left").withColumn("kept", F.coalesce("kept", none))
        scanned = F.aggregate(F.transform("_head", lambda x: x["c"]), F.col("kept"), scan)
        kept = checkpointed(
            state.select(
                "vod_id",
                F.when(F.col("_head").isNull(), F.col("kept")).otherwise(scanned).alias("kept"),
                "_last", F.size("kept").alias("_before"),
            )
        )
        unfinished = kept.where((F.size("kept") < max_clips) & F.col("_last").isNotNull())
        ahead = unfinished.select("vod_id", "_last")
        rest = salted_lookup(open_clips, ahead, ["vod_id"], spread_by=["clip_id"], how="inner")
        rest = checkpointed(rest.where(F.col("_ord") > F.col("_last")).drop("_last"))
        if rest.isEmpty():
            break
        if index is None:
            index = TitleIndex(checkpointed(texts.join(rest.select("vod_id", "clip_id"), ["vod_id", "clip_id"], "left_semi").drop("_ord")))
        new = unfinished.select(
            "vod_id", F.explode(F.slice("kept", F.col("_before") + 1, F.size("kept") - F.col("_before"))).alias("k")
        ).select("vod_id", "k.clip_id", "k.norm", "k.tok")
        open_clips = checkpointed(rest.join(index.resembling(checkpointed(new)), ["vod_id", "clip_id"], "left_anti"))
        kept = kept.drop("_last", "_before")
        if open_clips.isEmpty():
            break
    return kept.select("vod_id", F.posexplode("kept").alias("_i", "k")).select(
        "vod_id", F.col("k.clip_id").alias("clip_id"), (F.col("_i") + 1).alias("rank")
    )


def eligible_clips(scored: DataFrame, *, min_score: float = MIN_FINAL_SCORE, fallback_top_n: int = 0) -> DataFrame:
    """Eligible clips at or above ``min_score``; for videos without any, the
    ``fallback_top_n`` best ones."""
    passing = F.col("eligible") & (F.col("final_score") >= min_score)
    if fallback_top_n <= 0:
        return scored.where(passing).withColumn("is_fallback", F.lit(False))
    videos = scored.groupBy("vod_id").agg((~F.max(passing)).alias("is_fallback"))
    tagged = salted_lookup(scored, videos, ["vod_id"], spread_by=["clip_id"])
    order = Window.partitionBy("vod_id").orderBy(F.desc("final_score"), "pos")
    spare = (
        tagged.where("is_fallback").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= fallback_top_n)
    )
    return tagged.where(~F.col("is_fallback") & passing).unionByName(spare.drop("_r"))


def final_clips(
    scored: DataFrame,
    *,
    min_score: float = MIN_FINAL_SCORE,
    max_clips: int = MAX_CLIPS,
    fallback_top_n: int = 0,
) -> DataFrame:
    """The clips to publish, ranked and explained, at most ``max_clips`` per video.

    ``scored`` holds one row per arc with its score, analysis and context:
    vod_id, clip_id, pos, start_s, end_s, final_score, raw_score, eligible,
    final_trim_start, final_trim_end, trim_source, clip_point, narrative_type,
    trigger, payoff, confidence, requires_context, platform_recommendations,
    trim_start_reason, trim_end_reason, primary_speaker_identity,
    evidence_lines; optional platform_scores and the voice columns of a clip's
    context.  Clips whose trim leaves their bounds are dropped before
    titles are compared.
    """
    # Scored clips are a stage result that is read several times.
    return final_of_written(
        checkpointed(scored), min_score=min_score, max_clips=max_clips, fallback_top_n=fallback_top_n
    )


def final_of_written(scored: DataFrame, *, min_score: float, max_clips: int, fallback_top_n: int) -> DataFrame:
    """:func:`final_clips` for scored clips that the caller has checkpointed, so they are not written twice."""
    ts, te = F.col("final_trim_start"), F.col("final_trim_end")
    sound = (te > ts) & (ts >= F.col("start_s")) & (te <= F.col("end_s"))
    title = T.guard_title(
        T.generate_title(F.col("clip_point"), F.col("narrative_type"), F.col("trigger"), F.col("payoff")),
        F.col("primary_speaker_identity"), F.col("trigger"), F.col("payoff"),
    )
    ready = (
        eligible_clips(scored, min_score=min_score, fallback_top_n=fallback_top_n)
        .where(sound)
        .withColumn("title", title)
    )
    order = [(-F.col("final_score")).alias("s"), F.col("pos").alias("p")]
    chosen = distinct_titles(ready, order=order, max_clips=max_clips)
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    reason = lambda c: F.when(blank(c) != "", blank(c)).otherwise("model boundary")
    platforms = F.coalesce("platform_recommendations", F.array().cast("array<string>"))
    risks = F.array_compact(
        F.array(
            F.when(F.coalesce("requires_context", F.lit(False)), "context_required"),
            F.when(F.coalesce("confidence", F.lit(0.0)) < 0.7, "low_discovery_confidence"),
            F.when(F.size(platforms) == 0, "no_platform_recommendation"),
        )
    )
    given = lambda c, kind, other: F.coalesce(F.col(c) if c in scored.columns else F.lit(None).cast(kind), other)
    evidence = F.when(F.size("evidence_lines") > 0, F.col("evidence_lines")).otherwise(
        F.array(F.lit("No evidence provided"))
    )
    return ready.join(chosen, ["vod_id", "clip_id"]).select(
        "vod_id",
        "rank",
        "clip_id",
        "start_s",
        "end_s",
        ts.alias("trim_start"),
        te.alias("trim_end"),
        "trim_source",
        F.col("final_score").alias("score"),
        "raw_score",
        F.col("final_score").alias("normalized_score"),
        "title",
        F.coalesce(F.when(F.col("narrative_type") != "", F.col("narrative_type")), F.lit("unknown")).alias(
            "narrative_type"
        ),
        given("platform_scores", "map<string,double>", F.create_map().cast("map<string,double>")).alias("platform_scores"),
        platforms.alias("platform_recommendations"),
        F.struct(
            given("primary_speaker_identity", "string", F.lit("unknown")).alias("identity"),
            given("primary_speaker_name", "string", F.lit(None)).alias("name"),
            given("streamer_speaking_ratio", "double", F.lit(0.0)).alias("streamer_speaking_ratio"),
            given("streamer_speaking_confidence", "double", F.lit(0.0)).alias("streamer_speaking_confidence"),
            given("off_streamer_voice_detected", "boolean", F.lit(False)).alias("off_streamer_voice_detected"),
            given("speaker_name_evidence", "array<string>", F.array().cast("array<string>")).alias("evidence"),
        ).alias("speaker"),
        F.concat(
            F.lit("Scored "), F.format_string("%.1f", round_half_even("final_score", 1)),
            F.lit("/10 by rule; no better clip of the video has a title like this."),
        ).alias("why_selected"),
        F.concat(
            F.lit("trigger: "), F.coalesce("trigger", F.lit("")), F.lit(" -> payoff: "), F.coalesce("payoff", F.lit(""))
        ).alias("narrative_arc"),
        evidence.alias("evidence"),
        F.concat(
            F.lit("Start: "), reason("trim_start_reason"), F.lit("; End: "), reason("trim_end_reason")
        ).alias("trim_rationale"),
        duration_fit(te - ts).alias("duration_fit"),
        F.when(F.size(platforms) > 0, F.concat(F.lit("Suits "), F.array_join(platforms, ", ")))
        .otherwise("No platform stands out")
        .alias("platform_fit"),
        risks.alias("risks"),
        F.lit(FEEDBACK).alias("feedback"),
        "is_fallback",
    )


def regate(rescored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits re-scored selections into clips that stay (ranked again) and clips dropped.

    ``rescored``: vod_id, clip_id, rank, is_fallback, final_score, eligible,
    rejection_reasons.  Fallback clips stay whatever their score.
    """
    stays = F.col("is_fallback") | (F.col("eligible") & (F.col("final_score") >= MIN_FINAL_SCORE))
    again = F.row_number().over(Window.partitionBy("vod_id").orderBy("rank"))
    kept = rescored.where(stays).withColumn("rank", again)
    reasons = F.array_union("rejection_reasons", F.array(F.lit("rms_rescore_below_threshold")))
    return kept, rescored.where(~stays).withColumn("reason_codes", reasons)


def overlay_ranking(clips: DataFrame, model_clips: DataFrame, fields: list[str]) -> DataFrame:
    """Takes non-empty ``fields`` of the model's own ranking where it has the clip.

    A model clip belongs to a selected one if its start or trim start equals
    the clip's start (the latest such row wins), else if its start lies inside
    the clip (the first one wins).  ``model_clips``: vod_id, pos, start_s,
    trim_start and the fields.
    """
    from .intervals import point_join

    payload = F.struct(*fields)
    model = model_clips.select("vod_id", "pos", "start_s", "trim_start", payload.alias("_f"))
    by_start = (
        model.select("vod_id", F.col("start_s").alias("_key"), F.struct("pos", F.lit(0).alias("k")).alias("o"), "_f")
        .unionAll(model.select("vod_id", "trim_start", F.struct("pos", F.lit(1).alias("k")), "_f"))
        .where(F.col("_key").isNotNull())
        .groupBy("vod_id", "_key")
        .agg(F.max_by("_f", "o").alias("_exact"))
    )
    spans = clips.select("vod_id", "clip_id", F.col("start_s").alias("_lo"), F.col("end_s").alias("_hi"))
    inside = (
        point_join(
            model.where(F.col("start_s").isNotNull()).select("vod_id", "pos", F.col("start_s").alias("_t"), "_f"),
            spans, bucket=300, at="_t", span=("_lo", "_hi"), spread_by=["pos"],
        )
        .groupBy("vod_id", "clip_id")
        .agg(F.min_by("_f", "pos").alias("_range"))
    )
    joined = (
        clips.withColumn("_key", F.col("start_s"))
        .join(by_start, ["vod_id", "_key"], "left")
        .join(inside, ["vod_id", "clip_id"], "left")
        .withColumn("_m", F.coalesce("_exact", "_range"))
    )
    for f in fields:
        given = F.col("_m")[f]
        if dict(model_clips.dtypes)[f].startswith("array"):
            given = F.when(F.size(given) > 0, given)
        elif dict(model_clips.dtypes)[f] == "string":
            given = F.when(given != "", given)
        current = F.col(f) if f in clips.columns else F.lit(None)
        joined = joined.withColumn(f, F.coalesce(given, current))
    return joined.drop("_key", "_exact", "_range", "_m")


def overlay_reviews(analyses: DataFrame, reviews: DataFrame, fields: list[str], key: list[str]) -> DataFrame:
    """Replaces analysis fields by those of a review, unless the review failed.

    Fields a review does not state (NULL) keep their value.
    """
    good = reviews.where(F.col("error").isNull()).select(*key, *[F.col(f).alias(f"_{f}") for f in fields])
    good = good.withColumn("_reviewed", F.lit(True))
    joined = analyses.join(good, key, "left")
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(f"_{f}", f))
    return joined.withColumn("reviewed", F.coalesce("_reviewed", F.lit(False))).drop(
        "_reviewed", *[f"_{f}" for f in fields]
    )


def exportable_clips(clips: DataFrame, min_score: float = 7.0) -> DataFrame:
    """Clips worth cutting: a score of at least ``min_score``; a missing trim is the whole clip."""
    return (
        clips.where(F.coalesce("score", F.lit(0.0)) >= min_score)
        .withColumn("trim_start", F.coalesce("trim_start", "start_s"))
        .withColumn("trim_end", F.coalesce("trim_end", "end_s"))
    )


def top_for_audio(analyses: DataFrame, k: int) -> DataFrame:
    """The ``k`` most worthy clips of each video, equal ones in input order."""
    order = Window.partitionBy("vod_id").orderBy(F.desc(F.coalesce("clip_worthiness", F.lit(0.0))), "pos")
    return analyses.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def attach_audio(analyses: DataFrame, audio: DataFrame) -> DataFrame:
    """Adds the audio result of the same start time; of several the latest one counts."""
    fields = [c for c in audio.columns if c not in ("vod_id", "start_s", "pos")]
    latest = audio.groupBy("vod_id", "start_s").agg(F.max_by(F.struct(*fields), "pos").alias("_a"))
    return analyses.join(latest, ["vod_id", "start_s"], "left").select(analyses.columns + ["_a.*"])
