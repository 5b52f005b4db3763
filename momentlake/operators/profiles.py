"""Streamer profiles: observations, their merge policy, upserts and prompt context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even, safe_double
from ..functions.text import clip_text, is_sensitive, normalise_claim

AUTO_CONFIDENCE, QUEUE_CONFIDENCE, MIN_EVIDENCE = 0.80, 0.60, 2
CONTEXT_CONFIDENCE = 0.65
# The kinds of facts in a profile context, in order.
CONTEXT_KINDS = ("voice_profile", "personality_trait", "inside_joke", "content_pattern", "community_chatter")


def clip_observations(clips: DataFrame) -> DataFrame:
    """Observations that selected clips suggest: their inside joke and narrative arc.

    ``clips``: vod_id, pos, start_s, end_s, trim_start, trim_end, clip_point,
    title, label, score, inside_joke, narrative_arc.
    """
    start = F.coalesce(F.col("trim_start").cast("double"), F.col("start_s").cast("double"), F.lit(0.0))
    end = F.coalesce(F.col("trim_end").cast("double"), F.col("end_s").cast("double"), start + 1.0)
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    title = F.coalesce(filled("clip_point"), filled("title"), filled("label"), F.lit("untitled clip"))
    span = F.format_string("%.3f-%.3f", "_s", "_e")
    kinds = F.array_compact(
        F.array(
            F.when(
                F.col("inside_joke") != "",
                F.struct(F.lit(0).alias("k"), F.lit("inside_joke").alias("type"), F.col("inside_joke").alias("claim")),
            ),
            F.when(
                F.col("narrative_arc") != "",
                F.struct(F.lit(1).alias("k"), F.lit("content_pattern").alias("type"), F.col("narrative_arc").alias("claim")),
            ),
        )
    )
    return (
        clips.withColumn("_s", start)
        .withColumn("_e", F.when(end > start, end).otherwise(start + 1.0))
        .withColumn("_title", title)
        .withColumn("_o", F.explode(kinds))
        .select(
            "vod_id",
            (F.col("pos") * 2 + F.col("_o.k")).alias("pos"),
            F.col("_s").alias("timestamp_start"),
            F.col("_e").alias("timestamp_end"),
            F.col("_o.type").alias("type"),
            F.col("_o.claim").alias("claim"),
            F.array(F.concat(F.lit("title: "), "_title"), F.concat(F.lit("window: "), span)).alias("evidence"),
            F.lit("llm_summary").alias("source"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), safe_double("score") / 10.0)).alias("confidence"),
            F.array(F.concat(F.lit("vod:"), F.col("vod_id").cast("string"), F.lit("@"), span)).alias("evidence_refs"),
        )
    )


def dedupe_observations(observations: DataFrame, keys: list[str]) -> DataFrame:
    """One observation per (keys, type, normalised claim): the most confident, then
    the one with more evidence, then the first.

    The best rank per claim is found first (a partial aggregate over small
    columns); the rows themselves follow by a join on it.
    """
    claim = F.sha2(normalise_claim(F.col("claim")), 256)
    rank = F.struct(
        (-F.col("confidence")).alias("c"), (-F.size("evidence")).alias("e"), F.col("pos").alias("p")
    )
    tagged = observations.withColumn("_key", claim).withColumn("_rank", rank)
    best = tagged.groupBy(*keys, "type", "_key").agg(F.min("_rank").alias("_rank"))
    return tagged.join(best, [*keys, "type", "_key", "_rank"], "left_semi").drop("_key", "_rank")


def disposition(claim: Column, confidence: Column, n_evidence: Column, auto: float = AUTO_CONFIDENCE) -> Column:
    """``accept``, ``queue`` or ``reject``.  A confident claim with too little
    evidence is rejected, not queued."""
    return (
        F.when(is_sensitive(claim), "reject")
        .when((confidence >= auto) & (n_evidence >= MIN_EVIDENCE), "accept")
        .when((confidence >= QUEUE_CONFIDENCE) & (confidence < auto), "queue")
        .otherwise("reject")
    )


def partition_observations(observations: DataFrame, auto: float = AUTO_CONFIDENCE) -> DataFrame:
    return observations.withColumn(
        "disposition", disposition(F.col("claim"), F.col("confidence"), F.size("evidence"), auto)
    )


def upsert_claims(profile: DataFrame, accepted: DataFrame, batch: str | None = None) -> DataFrame:
    """Merges accepted observations into profile claims.

    ``profile``: streamer_id, pos, kind, claim, description, context, impact,
    confidence, evidence_refs, updated.  ``accepted``: streamer_id, pos, vod_id,
    type, claim, confidence, evidence_refs, one per claim.  New claims are
    inserted; known ones take the larger confidence, the new description only
    if it is strictly more confident, and all references.  Of profile rows with
    equal normal forms the last one is updated; ``added`` marks rows that came in by merging, which
    follow all others.

    With a ``batch`` id rows keep the ids of the batches they have taken in (``batches``), and a row
    takes in a batch once: merging the same batch again changes nothing.
    """
    key = ["streamer_id", "kind", "_key"]
    none = F.array().cast("array<string>")
    has = lambda c, default: F.coalesce(c, default) if c in profile.columns else default
    digest = F.sha2(normalise_claim(F.col("claim")), 256)
    old = profile.withColumns({"_key": digest, "added": has("added", F.lit(False)), "batches": has("batches", none)})
    last = old.groupBy(*key).agg(F.max(F.struct("added", "pos")).alias("_last"))
    last = last.select(*key, "_last.*", F.lit(True).alias("_target"))
    old = old.join(last, [*key, "added", "pos"], "left")
    new = (
        accepted.where(F.col("type").isin("inside_joke", "content_pattern") & (normalise_claim(F.col("claim")) != ""))
        .select(
            "streamer_id", F.col("type").alias("kind"), digest.alias("_key"), F.col("pos").alias("n_pos"),
            F.col("vod_id").alias("n_vod"), F.col("claim").alias("n_claim"), F.col("confidence").alias("n_conf"),
            F.col("evidence_refs").alias("n_refs"),
        )
        .withColumn("_target", F.lit(True))
    )
    both = old.join(new, [*key, "_target"], "full")
    inserted, touched = F.col("claim").isNull(), F.col("n_claim").isNotNull()
    if batch is not None:
        touched = touched & ~F.coalesce(F.array_contains("batches", batch), F.lit(False))
    stronger = touched & (F.col("n_conf") > F.col("confidence"))
    joke = F.col("kind") == "inside_joke"
    taken = lambda c: F.when(inserted | touched, F.col(c))
    marks = [] if batch is None else [
        F.concat(F.coalesce("batches", none), F.when(inserted | touched, F.array(F.lit(batch))).otherwise(none)).alias("batches")
    ]
    return both.select(
        "streamer_id",
        F.coalesce("pos", "n_pos").alias("pos"),
        F.coalesce("added", F.lit(True)).alias("added"),
        "kind",
        F.coalesce("claim", "n_claim").alias("claim"),
        F.when(inserted | stronger, F.col("n_claim")).otherwise(F.col("description")).alias("description"),
        F.when(inserted & joke, F.concat(F.lit("Observed in VOD "), F.col("n_vod").cast("string")))
        .otherwise(F.col("context"))
        .alias("context"),
        F.when(inserted & ~joke, "neutral").otherwise(F.col("impact")).alias("impact"),
        F.greatest(F.col("confidence"), taken("n_conf")).alias("confidence"),
        F.array_union(F.coalesce("evidence_refs", none), F.coalesce(taken("n_refs"), none)).alias("evidence_refs"),
        F.when(~inserted & touched, F.lit(True)).otherwise(F.coalesce("updated", F.lit(False))).alias("updated"),
        *marks,
    )


def recent_observations(log: DataFrame, limit: int = 200) -> DataFrame:
    """The last ``limit`` log rows of each streamer; the limit runs before the shuffle."""
    newest = Window.partitionBy("streamer_id").orderBy(F.desc("pos"))
    return log.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= max(0, limit)).drop("_r")


def context_facts(facts: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Facts worth showing: of a known kind, confident and with references.

    ``facts``: streamer_id, kind, pos, confidence, evidence_refs, message_count,
    last_seen.  With ``limits`` only so many of each kind: chatters by activity,
    everything else by ``pos``; the largest limit runs before the shuffle.
    """
    sure = (F.col("confidence") >= CONTEXT_CONFIDENCE) & (F.size("evidence_refs") > 0)
    shown = facts.where(sure & F.col("kind").isin(*CONTEXT_KINDS))
    if limits is None:
        return shown
    chatter = F.col("kind") == "community_chatter"
    order = Window.partitionBy("streamer_id", "kind").orderBy(
        F.when(chatter, -F.coalesce("message_count", F.lit(0))).otherwise(0),
        F.desc(F.when(chatter, F.coalesce("last_seen", F.lit("")))),
        "pos",
    )
    own = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    return (
        shown.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= max(limits.values()))
        .where(F.col("rank") <= F.try_element_at(own, F.col("kind")))
    )


def profile_context(facts: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """The lines of each streamer's profile as rows (streamer_id, section, kind, pos, line)
    from the facts chosen by :func:`context_facts`; a writer sorts them by section and pos.

    Extra columns: label, description, role, impact.
    """
    conf = F.concat(
        F.lit(", conf="), F.format_string("%.2f", round_half_even("confidence", 2)), F.lit(", ref="),
        F.get("evidence_refs", 0),
    )
    role = F.when(F.col("role") != "", F.concat(F.lit(" ("), "role", F.lit(")"))).otherwise("")
    body = (
        F.when(F.col("kind") == "voice_profile", F.concat("label", role))
        .when(F.col("kind") == "personality_trait", clip_text(F.coalesce("description", "label")))
        .when(F.col("kind") == "inside_joke", F.concat("label", F.lit(": "), clip_text(F.col("description"))))
        .when(
            F.col("kind") == "content_pattern",
            F.concat(F.lit("["), "impact", F.lit("] "), clip_text(F.col("label")), F.lit(" — "), clip_text(F.col("description"))),
        )
        .otherwise(F.concat("label", role, F.lit(", msgs="), F.coalesce("message_count", F.lit(0)).cast("string")))
    )
    section = F.array_position(F.array(*[F.lit(k) for k in CONTEXT_KINDS]), F.col("kind"))
    line = F.concat(F.lit("- "), F.replace("kind", F.lit("_"), F.lit(" ")), F.lit(": "), body, conf)
    return context_facts(facts, limits).select("streamer_id", section.alias("section"), "kind", "pos", line.alias("line"))
