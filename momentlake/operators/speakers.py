"""Speakers: alignment, recognition, enrolment and name inference."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import addressed_names, introductions
from ..runtime import checkpointed, salted_lookup
from .intervals import neighbour, overlap_join, point_join, running_max_before, surrounding_times
from .profile_search import nearest_profiles

UNKNOWN = "UNKNOWN"
# Who a voice can belong to.
IDENTITIES = ("streamer", "guest", "unknown", "chatter", "mixed")
ACCEPT_SIMILARITY = 0.72
HIGH_SIMILARITY = 0.80


def align_speakers(segments: DataFrame, turns: DataFrame, min_ratio: float = 0.30) -> DataFrame:
    """Adds to each line the speaker of the turn it overlaps most.

    Equal overlaps go to the earliest (start, end, label).  Lines covered by
    less than ``min_ratio`` of their length, and lines without length, get
    ``UNKNOWN``; turns without length cover nothing.

    A turn that an earlier one covers to its end is never the best one.  The others end in the order in
    which they start, so a line looks up two of them, the last that starts by its start and the first that
    lasts to its end, and only what lies between these is compared with it.
    """
    marks = _leading_turns(turns)
    mark = lambda name: F.struct(F.col("start_s").alias("ts"), F.col("end_s").alias("te"), "label").alias(name)
    starts = segments.select("vod_id", F.col("start_s").alias("t")).distinct()
    ends = segments.select("vod_id", F.greatest("start_s", "end_s").alias("t")).distinct()
    # One turn per start is enough before a line: the longest.
    longest = marks.groupBy("vod_id", F.col("start_s").alias("prev_mark")).agg(F.max_by(mark("m"), "end_s").alias("_first"))
    by_end = marks.select("vod_id", F.col("end_s").alias("next_mark"), mark("_last"))
    first = surrounding_times(starts, marks.select("vod_id", F.col("start_s").alias("t"))).join(longest, ["vod_id", "prev_mark"])
    last = surrounding_times(ends, marks.select("vod_id", F.col("end_s").alias("t"))).join(by_end, ["vod_id", "next_mark"])
    met = segments.withColumn("_end", F.greatest("start_s", "end_s"))
    met = salted_lookup(met, first.select("vod_id", F.col("t").alias("start_s"), "_first"), ["vod_id", "start_s"], spread_by=["pos"])
    met = salted_lookup(met, last.select("vod_id", F.col("t").alias("_end"), "_last"), ["vod_id", "_end"], spread_by=["pos"])
    plain = met.drop("speaker_label", "_end")
    # Lines that no turn covers whole may be met best by a turn inside them.
    backward = F.col("end_s") < F.col("start_s")
    whole = ~backward & F.coalesce(F.col("_last.ts") <= F.col("start_s"), F.lit(False))
    spans = plain.where(~whole).select("vod_id", "start_s", "end_s").distinct()
    inner = marks.select("vod_id", F.col("start_s").alias("_ts"), F.col("end_s").alias("_te"), F.col("label").alias("_label"))
    around = overlap_join(spans.where(backward), inner, bucket=300, left_span=("start_s", "end_s"), right_span=("_ts", "_te"))
    length = F.when(backward, 0).otherwise(F.col("_te") - F.col("_ts"))
    inside = (
        point_join(inner, spans.where(~backward), bucket=300, at="_ts", span=("start_s", "end_s"), spread_by=["_te"])
        .where(F.col("_te") <= F.col("end_s"))
        .unionByName(around)
        .groupBy("vod_id", "start_s", "end_s")
        .agg(F.min(F.struct((-length).alias("n"), F.col("_ts").alias("ts"), F.col("_te").alias("te"), F.col("_label").alias("label"))).alias("_m"))
        .select("vod_id", "start_s", "end_s", F.struct("_m.ts", "_m.te", "_m.label").alias("_inside"))
    )
    held = plain.join(inside, ["vod_id", "start_s", "end_s"], "left")
    shared = lambda m: F.least("end_s", m["te"]) - F.greatest("start_s", m["ts"])
    ranked = F.transform(
        F.filter(F.array("_first", "_last", "_inside"), lambda m: (m["ts"] < F.col("end_s")) & (m["te"] > F.col("start_s"))),
        lambda m: F.struct((-shared(m)).alias("n"), m["ts"].alias("ts"), m["te"].alias("te"), m["label"].alias("label")),
    )
    best = F.array_min(ranked)
    covered = F.try_divide(-best["n"], F.col("end_s") - F.col("start_s")) >= min_ratio
    return held.withColumn("speaker_label", F.coalesce(F.when(covered, best["label"]), F.lit(UNKNOWN))).drop(
        "_first", "_last", "_inside"
    )


def _leading_turns(turns: DataFrame) -> DataFrame:
    """The turns (vod_id, start_s, end_s, label) that end after every turn that starts before them, each span once."""
    spans = turns.where(F.col("end_s") > F.col("start_s")).groupBy("vod_id", "start_s", "end_s").agg(F.min(F.struct(F.col("speaker_label").alias("label"))).alias("_l"))
    latest = turns.where(F.col("end_s") > F.col("start_s")).groupBy("vod_id", "start_s").agg(F.max("end_s").alias("_end"))
    before = running_max_before(latest, order=["start_s"], value="_end", out="_before").select("vod_id", "start_s", "_before")
    leading = spans.join(before, ["vod_id", "start_s"]).where(F.col("_before").isNull() | (F.col("end_s") > F.col("_before")))
    return checkpointed(leading.select("vod_id", "start_s", "end_s", "_l.label"))


def non_overlapping_turns(turns: DataFrame) -> DataFrame:
    """Pushes each turn's start behind everything that came before; turns that
    vanish are dropped.  Of equal spans the first one stays."""
    others = [c for c in turns.columns if c not in ("vod_id", "start_s", "end_s")]
    grid = turns.groupBy("vod_id", "start_s", "end_s").agg(F.min_by(F.struct(*others), "pos").alias("_row"))
    before = running_max_before(grid, order=["start_s", "end_s"], value="end_s", out="_busy_until")
    return (
        before.withColumn("start_s", F.greatest("start_s", "_busy_until"))
        .where(F.col("end_s") > F.col("start_s"))
        .select("vod_id", "start_s", "end_s", "_row.*")
    )


def cluster_embeddings(
    turns: DataFrame, *, min_seconds: float = 1.5, max_seconds: float | None = None, max_turns: int | None = None
) -> DataFrame:
    """Mean embedding per (vod_id, speaker_label) of its turns.

    ``turns``: vod_id, speaker_label, pos, dur, embedding.  With ``max_turns``
    or ``max_seconds`` only the longest turns up to these limits; the longest
    always counts.  Sums are made per dimension on the map side, so a voice may
    have any number of turns.
    """
    key = ["vod_id", "speaker_label"]
    chosen = turns.where(F.col("dur") >= min_seconds)
    if max_turns is not None or max_seconds is not None:
        longest = Window.partitionBy(*key).orderBy(F.desc("dur"), "pos")
        chosen = chosen.withColumn("_rank", F.row_number().over(longest))
        if max_turns is not None:
            chosen = chosen.where(F.col("_rank") <= max_turns)
        if max_seconds is not None:
            spoken = F.sum("dur").over(longest.rowsBetween(Window.unboundedPreceding, 0))
            chosen = chosen.withColumn("_sum", spoken).where((F.col("_rank") == 1) | (F.col("_sum") <= max_seconds))
    dims = (
        chosen.select(*key, F.posexplode("embedding").alias("i", "x"))
        .groupBy(*key, "i")
        .agg((F.sum(F.col("x").cast("double")) / F.count(F.lit(1))).alias("x"), F.count(F.lit(1)).alias("n"))
    )
    vector = F.array_sort(F.collect_list(F.struct("i", "x")))
    return dims.groupBy(*key).agg(
        F.transform(vector, lambda v: v["x"]).alias("embedding"), F.max("n").cast("int").alias("turns_used")
    )


def _norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column) -> Column:
    """The vector at length one; a zero vector stays as it is."""
    v = v.cast("array<double>")
    norm = _norm(v)
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def enroll_profiles(samples: DataFrame) -> DataFrame:
    """One voice profile per ``profile_id``: the normalised mean of normalised vectors.

    The mean is a partial aggregate, so any number of samples per profile is
    fine.  Profiles whose samples differ in dimension get an ``error`` and no
    embedding.
    """
    sized = samples.select("profile_id", l2_normalize(F.col("embedding")).alias("v")).withColumn("dim", F.size("v"))
    dims = sized.groupBy("profile_id").agg(
        F.min("dim").alias("_lo"), F.max("dim").alias("_hi"), F.count(F.lit(1)).alias("samples")
    )
    mixed = dims.where(F.col("_lo") != F.col("_hi")).select("profile_id")
    means = (
        salted_lookup(sized, mixed, ["profile_id"], spread_by=["v"], how="left_anti")
        .groupBy("profile_id")
        .agg(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("_mean"))
    )
    return dims.join(means, "profile_id", "left").select(
        "profile_id",
        "samples",
        F.when(F.col("_lo") == F.col("_hi"), l2_normalize(F.col("_mean"))).alias("embedding"),
        F.when(F.col("_lo") != F.col("_hi"), "embeddings differ in dimension").alias("error"),
    )


def best_profiles(clusters: DataFrame, profiles: DataFrame) -> DataFrame:
    """The most similar profile of each cluster by cosine (ties: first profile).

    Where both sides have a ``streamer_id`` only the profiles of a cluster's own
    streamer compete: a join on that key.  Otherwise all do, by a search that skips
    what cannot win (:func:`~.profile_search.nearest_profiles`).
    """
    usable = profiles.where(F.size("embedding") > 0).select(
        "pos",
        "profile_id",
        "role",
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce("accept_similarity", F.lit(ACCEPT_SIMILARITY)).alias("accept"),
        F.coalesce("high_confidence_similarity", F.lit(HIGH_SIMILARITY)).alias("high"),
        *[c for c in profiles.columns if c == "streamer_id"],
    )
    if "streamer_id" in profiles.columns and "streamer_id" in clusters.columns:
        return _best_of_streamer(clusters, usable)
    return nearest_profiles(clusters, usable).drop("compared")


def _best_of_streamer(clusters: DataFrame, profiles: DataFrame) -> DataFrame:
    voices = clusters.select("vod_id", "speaker_label", "streamer_id", F.col("embedding").cast("array<double>").alias("_v"))
    known = profiles.withColumnRenamed("embedding", "_p")
    pairs = salted_lookup(voices, known, ["streamer_id"], spread_by=["vod_id", "speaker_label"], how="inner")
    dot = F.aggregate(F.zip_with("_v", "_p", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    norms = _norm(F.col("_v")) * _norm(F.col("_p"))
    # Vectors of other sizes and zero vectors are at similarity 0.
    score = F.when((F.size("_v") == F.size("_p")) & (norms > 0), dot / norms).otherwise(0.0)
    return (
        pairs.withColumn("score", score)
        .groupBy("vod_id", "speaker_label")
        .agg(
            F.min_by(
                F.struct("score", "profile_id", "role", "accept", "high"), F.struct(-F.col("score"), F.col("pos"))
            ).alias("best")
        )
        .select("vod_id", "speaker_label", "best.*")
    )


def recognise_clusters(clusters: DataFrame, profiles: DataFrame, turns: DataFrame) -> DataFrame:
    """Identity, confidence and profile for every speaker label of ``turns``.

    Below the profile's accept threshold a voice is unknown (the similarity is
    reported if not negative); at its high threshold the confidence is at
    least 0.85.  Labels without an embedding are unknown.
    """
    best = best_profiles(clusters, profiles)
    s, a = F.col("score"), F.col("accept")
    accepted = s >= a
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (s - a) / F.greatest(F.lit(1e-6), 1.0 - a)))
    raised = F.when(s >= F.col("high"), F.greatest(confidence, F.lit(0.85))).otherwise(confidence)
    role = F.when(F.col("role").isin(*IDENTITIES), F.col("role")).otherwise("unknown")
    matched = best.select(
        "vod_id",
        "speaker_label",
        F.when(accepted, role).otherwise("unknown").alias("identity"),
        F.when(accepted, raised).otherwise(0.0).alias("confidence"),
        F.when(accepted | (s >= 0), s).alias("cosine_similarity"),
        F.when(accepted, F.col("profile_id")).alias("profile_id"),
    )
    labels = turns.select("vod_id", "speaker_label").distinct()
    return (
        labels.join(matched, ["vod_id", "speaker_label"], "left")
        .withColumn("identity", F.coalesce("identity", F.lit("unknown")))
        .withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    )


def infer_names(lines: DataFrame, messages: DataFrame, *, reply_seconds: float = 8.0, block_rows: int = 100_000) -> DataFrame:
    """Name clues from dialogue, one row per clue.

    ``lines``: vod_id, pos, start_s, speaker_label, text.  A self-introduction
    names the speaker.  A name spoken to someone goes to the speaker of the
    next line if that is another voice starting within ``reply_seconds``
    (confidence 0.72, or 0.60 when several names are called).  ``ord`` orders
    the clues of a video as they were found.
    """
    labelled = lines.select(
        "vod_id",
        "pos",
        F.coalesce("start_s", F.lit(0)).cast("double").alias("start_s"),
        F.coalesce(F.when(F.col("speaker_label") != "", F.col("speaker_label")), F.lit(UNKNOWN)).alias("speaker_label"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    intros = labelled.select(
        "vod_id", "pos", "start_s", "speaker_label", F.posexplode(introductions(F.col("text"))).alias("_i", "_c")
    ).select(
        "vod_id",
        "speaker_label",
        F.col("_c.name").alias("name"),
        F.col("_c.confidence").alias("confidence"),
        F.format_string("self-identification at %.1fs: '%s'", "start_s", "_c.phrase").alias("evidence"),
        F.struct("pos", F.lit(0).alias("kind"), F.col("_i").alias("i")).alias("ord"),
    )

    followed = neighbour(
        labelled.withColumn("_names", addressed_names(F.col("text"))),
        order=["pos"],
        block=F.floor(F.col("pos") / block_rows),
        take=["start_s", "speaker_label"],
        out="_next",
        following=True,
    )
    wait = F.col("_next.start_s") - F.col("start_s")
    replied = (F.col("_next.speaker_label") != F.col("speaker_label")) & wait.between(0.0, reply_seconds)
    calls = (
        followed.where((F.size("_names") > 0) & replied)
        .withColumn("confidence", F.when(F.size("_names") > 1, F.lit(0.72) - F.lit(0.12)).otherwise(0.72))
        .select("vod_id", "pos", "start_s", "_next", "confidence", F.posexplode("_names").alias("_i", "name"))
        .withColumn("_user", F.lower("name"))
    )
    users = (
        messages.select("vod_id", F.lower(F.trim("usr")).alias("_user"))
        .where(F.col("_user") != "")
        .distinct()
        .withColumn("_in_chat", F.lit(True))
    )
    answered = salted_lookup(calls, users, ["vod_id", "_user"], spread_by=["pos"]).select(
        "vod_id",
        F.col("_next.speaker_label").alias("speaker_label"),
        "name",
        "confidence",
        F.concat(
            F.format_string(
                "addressed by name '%s' at %.1fs; %s responds within 8s", "name", "start_s", "_next.speaker_label"
            ),
            F.when(F.col("_in_chat"), " (name also appears in chat usernames)").otherwise(""),
        ).alias("evidence"),
        F.struct("pos", F.lit(1).alias("kind"), F.col("_i").alias("i")).alias("ord"),
    )
    return intros.unionByName(answered)


def merge_name_candidates(clues: DataFrame) -> DataFrame:
    """One row per (speaker, name up to case): best confidence, first spelling and
    evidence, number of distinct evidence lines, rank within the speaker.

    The evidence lines themselves stay rows, see :func:`name_evidence`.
    """
    key = ["vod_id", "speaker_label", "name_key"]
    merged = (
        clues.withColumn("name_key", F.lower("name"))
        .groupBy(*key)
        .agg(
            F.max("confidence").alias("confidence"),
            F.min_by(F.struct("name", "evidence"), "ord").alias("_first"),
            F.countDistinct("evidence").alias("evidence_count"),
            F.min("ord").alias("first_ord"),
        )
    )
    order = Window.partitionBy("vod_id", "speaker_label").orderBy(F.desc("confidence"), "first_ord")
    return merged.select(
        "vod_id",
        "speaker_label",
        F.col("_first.name").alias("name"),
        "confidence",
        F.col("_first.evidence").alias("first_evidence"),
        "evidence_count",
        F.row_number().over(order).alias("rank"),
    )


def name_evidence(clues: DataFrame) -> DataFrame:
    """Distinct evidence lines per (speaker, name up to case) with their first occurrence."""
    return (
        clues.groupBy("vod_id", "speaker_label", F.lower("name").alias("name_key"), "evidence")
        .agg(F.min("ord").alias("first_ord"))
    )


def cluster_summary(turns: DataFrame, recognition: DataFrame, names: DataFrame) -> DataFrame:
    """Speech seconds and turn count per speaker with identity and best name."""
    length = F.greatest(F.lit(0), F.col("end_s") - F.col("start_s"))
    totals = turns.groupBy("vod_id", "speaker_label").agg(
        F.sum(length).cast("double").alias("total_speech_seconds"), F.count(F.lit(1)).alias("segment_count")
    )
    best = names.groupBy("vod_id", "speaker_label").agg(
        F.min_by("name", "rank").alias("top_name"), F.count(F.lit(1)).alias("name_count")
    )
    return (
        totals.join(
            recognition.select(
                "vod_id",
                "speaker_label",
                F.col("identity").alias("primary_identity"),
                F.col("confidence").alias("primary_identity_confidence"),
            ),
            ["vod_id", "speaker_label"],
            "left",
        )
        .join(best, ["vod_id", "speaker_label"], "left")
        .fillna("unknown", ["primary_identity"])
        .fillna(0.0, ["primary_identity_confidence"])
        .fillna(0, ["name_count"])
    )


def enrich_turns(turns: DataFrame, recognition: DataFrame, names: DataFrame, min_confidence: float = 0.70) -> DataFrame:
    """Attaches the recognition of the label, and its best name if confident enough."""
    best = names.where((F.col("rank") == 1) & (F.col("confidence") >= min_confidence)).select(
        "vod_id", "speaker_label", F.col("name").alias("inferred_name")
    )
    facts = recognition.select(
        "vod_id", "speaker_label", "identity", F.col("confidence").alias("identity_confidence"), "profile_id"
    ).join(best, ["vod_id", "speaker_label"], "full")
    return salted_lookup(turns, facts, ["vod_id", "speaker_label"], spread_by=["pos"])
