"""Trimming full-window clips to their loudest passage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import AUDIO_TRIM, MODEL_TRIM

FULL_WINDOW_SECONDS = 120
SHORTEST, LONGEST = 15, 60
NARROW_SHARE, BROAD_SHARE = 0.15, 0.05


def second_energies(samples: DataFrame) -> DataFrame:
    """Root mean square of the samples ``x`` per second of each video.

    A partial aggregate: the samples of one second may lie anywhere.
    """
    x = F.col("x").cast("double")
    return samples.groupBy("vod_id", "sec").agg(F.sqrt(F.avg(x * x)).alias("energy"))


def _run_around(energies: Column, peak: Column, threshold: Column) -> tuple[Column, Column]:
    """Longest run ``[from, to)`` around the peak whose other seconds are above the threshold."""
    n = F.size(energies)
    index = F.sequence(F.lit(0), n - 1)
    quiet = lambda i: F.get(energies, i) <= threshold
    before = F.array_max(F.filter(index, lambda i: (i < peak) & quiet(i)))
    after = F.array_min(F.filter(index, lambda i: (i > peak) & quiet(i)))
    return F.coalesce(before + 1, F.lit(0)), F.coalesce(after, n)


def loudest_passage(clips: DataFrame) -> DataFrame:
    """Trim of clips that still cover their whole 120 s window.

    ``clips``: start_s, end_s, trim_start, trim_end, energies (one value per
    second, at most 120).  The passage around the loudest second is widened
    while above a floor-to-peak threshold, padded to 15 s and cut to 60 s.
    Clips that were narrowed or are not 120 s long keep their trim, and so do
    those with fewer than 15 seconds of audio; without audio the middle 45 s
    is taken.
    """
    e = F.col("energies")
    n = F.size(e)
    whole = (F.col("trim_start") == F.col("start_s")) & (F.col("trim_end") == F.col("end_s"))
    due = whole & (F.col("end_s") - F.col("start_s") == FULL_WINDOW_SECONDS)
    c = (
        clips.withColumn("_due", due)
        .withColumn("_enough", F.coalesce(n >= SHORTEST, F.lit(False)))
        .withColumn("_peak", (F.array_position(e, F.array_max(e)) - 1).cast("int"))
        .withColumn("_top", F.array_max(e))
        .withColumn("_floor", F.get(F.array_sort(e), F.floor(n / 4).cast("int")))
    )
    level = lambda share: F.col("_floor") + (F.col("_top") - F.col("_floor")) * share
    s1, t1 = _run_around(e, F.col("_peak"), level(NARROW_SHARE))
    s2, t2 = _run_around(e, F.col("_peak"), level(BROAD_SHARE))
    c = c.withColumn("_s1", s1).withColumn("_t1", t1).withColumn("_s2", s2).withColumn("_t2", t2)

    # Short passages: the broader run if it is longer, then padding on both sides.
    broaden = (F.col("_t1") - F.col("_s1") < SHORTEST) & (F.col("_t2") - F.col("_s2") > F.col("_t1") - F.col("_s1"))
    c = c.withColumn("_s3", F.when(broaden, F.col("_s2")).otherwise(F.col("_s1"))).withColumn(
        "_t3", F.when(broaden, F.col("_t2")).otherwise(F.col("_t1"))
    )
    need = SHORTEST - (F.col("_t3") - F.col("_s3"))
    left = F.floor(need / 2).cast("int")
    c = c.withColumn("_s4", F.when(need > 0, F.greatest(F.lit(0), F.col("_s3") - left)).otherwise(F.col("_s3")))
    c = c.withColumn("_t4", F.when(need > 0, F.least(n, F.col("_t3") + need - left)).otherwise(F.col("_t3")))
    missing = SHORTEST - (F.col("_t4") - F.col("_s4"))
    at_start = F.col("_s4") == 0
    at_end = ~at_start & (F.col("_t4") == n)
    c = c.withColumn(
        "_t5", F.when((missing > 0) & at_start, F.least(n, F.col("_t4") + missing)).otherwise(F.col("_t4"))
    ).withColumn(
        "_s5", F.when((missing > 0) & at_end, F.greatest(F.lit(0), F.col("_s4") - missing)).otherwise(F.col("_s4"))
    )
    centre = F.floor((F.col("_s5") + F.col("_t5")) / 2).cast("int")
    too_long = F.col("_t5") - F.col("_s5") > LONGEST
    c = c.withColumn(
        "_from", F.when(too_long, F.greatest(F.lit(0), centre - LONGEST // 2)).otherwise(F.col("_s5"))
    ).withColumn("_to", F.when(too_long, F.least(n, centre + LONGEST // 2)).otherwise(F.col("_t5")))

    middle = F.floor((F.col("start_s") + F.col("end_s")) / 2)
    by_audio = F.col("_due") & F.col("_enough")
    no_audio = F.col("_due") & e.isNull()
    return c.select(
        *[x for x in clips.columns if x not in ("trim_start", "trim_end", "trim_source", "energies")],
        F.when(by_audio, F.col("start_s") + F.col("_from"))
        .when(no_audio, F.greatest(F.col("start_s"), middle - 22))
        .otherwise(F.col("trim_start"))
        .alias("trim_start"),
        F.when(by_audio, F.col("start_s") + F.col("_to"))
        .when(no_audio, F.least(F.col("end_s"), middle + 23))
        .otherwise(F.col("trim_end"))
        .alias("trim_end"),
        F.when(by_audio | no_audio, AUDIO_TRIM).otherwise(MODEL_TRIM).alias("trim_source"),
    )


def attach_energies(clips: DataFrame, energies: DataFrame) -> DataFrame:
    """Adds the energies of the seconds inside each clip as a list in time order.

    Only clips that still cover a full 120 s window get one, so a list has at
    most 120 values.  It ends with the last second that has samples; silent
    seconds before that count as 0.
    """
    whole = (F.col("trim_start") == F.col("start_s")) & (F.col("trim_end") == F.col("end_s"))
    due = clips.where(whole & (F.col("end_s") - F.col("start_s") == FULL_WINDOW_SECONDS))
    seconds = due.select(
        "vod_id", "clip_id", F.explode(F.sequence(F.col("start_s"), F.col("end_s") - 1)).alias("sec")
    )
    known = F.filter("_e", lambda x: x["energy"].isNotNull())
    lists = (
        seconds.join(energies, ["vod_id", "sec"], "left")
        .groupBy("vod_id", "clip_id")
        .agg(F.array_sort(F.collect_list(F.struct("sec", "energy"))).alias("_e"))
        .withColumn("_last", F.array_max(F.transform(known, lambda x: x["sec"])))
        .where(F.col("_last").isNotNull())
        .withColumn("_e", F.filter("_e", lambda x: x["sec"] <= F.col("_last")))
        .select(
            "vod_id",
            "clip_id",
            F.transform("_e", lambda x: F.coalesce(x["energy"], F.lit(0.0))).alias("energies"),
        )
    )
    return clips.join(lists, ["vod_id", "clip_id"], "left")
