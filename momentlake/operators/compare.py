"""Comparing two runs over the same videos."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even, safe_double
from ..functions.titles import compare_title
from ..runtime import checkpointed
from .scoring import AUDIO_TRIM

METRICS = (
    "selected_count", "score_mean", "score_min", "score_max", "trim_width_mean", "trim_width_median",
    "trim_width_min", "trim_width_max", "duplicate_title_count", "duplicate_title_rate", "rms_fallback_count",
    "rms_fallback_rate",
)
# Cells hold FAN by FAN cells of the next level; those of so few keys are not cut further.
FAN_BITS = 3
FAN, LEAF = 1 << FAN_BITS, 64
_CELL = ["_k", "_cs", "_ce"]
_QUERY = ["vod_id", "which", "q_s", "q_e"]


def run_metrics(clips: DataFrame) -> DataFrame:
    """Quality figures per (run, vod_id) of selected clips.

    ``clips``: run, vod_id, score, trim_start, trim_end, clip_point, trim_source.
    Duplicate titles are counted from distinct (run, video, title) rows.
    """
    key = ["run", "vod_id"]
    width = (safe_double("trim_end") - safe_double("trim_start")).cast("bigint")
    titled = F.trim(F.coalesce("clip_point", F.lit(""))) != ""
    rows = clips.withColumn("_score", safe_double("score")).withColumn("_width", width)
    main = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("selected_count"),
        F.avg("_score").alias("score_mean"),
        F.min("_score").alias("score_min"),
        F.max("_score").alias("score_max"),
        F.avg("_width").alias("trim_width_mean"),
        F.percentile("_width", 0.5).alias("trim_width_median"),
        F.min("_width").alias("trim_width_min"),
        F.max("_width").alias("trim_width_max"),
        F.count_if(titled).alias("_titled"),
        F.count_if(F.col("trim_source") == AUDIO_TRIM).alias("rms_fallback_count"),
    )
    distinct = (
        rows.where(titled)
        .groupBy(*key, F.sha2(compare_title(F.col("clip_point")), 256).alias("_t"))
        .agg(F.lit(1).alias("_one"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_distinct"))
    )
    duplicates = F.col("_titled") - F.coalesce("_distinct", F.lit(0))
    rate = F.when(F.col("_titled") > 0, F.col("duplicate_title_count") / F.col("_titled")).otherwise(0.0)
    four = lambda c: round_half_even(c, 4).alias(c)
    return (
        main.join(distinct, key, "left")
        .withColumn("duplicate_title_count", duplicates)
        .withColumn("duplicate_title_rate", rate)
        .withColumn("rms_fallback_rate", F.col("rms_fallback_count") / F.col("selected_count"))
        .select(
            *key, "selected_count", four("score_mean"), four("score_min"), four("score_max"), four("trim_width_mean"),
            four("trim_width_median"), "trim_width_min", "trim_width_max", "duplicate_title_count",
            four("duplicate_title_rate"), "rms_fallback_count", four("rms_fallback_rate"),
        )
    )


def compare_metrics(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Metrics of two runs side by side, one row per video and metric; a video
    missing from a run counts as 0 there."""

    def tall(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(name)) for m in METRICS])
        return df.select("vod_id", F.inline(pairs))

    return (
        tall(baseline, "baseline")
        .join(tall(candidate, "candidate"), ["vod_id", "metric"], "full")
        .fillna(0.0, ["baseline", "candidate"])
        .withColumn("delta", round_half_even(F.col("candidate") - F.col("baseline"), 4))
    )


def clip_keys(rows: DataFrame) -> DataFrame:
    """Distinct whole-second (vod_id, start_s, end_s) keys."""
    return rows.select(
        "vod_id",
        F.coalesce(F.col("start_s").cast("bigint"), F.lit(0)).alias("start_s"),
        F.coalesce(F.col("end_s").cast("bigint"), F.lit(0)).alias("end_s"),
    ).distinct()


def shared_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return clip_keys(a).intersect(clip_keys(b))


def missing_keys(baseline: DataFrame, run: DataFrame) -> DataFrame:
    return clip_keys(baseline).subtract(clip_keys(run))


def coverage(baseline: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """Share of the baseline's clip keys found in each of the other sets, per video.

    One aggregation over the union of all keys.
    """
    key = ["vod_id", "start_s", "end_s"]
    names = list(others)

    def tagged(df: DataFrame, name: str | None) -> DataFrame:
        flags = [F.lit(n == name).alias(f"_{n}") for n in names]
        return clip_keys(df).select(*key, F.lit(name is None).alias("_base"), *flags)

    union = reduce(DataFrame.unionAll, [tagged(baseline, None), *[tagged(df, n) for n, df in others.items()]])
    per_key = union.groupBy(*key).agg(
        F.max("_base").alias("_base"), *[F.max(f"_{n}").alias(f"_{n}") for n in names]
    )
    share = lambda n: round_half_even(F.count_if(F.col(f"_{n}")) / F.count(F.lit(1)), 4).alias(f"{n}_coverage")
    return (
        per_key.where("_base")
        .groupBy("vod_id")
        .agg(F.count(F.lit(1)).alias("baseline_count"), *[share(n) for n in names])
    )


def _grid(keys: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """Keys in the square cells of every level 1 to ``top`` (a cell of level k is ``FAN`` to the k wide), and the
    cells with their number of keys and bounds."""
    width = F.expr(f"shiftleft(1L, {FAN_BITS} * _k)")
    placed = keys.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(top)))).select(
        *keys.columns, "_k", F.floor(F.col("start_s") / width).alias("_cs"), F.floor(F.col("end_s") / width).alias("_ce")
    )
    cells = placed.groupBy("vod_id", "which", *_CELL).agg(
        F.count(F.lit(1)).alias("_n"), F.min("start_s").alias("s0"), F.max("start_s").alias("s1"), F.min("end_s").alias("e0"),
        F.max("end_s").alias("e1"),
    )
    return placed, cells


def _closest(frontier: DataFrame) -> DataFrame:
    """Drops the cells that are farther from their query than all of another cell."""
    near = lambda q, lo, hi: F.greatest(F.lit(0), F.col(lo) - F.col(q), F.col(q) - F.col(hi))
    far = lambda q, lo, hi: F.greatest(F.abs(F.col(q) - F.col(lo)), F.abs(F.col(q) - F.col(hi)))
    best = F.min(far("q_s", "s0", "s1") + far("q_e", "e0", "e1")).over(Window.partitionBy(*_QUERY))
    return (
        frontier.withColumn("_best", best)
        .where(near("q_s", "s0", "s1") + near("q_e", "e0", "e1") <= F.col("_best"))
        .drop("_best")
    )


def _nearest_in_lists(base: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Nearest keys in videos of at most ``LEAF`` keys a set: one row a video holds them as short lists."""
    own = lambda n: F.collect_list(F.when(F.col("which") == n, F.struct("start_s", "end_s"))).alias(f"_{n}")
    lists = keys.groupBy("vod_id").agg(*[own(n) for n in names])

    def rank(c: Column) -> Column:
        ds, de = F.abs(c["start_s"] - F.col("start_s")), F.abs(c["end_s"] - F.col("end_s"))
        return F.struct((ds + de).alias("d"), ds.alias("ds"), de.alias("de"), (-c["start_s"]).alias("s"), (-c["end_s"]).alias("e"))

    best = base.join(lists, "vod_id", "left").select(
        "vod_id", "start_s", "end_s", *[F.array_min(F.transform(f"_{n}", rank)).alias(f"_{n}") for n in names]
    )
    shown = [(-F.col(f"`_{n}`")[end]).alias(f"{n}_{name}") for n in names for name, end in (("start", "s"), ("end", "e"))]
    return best.select("vod_id", "start_s", "end_s", *shown)


def nearest_keys(missed: DataFrame, sets: dict[str, DataFrame]) -> DataFrame:
    """For each missed key the nearest key of each set, as ``<set>_start`` and ``<set>_end``.

    Nearest by the sum of both distances, then start distance, end distance,
    larger start, larger end.  Videos of few keys are searched as lists, others by a grid.
    """
    sides = [clip_keys(df).withColumn("which", F.lit(n)) for n, df in sets.items()]
    keys = checkpointed(reduce(DataFrame.unionAll, sides))
    base, names = clip_keys(missed), list(sets)
    dense = keys.groupBy("vod_id", "which").count().where(F.col("count") > LEAF).select("vod_id").distinct()
    dense = checkpointed(dense)
    if dense.isEmpty():
        return _nearest_in_lists(base, keys, names)
    base = checkpointed(base)
    few, many = (tuple(df.join(dense, "vod_id", how) for df in (base, keys)) for how in ("left_anti", "left_semi"))
    return _nearest_in_lists(*few, names).unionByName(_nearest_in_grid(*many, names))


def _nearest_in_grid(base: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Nearest keys in any video.  The search goes down a grid of (start, end) cells
    from the widest: a cell of more than ``LEAF`` keys is replaced by the cells in it, and cells that
    cannot hold the nearest key, by the bounds of their keys, are dropped.  So a query meets the keys
    of a few small cells however dense or empty its surroundings are.
    """
    widest = keys.agg(F.max(F.greatest(F.abs("start_s"), F.abs("end_s"))).alias("w")).first()["w"] or 0
    top = max(1, -(-int(widest + 1).bit_length() // FAN_BITS))
    placed, cells = _grid(keys, top)
    cells = checkpointed(cells)
    # Levels on which some cell is still to be cut.
    lowest = cells.where((F.col("_n") > LEAF) & (F.col("_k") > 1)).agg(F.min("_k").alias("k")).first()["k"] or top + 1
    box = ["_n", "s0", "s1", "e0", "e1"]
    frontier = base.select("vod_id", F.col("start_s").alias("q_s"), F.col("end_s").alias("q_e")).join(
        cells.where(F.col("_k") == top), "vod_id"
    )
    frontier = _closest(frontier.select(*_QUERY, *_CELL, *box))
    for k in range(top, lowest - 1, -1):
        inner = F.struct("_k", "_cs", "_ce", *box)
        parts = (
            cells.where(F.col("_k") == k - 1)
            .groupBy("vod_id", "which", F.floor(F.col("_cs") / FAN).alias("_ps"), F.floor(F.col("_ce") / FAN).alias("_pe"))
            .agg(F.collect_list(inner).alias("_parts"), F.sum("_n").alias("_all"))
            .where(F.col("_all") > LEAF)
            .select("vod_id", "which", F.lit(k).alias("_k"), F.col("_ps").alias("_cs"), F.col("_pe").alias("_ce"), "_parts")
        )
        cut = frontier.join(parts, ["vod_id", "which", *_CELL], "left")
        cut = cut.select(*_QUERY, F.explode(F.coalesce("_parts", F.array(inner))).alias("_c"))
        frontier = _closest(cut.select(*_QUERY, "_c.*"))
    ds, de = F.abs(F.col("start_s") - F.col("q_s")), F.abs(F.col("end_s") - F.col("q_e"))
    found = (
        frontier.select(*_QUERY, *_CELL)
        .join(placed, ["vod_id", "which", *_CELL])
        .groupBy(*_QUERY)
        .agg(F.min(F.struct((ds + de).alias("d"), ds.alias("ds"), de.alias("de"), (-F.col("start_s")).alias("s"), (-F.col("end_s")).alias("e"))).alias("b"))
    )
    nearest = found.groupBy("vod_id", "q_s", "q_e").pivot("which", names).agg(F.first("b"))
    shown = [
        (-F.col(f"`{n}`")[end]).alias(f"{n}_{name}") for n in names for name, end in (("start", "s"), ("end", "e"))
    ]
    out = nearest.select("vod_id", F.col("q_s").alias("start_s"), F.col("q_e").alias("end_s"), *shown)
    return base.join(out, ["vod_id", "start_s", "end_s"], "left")


def first_number(*paths: Column) -> Column:
    """The first of several alternative fields that is present."""
    return F.coalesce(*[p.cast("double") for p in paths])


def run_deltas(baseline: DataFrame, run: DataFrame) -> DataFrame:
    """Differences of runtime, calls and images per video, NULL where either side is unknown.

    Both: vod_id, runtime_seconds, calls, images.
    """
    b = baseline.select("vod_id", *[F.col(c).alias(f"b_{c}") for c in ("runtime_seconds", "calls", "images")])
    r = run.select("vod_id", *[F.col(c).alias(f"r_{c}") for c in ("runtime_seconds", "calls", "images")])
    whole = lambda c: F.col(c).cast("bigint")
    return b.join(r, "vod_id", "full").select(
        "vod_id",
        (whole("r_runtime_seconds") - whole("b_runtime_seconds")).alias("runtime_delta_seconds"),
        (whole("r_calls") - whole("b_calls")).alias("call_delta"),
        (whole("r_images") - whole("b_images")).alias("image_delta"),
    )
