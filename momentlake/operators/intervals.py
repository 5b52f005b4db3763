"""Interval building blocks shared by the other operators.

All of them split the time line of a video into blocks, so the work of one
very long or very busy video spreads over many tasks.  Callers first reduce
raw rows to a time grid (one row per distinct time), which a map-side partial
aggregate does before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import checkpointed, salted_lookup

BLOCK_SECONDS = 3600
# Rows that are scanned together, and the most cut points of one group of rows.
CELL_ROWS = 4096
MOST_CUTS = 256
# Groups with cut points up to which the table of cut points is broadcast.
BROADCAST_CUTS = 10_000
# Raw rows of one time bucket are spread over this many join keys.
JOIN_SALTS = 4
# Raw rows of one time bucket up to which they have one join key.
PART_ROWS = 16_384


def _salted(many: DataFrame, few: DataFrame, spread_by: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Spreads ``many`` by a hash of ``spread_by`` and repeats ``few`` to match."""
    if not spread_by:
        return many, few, []
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(JOIN_SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1)))
    return many.withColumn("_salt", salt), few.withColumn("_salt", every), ["_salt"]


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    *,
    bucket: float,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    closed: bool = False,
    keys: Sequence[str] = ("vod_id",),
    spread_right_by: Sequence[str] = (),
) -> DataFrame:
    """All pairs of intervals of one video that overlap, each pair once.

    Both sides are repeated for the time buckets they touch and joined on
    ``(keys, bucket)``; a pair is kept only in the bucket where its overlap
    begins.  ``closed`` also keeps pairs that touch in one point.  Column names
    other than ``keys`` must differ between the sides.  Raw rows on the right
    name columns in ``spread_right_by``: a hash of them spreads a busy bucket.
    """
    ls, le = map(F.col, left_span)
    rs, re_ = map(F.col, right_span)

    def spread(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
        first = F.floor(lo / bucket)
        last = F.floor(F.greatest(lo, hi) / bucket)
        return df.withColumn("_bucket", F.explode(F.sequence(first, last)))

    hit = (ls <= re_) & (rs <= le) if closed else (ls < re_) & (rs < le)
    many, few, salt = _salted(spread(right, rs, re_), spread(left, ls, le), spread_right_by)
    return (
        few.join(many, [*keys, "_bucket", *salt])
        .where(hit & (F.col("_bucket") == F.floor(F.greatest(ls, rs) / bucket)))
        .drop("_bucket", *salt)
    )


def point_join(
    points: DataFrame,
    spans: DataFrame,
    *,
    bucket: float,
    at: str,
    span: tuple[str, str],
    closed: bool = True,
    keys: Sequence[str] = ("vod_id",),
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Pairs (point, interval) with ``lo <= at <= hi`` (or ``at < hi``).

    Only the intervals are repeated over buckets; a point has one bucket.
    Points that are raw rows name columns in ``spread_by``: a hash of them
    spreads a busy bucket.
    """
    t, lo, hi = F.col(at), F.col(span[0]), F.col(span[1])
    wide = spans.withColumn(
        "_bucket", F.explode(F.sequence(F.floor(lo / bucket), F.floor(F.greatest(lo, hi) / bucket)))
    )
    inside = (t >= lo) & ((t <= hi) if closed else (t < hi))
    many, few, salt = _salted(points.withColumn("_bucket", F.floor(t / bucket)), wide, spread_by)
    return many.join(few, [*keys, "_bucket", *salt]).where(inside).drop("_bucket", *salt)


def raw_point_join(
    points: DataFrame, spans: DataFrame, *, bucket: float, at: str, span: tuple[str, str], spread_by: Sequence[str]
) -> DataFrame:
    """Pairs (point, interval) of one video with ``lo <= at <= hi`` where points are raw rows and every pair is a row.

    Only a bucket of more than ``PART_ROWS`` points is joined in parts (by a hash of ``spread_by``), so intervals are
    not repeated elsewhere.  Both sides are shuffled and merged: the pairs of a bucket outnumber its rows, so a
    broadcast would leave them to as many tasks as there are files, and its size is not known beforehand.
    """
    t, lo, hi = F.col(at), F.col(span[0]), F.col(span[1])
    place = ["vod_id", "_bucket"]
    within = F.floor(t / bucket).alias("_bucket")
    parts = F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("_parts")
    # At most one row for so many points.
    crowded = F.broadcast(points.groupBy("vod_id", within).agg(parts).where(F.col("_parts") > 1))
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce("_parts", F.lit(1)))
    many = points.withColumn("_bucket", within).join(crowded, place, "left").withColumn("_part", part).drop("_parts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1))
    touched = F.explode(F.sequence(F.floor(lo / bucket), F.floor(F.greatest(lo, hi) / bucket)))
    few = spans.withColumn("_bucket", touched).join(crowded, place, "left").withColumn("_part", every).drop("_parts")
    return many.join(few.hint("merge"), [*place, "_part"]).where((t >= lo) & (t <= hi)).drop("_bucket", "_part")


def running_max_before(
    grid: DataFrame,
    *,
    order: Sequence[str],
    value: str,
    out: str,
    keys: Sequence[str] = ("vod_id",),
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Adds the largest ``value`` of all earlier rows in ``order`` (NULL for the first).

    ``order[0]`` is a time.  Rows are scanned inside time blocks; the maximum
    of the earlier blocks comes from a table with one row per block.
    """
    block = F.floor(F.col(order[0]) / block_seconds)
    rows = grid.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_block")
        .agg(F.max(value).alias("_block_max"))
        .select(*keys, "_block", F.max("_block_max").over(over_blocks).alias("_carry"))
    )
    return (
        rows.withColumn("_local", F.max(value).over(inside))
        .join(carried, [*keys, "_block"], "left")
        # greatest() skips NULLs, so it is NULL only when nothing came before.
        .withColumn(out, F.greatest("_local", "_carry"))
        .drop("_block", "_local", "_carry")
    )


def last_marked(
    grid: DataFrame,
    *,
    order: str,
    value: Column,
    out: str,
    keys: Sequence[str] = ("vod_id",),
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Adds the latest non-NULL ``value`` at or before each row (values must grow with time)."""
    rows = grid.withColumn("_mark", value).withColumn("_block", F.floor(F.col(order) / block_seconds))
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    over_blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_block")
        .agg(F.max("_mark").alias("_block_mark"))
        .select(*keys, "_block", F.max("_block_mark").over(over_blocks).alias("_carry"))
    )
    return (
        rows.withColumn("_local", F.max("_mark").over(inside))
        .join(carried, [*keys, "_block"], "left")
        .withColumn(out, F.greatest("_local", "_carry"))
        .drop("_mark", "_block", "_local", "_carry")
    )


def _number(rows: DataFrame, name: str) -> Column:
    """A number in the order of a column: itself, or the first seven bytes of a text."""
    if dict(rows.dtypes)[name] != "string":
        return F.col(name)
    head = F.hex(F.substring(F.encode(name, "utf-8"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("bigint")


def _cuts(rows: DataFrame, group: Sequence[str], x: Column) -> DataFrame:
    """Cut points of every group of more than ``CELL_ROWS`` rows, about one per so many rows, from a
    quantile sketch of ``x``; ``_dense`` are the values that fill a cell by themselves."""
    fractions = [i / MOST_CUTS for i in range(1, MOST_CUTS)]
    sketch = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(x, fractions, 8 * MOST_CUTS).alias("_p")
    )
    stride = F.greatest(F.lit(1), F.floor(F.lit(MOST_CUTS * CELL_ROWS) / F.col("_n")))
    points = sketch.where(F.col("_n") > CELL_ROWS).select(
        *group, F.filter("_p", lambda _, i: (i + 1) % stride == 0).alias("_p")
    )
    repeated = F.filter("_p", lambda v, i: (i > 0) & (v == F.get(F.col("_p"), i - 1)))
    return points.select(*group, F.array_distinct("_p").alias("_cuts"), F.array_distinct(repeated).alias("_dense"))


def celled(rows: DataFrame, *, order: Sequence[str], block: Column, keys: Sequence[str] = ("vod_id",)) -> DataFrame:
    """Adds ``_block`` and ``_cell``, which does not decrease in ``order``: parts of a block with some
    ``CELL_ROWS`` rows (a ``MOST_CUTS``-th of a block of more).

    Cut points come from sketches of the first column, and for values of it that fill a cell from
    sketches of the next one, so one busy second is cut like a busy hour.  Where every block is
    small a block is one cell and rows are joined with nothing.  Rows are read several times, so they are written first.
    """
    rows = checkpointed(rows)
    # A struct, for a null time is a block as well.
    out, path, dense = rows.withColumn("_block", F.struct(block.alias("_at"))), [], None
    largest = out.groupBy(*keys, "_block").count().agg(F.max("count").alias("n")).first()["n"] or 0
    for level, name in enumerate(order if largest > CELL_ROWS else ()):
        x, group = _number(rows, name), [*keys, "_block", *path]
        cuts = checkpointed(_cuts(out if dense is None else out.where(dense), group, x))
        found = cuts.limit(BROADCAST_CUTS + 1).count()
        if not found:
            break
        if found <= BROADCAST_CUTS:
            out = out.join(F.broadcast(cuts), group, "left")
        else:
            out = salted_lookup(out, cuts, group, spread_by=order)
        below = F.size(F.filter("_cuts", lambda c: c < x)) + F.size(F.filter("_cuts", lambda c: c <= x))
        path.append(f"_cell_{level}")
        out = out.withColumn(path[-1], F.when(F.col("_cuts").isNotNull(), below).otherwise(0))
        out = out.withColumn(f"_dense_{level}", F.coalesce(F.array_contains("_dense", x), F.lit(False))).drop("_cuts", "_dense")
        dense = F.col(f"_dense_{level}")
        if cuts.where(F.size("_dense") > 0).isEmpty():
            break
    cell = F.struct("_block", *path).alias("_cell")
    return out.select(*rows.columns, "_block", cell)


def neighbour(
    rows: DataFrame,
    *,
    order: Sequence[str],
    block: Column,
    take: Sequence[str],
    out: str,
    following: bool = False,
    keys: Sequence[str] = ("vod_id",),
) -> DataFrame:
    """Adds a struct of the ``take`` columns of the previous (or following) row.

    Same as ``lag``/``lead`` over the whole video.  Rows are scanned inside cells
    (see :func:`celled`), so that all rows of one second are many tasks; cells, one row
    each, inside blocks; and blocks over the video.  ``block`` must not decrease
    in ``order``, whose columns together tell rows apart.  The
    first row of a cell gets the edge row of the nearest cell before it.
    """
    tagged = celled(rows, order=order, block=block, keys=keys)
    payload, at = F.struct(*take), F.struct(*order)
    beside, edge = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    local = beside(payload).over(Window.partitionBy(*keys, "_cell").orderBy(*order))
    cells = tagged.groupBy(*keys, "_block", "_cell").agg(edge(payload, at).alias("_edge"))
    blocks = cells.groupBy(*keys, "_block").agg(edge("_edge", F.col("_cell")).alias("_last"))
    far = blocks.select(*keys, "_block", beside("_last").over(Window.partitionBy(*keys).orderBy("_block")).alias("_far"))
    near = beside("_edge").over(Window.partitionBy(*keys, "_block").orderBy("_cell"))
    carried = (
        cells.withColumn("_near", near)
        .join(far, [*keys, "_block"], "left")
        .select(*keys, "_cell", F.coalesce("_near", "_far").alias("_carry"))
    )
    return (
        tagged.withColumn("_local", local)
        .join(carried, [*keys, "_cell"], "left")
        .withColumn(out, F.coalesce("_local", "_carry"))
        .drop("_cell", "_block", "_local", "_carry")
    )


def sliding_windows(
    videos: DataFrame, window_seconds: int, step_seconds: int, duration: str = "duration_s"
) -> DataFrame:
    """Windows ``[start, min(start + window, duration)]`` from 0 by ``step``,
    ending with the first window that reaches the end of the video."""
    w, s = max(1, int(window_seconds)), max(1, int(step_seconds))
    d = F.col(duration)
    # Index of the first window that reaches the end, and of the last one that starts in time.
    reaches = F.greatest(F.lit(0), F.ceil((d - w) / s))
    starts_in_time = F.ceil(d / s) - 1
    last = F.least(reaches, starts_in_time)
    return (
        videos.where(d > 0)
        .withColumn("window_index", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
        .withColumn("start_s", F.col("window_index") * s)
        .withColumn("end_s", F.least(F.col("start_s") + w, d))
    )


def coverage_windows(
    videos: DataFrame, window_seconds: int, step_seconds: int, duration: str = "duration_s"
) -> DataFrame:
    """Full-length windows by ``step`` plus one aligned with the tail of the video."""
    w, s = max(10, int(window_seconds)), max(1, int(step_seconds))
    total = F.ceil(F.col(duration)).cast("bigint")
    upper = F.greatest(F.lit(0).cast("bigint"), total - w)
    starts = F.array_union(F.sequence(F.lit(0).cast("bigint"), upper, F.lit(s).cast("bigint")), F.array(upper))
    return (
        videos.where(F.col(duration) > 0)
        .withColumn("start_s", F.explode(starts))
        .withColumn("end_s", F.least(F.col("start_s") + w, total))
    )


def overlapping_chunks(
    videos: DataFrame,
    *,
    chunk_seconds: int = 600,
    overlap_seconds: int = 60,
    vod_start: str = "vod_start",
    vod_end: str = "vod_end",
) -> DataFrame:
    """Chunks of ``chunk_seconds`` that overlap their successor.

    A last chunk may lie wholly inside the one before it; it is kept.
    """
    size = max(1, int(chunk_seconds))
    step = size - max(0, int(overlap_seconds))
    step = size if step <= 0 else step
    first = F.col(vod_start)
    last = F.greatest(F.col(vod_end), first + 1)
    return videos.select(
        "*", F.posexplode(F.sequence(first, last - 1, F.lit(step).cast("bigint"))).alias("chunk_index", "chunk_start")
    ).withColumn("chunk_end", F.least(F.col("chunk_start") + size, last))


def scenes_from_cuts(cuts: DataFrame, tail_seconds: int = 300) -> DataFrame:
    """Cut times to scene intervals: a scene ends at the next cut, the last one
    after ``tail_seconds``.  ``scene_index`` counts from 0 in time order."""
    hour = F.floor(F.col("t") / BLOCK_SECONDS)
    followed = neighbour(cuts, order=["t", "pos"], block=hour, take=["t"], out="_next", following=True)
    return (
        numbered(followed, order=["t", "pos"], block=hour, out="scene_index")
        .withColumn("end_s", F.coalesce("_next.t", F.col("t") + tail_seconds))
        .withColumnRenamed("t", "start_s")
        .withColumn("duration_s", F.col("end_s") - F.col("start_s"))
        .drop("_next")
    )


def surrounding_times(
    points: DataFrame, marks: DataFrame, *, block_seconds: int = BLOCK_SECONDS, keys: Sequence[str] = ("vod_id",)
) -> DataFrame:
    """For each distinct point ``(keys, t)`` the nearest mark at or before
    (``prev_mark``) and at or after it (``next_mark``), NULL where there is none.

    Both tables have a time column ``t``.  Points and marks meet on one grid of
    distinct times, scanned block by block.
    """
    grid = (
        points.select(*keys, "t", F.lit(0).alias("_m"), F.lit(1).alias("_p"))
        .unionByName(marks.select(*keys, "t", F.lit(1).alias("_m"), F.lit(0).alias("_p")))
        .groupBy(*keys, "t")
        .agg(F.max("_m").alias("_m"), F.max("_p").alias("_p"))
    )
    here = F.when(F.col("_m") == 1, F.col("t"))
    before = last_marked(grid, order="t", value=here, out="prev_mark", keys=keys, block_seconds=block_seconds)
    mirrored = before.withColumn("_neg", -F.col("t"))
    after = last_marked(
        mirrored, order="_neg", value=F.when(F.col("_m") == 1, F.col("_neg")), out="_next", keys=keys,
        block_seconds=block_seconds,
    )
    return after.where(F.col("_p") == 1).select(*keys, "t", "prev_mark", (-F.col("_next")).alias("next_mark"))


def numbered(
    rows: DataFrame, *, order: Sequence[str], block: Column, out: str, keys: Sequence[str] = ("vod_id",)
) -> DataFrame:
    """Row numbers from 0 per key in ``order``, counted inside cells, plus
    the sizes of the earlier cells and blocks; see :func:`neighbour` for ``order`` and ``block``."""
    tagged = celled(rows, order=order, block=block, keys=keys)
    before = lambda name, *over: F.coalesce(
        F.sum(name).over(Window.partitionBy(*over[:-1]).orderBy(over[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    cells = tagged.groupBy(*keys, "_block", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    blocks = cells.groupBy(*keys, "_block").agg(F.sum("_n").alias("_m"))
    starts = blocks.select(*keys, "_block", before("_m", *keys, "_block").alias("_start"))
    offsets = (
        cells.withColumn("_offset", before("_n", *keys, "_block", "_cell"))
        .join(starts, [*keys, "_block"])
        .select(*keys, "_cell", (F.col("_offset") + F.col("_start")).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*order)) - 1
    return (
        tagged.withColumn("_inside", inside)
        .join(offsets, [*keys, "_cell"])
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_cell", "_block", "_inside", "_offset")
    )
