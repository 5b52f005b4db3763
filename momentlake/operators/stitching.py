"""Stitching neighbouring discoveries into story arcs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_half_even, safe_double
from ..runtime import checkpointed
from .intervals import CELL_ROWS, last_marked, numbered, running_max_before

MAX_GAP, MAX_BRIDGE_GAP, MIN_SHARED = 20, 45, 2
MAX_SPAN, MAX_MEMBERS = 240, 2
# Edges that are decided together, and those up to which a whole video is one cell.
CELL_EDGES, VIDEO_EDGES = 512, 64
# Seconds of a bucket of the join of pairs, and candidates of one that are joined together.
PAIR_SECONDS, PAIR_ROWS = 300, 1024
# Lists that are merged side by side on one level of a scan.
SCAN = 64

# Words that do not tie two stories together.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "to", "of", "in", "on", "for", "with", "is", "it", "this", "that", "she", "he",
    "they", "you", "chat", "streamer", "from", "at", "as", "be", "was", "are", "were", "what", "when", "why",
)
NO_EVIDENCE = "No direct evidence provided by model output"
NO_TRIGGER = "Model did not provide explicit trigger"
NO_PAYOFF = "Model did not provide explicit payoff"


def discoveries(analyses: DataFrame) -> DataFrame:
    """Discovery rows from clip analyses.

    ``analyses``: vod_id, pos, start_s, end_s, narrative_type, narrative_arc,
    reason, trigger, payoff, has_payoff (boolean), clip_point, confidence,
    clip_worthiness (text or numbers).  Without a payoff text the flag itself
    is shown.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    start = F.coalesce(F.col("start_s").cast("bigint"), F.lit(0).cast("bigint"))
    point = F.trim(F.coalesce("clip_point", F.lit("")))
    evidence = F.array_compact(
        F.array(
            filled("reason"),
            F.concat(F.lit("narrative_arc: "), filled("narrative_arc")),
            F.when(point != "", F.concat(F.lit("clip_point: "), point)),
        )
    )
    worth = safe_double("clip_worthiness")
    derived = F.when(worth <= 0, 0.3).otherwise(F.least(F.lit(1.0), worth / 10.0))
    stated = F.greatest(F.lit(0.0), F.least(F.lit(1.0), safe_double("confidence")))
    return analyses.select(
        "vod_id",
        "pos",
        F.concat(F.lit("cand_"), start.cast("string")).alias("candidate_id"),
        start.alias("start_s"),
        F.coalesce(F.col("end_s").cast("bigint"), start).alias("end_s"),
        F.coalesce(filled("narrative_type"), F.lit("unknown")).alias("narrative_type"),
        F.coalesce(filled("trigger"), F.lit(NO_TRIGGER)).alias("trigger"),
        F.coalesce(filled("payoff"), F.when(F.col("has_payoff"), "True"), F.lit(NO_PAYOFF)).alias("payoff"),
        F.when(F.size(evidence) > 0, evidence).otherwise(F.array(F.lit(NO_EVIDENCE))).alias("evidence_lines"),
        round_half_even(F.when(F.col("confidence").isNotNull(), stated).otherwise(derived), 4).alias("confidence"),
    )


def _best_before(lists: DataFrame, at: str, top: int, levels: int) -> DataFrame:
    """Adds ``_before``: the ``top`` items of all earlier lists (sorted, of at most ``top`` items) of the video.

    A scan as a tree: rows are merged with earlier ones inside blocks of ``SCAN`` values of ``at``, by steps that double,
    and blocks in the same way one level higher.  No list is ever longer than ``top``.
    """
    merged = lambda *x: F.slice(F.array_sort(F.flatten(F.array_compact(F.array(*x)))), 1, top)
    rows = lists.withColumn("_up", F.floor(F.col(at) / SCAN))
    inside = Window.partitionBy("vod_id", "_up").orderBy(at)
    scanned, step = rows.withColumn("_sum", F.col("_top")), 1
    while step < SCAN:
        scanned = scanned.withColumn("_sum", merged(F.col("_sum"), F.lag("_sum", step).over(inside)))
        step *= 2
    scanned = scanned.withColumn("_near", F.lag("_sum", 1).over(inside)).drop("_sum")
    if levels <= 1:
        return scanned.withColumn("_before", merged(F.col("_near"))).drop("_near", "_up")
    whole = F.slice(F.array_sort(F.flatten(F.collect_list("_top"))), 1, top)
    above = rows.groupBy("vod_id", "_up").agg(whole.alias("_top")).withColumnRenamed("_up", f"{at}_up")
    far = _best_before(above, f"{at}_up", top, levels - 1)
    far = far.select("vod_id", F.col(f"{at}_up").alias("_up"), F.col("_before").alias("_far"))
    return scanned.join(far, ["vod_id", "_up"]).withColumn("_before", merged(F.col("_near"), F.col("_far"))).drop("_near", "_far", "_up")


def running_context(found: DataFrame, top: int = 5, sure: float = 0.7) -> DataFrame:
    """After each batch: rows so far, rows at or above ``sure`` and the ``top`` most
    confident ones.  ``found``: vod_id, pos, batch (a whole number), candidate_id, confidence.

    Rows are first reduced to one per batch with its own top list; those lists
    are merged by a scan of bounded lists.
    """
    best = Window.partitionBy("vod_id", "batch").orderBy(F.desc("confidence"), "pos")
    item = F.struct((-F.col("confidence")).alias("neg"), "pos", "candidate_id")
    tops = (
        found.withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") <= top)
        .groupBy("vod_id", "batch")
        .agg(F.array_sort(F.collect_list(item)).alias("_top"))
    )
    ends = found.agg(F.min("batch").alias("a"), F.max("batch").alias("b")).first()
    lowest, span = ends["a"] or 0, (ends["b"] or 0) - (ends["a"] or 0)
    levels = 1
    while SCAN**levels <= span:
        levels += 1
    ranked = _best_before(tops.withColumn("_at", F.col("batch") - lowest), "_at", top, levels).drop("_at")
    counts = found.groupBy("vod_id", "batch").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("confidence") >= sure).alias("_sure")
    )
    names = F.transform(F.slice(F.array_sort(F.concat("_top", "_before")), 1, top), lambda x: x["candidate_id"])
    so_far = Window.partitionBy("vod_id").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return counts.join(ranked, ["vod_id", "batch"]).select(
        "vod_id",
        "batch",
        F.sum("_n").over(so_far).alias("analysed"),
        F.sum("_sure").over(so_far).alias("confident"),
        names.alias("top_candidates"),
    )


def story_tokens(*texts: Column) -> Column:
    """Distinct words of at least three letters without stop words."""
    # Found as matches: cheaper than a split at everything else.
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", *texts)), F.lit("[a-z0-9']{3,}"), 0)
    return F.array_except(words, F.array(*[F.lit(w) for w in STOP_WORDS if len(w) > 2]))


def _met(left: DataFrame, right: DataFrame, starts: DataFrame) -> DataFrame:
    """Pairs of a left candidate and a right one that starts from its start to its ``_reach``.

    Only a bucket in which more than ``PAIR_ROWS`` candidates start is joined in parts, so that rows with
    their words are not repeated elsewhere.  ``starts``: vod_id, r_start_s of every candidate.
    """
    at = F.floor(F.col("r_start_s") / PAIR_SECONDS).alias("_bucket")
    parts = F.ceil(F.count(F.lit(1)) / PAIR_ROWS).alias("_parts")
    # At most one row for so many candidates.
    crowded = F.broadcast(starts.groupBy("vod_id", at).agg(parts).where(F.col("_parts") > 1))
    part = F.pmod(F.xxhash64("r_pos"), F.coalesce("_parts", F.lit(1)))
    many = right.withColumn("_bucket", at).join(crowded, ["vod_id", "_bucket"], "left").withColumn("_part", part).drop("_parts")
    lo, hi = (F.floor(F.col(c) / PAIR_SECONDS) for c in ("l_start_s", "_reach"))
    few = left.withColumn("_bucket", F.explode(F.sequence(lo, F.greatest(lo, hi)))).join(crowded, ["vod_id", "_bucket"], "left")
    few = few.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    inside = F.col("r_start_s").between(F.col("l_start_s"), F.col("_reach"))
    return many.join(few, ["vod_id", "_bucket", "_part"]).where(inside).drop("_bucket", "_part")


def stitch_pairs(
    candidates: DataFrame,
    *,
    max_gap: int = MAX_GAP,
    min_shared: int = MIN_SHARED,
    max_bridge_gap: int = MAX_BRIDGE_GAP,
    mergeable: bool = False,
) -> DataFrame:
    """Every pair of candidates at most ``max_bridge_gap`` seconds apart with its
    merge score, decision and reasons; with ``mergeable`` only pairs that could merge: of one type, or near.

    ``candidates``: vod_id, pos, candidate_id, start_s, end_s, narrative_type,
    trigger, payoff, evidence_lines.  The left one comes first by start, end
    and pos.
    """
    tokens = story_tokens(
        F.coalesce("trigger", F.lit("")), F.coalesce("payoff", F.lit("")), F.coalesce("narrative_type", F.lit("")),
        F.concat_ws(" ", "evidence_lines"),
    )
    kind = F.coalesce(F.when(F.col("narrative_type") != "", F.col("narrative_type")), F.lit("unknown"))
    rows = candidates.select("vod_id", "pos", "candidate_id", "start_s", "end_s", kind.alias("kind"), tokens.alias("tok"))
    left = rows.select("vod_id", *[F.col(c).alias(f"l_{c}") for c in rows.columns if c != "vod_id"]).withColumn(
        "_reach", F.col("l_end_s") + max_bridge_gap
    )
    right = rows.select("vod_id", *[F.col(c).alias(f"r_{c}") for c in rows.columns if c != "vod_id"])
    later = F.struct("r_start_s", "r_end_s", "r_pos") > F.struct(
        F.col("l_start_s").alias("r_start_s"), F.col("l_end_s").alias("r_end_s"), F.col("l_pos").alias("r_pos")
    )
    gap = F.col("r_start_s") - F.col("l_end_s")
    same_kind = F.col("l_kind") == F.col("r_kind")
    n = F.col("shared_count")
    near, bridge = F.col("gap_s") <= max_gap, F.col("gap_s") <= max_bridge_gap
    score = (
        F.when(near, 2).when(bridge, 1).otherwise(0)
        + F.when(F.col("type_match"), 2).otherwise(0)
        + F.when(n >= min_shared, 2).when(n > 0, 1).otherwise(0)
    )
    shown = F.array_join("shared_tokens", ",")
    reasons = F.array_compact(
        F.array(
            F.when(near, f"temporal_gap<={max_gap}").when(bridge, f"temporal_bridge_gap<={max_bridge_gap}"),
            F.when(F.col("type_match"), F.concat(F.lit("narrative_type_match:"), F.col("l_kind"))),
            F.when(n >= min_shared, F.concat(F.lit("shared_tokens:"), shown)).when(
                n > 0, F.concat(F.lit("weak_shared_tokens:"), shown)
            ),
        )
    )
    met = _met(left, right, candidates.select("vod_id", F.col("start_s").alias("r_start_s"))).where(later)
    if mergeable:
        # Any other pair is left before its words are compared: it has three points at most.
        met = met.where(same_kind | (gap <= max_gap))
    return (
        # Exploded, words are compared once a pair: a filter on what follows from them stays above.
        met.withColumn("_shared", F.explode(F.array(F.array_intersect("l_tok", "r_tok"))))
        .withColumn("gap_s", gap)
        .withColumn("type_match", same_kind)
        .withColumn("shared_tokens", F.array_sort("_shared"))
        .withColumn("shared_count", F.size("_shared"))
        .withColumn("score", score)
        .withColumn("strict_rule", near & (F.col("type_match") | (n >= min_shared)))
        .withColumn("graph_rule", bridge & (F.col("score") >= 4))
        .withColumn("merged", F.col("strict_rule") | F.col("graph_rule"))
        .withColumn("reasons", reasons)
        .drop("l_tok", "r_tok", "_reach", "l_kind", "r_kind", "_shared")
    )


def _edge_rank() -> Column:
    """Order of the edges of a video: score falling, then gap, left and right candidate."""
    return F.struct(
        (-F.col("score")).cast("bigint").alias("worse"), F.col("gap_s").cast("bigint").alias("gap_s"),
        *[F.col(f"{s}_{c}").cast("bigint").alias(f"{s}_{c}") for s in "lr" for c in ("start_s", "end_s", "pos")],
    )


def _edge_cells(edges: DataFrame, cell_edges: int) -> DataFrame:
    """Adds ``cell`` and ``alone``: edges that share a candidate lie in one island of time, and an
    island of at most ``cell_edges`` edges is a cell, on which no edge outside bears.  A larger island is cut by
    counts of edges, and a second of more edges by a hash of the left candidate."""
    grid = edges.groupBy("vod_id", F.col("rank.l_start_s").alias("l_start_s")).agg(
        F.max("rank.r_start_s").alias("_reach"), F.count(F.lit(1)).alias("_n")
    )
    grid = running_max_before(grid, order=["l_start_s"], value="_reach", out="_before")
    opens = F.col("_before").isNull() | (F.col("l_start_s") > F.col("_before"))
    grid = last_marked(grid, order="l_start_s", value=F.when(opens, F.col("l_start_s")), out="_island")
    island = Window.partitionBy("vod_id", "_island")
    earlier = F.sum("_n").over(island.orderBy("l_start_s")) - F.col("_n")
    cut = grid.select(
        "vod_id", "l_start_s", "_island", (F.sum("_n").over(island) <= cell_edges).alias("alone"),
        F.floor(earlier / cell_edges).alias("_slice"), F.ceil(F.col("_n") / cell_edges).alias("_parts"),
    )
    part = F.pmod(F.xxhash64("rank.l_pos"), F.col("_parts"))
    where = F.when(F.col("alone"), F.struct(F.lit(0).cast("bigint").alias("_slice"), F.lit(0).cast("bigint").alias("_part")))
    return (
        edges.withColumn("l_start_s", F.col("rank.l_start_s"))
        .join(cut, ["vod_id", "l_start_s"])
        .withColumn("cell", F.struct("_island", where.otherwise(F.struct("_slice", part.alias("_part"))).alias("at")))
        .drop("l_start_s", "_island", "_slice", "_parts")
    )


def _outside(live: DataFrame) -> DataFrame:
    """Adds to each edge the best open edge of its groups in other cells (``l_ext``, ``r_ext``)."""
    touch = live.select("vod_id", "cell", "rank", F.explode(F.array("l.g", "r.g")).alias("g"))
    best = touch.groupBy("vod_id", "g", "cell").agg(F.min("rank").alias("best"))
    group = Window.partitionBy("vod_id", "g")
    ranked = best.withColumn("_r", F.row_number().over(group.orderBy("best")))
    first = F.min(F.when(F.col("_r") == 1, F.col("best"))).over(group)
    second = F.min(F.when(F.col("_r") == 2, F.col("best"))).over(group)
    ext = ranked.select("vod_id", "g", "cell", F.when(F.col("_r") == 1, second).otherwise(first).alias("ext"))
    ext = ext.where(F.col("ext").isNotNull())
    for s in "lr":
        named = ext.select("vod_id", "cell", F.col("g").alias(f"_{s}"), F.col("ext").alias(f"{s}_ext"))
        live = live.withColumn(f"_{s}", F.col(f"{s}.g")).join(named, ["vod_id", "cell", f"_{s}"], "left").drop(f"_{s}")
    return live


def _settled(live: DataFrame, max_span: int, max_members: int) -> DataFrame:
    """Decides the edges of each cell, best first, as far as the cell can: (won, open, groups).

    An edge waits if a better open one touches one of its groups, be it in another cell or
    before it here; all else is as in a scan over the whole video.
    """
    rank = live.schema["rank"].dataType.simpleString()
    side = "struct<g:bigint,lo:bigint,hi:bigint,n:bigint>"
    edge_type = f"struct<rank:{rank},l:{side},r:{side},l_ext:{rank},r_ext:{rank}>"
    group_type = f"struct<of:array<bigint>,lo:bigint,hi:bigint,n:bigint,ext:{rank},waits:boolean>"
    none = lambda t: F.array().cast(f"array<{t}>")
    state = lambda groups, won, left: F.struct(groups.alias("groups"), won.alias("won"), left.alias("open"))

    def group(of: Column, lo: Column, hi: Column, n: Column, ext: Column, waits: Column) -> Column:
        return F.struct(
            of.alias("of"), lo.alias("lo"), hi.alias("hi"), n.alias("n"), ext.alias("ext"), waits.alias("waits")
        ).cast(group_type)

    def step(s: Column, e: Column) -> Column:
        def found(end: str) -> Column:
            own = e[end]
            fresh = group(F.array(own["g"]), own["lo"], own["hi"], own["n"], e[f"{end}_ext"], F.lit(False))
            return F.coalesce(F.get(F.filter(s["groups"], lambda x: F.array_contains(x["of"], own["g"])), 0), fresh)

        def decide(pair: Column) -> Column:
            a, b = pair["a"], pair["b"]
            lo, hi, n = F.least(a["lo"], b["lo"]), F.greatest(a["hi"], b["hi"]), a["n"] + b["n"]
            possible = ~F.array_contains(a["of"], e["r"]["g"]) & (n <= max_members) & (hi - lo <= max_span)
            better = lambda x: F.coalesce(x["ext"] < e["rank"], F.lit(False))
            waits = a["waits"] | b["waits"] | better(a) | better(b)
            rest = F.filter(
                s["groups"], lambda x: ~F.array_contains(x["of"], e["l"]["g"]) & ~F.array_contains(x["of"], e["r"]["g"])
            )
            stuck = [group(x["of"], x["lo"], x["hi"], x["n"], x["ext"], F.lit(True)) for x in (a, b)]
            joined = group(F.concat(a["of"], b["of"]), lo, hi, n, F.least(a["ext"], b["ext"]), F.lit(False))
            return (
                F.when(~possible, s)
                .when(waits, state(F.concat(rest, F.array(*stuck)), s["won"], F.concat(s["open"], F.array(e))))
                .otherwise(state(F.concat(rest, F.array(joined)), F.concat(s["won"], F.array(e["rank"])), s["open"]))
            )

        pair = F.struct(found("l").alias("a"), found("r").alias("b"))
        return F.get(F.transform(F.array(pair), decide), 0)

    edge = F.struct("rank", "l", "r", "l_ext", "r_ext").cast(edge_type)
    ordered = live.groupBy("vod_id", "cell", "alone").agg(F.array_sort(F.collect_list(edge)).alias("_edges"))
    start = state(none(group_type), none(rank), none(edge_type))
    return ordered.select("vod_id", "cell", "alone", F.aggregate("_edges", start, step).alias("s")).select(
        "vod_id", "cell", "alone", "s.won", "s.open", F.filter("s.groups", lambda x: F.size(x["of"]) > 1).alias("groups")
    )


def stitch_groups(
    pairs: DataFrame, *, max_span: int = MAX_SPAN, max_members: int = MAX_MEMBERS, cell_edges: int = CELL_EDGES
) -> tuple[DataFrame, DataFrame] | None:
    """Groups of stitched candidates and the edges that joined them.

    Equals taking the mergeable pairs of a video one by one, best first, and
    joining two groups if the result spans at most ``max_span`` seconds and has
    at most ``max_members`` members.  Videos of few edges and islands of time are settled in one round, side by side; parts of a
    large island in rounds, each of which accepts every edge that no better open edge can affect.  Returns ``(members, edges)`` with
    ``members``: vod_id, pos, group_pos; None if no pair may merge.
    """
    span_ok = F.greatest("l_end_s", "r_end_s") - F.least("l_start_s", "r_start_s") <= max_span
    edges = checkpointed(
        pairs.where(F.col("merged") & span_ok).select("vod_id", "l_pos", "r_pos", _edge_rank().alias("rank"), "reasons")
    )
    if max_members < 2 or edges.isEmpty():
        return None
    side = lambda s: F.struct(
        F.col(f"rank.{s}_pos").alias("g"), F.col(f"rank.{s}_start_s").alias("lo"), F.col(f"rank.{s}_end_s").alias("hi"),
        F.lit(1).cast("bigint").alias("n"),
    )
    ranks = edges.select("vod_id", "rank")
    few_edges = min(cell_edges, VIDEO_EDGES)
    busy = checkpointed(ranks.groupBy("vod_id").count().where(F.col("count") > few_edges).select("vod_id"))
    no_place = F.lit(0).cast("bigint")
    whole = F.struct(no_place.alias("_island"), F.struct(no_place.alias("_slice"), no_place.alias("_part")).alias("at"))
    nothing = F.lit(None).cast(edges.schema["rank"].dataType)
    sides, unknown = {"l": side("l"), "r": side("r")}, {"l_ext": nothing, "r_ext": nothing}
    crowded = not busy.isEmpty()
    known = ranks.join(busy, "vod_id", "left_anti") if crowded else ranks
    known = known.withColumns({"alone": F.lit(True), "cell": whole, **sides, **unknown})
    if crowded:
        # Only videos of many edges are cut.
        live = checkpointed(_edge_cells(ranks.join(busy, "vod_id", "left_semi"), cell_edges).withColumns(sides))
        known = known.unionByName(live.where("alone").withColumns(unknown))
        parts = live.where("not alone")
        if not parts.isEmpty():
            known = known.unionByName(_outside(parts))
    settled = checkpointed(_settled(known, max_span, max_members))
    won, moved = [], []
    while True:
        won.append(settled.select("vod_id", F.explode("won").alias("rank")))
        group = settled.select("vod_id", F.explode("groups").alias("_g"))
        moves = group.select(
            "vod_id", F.explode("_g.of").alias("group_pos"), F.array_min("_g.of").alias("to"), F.col("_g.lo").alias("lo"),
            F.col("_g.hi").alias("hi"), F.col("_g.n").alias("n"),
        )
        moved.append(moves)
        left = settled.select("vod_id", "cell", "alone", F.explode("open").alias("e")).select(
            "vod_id", "cell", "alone", "e.rank", "e.l", "e.r"
        )
        if left.isEmpty():
            break
        for s in "lr":
            now = moves.select("vod_id", F.col("group_pos").alias("_g"), F.struct(F.col("to").alias("g"), "lo", "hi", "n").alias("_now"))
            left = left.withColumn("_g", F.col(f"{s}.g")).join(now, ["vod_id", "_g"], "left")
            left = left.withColumn(s, F.coalesce("_now", s)).drop("_g", "_now")
        fits = (
            (F.col("l.g") != F.col("r.g"))
            & (F.col("l.n") + F.col("r.n") <= max_members)
            & (F.greatest("l.hi", "r.hi") - F.least("l.lo", "r.lo") <= max_span)
        )
        settled = checkpointed(_settled(_outside(left.where(fits)), max_span, max_members))
    accepted = reduce(DataFrame.unionAll, won).select("vod_id", F.col("rank.l_pos").alias("l_pos"), F.col("rank.r_pos").alias("r_pos"))
    members = moved[0].select("vod_id", F.col("group_pos").alias("pos"), F.col("to").alias("group_pos"))
    for moves in moved[1:]:
        # Groups of candidates that were alone before, and groups that were joined again.
        again = moves.select("vod_id", "group_pos", "to")
        members = members.join(again, ["vod_id", "group_pos"], "full")
        members = checkpointed(members.select("vod_id", F.coalesce("pos", "group_pos").alias("pos"), F.coalesce("to", "group_pos").alias("group_pos")))
    return members, edges.join(accepted, ["vod_id", "l_pos", "r_pos"])


def stitch(
    candidates: DataFrame,
    *,
    max_gap: int = MAX_GAP,
    min_shared: int = MIN_SHARED,
    max_bridge_gap: int = MAX_BRIDGE_GAP,
    max_span: int = MAX_SPAN,
    max_members: int = MAX_MEMBERS,
) -> DataFrame:
    """Story arcs: stitched groups and the candidates left alone.

    An arc covers its members; its type is their most frequent one, its trigger
    and payoff those of the member with the highest ``worthiness`` (the first
    one if the column is missing).
    """
    pairs = stitch_pairs(
        candidates, max_gap=max_gap, min_shared=min_shared, max_bridge_gap=max_bridge_gap, mergeable=True
    )
    result = stitch_groups(pairs, max_span=max_span, max_members=max_members)
    key = ["vod_id", "group_pos"]
    if result is None:
        grouped = candidates.withColumn("group_pos", F.col("pos"))
        reasons = None
    else:
        members, edges = result
        grouped = candidates.join(members, ["vod_id", "pos"], "left").withColumn(
            "group_pos", F.coalesce("group_pos", "pos")
        )
        reasons = (
            edges.join(members.withColumnRenamed("pos", "l_pos"), ["vod_id", "l_pos"])
            .groupBy(*key)
            .agg(F.array_sort(F.collect_list(F.struct("rank", "reasons"))).alias("_e"))
            .select(*key, F.array_distinct(F.flatten(F.col("_e.reasons"))).alias("merge_reasons"))
        )
    kind = F.coalesce(F.when(F.col("narrative_type") != "", F.col("narrative_type")), F.lit("unknown"))
    worth = safe_double("worthiness") if "worthiness" in candidates.columns else F.lit(0.0)
    member = F.struct(
        "start_s", "end_s", "pos", "candidate_id", kind.alias("kind"), worth.alias("worth"), "trigger", "payoff",
        "evidence_lines", F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )
    arcs = grouped.groupBy(*key).agg(F.array_sort(F.collect_list(member)).alias("m"))
    m = F.col("m")
    of = lambda name: F.transform(m, lambda x: x[name])
    kinds = of("kind")
    tally = F.transform(
        F.array_distinct(kinds), lambda k: F.struct(F.size(F.filter(kinds, lambda x: x == k)).alias("n"), k.alias("k"))
    )
    top_kind = F.get(F.filter(tally, lambda t: t["n"] == F.array_max(F.transform(tally, lambda x: x["n"]))), 0)["k"]
    best = F.get(F.filter(m, lambda x: x["worth"] == F.array_max(of("worth"))), 0)
    lines = F.transform(F.flatten(F.transform(m, lambda x: F.coalesce(x["evidence_lines"], F.array().cast("array<string>")))), lambda x: F.trim(x))
    evidence = F.array_distinct(F.filter(lines, lambda x: x != ""))
    filled = lambda c, d: F.coalesce(F.when(c != "", c), F.lit(d))
    arcs = arcs.select(
        *key,
        F.array_min(of("start_s")).alias("start_s"),
        F.array_max(of("end_s")).alias("end_s"),
        top_kind.alias("narrative_type"),
        filled(best["trigger"], NO_TRIGGER).alias("trigger"),
        filled(best["payoff"], NO_PAYOFF).alias("payoff"),
        F.when(F.size(evidence) > 0, evidence).otherwise(F.array(F.lit(NO_EVIDENCE))).alias("evidence_lines"),
        round_half_even(F.array_max(of("confidence")), 4).alias("confidence"),
        of("candidate_id").alias("source_candidate_ids"),
        F.transform(m, lambda x: F.struct(x["start_s"].alias("start_s"), x["end_s"].alias("end_s"))).alias("source_windows"),
        F.get(m, 0)["end_s"].alias("_first_end"),
        F.get(m, 0)["pos"].alias("_first_pos"),
    )
    single = F.array(F.lit("single_candidate"))
    if reasons is not None:
        arcs = arcs.join(reasons, key, "left").withColumn("merge_reasons", F.coalesce("merge_reasons", single))
    else:
        arcs = arcs.withColumn("merge_reasons", single)
    order = ["start_s", "_first_end", "_first_pos"]
    most = candidates.groupBy("vod_id").count().agg(F.max("count")).first()[0] or 0
    if most <= CELL_ROWS:
        # Every video is one cell.
        arcs = arcs.withColumn("_no", F.row_number().over(Window.partitionBy("vod_id").orderBy(*order)) - 1)
    else:
        arcs = numbered(arcs, order=order, block=F.floor(F.col("start_s") / 3600), out="_no")
    return (
        arcs
        .withColumn("arc_no", F.col("_no") + 1)
        .withColumn("stitched_id", F.format_string("stitched_%d_%d_%d", "start_s", "end_s", "arc_no"))
        .drop("group_pos", "_first_end", "_first_pos", "_no")
    )


def representative_analyses(arcs: DataFrame, analyses: DataFrame) -> DataFrame:
    """For each arc the analysis of its most worthy source clip (the first one on a
    tie).  ``analyses``: vod_id, candidate_id, clip_worthiness, ...  Arcs without
    any analysed source are dropped."""
    sources = arcs.select("vod_id", "stitched_id", F.posexplode("source_candidate_ids").alias("_i", "candidate_id"))
    columns = [c for c in analyses.columns if c != "vod_id"]
    return (
        sources.join(analyses, ["vod_id", "candidate_id"])
        .groupBy("vod_id", "stitched_id")
        .agg(
            F.min_by(
                F.struct(*columns), F.struct(-F.coalesce(F.col("clip_worthiness").cast("double"), F.lit(0.0)), "_i")
            ).alias("a")
        )
        .select("vod_id", "stitched_id", "a.*")
    )


def stitch_report(pairs: DataFrame, k: int | None = None) -> DataFrame:
    """Pair counts per video, decision and first reason, most frequent first; with ``k`` only so many."""
    first = F.coalesce(F.get("reasons", 0), F.lit("none"))
    counts = pairs.groupBy("vod_id", "merged", first.alias("primary_reason")).agg(
        F.count(F.lit(1)).alias("pairs"), F.min(F.struct("l_start_s", "l_end_s", "l_pos", "r_start_s", "r_end_s", "r_pos")).alias("_first")
    )
    order = Window.partitionBy("vod_id", "merged").orderBy(F.desc("pairs"), "_first")
    ranked = counts.withColumn("rank", F.row_number().over(order)).drop("_first")
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def notable_pairs(pairs: DataFrame, limit: int = 20, near_miss_score: int = 3) -> DataFrame:
    """The best merged pairs and the best rejected ones with at least ``near_miss_score``."""
    order = Window.partitionBy("vod_id", "merged").orderBy(
        F.desc("score"), "gap_s", "l_start_s", "l_end_s", "l_pos", "r_start_s", "r_end_s", "r_pos"
    )
    return (
        pairs.where(F.col("merged") | (F.col("score") >= near_miss_score))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= limit)
    )
