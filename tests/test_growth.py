"""What the steps of a query hand on grows with their input, not with pairs of it."""

import time

from pyspark.sql import functions as F

from momentlake import runtime
from momentlake.catalog import selection_queries
from momentlake.operators import annotations, chat, compare, context, games, intervals, selection, speakers, stitching, triage
from momentlake.plans import publish


def recorded(monkeypatch, module, name):
    """Row counts of the tables that ``module.name`` returns from now on."""
    inner, counts = getattr(module, name), []

    def run(*args, **kwargs):
        out = inner(*args, **kwargs)
        counts.append(out.count())
        return out

    monkeypatch.setattr(module, name, run)
    return counts


def test_a_time_meets_one_game_segment(spark, monkeypatch):
    counts = recorded(monkeypatch, games, "point_join")
    points = spark.range(300).select(F.lit(1).alias("vod_id"), F.col("id").alias("pos"), (F.col("id") * 20).alias("t"))
    segments = spark.range(200).select(
        F.lit(1).alias("vod_id"), F.col("id").alias("pos"), (F.col("id") * 7 % 90).alias("start_s"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 31).alias("end_s"),
        F.col("id").cast("string").alias("game_id"), F.concat(F.lit("g"), "id").alias("game_name"),
    )
    got = {r.pos: r.game_name for r in games.game_at(points, segments).collect()}
    spans = [(i * 7 % 90, i, i * 31 if i % 3 else None) for i in range(200)]
    for p in range(300):
        on = [(a, i) for a, i, b in spans if a <= p * 20 and (b is None or p * 20 < b)]
        assert got[p] == (f"g{min(on)[1]}" if on else None)
    assert counts == [300 - sum(v is None for v in got.values())]


def test_texts_are_not_repeated_for_clips(spark, monkeypatch):
    written, inner = [], context.checkpointed
    monkeypatch.setattr(context, "checkpointed", lambda df: written.append(df.columns) or inner(df))
    clips = spark.createDataFrame([(1, i, 0.0 + i, 60.0 + i) for i in range(20)], "vod_id long, clip_id long, lo double, hi double")
    lines = spark.createDataFrame(
        [(1, 0, 30, 33, "so we are at an"), (1, 1, 34, 36, "ox in a box on it today"), (1, 2, 50, 55, "Alpha beta gamma delta epsilon")],
        "vod_id long, pos long, start_s long, end_s long, text string",
    )
    chat = spark.createDataFrame(
        [
            (1, 0, 40, "a", "at an ox in a box on it"),  # across two lines, one word of three letters
            (1, 1, 41, None, "delta alpha gamma beta is it zeta"), (1, 1, 41, None, "delta alpha gamma beta is it zeta"),
            (1, 2, 42, "c", "nothing of all this was said"), (1, 3, 43, "d", "betagammadeltaalphaepsilon"),
        ],
        "vod_id long, pos long, t long, usr string, message string",
    )
    got = [(r.clip_id, r.pos) for r in context.read_aloud(clips, lines, chat).collect()]
    want = [(c, 0) for c in range(20)] + [(c, 1) for c in range(20)] * 2
    assert sorted(got) == sorted(want)
    assert written and not [c for c in written if "clip_id" in c and "message" in c]


def test_annotations_are_summed_up_once_for_clips_with_the_same_windows(spark, monkeypatch):
    counts = recorded(monkeypatch, annotations, "windows_in")
    clips = spark.range(200).select(
        F.lit(1).alias("vod_id"), F.col("id").alias("pos"), (F.col("id") % 20 + 1).alias("start_s"), F.lit(45).cast("long").alias("end_s")
    )
    event = "struct<timestamp:string,type:string,confidence:string,evidence:string,speaker_guess:string>"
    raw = spark.range(30).select(
        F.lit(1).alias("vod_id"), F.col("id").alias("pos"), (F.col("id") % 3 * 30).alias("start_s"),
        (F.col("id") % 3 * 30 + 30).alias("end_s"), F.lit(None).cast("string").alias("window_id"),
        F.array(F.struct(*[F.lit(v).alias(n) for n, v in zip(("timestamp", "type", "confidence", "evidence", "speaker_guess"), ("40", "laugh", "1", "", ""))])).cast(f"array<{event}>").alias("audio_events"),
        F.array().cast("array<struct<timestamp:string,type:string,confidence:string,evidence:string>>").alias("visual_events"),
        F.lit("").alias("primary_speaker"), F.lit("0.5").alias("streamer_led_likelihood"),
        F.lit(False).alias("non_streamer_voice_present"), F.lit("").alias("non_streamer_voice_type"),
        F.lit("").alias("streamer_affect"), F.lit("0").alias("organic_reaction_likelihood"),
        F.lit("0").alias("transactional_alert_likelihood"), F.lit("").alias("emotion_evidence"),
        F.array(F.lit("late")).alias("risk_flags"), F.array().cast("array<string>").alias("clip_relevance_notes"),
        F.lit(True).alias("parse_ok"), F.lit(None).cast("string").alias("error"),
    )
    out = annotations.fallback_candidates(clips, annotations.normalise_annotations(raw)).collect()
    assert len(out) == 200 and {len(r.annotation_refs) for r in out} == {2}
    assert all(r.evidence_lines[0] == f"[{r.start_s}s] clip window {r.start_s}-45s" and r.risk_flags == ["late"] for r in out)
    assert counts == [20]


def test_voices_of_clips_are_totals_of_blocks(spark, monkeypatch):
    pairs = recorded(monkeypatch, context, "overlap_join")
    lengths = (0.0, 0.5, 3.0, 8.0, 37.25, 120.0, 512.0)
    clips = [(i % 2, i, i * 7 % 400 + 0.25 * (i % 3), i * 7 % 400 + 0.25 * (i % 3) + lengths[i % 7]) for i in range(140)]
    turns = [
        (i % 2, i, i * 13 % 700 + 0.5 * (i % 2), i * 13 % 700 + 0.5 * (i % 2) + i % 11 * (1 + 20 * (i % 5 == 0)),
         f"S{i % 3}" if i % 8 else None, ("streamer", "Guest", None)[i * 5 % 3], f"n{i}" if i % 4 else None, i % 10 / 10)
        for i in range(300)
    ]
    got = context.speaker_stats(
        spark.createDataFrame(clips, "vod_id long, clip_id long, lo double, hi double"),
        spark.createDataFrame(
            turns, "vod_id long, pos long, start_s double, end_s double, speaker_label string, identity string, inferred_name string, confidence double"
        ),
    ).collect()
    assert len(got) == 140
    clips = {c[1]: c for c in clips}
    for r in got:
        vod, _, lo, hi = clips[r.clip_id]
        heard = [t for t in turns if t[0] == vod and t[3] > t[2] and t[2] < hi and lo < t[3]]
        shared = {}
        for t in heard:
            shared.setdefault(t[4] or "UNKNOWN", []).append((min(hi, t[3]) - max(lo, t[2]), t))
        main = min(shared.items(), key=lambda s: (-sum(x for x, _ in s[1]), s[1][0][1][1]), default=(None, []))
        last = {label: (s[-1][1][5] or "unknown").lower() for label, s in shared.items()}
        streamer = sum(min(hi, t[3]) - max(lo, t[2]) for t in heard if t[5] == "streamer")
        sure = max([t[7] for s in shared.values() if s[-1][1][5] == "streamer" for _, t in s], default=0.0)
        assert (r.turn_count, r.primary_speaker_label) == (len(heard), main[0])
        assert r.primary_speaker_identity == last.get(main[0])
        assert r.primary_speaker_name == (main[1][-1][1][6] if main[1] else None)
        assert (r.streamer_speaking_seconds, r.streamer_speaking_confidence) == (streamer, sure)
        assert r.off_streamer_voice_detected == ("guest" in last.values())
    # Only spans of less than eight seconds meet voices one by one.
    assert sum(pairs) == sum(
        t[0] == c[0] and t[3] > t[2] and t[2] < c[3] and c[2] < t[3] for c in clips.values() if c[3] - c[2] < 8 for t in turns
    )


def test_lines_look_up_their_speaker(spark, monkeypatch):
    pairs = recorded(monkeypatch, speakers, "point_join"), recorded(monkeypatch, speakers, "overlap_join")
    lines = [(i % 2, i, i * 37 % 300, i * 37 % 300 + (i * 11 % 45 - (2 if i % 50 else 9)), "x", None) for i in range(600)]
    lines.append((0, 600, None, 5, "x", None))
    turns = [(i % 2, i, i * 41 % 300, i * 41 % 300 + i * 7 % 28 - 1, f"S{i % 4}" if i % 9 else None) for i in range(900)]
    got = speakers.align_speakers(
        spark.createDataFrame(lines, "vod_id long, pos long, start_s long, end_s long, text string, speaker_label string"),
        spark.createDataFrame(turns, "vod_id long, pos long, start_s long, end_s long, speaker_label string"),
    ).collect()
    assert len(got) == 601
    for r in got:
        vod, _, lo, hi = lines[r.pos][:4]
        met = [t for t in turns if lo is not None and t[0] == vod and t[2] < t[3] and t[2] < hi and lo < t[3]]
        best = min(((-min(hi, t[3]) + max(lo, t[2]), t[2], t[3], t[4] or "", t[4]) for t in met), default=None)
        held = best is not None and hi != lo and -best[0] / (hi - lo) >= 0.3
        assert r.speaker_label == (best[4] if held and best[4] else "UNKNOWN"), r
    # Some 30 turns overlap each of the 601 lines.
    assert sum(map(sum, pairs)) < 3000


def test_a_point_costs_two_rows_an_emote(spark, monkeypatch):
    pairs = recorded(monkeypatch, intervals, "point_join")
    says = [(i % 2, i, (i * 7 % 400) / 2, [f"e{i % 3}", f"e{i % 5}"] if i % 4 else None) for i in range(800)]
    points = [(i % 2, i * 3 % 250 / 2) for i in range(200)]
    got = chat.emotes_around(
        spark.createDataFrame(points, "vod_id long, t double"),
        spark.createDataFrame(says, "vod_id long, pos long, t double, emotes array<string>"), radius_seconds=15, k=3,
    ).collect()
    want = set()
    for vod, t in set(points):
        uses = {}
        for v, pos, at, emotes in says:
            if v == vod and t - 15 <= at <= t + 15:
                for i, e in enumerate(emotes or ()):
                    uses.setdefault(e, []).append((pos, i))
        best = sorted(uses, key=lambda e: (-len(uses[e]), min(uses[e])))[:3]
        want |= {(vod, t, r, e, len(uses[e])) for r, e in enumerate(best, 1)}
    assert {(r.vod_id, r.t, r["rank"], r.emote, r.uses) for r in got} == want and len(got) == len(want)
    assert not sum(pairs)


def stories(spark, n, videos):
    words = ("big laugh", "donation alert", "chat loses it", "viewer story", "quick laugh alert")
    rows = [
        (i % videos, i, f"c{i}", i * 37 % 900, i * 37 % 900 + 20 + i * 79 % 61, ("story", "reaction", "")[i % 3], words[i % 5], words[i * 7 % 5],
         [words[i % 4]], 0.5)
        for i in range(n)
    ]
    kinds = "vod_id long, pos long, candidate_id string, start_s long, end_s long, narrative_type string, trigger string, payoff string"
    return rows, spark.createDataFrame(rows, kinds + ", evidence_lines array<string>, confidence double")


def test_words_are_compared_once_a_pair(spark, monkeypatch):
    monkeypatch.setattr(stitching, "PAIR_ROWS", 7)
    rows, candidates = stories(spark, 300, 3)
    pairs = stitching.stitch_pairs(candidates)
    got = {(r.l_pos, r.r_pos): (r.shared_count, r.score) for r in pairs.collect()}
    want = {}
    for a in rows:
        for b in rows:
            if a[0] == b[0] and (a[3], a[4], a[1]) < (b[3], b[4], b[1]) and b[3] <= a[4] + 45:
                tok = [{w for w in " ".join([x[6], x[7], x[5] or "", *x[8]]).split() if len(w) > 2 and w != "chat"} for x in (a, b)]
                n = len(tok[0] & tok[1])
                want[a[1], b[1]] = (n, 1 + (b[3] - a[4] <= 20) + 2 * (a[5] == b[5]) + min(n, 2))
    assert got == want
    shown = stitching.notable_pairs(pairs, 3).select("l_pos", "r_pos", "score", "rank")
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("array_intersect(") == 1


def test_videos_of_few_edges_are_not_cut(spark, monkeypatch):
    cut, inner = [], stitching._edge_cells
    monkeypatch.setattr(stitching, "_edge_cells", lambda edges, n: cut.append(edges.select("vod_id").distinct().count()) or inner(edges, n))
    rows, few = stories(spark, 60, 6)
    pairs = {(r.l_pos, r.r_pos): r for r in stitching.stitch_pairs(few).collect()}
    arcs = {tuple(r.source_candidate_ids) for r in stitching.stitch(few).collect()}
    used, joined = set(), set()
    span = lambda r: max(r.l_end_s, r.r_end_s) - r.l_start_s
    order = lambda r: (-r.score, r.gap_s, r.l_start_s, r.l_end_s, r.l_pos, r.r_start_s, r.r_end_s, r.r_pos)
    for r in sorted((r for r in pairs.values() if r.merged and span(r) <= 240), key=order):
        if not used & {r.l_pos, r.r_pos}:
            used |= {r.l_pos, r.r_pos}
            joined.add((f"c{r.l_pos}", f"c{r.r_pos}"))
    assert joined and arcs == joined | {(f"c{r[1]}",) for r in rows if r[1] not in used}
    assert cut == []
    # One video of many edges beside them is cut alone, and changes nothing for the others.
    many = stories(spark, 900, 1)[1].withColumns({"vod_id": F.lit(9).cast("long"), "candidate_id": F.concat(F.lit("x"), "candidate_id")})
    both = stitching.stitch(few.unionByName(many)).collect()
    assert {tuple(r.source_candidate_ids) for r in both if r.vod_id < 9} == arcs
    assert cut == [1]


def test_only_videos_of_many_keys_are_searched_by_a_grid(spark, monkeypatch):
    gridded, inner = [], compare._grid
    monkeypatch.setattr(compare, "_grid", lambda keys, top: gridded.append({r.vod_id for r in keys.select("vod_id").distinct().collect()}) or inner(keys, top))
    key = "vod_id long, start_s long, end_s long"
    few = [(i % 7, i * 37 % 90, i * 37 % 90 + i % 11) for i in range(140)]
    many = [(9, i * 41 % 400, i * 41 % 400 + i % 13) for i in range(200)]
    other = [(v, s + 3, e + 1) for v, s, e in few if v % 2]
    missed = [(v, s + 1, e) for v, s, e in few + many] + [(50, 1, 2), (None, 1, 2)]

    def check(rows):
        sets = {"a": rows, "b": other}
        got = compare.nearest_keys(spark.createDataFrame(missed, key), {n: spark.createDataFrame(r, key) for n, r in sets.items()}).collect()
        assert len(got) == len(set(missed))
        for r in got:
            for n, of in sets.items():
                far = lambda s, e: (abs(s - r.start_s) + abs(e - r.end_s), abs(s - r.start_s), abs(e - r.end_s), -s, -e)  # noqa: E731, B023
                best = min(((s, e) for v, s, e in of if v == r.vod_id), key=lambda x: far(*x), default=(None, None))
                assert (r[f"{n}_start"], r[f"{n}_end"]) == best

    check(few)
    assert gridded == []
    check(few + many)
    assert gridded == [{9}]


def test_accepted_claims_are_made_once_for_two_merges(spark, monkeypatch):
    from momentlake.catalog import profile_queries

    plans, inner = [], profile_queries.logs.merge_claims
    monkeypatch.setattr(
        profile_queries.logs, "merge_claims",
        lambda accepted, *at: plans.append(accepted._jdf.queryExecution().optimizedPlan().toString()) or inner(accepted, *at),
    )
    assert profile_queries.stored_profile(spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 2 and not [p for p in plans if "sha2" in p or "parquet" in p]


def test_reasons_are_lowered_once_a_candidate(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a", 0, 20, 0, 20, 3.0, 0.5, "none", ["top"], ["e"], [], []),
         (1, 2, "b", 40, 60, 40, 60, 2.0, 0.5, "none", [" Sound", "LAUGHTER ", None], ["e"], [], []),
         (1, 3, "c", 80, 99, 80, 99, 1.0, 0.5, "none", ["Laugh", "laughter"], ["e"], [], [])],
        "vod_id bigint, pos bigint, candidate_id string, start_s bigint, end_s bigint, trim_start bigint, trim_end bigint, "
        "triage_score double, triage_confidence double, vision_need string, selection_reasons array<string>, "
        "evidence_lines array<string>, risk_flags array<string>, annotation_refs array<string>",
    )
    manifest = spark.createDataFrame([(1, "m", 0, 30)], "vod_id bigint, clip_id string, start_s bigint, end_s bigint")
    out = triage.vision_shortlist(rows, manifest, budgets=triage.review_budgets(rows, 1.0, 3, 3))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(trim(lambda") == 1
    assert {(r.candidate_id, r.selection_reason) for r in out.collect()} == {
        ("a", "text_top_rank"), ("b", "sound"), ("c", "laugh")}


def joined_rows(df):
    """Rows of the two sides of the topmost join, and the operator that joins them."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1:
        plan = plan.children().apply(0)
    spark = df.sparkSession
    sides = [spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.children().apply(i)) for i in (0, 1)]
    kind = next(x for x in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if x in df._jdf.queryExecution().executedPlan().toString())
    return sorted(x.count() for x in sides), kind


def pairs_of_rows(clips, points):
    return sorted(((c[1], p[1]) for c in clips for p in points if c[0] == p[0] and None not in (c[0], c[2], p[2]) and c[2] <= p[2] <= c[3]), key=str)


CLIPS = [(v, i, max(0.0, i * 61 % 4000 - 300.0), i * 61 % 4000 + 300.0) for v in (1, 2) for i in range(40)] + [(None, 98, 0.0, 9.0), (1, 99, None, 9.0)]


def clip_table(spark):
    """A table of a size that Spark knows, so that it may choose to broadcast it."""
    cast = "cast({} as bigint), cast({} as bigint), cast({} as double), cast({} as double)".format
    rows = ", ".join(f"({cast(*('null' if x is None else x for x in c))})" for c in CLIPS)
    return spark.sql(f"select * from values {rows} as t(vod_id, clip_id, lo, hi)")


def test_messages_of_clips_are_merged_not_broadcast(spark, monkeypatch):
    clips = clip_table(spark)
    # One busy second, equal rows, no time, no video.
    rows = [(1, i, 1200, "u", "m") for i in range(100)] + [(2, i, i * 97 % 4100, None, "m") for i in range(50)] * 2
    rows += [(1, 500, None, "u", "m"), (None, 501, 5, "u", "m")]
    chat = spark.createDataFrame(rows, "vod_id long, pos long, t long, usr string, message string")
    for most in (16, 1 << 14):
        monkeypatch.setattr(intervals, "PART_ROWS", most, raising=False)
        met = context.clip_chat(clips, chat)
        assert joined_rows(met)[1] == "SortMergeJoin"
        assert sorted(((r.clip_id, r.pos) for r in met.collect()), key=str) == pairs_of_rows(CLIPS, rows)


def test_clips_are_not_repeated_for_quiet_buckets(spark):
    clips = clip_table(spark)
    rows = [(v, i, i * 61 % 4000, i, "m") for v in (1, 2) for i in range(40)]
    lines = spark.createDataFrame(rows, "vod_id long, pos long, start_s long, end_s long, text string")
    met = context.clip_lines(clips, lines)
    # A clip of ten minutes touches two buckets at most.
    assert joined_rows(met)[0][1] <= 2 * len(CLIPS)
    assert sorted(((r.clip_id, r.pos) for r in met.collect()), key=str) == pairs_of_rows(CLIPS, rows)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def test_shuffle_files_behind_a_checkpoint_are_removed(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(CLEANUP, None)
    sums = runtime.checkpointed(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(CLEANUP, None) == setting
    assert sorted((r["k"], r["count"]) for r in sums.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]


def test_scored_clips_are_written_once(spark, monkeypatch):
    written = []
    for module in (publish, selection):
        inner = module.checkpointed
        monkeypatch.setattr(module, "checkpointed", lambda df, inner=inner: written.append(df.columns) or inner(df))
    out = selection_queries.published_clips(spark, "/root/testdata/sf0.001")
    scored = [c for c in written if "final_score" in c and "clip_worthiness" in c]
    assert len(scored) == 1 and "penalty_trace" not in scored[0]
    assert out.columns[:3] == ["vod_id", "rank", "clip_id"]


def test_turns_are_shuffled_once_for_all_widths(spark):
    turns = [(1, i, i * 13 % 400, i * 13 % 400 + 1 + i % 70, "ab"[i % 2], "streamer" if i % 3 else "guest") for i in range(60)]
    voices = spark.createDataFrame(
        [(*t, None, 0.5) for t in turns], "vod_id long, pos long, _ts long, _te long, label string, who string, who_name string, conf double"
    )
    asked = [(1, w, b, x * w, e) for w in (4.0, 16.0, 64.0) for b in (0, 1, 5) for x in (0.25, 0.75) for e in (True, False)]
    points = spark.createDataFrame([*asked, (2, 4.0, 0, 1.0, True)], "vod_id long, _w double, _block long, _x double, _ends boolean")
    totals = context._block_totals(points, voices)
    assert totals._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    want = {}
    for v, w, b, x, e in asked:
        for _, pos, ts, te, label, who in turns:
            # Before the point count turns that begin in the block, after it all that reach past it.
            lo, hi = (b * w + x, b * w + w) if e else (b * w, b * w + x)
            if max(0, min(te, hi) - max(ts, lo)) > 0 or (not e and b * w <= ts < hi):
                n = want.setdefault((v, w, b, x, e, label), [0, 0, 0])
                n[0] += max(0, min(te, hi) - max(ts, lo))
                n[1] += max(0, min(te, hi) - max(ts, lo)) * (who == "streamer")
                n[2] += 1 if e or ts >= b * w else 0
    got = {(r.vod_id, r._w, r._block, r._x, r._ends, r.label): [r.seconds, r.streamer_seconds, r.turns] for r in totals.collect()}
    assert {k: n for k, n in got.items() if n[0] or n[2]} == want
