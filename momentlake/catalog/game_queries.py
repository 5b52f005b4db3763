from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import entity, table, with_entities
from ..functions import text as X
from ..operators import games
from . import query

_SEG = "array<struct<start_s:double,end_s:double,game_id:string,game_name:string,source:string,confidence:double>>"


@query(
    "game_segments_by_precedence",
    """
    with v as (
        select s_suppkey as vod_id, s_suppkey % 5 as k, s_suppkey % 3 as o, 3600.0::double + s_suppkey as d from supplier)
    select vod_id, 0::bigint as pos, 5.0::double as start_s, 50.0::double as end_s, 'override list' as game_name, 'manual' as source
    from v where o = 0
    union all
    select vod_id, 0, 0.0, d, case when k % 2 = 0 then 'Override' when k > 0 then 'Meta Game' else 'unknown' end, 'manual'
    from v where o = 1
    union all
    select vod_id, 0, 0.0, 100.0, 'first', 'meta' from v where o = 2 and k >= 3
    union all
    select vod_id, 1, 100.0, null, 'second', 'meta' from v where o = 2 and k >= 3
    union all
    select vod_id, 0, 0.0, d, 'Meta Game', 'vod_meta' from v where o = 2 and k in (1, 2)""",
)
def game_segments_by_precedence(spark, sf_dir):
    s = F.col("s_suppkey")
    k, o = s % 5, s % 3

    def seg(a, b, name, source):
        none = F.lit(None)
        return F.struct(
            F.lit(a).alias("start_s"), F.lit(b).alias("end_s"), none.cast("string").alias("game_id"),
            F.lit(name).alias("game_name"), F.lit(source).alias("source"), F.lit(1.0).alias("confidence"),
        )

    sup = table(spark, sf_dir, "supplier")
    videos = sup.select(
        s.alias("vod_id"), (3600.0 + s).alias("duration_s"), F.when(k > 0, "Meta Game").alias("game_name"),
        F.lit(None).cast("string").alias("game_id"),
        F.when(k >= 3, F.array(seg(100.0, 90.0, "second", "meta"), seg(0.0, 100.0, "first", "meta"))).cast(_SEG).alias("segments"),
    )
    overrides = sup.select(
        s.alias("vod_id"), F.when((o == 1) & (k % 2 == 0), "Override").alias("o_game_name"),
        F.when((o == 1) & (k % 2 == 1), "g7").alias("o_game_id"),
        F.when(o == 0, F.array(seg(5.0, 50.0, "override list", "manual"))).cast(_SEG).alias("o_segments"),
    )
    return games.category_segments(videos, overrides).select("vod_id", "pos", "start_s", "end_s", "game_name", "source")


_GAME_AT = """
    hits as (
        select s.vod_id, s.pos, g.game_id, g.game_name from speech s
        join game_segments g on g.vod_id = s.vod_id and s.start_s >= g.start_s
             and (g.end_s is null or s.start_s < g.end_s)
        qualify row_number() over (partition by s.vod_id, s.pos order by g.start_s, g.pos) = 1)"""


@query(
    "game_at_line",
    with_entities("speech game_segments", f""",{_GAME_AT}
    select s.vod_id, s.pos, s.start_s as t, h.game_id, h.game_name
    from speech s left join hits h using (vod_id, pos)"""),
)
def game_at_line(spark, sf_dir):
    points = entity(spark, sf_dir, "speech").select("vod_id", "pos", F.col("start_s").alias("t"))
    return games.game_at(points, entity(spark, sf_dir, "game_segments"))


@query(
    "clip_game_context",
    with_entities("speech game_segments", f""",{_GAME_AT},
    known as (select n_name as game_name, concat('Region ', n_regionkey) as summary from nation),
    texts as (
        select s.vod_id, s.pos, s.start_s as t, h.game_name,
               concat_ws(chr(10), 'Game background', 'Active game: ' || h.game_name,
                   'Game ID: ' || h.game_id, coalesce('Profile: ' || k.game_name, 'No profile.'), k.summary) as text
        from speech s left join hits h using (vod_id, pos) left join known k on k.game_name = h.game_name)
    select vod_id, pos, t, game_name, text as game_context
    from texts"""),
)
def clip_game_context(spark, sf_dir):
    points = entity(spark, sf_dir, "speech").select("vod_id", "pos", F.col("start_s").alias("t"))
    known = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("game_name"), F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("summary")
    )
    return games.clip_game_context(points, entity(spark, sf_dir, "game_segments"), known)


@query(
    "run_game_lines",
    with_entities("game_segments", """
    select vod_id, pos, concat('- ', game_name, ' (', printf('%.1f', start_s::double), 's-',
               case when end_s is null then 'end' else concat(printf('%.1f', end_s::double), 's') end, ', source=',
               case when pos % 2 = 0 then 'vod_meta' else 'unknown' end, ', cache_status=',
               case when n_regionkey = 1 then 'unknown' else 'refreshed' end, ')') as line
    from game_segments join nation on n_name = game_name"""),
)
def run_game_lines(spark, sf_dir):
    segments = entity(spark, sf_dir, "game_segments").withColumn("source", F.when(F.col("pos") % 2 == 0, "vod_meta"))
    statuses = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("game_name"), F.when(F.col("n_regionkey") != 1, "refreshed").alias("cache_status")
    )
    return games.run_game_lines(segments, statuses)


@query(
    "run_game_warnings",
    with_entities("game_segments", """,
    warned as (
        select n_name as game_name, i, case when i = 1 then ' ' else concat('lookup ', i, ' failed for ', n_name) end as warning
        from (select *, unnest(range(0, n_nationkey % 4)) as i from nation))
    select vod_id, game_name, i, warning
    from (select distinct vod_id, game_name from game_segments) join warned using (game_name) where trim(warning) <> ''"""),
)
def run_game_warnings(spark, sf_dir):
    n = (F.col("n_nationkey") % 4).cast("int")
    said = lambda i: F.when(i == 1, " ").otherwise(F.concat(F.lit("lookup "), i.cast("string"), F.lit(" failed for "), "n_name"))
    statuses = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("game_name"),
        F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), said)).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )
    return games.run_game_warnings(entity(spark, sf_dir, "game_segments"), statuses)


@query(
    "game_search_hits",
    r"""
    with hits as (
        select concat(n.n_name, ' Game') as wanted, p_partkey as pos,
               case when p_partkey % 25 = n.n_nationkey and p_size > 25 then concat(' ', lower(n.n_name), '_GAME ') else p_name end as name
        from part join nation n on p_partkey % 25 = n.n_nationkey)
    select wanted, pos, name, trim(regexp_replace(lower(wanted), '[^a-z0-9]+', '-', 'g'), '-') as slug from hits
    qualify row_number() over (partition by wanted order by
        trim(regexp_replace(replace(lower(name), '_', ' '), '\s+', ' ', 'g')) <> replace(lower(wanted), '_', ' '), pos) = 1""",
)
def game_search_hits(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    hits = table(spark, sf_dir, "part").join(n, F.col("p_partkey") % 25 == F.col("n_nationkey")).select(
        F.concat("n_name", F.lit(" Game")).alias("wanted"), F.col("p_partkey").alias("pos"),
        F.when(F.col("p_size") > 25, F.concat(F.lit(" "), F.lower("n_name"), F.lit("_GAME "))).otherwise(F.col("p_name")).alias("name"),
    )
    return games.pick_search_hit(hits).withColumn("slug", X.slug(F.col("wanted")))


@query(
    "game_profiles",
    r"""
    with cat as (
        select p_name as game_name, min(p_partkey) as game_id, min(p_size) as sz, min(p_brand) as brand, min(p_type) as t
        from part where p_size <> 3 group by all),
    art as (
        select p_name as game_name, concat(repeat(concat(p_name, ' is fun, '), 12), '...') as extract
        from part where p_size > 20 group by all),
    j as (
        select coalesce(c.game_name, a.game_name) as game_name, c.game_id, c.sz, c.brand, c.t, a.extract
        from cat c full join art a on a.game_name = c.game_name),
    s as (
        select *, case when sz % 3 = 1 then concat('Story of ', game_name, '. ')
                       else coalesce(extract, '') end as summary
        from j)
    select game_name, cast(game_id as varchar) as game_id, replace(game_name, ' ', '-') as slug, summary,
           case when sz is null then '' else t end as genres,
           case when sz is null then '' else concat_ws('|', brand, concat(t, ' mode')) end as common_terms,
           rtrim(trim(summary), '.,;: ') as core_objective,
           case when sz is null then 'Use only directly observed on-screen evidence.'
                else concat('Look for moments related to ', lower(t), ' gameplay.|Watch for references to ', lower(brand),
                            '.|Watch for references to ', lower(t), ' mode.') end as clip_eval_hints,
           concat_ws('|', case when game_id is not null then 'igdb' end, case when extract is not null then 'wikipedia' end)
               as sources
    from s""",
)
def game_profiles(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    one = lambda c: F.array(F.col(c))
    catalogue = (
        part.where("p_size <> 3")
        .groupBy(F.col("p_name").alias("game_name"))
        .agg(F.min("p_partkey").alias("game_id"), F.min("p_size").alias("sz"), F.min("p_brand").alias("brand"), F.min("p_type").alias("t"))
        .select(
            "game_name", "game_id", F.lit("").alias("summary"),
            F.when(F.col("sz") % 3 == 1, F.concat(F.lit("Story of "), "game_name", F.lit(". "))).alias("storyline"),
            one("t").alias("genres"),
            F.array(F.col("brand"), F.lower("brand")).alias("keywords"),
            F.array(F.concat("t", F.lit(" mode"))).alias("themes"),
            F.lit(None).cast("array<string>").alias("modes"), F.array(F.lit(" ")).alias("franchises"),
            F.lit(1).alias("updated_at"),
        )
    )
    articles = part.where("p_size > 20").groupBy(F.col("p_name").alias("game_name")).agg(
        F.first(F.concat(F.repeat(F.concat("p_name", F.lit(" is fun, ")), 12), F.lit("..."))).alias("extract")
    )
    out = games.game_profiles(catalogue, articles).drop("source_updated_at")
    for c in ("genres", "common_terms", "clip_eval_hints", "sources"):
        out = out.withColumn(c, F.array_join(c, "|"))
    return out


@query(
    "profile_freshness",
    """
    with p as (
        select o_orderkey as id, case when o_orderkey % 3 > 0 then o_orderkey % 100 end as stored,
               case when o_orderkey % 4 > 0 then o_custkey % 100 end as upstream,
               case when o_orderkey % 7 > 0 then o_orderdate end as refreshed
        from orders),
    f as (
        select *, coalesce(upstream <= stored,
               floor((epoch(timestamp '1998-01-01 12:00:00') - epoch(refreshed)) / 86400) <= 400, false) as fresh
        from p)
    select id, fresh, case when id % 5 > 0 and id % 2 = 0 and fresh then 'cache_hit_fresh'
                           when id % 5 > 0 and id % 2 = 1 then 'cache_hit_no_freshness_probe'
                           when id % 11 > 2 then 'refreshed' when id % 5 > 0 then 'stale_fallback'
                           else 'minimal_profile' end as cache_status
    from f""",
)
def profile_freshness(spark, sf_dir):
    k = F.col("o_orderkey")
    now = F.lit("1998-01-01 12:00:00").cast("timestamp")
    text = F.when(k % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("unreadable")
    fresh = games.is_fresh(
        F.when(k % 3 > 0, k % 100), F.when(k % 4 > 0, F.col("o_custkey") % 100), text, now, 400
    )
    return table(spark, sf_dir, "orders").select(k.alias("id"), fresh.alias("fresh")).withColumn(
        "cache_status",
        games.cache_status(F.col("id") % 5 > 0, F.col("fresh"), F.col("id") % 2 == 0, F.col("id") % 11 > 2),
    )
