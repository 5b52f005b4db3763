"""The registered queries of this package and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from momentlake.llm import chat_format, collocations, exact_dedup, hamming, jaccard_join, lexical, mixing, packing, pipeline, pitman_yor
from momentlake.llm import quality, secrets, sharding, winnowing
from momentlake.llm.common import documents
from momentlake.runtime import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


@_query("op1_quality_nbsvm")
def quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = quality.classify(docs, documents(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op2_winnow")
def winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnowing.edited_fingerprints(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.as_text(F.col("fingerprint")).alias("fingerprint"),
        winnowing.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@_query("op3_pitman_yor")
def pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


@_query(
    "op4_mix_sources",
    r"""
    with recursive sized as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
    s as (
      select source, sum(size)::bigint as source_size, 3.0::double * sum(size) as cap,
        (1 + (row_number() over (order by source nulls last) - 1) % 3)::double as weight from sized group by source),
    rounds as (
      select source, source_size, cap, weight, false as full_, 0 as round,
        (select sum(source_size) from s)::double as left_, (select sum(weight) from s)::double as w from s
      union all
      select source, source_size, cap, weight, full_ or now, round + 1,
        left_ - sum(case when now then cap else 0 end) over (), w - sum(case when now then weight else 0 end) over ()
      from (select *, not full_ and cap <= left_ / w * weight as now, bool_or(not full_ and cap <= left_ / w * weight) over () as more
            from rounds where w > 0) where more),
    last as (select * from rounds where round = (select max(round) from rounds)),
    targets as (select source, source_size, case when full_ or w <= 0 then cap else left_ / w * weight end as target from last),
    rated as (
      select doc_id, sized.source, size, source_size, target,
        case when source_size > 0 then least(target / source_size, 3.0::double) else 0.0::double end as rate
      from sized join targets on sized.source is not distinct from targets.source),
    seeded as (
      select *, ('0x' || md5('mix|' || seed || '|' || coalesce(doc_id::varchar, ''))[1:13])::bigint / 4503599627370496.0::double as draw
      from rated, range(16) seeds(seed)),
    sums as (
      select source, seed, abs(any_value(floor(rate)) * any_value(source_size)
          + sum(case when draw < rate - floor(rate) then size else 0 end) - any_value(target)) as off
      from seeded group by source, seed),
    best as (select source, arg_min(seed, (off, seed)) as seed from sums group by source)
    select doc_id, size, source_size, round(target, 6) as target,
      (size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end))::bigint as taken
    from seeded join best on seeded.source is not distinct from best.source and seeded.seed = best.seed
    """,
)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


@_query("op5_pack_tiers")
def pack_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), with_ids=False).drop("ids")


@_query(
    "op6_maximal_conversations",
    """
    with t as (
      select coalesce('+' || conv_id::varchar, '-') as conv, conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn,
        md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) as said from conversations),
    p as (
      select *, row_number() over (partition by conv order by turn nulls first, said) - 1 as pos from t),
    c as (select conv, count(*) as n, string_agg(said, '' order by pos) as whole from p group by conv),
    best as (select min(conv) as conv, n, whole from c group by n, whole),
    kept as (
      select conv from best a where not exists (
        select 1 from c b where b.n > a.n and b.whole[1:32] = a.whole[1:32] and starts_with(b.whole, a.whole)))
    select conv_id, min(pos)::bigint as first_turn, count(*) as n_turns,
      string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' order by pos) as rendered
    from p semi join kept using (conv) group by conv, conv_id, pos // 64
    """,
)
def maximal_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rendered(documents(spark, sf_dir, "conversations"))


@_query("op7_jaccard_join")
def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


@_query("op8_longest_first_shards")
def longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    named = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    placed = sharding.shard(named.select("doc_id", "text", "text_crc32"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@_query("op9_find_secrets")
def find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.as_text(F.array_sort("base")), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
        "n_random",
    )


@_query(
    "op10_exact_dedup",
    r"""
    with t as (
      select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content from documents),
    g as (select *, row_number() over (partition by content order by n desc, doc_id) as r, count(*) over (partition by content) as group_size from t),
    k as (select content, doc_id as keep_id from g where r = 1)
    select doc_id, keep_id, group_size, r = 1 as kept, sha256(content) as text_sha256 from g join k using (content)
    """,
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


@_query(
    "op11_collocations",
    r"""
    with p as (
      select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
    w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
    g as (
      select lang, 1 as k, unnest(ws) as phrase from w
      union all select lang, 2, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) from w
      union all select lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) from w),
    f as (select lang, k, phrase, count(*) as f from g group by all),
    c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as s from f where k > 1 and f >= 10),
    cuts as (
      select lang, k, phrase, a, s, 1 as cut, s[1] as x, array_to_string(s[2:], ' ') as y from c
      union all select lang, k, phrase, a, s, 2, s[1] || ' ' || s[2], s[3] from c where k = 3),
    scored as (
      select cuts.*, lf.f as l, rf.f as r,
        ((1000000::hugeint * a * a) // (lf.f::hugeint * rf.f))::bigint as score
      from cuts join f lf on lf.lang = cuts.lang and lf.phrase = x join f rf on rf.lang = cuts.lang and rf.phrase = y),
    best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
    inner_ as (
      select lang, s[1] || ' ' || s[2] as phrase, a from c where k = 3
      union all select lang, s[2] || ' ' || s[3], a from c where k = 3),
    longer as (select lang, phrase, max(a) as longer from inner_ group by all),
    n as (select lang, sum(len(ws))::bigint as n from w group by lang),
    ranked as (
      select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
      from best left join longer using (lang, phrase) join n using (lang) where longer is null or 100 * longer < 50 * a)
    select * from ranked where rank <= 2000
    """,
)
def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


@_query(
    "op12_itq_near_duplicates",
    """
    with recursive v as (
      select vec_id, label, embedding::double[] as e from embeddings
      where label is not null and len(embedding) > 0 and list_bool_and([x is not null and isfinite(x) for x in embedding])
        and list_bool_or([x <> 0 for x in embedding])),
    p as (
      select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.98),
    reach as (
      select vec_id as x, vec_id as y from embeddings union select reach.x, p.y from reach join p on reach.y = p.x),
    least as (select x as vec_id, min(y) as component_id from reach group by x),
    degree as (select x as vec_id, count(*) as n_links from p group by x)
    select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
    from least left join degree using (vec_id)
    """,
)
def itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_duplicates(documents(spark, sf_dir, "embeddings"))


@_query(
    "op13_nra_search",
    r"""
    with d as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
    q as (
      select item_id, term, count(*) as times from (select item_id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
    c as (select count(*) filter (where len(ts) > 0) as docs, sum(len(ts))::bigint as terms from d),
    p as (
      select doc_id, term, count(*) as tf from (select doc_id, unnest(ts) as term from d)
      where term in (select term from q) group by all),
    f as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from p, c group by term, docs),
    m as (select doc_id, 25 + (75 * len(ts)::bigint * docs) // terms as m from d, c where terms > 0),
    e as (select term, doc_id, (1000000000 * tf) // (1000 * tf + 8 * m) as impact from p join m using (doc_id)),
    s as (
      select item_id, doc_id, sum(times * w * impact)::bigint as score
      from q join f using (term) join e using (term) group by item_id, doc_id),
    r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from s where score > 0)
    select * from r where rank <= 10
    """,
)
def nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = lambda spark, sf_dir: pipeline.run(configure(spark), sf_dir)
if pipeline.ORACLE_SQL:
    CHECKS["pipeline"] = pipeline.ORACLE_SQL
