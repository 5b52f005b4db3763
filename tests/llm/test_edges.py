"""Every operator and stage on odd tables: null columns, empty and very long texts, repeated rows, no rows, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from momentlake.llm import chat_format, exact_dedup, jaccard_join, mixing, packing, pitman_yor, quality, secrets, sharding, winnowing

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(60_000))
ROWS = [
    (1, "the same text", "en", "a", 3),
    (1, "the same text", "en", "a", 3),
    (2, "the same text", None, None, None),
    (None, "an id is missing here", "en", "a", 1),
    (None, None, None, None, None),
    (3, None, "en", "b", 0),
    (4, "", "en", "b", 0),
    (5, " \t\n", "en", "c", 0),
    (6, LONG, "en", "c", 1),
    (7, "x" * 200_000, "en", "c", 1),
    (-(1 << 63), "least id", "en", "a", 1),
    ((1 << 63) - 1, "largest id", "en", "a", 1),
    (8, "\U0001f600 \u0000 zero", "en", "", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators make or use inside.
CLASHES = (
    "size shard slot node pivot row group target copies score predicted fingerprint spans digest kept base _t _group _key region component "
    "box id n r t _id _r _copy _first _block _m _base _size _digest _stays blank n_hex"
).split()


def tables(spark):
    odd = spark.createDataFrame(ROWS, SCHEMA)
    wide = odd
    for c in CLASHES:
        wide = wide.withColumn(c, F.lit("clash"))
    return {"odd": odd, "clashing": wide, "empty": odd.limit(0), "nulls": odd.limit(0).unionByName(spark.createDataFrame([(None,) * 5] * 3, SCHEMA))}


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, None), (None, 1), (6, 0), (6, 1), (4, 1), (99, 0)], "doc_id long, quality int")


OPERATORS = {
    "quality": lambda spark, d: quality.classify(d, labels(spark)),
    "winnowing": lambda spark, d: winnowing.edited_fingerprints(d),
    "fingerprints": lambda spark, d: winnowing.fingerprint_documents(d),
    "language_model": lambda spark, d: pitman_yor.score_documents(d, buckets=2),
    "mixing": lambda spark, d: mixing.mix(d),
    "packing": lambda spark, d: packing.pack(d).select("doc_id").distinct(),
    "jaccard": lambda spark, d: jaccard_join.jaccard_components(d),
    "sharding": lambda spark, d: sharding.shard(d),
    "secrets": lambda spark, d: secrets.find_secrets(d),
    "exact": lambda spark, d: exact_dedup.exact_duplicates(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_tables(spark, name):
    for kind, df in tables(spark).items():
        rows = OPERATORS[name](spark, df).collect()
        if name == "packing":
            assert len(rows) == df.select("doc_id").distinct().count(), kind
        else:
            assert len(rows) == df.count(), kind


def test_results_on_odd_rows(spark):
    df = tables(spark)["odd"]
    exact = exact_dedup.exact_duplicates(df).collect()
    assert sorted((r.keep_id for r in exact if r.kept), key=str) == sorted([1, None, 5, 6, 7, 8, -(1 << 63), (1 << 63) - 1], key=str)
    assert sum(r.kept for r in exact if r.doc_id == 1) == 1
    joined = jaccard_join.jaccard_components(df).collect()
    assert {(r.doc_id, r.component_id) for r in joined} >= {(1, 1), (2, 1), (3, 3), (4, 4), (None, None)}
    assert {r.n_shingles for r in joined if r.doc_id in (3, 4, 5)} == {0}
    scores = pitman_yor.score_documents(df, buckets=2).collect()
    assert {r.n_tokens for r in scores if r.doc_id in (3, 4, 5)} == {1} and all(r.score < 0 for r in scores)
    near = winnowing.edited_fingerprints(df).collect()
    assert {len(r.fingerprint) for r in near if r.doc_id in (3, 4)} == {0} and all(r.fingerprint for r in near if r.doc_id in (5, 7))
    assert sorted(r.size for r in mixing.mix(df).collect() if r.doc_id in (3, 4, 5)) == [0, 0, 0]


#: Operators that return all columns of a table, and the columns they add or replace.
WIDE = {
    "quality": ["score", "predicted"],
    "fingerprints": ["fingerprint"],
    "mixing": ["size", "source_size", "target", "copies"],
    "sharding": ["size", "shard", "slot"],
    "secrets": ["base", "spans", "n_assign", "n_access", "n_hex", "n_random"],
}


@pytest.mark.parametrize("name", sorted(WIDE))
def test_other_columns_come_through(spark, name):
    """Each input column once, with its own values, but for those of the result."""
    df = tables(spark)["clashing"]
    out = OPERATORS[name](spark, df)
    own = [c for c in df.columns if c not in WIDE[name]]
    assert out.columns == [*own, *WIDE[name]]
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, out.select(*own).collect()), key=key) == sorted(map(tuple, df.select(*own).collect()), key=key)
    assert not {"clash"} & {v for r in out.select(*WIDE[name]).collect() for v in r if isinstance(v, str)}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, name, stage):
    for kind, df in tables(spark).items():
        out = stage(spark, df, SF)
        assert name == "pack" or out.columns == df.columns, kind
        rows = out.collect()
        if name != "pack":
            given = {str(tuple(r)) for r in df.collect()}
            assert all(str(tuple(r)) in given for r in rows), kind


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)] * 3, [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, ""), (None, 5, "user", "b")]])
def test_odd_conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("said", F.lit("x"))
    got = chat_format.rendered(df).collect()
    assert sum(r.n_turns for r in got) == len(rows)
