"""The pipeline stage by stage against plain versions, on the smallest tables."""

import collections

import pytest
from test_operators import SPACE, brute, filled, words

import corpus_pipeline
from momentlake.llm import quality
from momentlake.llm.common import documents, shared_table
from momentlake.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = documents(spark, SF)
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = shared_table(stage(spark, docs, SF))
        out.append(docs.collect())
    return out


def test_stages_keep_the_columns(spark, stages):
    columns = documents(spark, SF).columns
    for rows in stages[:-1]:
        assert not rows or list(rows[0].asDict()) == columns


def test_quality_keeps_labelled_good_documents(spark, stages):
    before, after = stages[0], {r.doc_id for r in stages[1]}
    label = {r.doc_id: r.quality for r in documents(spark, SF, "labels").collect()}
    known = [r.doc_id for r in before if r.doc_id in label]
    assert sum((i in after) == label[i] for i in known) >= 0.95 * len(known)
    scored = quality.classify(documents(spark, SF), documents(spark, SF, "labels"))
    assert after == {r.doc_id for r in scored.where("predicted = 1").collect()}


def test_exact_copies(stages):
    best = {}
    for r in stages[1]:
        key = SPACE.sub("", r.text)
        best[key] = min(best.get(key, (1, None)), (-len(r.text), r.doc_id)) if key in best else (-len(r.text), r.doc_id)
    assert sorted(r.doc_id for r in stages[2]) == sorted(i for _, i in best.values())


def test_near_copies(stages):
    rows = sorted(stages[2], key=lambda r: r.doc_id)
    component = brute([r.text for r in rows], corpus_pipeline.NEAR)
    assert sorted(r.doc_id for r in stages[3]) == sorted({rows[c].doc_id for _, c in component.values()})


def test_mix(stages):
    sizes, taken = collections.Counter(), collections.Counter(r.doc_id for r in stages[4])
    for r in stages[3]:
        sizes[r.source] += len(words(r.text))
    target = filled(sizes, (1, 2, 3), 3)
    for r in stages[3]:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate + 1e-9) <= taken[r.doc_id] <= int(rate + 1e-9) + 1
    assert set(taken) <= {r.doc_id for r in stages[3]}


def test_pieces_hold_all_ids(stages):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in stages[4]:
        want[r.doc_id] += len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
    got = collections.Counter()
    for r in stages[5]:
        got[r.doc_id] += r.length
    assert got == want


def test_run_is_the_chain_of_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, QUERIES["pipeline"](spark, SF).collect())) == sorted(map(key, stages[5]))


def test_ten_operators_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES if n.startswith("op")}
    assert set(CHECKS) <= set(QUERIES) and "pipeline" in QUERIES
