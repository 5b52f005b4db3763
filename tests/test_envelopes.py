"""Elements of JSON envelopes against the JSON parser, in splits of a few bytes."""

import json
import random

import pytest

from momentlake.sources.envelopes import read_elements

WORDS = ['a "quoted" word', "brace } { ] [", "back\\slash", "end\\", '\\"', "naïve 你好 \U0001f600", "", "\n\t", '{"segments":[{"x":1}]}', "}" * 9, '"']


def item(rng, deep=2):
    out = {rng.choice(["start", "text", "k"]): rng.choice([rng.random(), rng.choice(WORDS), None, True, [1, [2]], []]) for _ in range(rng.randrange(4))}
    if deep and rng.random() < 0.4:
        out["nested"] = item(rng, deep - 1)
        out["list"] = [item(rng, 0), rng.choice(WORDS), {}]
    return out


@pytest.fixture
def small_splits(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield lambda size, rows: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)))
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size,batch", [(50_000_000, 2000), (4000, 7), (300, 3), (60, 2)])
def test_elements_equal_the_parser(spark, tmp_path, small_splits, size, batch):
    rng = random.Random(size)
    want = {}
    for f in range(3 if size > 1000 else 1):
        text, found = "", []
        for _ in range(rng.randrange(1, 5)):
            elements = [rng.choice([item(rng), item(rng), item(rng), 3, "x{", None, [item(rng)]]) for _ in range(rng.randrange(0, 60 if size > 1000 else 12))]
            objects = [e for e in elements if isinstance(e, dict)]
            other = {"meta": {"a": 1, "segments": [{"no": 1}]}, "timeline": [item(rng)], "note": rng.choice(WORDS)}
            shape = rng.randrange(4)
            doc = [elements, {**other, "segments": elements}, {"x": 1, "transcript": {"lang": "}", "segments": elements}, **other}, other][shape]
            found += objects if shape < 3 else []
            text += json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1])) + rng.choice(["", "\n", " "])
        (tmp_path / f"{f}.json").write_text(text)
        want[f"{f}.json"] = found
    small_splits(size, batch)
    rows = read_elements(spark, str(tmp_path), [(), ("segments",), ("transcript", "segments")]).collect()
    for name, found in want.items():
        own = sorted((r.pos, r.item) for r in rows if r.path.endswith(name))
        assert [json.loads(x) for _, x in own] == found
        assert len({pos for pos, _ in own}) == len(own)


def test_long_elements_and_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "}{" * 3000}, {"text": "x" * 5000}, {}]))
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text('{"other": 1}')
    small_splits(500, 4)
    assert sorted(len(r.item) for r in read_elements(spark, str(tmp_path)).collect()) == [2, 5012, 6012]
