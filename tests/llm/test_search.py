"""Ranked search against scoring of every document, on odd rows and in many small blocks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from momentlake.llm import lexical
from momentlake.llm.words import Cutter, Vocabulary

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) by scoring everything."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        asked, found = Counter(terms(text)), []
        for d, bag in bags:
            m = 25 + 75 * sum(bag.values()) * n // max(1, total)
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, q in asked.items())
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=str)


def searched(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("item", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("term", F.lit("x"))
    rows = lexical.search(d, i, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"] and dict(rows.dtypes)["rank"] == "int"
    return sorted((tuple(r) for r in rows.collect()), key=str)


def corpus(seed, n=700):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "Ünder", "LONGERTHANEIGHT", "x1"]) + str(min(rng.randrange(300), rng.randrange(300)))
    docs = [(i, " ".join(word() for _ in range(rng.randrange(40))) + rng.choice([".", "", "\x00 tail"])) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(30)]  # ties
    docs += [(None, docs[7][1]), (None, None), (9, docs[9][1]), (n + 50, ""), (n + 51, " ."), (n + 52, "x" * 100_000 + " a1"), (n + 53, docs[3][1] * 400)]
    items = [(i, docs[rng.randrange(n)][1]) for i in range(40)] + [(0, "a1 a2"), (0, "a1 a2"), (0, "A1"), (None, "a1"), (77, None), (78, "absent"), (79, "a1 " * 50)]
    return docs, items


@pytest.mark.parametrize("block", [3, 64, 2048])
def test_equals_scoring_every_document(spark, monkeypatch, block):
    docs, items = corpus(block)
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    assert searched(spark, docs, items) == plain(docs, items)


def test_few_results_and_chunks_of_items(spark, monkeypatch):
    docs, items = corpus(1, 120)
    monkeypatch.setattr(lexical, "CHUNK_ITEMS", 7)
    assert searched(spark, docs, items, k=3) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(2, 20)
    assert searched(spark, [], items) == [] == searched(spark, docs, [])
    assert searched(spark, [(1, None)], [(None, None)]) == []


def test_sums_beyond_doubles():
    weights = np.array([9_000_000, 7])
    rows = [(0, 0, 2_000), (0, 1, 1), (1, 1, 1)]
    found = lexical.Search(rows, 2, weights, 2)
    assert found.kind is np.int64
    ids = np.arange(4)
    found.read(ids, np.zeros(4, np.uint8), np.array([0, 0, 1, 2]), np.array([0, 1, 0, 1]), np.array([999_999, 3, 999_998, 10]))
    top = 9_000_000 * 2_000
    assert found.best[0] == [(-(top * 999_999 + 21), 0, 0), (-top * 999_998, 0, 1)]
    assert found.best[1] == [(-70, 0, 2), (-21, 0, 0)]


def test_reading_stops_early():
    """Documents that cannot reach the bar are given up: later blocks touch few of their entries."""
    rng = np.random.default_rng(0)
    found = lexical.Search([(0, t, 1) for t in range(6)], 1, np.array([900, 800, 700, 20, 10, 5]), 2)
    full = np.full(6, 900_000)
    found.read(np.arange(2), np.zeros(2, np.uint8), np.repeat([0, 1], 6), np.tile(np.arange(6), 2), np.concatenate([full, full]))
    bar, reads = found.bar[0], []
    found._sum = lambda cell, values, shape: reads.append(len(cell)) or lexical.Search._sum(found, cell, values, shape)
    n = 600
    found.read(np.arange(10, 10 + n), np.zeros(n, np.uint8), np.repeat(np.arange(n), 6), np.tile(np.arange(6), n), rng.integers(1, 500_000, 6 * n))
    assert found.bar[0] == bar and sum(reads) < 0.2 * 2 * 6 * n


def test_words_and_vocabulary():
    cutter = Cutter(b" \t", b"\n.")
    texts = ["One two.three", None, "", "LONGERTHANEIGHTBYTES one Ü\u0000x", "a" * 50 + " longerthaneightbytez"]
    (words,) = cutter.words(texts)
    raw = [words.raw[s:e].decode() for s, e in zip(words.starts, words.ends, strict=True)]
    assert raw == ["one", "two", "three", "longerthaneightbytes", "one", "Ü\u0000x", "a" * 50, "longerthaneightbytez"]
    assert words.owner.tolist() == [0, 0, 0, 3, 3, 3, 4, 4]
    assert len(set(words.piece.tolist())) == 4 and words.piece[0] == words.piece[1] != words.piece[2]
    ids, names = words.ids()
    assert [names[i].as_py().decode() for i in ids.tolist()] == raw
    found = Vocabulary([b"one", b"longerthaneightbytes", b"t"]).find(words)
    assert found.tolist() == [0, -1, -1, 1, 0, -1, -1, -1]


def test_long_texts_are_cut_at_stops(monkeypatch):
    from momentlake.llm import words as module

    monkeypatch.setattr(module, "BUFFER", 64)
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c.\n") for _ in range(rng.randrange(400))) for _ in range(20)] + ["x" * 500]
    got = []
    for part in Cutter(b" ", b".\n").words(texts):
        got += [(o, part.raw[s:e].decode()) for o, s, e in zip(part.owner.tolist(), part.starts, part.ends, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^ .\n]+", t)]
