"""Collocations against counting in plain Python, with hot words, hot pairs and many blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from momentlake.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, longest=3, least=10, k=2000):
    counts, n, out = defaultdict(Counter), Counter(), []
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(ws)
            for size in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    for lang, f in counts.items():
        found = []
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in cands.items():
            if any(100 * b >= 50 * a for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:i]] * f[p[i:]]), i, f[p[:i]], f[p[i:]]) for i in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    word = lambda: rng.choice(["The", "of", f"w{min(rng.randrange(60), rng.randrange(60))}", f"Ünique{rng.randrange(999)}"])
    docs = []
    for _ in range(n):
        text = "".join(word() + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice(["en", "en", "en", "fr", "", None, "und"]), text))
    docs += [("en", "hot pair " + w) for w in "abcdefgh" * 30] + [("fr", "one and the same line")] * 40
    return docs + [("en", None), (None, None), ("de", ""), ("de", " . "), ("en", "x" * 100_000), ("en", "a b " * 3000)]


def found(spark, docs, **options):
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("words", F.lit(1)).withColumn("n", F.lit("clash"))
    rows = c.collocations(df.repartition(3), **options)
    assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in rows.dtypes} == {"string", "bigint"}
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("sizes", [{}, {"bucket": 300, "hot": 40}, {"bucket": 100, "hot": 5}])
def test_equals_plain_counts(spark, monkeypatch, sizes):
    monkeypatch.setattr(c, "BLOCK", 3000)
    docs = corpus(len(sizes))
    assert found(spark, docs, **sizes) == plain(docs)


def test_longer_phrases_and_few_results(spark):
    docs = corpus(7, 150)
    assert found(spark, docs, longest=4, least=4, k=25, hot=30) == plain(docs, 4, 4, 25)


def test_empty_tables(spark):
    assert found(spark, []) == [] == found(spark, [(None, None)] * 3)


@pytest.mark.parametrize("least", [1, 3, 10])
def test_quicksort_counts_prefixes(least):
    rng = np.random.default_rng(least)
    columns = np.minimum(rng.integers(0, 40, (3, 3000)), rng.integers(1, 40, (3, 3000)))
    columns[0] += columns[0] == 0
    columns[2, columns[1] == 0] = 0
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist(), strict=True):
        for depth in range(1, 4):
            if row[depth - 1]:
                want[tuple(row[:depth])] += w
    got = {tuple(columns[:d, p].tolist()): n for d, at, sizes in c.frequent_prefixes(columns, weights, least) for p, n in zip(at.tolist(), sizes.tolist(), strict=True)}
    assert got == {p: n for p, n in want.items() if n >= least}
    assert not list(c.frequent_prefixes(columns[:, :0], weights[:0], 1))


def test_counts_of_a_hundred_billion(spark):
    """Products pass 64 bits; scores stay exact."""
    rows = [("a", 300_000_000_007), ("b", 200_000_000_003), ("a b", 100_000_000_019)]
    counts = spark.createDataFrame([("en", p, n) for p, n in rows], "lang string, phrase string, f long")
    real, c.phrase_counts = c.phrase_counts, lambda docs, **_: (counts, spark.createDataFrame([("en", 10**13)], "lang string, n long"))
    try:
        (row,) = c.collocations(counts).collect()
    finally:
        c.phrase_counts = real
    assert row.score == 10**6 * rows[2][1] ** 2 // (rows[0][1] * rows[1][1])
