"""Near-duplicate vectors against all pairs, with hot clusters, copies and odd rows."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from momentlake.llm import hamming

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, least=0.98):
    """Per row (links, component name) by all pairs; rows in the order given."""
    units = [hamming.unit_vector(v) if label is not None else None for _, v, label in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    groups = defaultdict(list)
    for i, (u, (_, _, label)) in enumerate(zip(units, rows, strict=True)):
        if u is not None:
            groups[label, len(u)].append(i)
    for at in groups.values():
        near = np.stack([units[i] for i in at]) @ np.stack([units[i] for i in at]).T >= least
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            links[at[a]] += 1
            links[at[b]] += 1
            up[find(at[a])] = find(at[b])
    names = defaultdict(list)
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            names[find(i)].append(vec)
    return [(vec, links[i], min(names[find(i)], default=None)) for i, (vec, _, _) in enumerate(rows)]


def near(rng, center, cosine):
    """A vector at this cosine to ``center``."""
    away = rng.standard_normal(len(center))
    away -= (away @ center) * center
    return cosine * center + math.sqrt(1 - cosine**2) * away / np.linalg.norm(away)


def clusters(seed, d, n=260):
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x)
    rows = [unit(rng.standard_normal(d)) for _ in range(n)]
    for size in (2, 3, 5, 9, 40):
        center = unit(rng.standard_normal(d))
        rows += [near(rng, center, rng.uniform(0.985, 0.9999)) * rng.uniform(0.1, 9) for _ in range(size)]
    for i in range(12):  # a chain
        rows.append(near(rng, unit(rows[-1]), 0.985) if i else unit(rng.standard_normal(d)))
    rows += [rows[0], rows[0], rows[1] * 2, -rows[2]]
    return [(int(i), [float(x) for x in v], int(rng.integers(0, 3)) if i < n else i % 2) for i, v in enumerate(rows)]


ODD = [
    (None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (900, [2.0, 4.0], 1), (901, [2.0, 4.0], None), (902, [], 1), (903, None, 1), (904, [0.0, -0.0], 1), (905, [0.0, 0.0], 1),
    (906, [float("nan"), 1.0], 1), (907, [float("inf"), 1.0], 1), (908, [None, 1.0], 1), (909, [1.0, 2.0, 0.0], 1), (910, [3.0], 1), (911, [5.0], 1), (911, [5.0], 1),
    (912, [1e300, 1e300], 2), (913, [1e-300, 1e-300], 2), (None, [7.0, 1.0, 1.0, 1.0], 2), (914, [0.0, 1.0], 3), (915, [-0.0, 1.0], 3),
]


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("key", F.lit(1)).withColumn("code", F.lit(2))
    out = hamming.near_duplicates(df, **options)
    assert out.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    got = out.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("d,block", [(64, 1024), (64, 7), (8, 1024), (100, 1024)])
def test_equals_all_pairs(spark, monkeypatch, d, block):
    monkeypatch.setattr(hamming, "BLOCK", block)
    rows = clusters(d, d) + ODD
    assert found(spark, rows) == sorted(plain(rows), key=str)


def test_empty_tables(spark):
    assert found(spark, []) == []
    rows = [(None, None, None)] * 3 + [(1, [], 1)]
    assert found(spark, rows) == sorted(plain(rows), key=str)


def test_recall_at_the_least_cosine():
    """Pairs exactly at the least cosine, the hardest: the index brings together at least 0.99 of them."""
    rng = np.random.default_rng(1)
    unit = rng.standard_normal((6000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    other = np.stack([near(rng, u, 0.98) for u in unit[:3000]])
    for rows in (60, 6000, 300_000_000):
        bits, tables, most = hamming.layout(0.98, rows)
        codes = hamming.Codes(list(unit), bits, tables)
        a, b = codes.of(unit[:3000]), codes.of(other)
        met = (a == b).any(axis=1) & (np.bitwise_count(a ^ b).sum(axis=1) <= most)
        assert met.mean() >= 0.99, (rows, met.mean())
        unrelated = codes.of(unit[3000:])
        assert np.bitwise_count(a ^ unrelated).sum(axis=1).min() > most


def test_learnt_rotation_fits_better_than_a_random_one():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    rows = base[rng.integers(0, 30, 3000)] + 0.3 * rng.standard_normal((3000, 16))
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    mean, learnt = hamming.quantisation(unit, 16, 0)
    assert np.allclose(learnt.T @ learnt, np.eye(16))
    loss = lambda flat: np.sum((np.sign(flat) * np.abs(flat).mean() - flat) ** 2)
    random_turn = np.linalg.qr(rng.standard_normal((16, 16)))[0]
    assert loss((unit - mean) @ learnt) < loss((unit - mean) @ random_turn)
    balance = ((unit - mean) @ learnt > 0).mean(axis=0)
    assert (abs(balance - 0.5) < 0.25).all()
