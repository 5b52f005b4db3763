"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Unit vectors are centred, projected on their main axes and turned by a rotation that is learnt so that signs
lose least; the signs are balanced binary codes.  Several rotations give as many bits as the tables need.  A code is cut
into one substring a table; vectors whose substrings agree in a table meet there, are compared by the Hamming distance of their whole codes,
and what passes is ranked again by the cosine of the original vectors in double precision.

Two vectors at the least cosine disagree in a bit with probability angle / pi, so the length of a substring (the logarithm of
the largest label, which keeps tables sparse) gives the number of tables for a wanted recall.  A pair that meets in several tables counts in the first.
Equal vectors are one class from the start.  Large buckets are compared by pairs of
blocks; only counts and links that join components leave a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import attach_groups, shared_table
from momentlake.llm.components import components

#: Vectors, and numbers in them, of the sample that rotations are learnt from; learning steps.
SAMPLE, SAMPLE_NUMBERS, STEPS = 10_000, 4_000_000, 30
#: Most bits of one rotation.
ROTATION_BITS = 64
#: Bits of a substring.
LEAST_BITS, MOST_BITS = 8, 24
#: Expected share of pairs at the least cosine that no table brings together.
MISSED = 0.001
#: Standard deviations above the expected Hamming distance at which a pair is given up.
SLACK = 5.0
#: Rows of a bucket's block, and of a place that is compared side by side with others.
BLOCK, SMALL = 256, 48
#: A substring as it is kept: four bytes, the highest first.
_WORD = ">u4"


def quantisation(unit: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the map to ``bits`` numbers whose signs are the code, learnt from rows of unit length."""
    rng = np.random.default_rng(seed)
    mean = unit.mean(axis=0)
    centred = unit - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :bits]
    flat = centred @ axes
    turn = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0]
    for _ in range(STEPS):
        left, _, right = np.linalg.svd(np.sign(flat @ turn).T @ flat)
        turn = (left @ right).T
    return mean, axes @ turn


class Codes:
    """Codes of unit vectors: ``tables`` substrings of ``bits`` bits.  Dimensions without a sample get random rotations."""

    def __init__(self, sample: list[np.ndarray], bits: int, tables: int) -> None:
        self.bits, self.tables = bits, tables
        by_size: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_size.setdefault(len(v), []).append(v)
        self.maps = {d: self._learnt(d, np.stack(rows)) for d, rows in by_size.items()}

    def _learnt(self, d: int, unit: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
        own = min(d, ROTATION_BITS)
        if unit is None or len(unit) < 2:
            rng = np.random.default_rng(d)
            unit = rng.standard_normal((2 * own, d))
            unit /= np.linalg.norm(unit, axis=1)[:, None]
        return [quantisation(unit, own, seed) for seed in range(-(-self.bits * self.tables // own))]

    def of(self, unit: np.ndarray) -> np.ndarray:
        """One row of ``tables`` substrings for each row."""
        d = unit.shape[1]
        if d not in self.maps:
            self.maps[d] = self._learnt(d, None)
        signs = np.concatenate([(unit - mean) @ turned > 0 for mean, turned in self.maps[d]], axis=1)
        signs = signs[:, : self.bits * self.tables].reshape(len(unit), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def unit_vector(v: object) -> np.ndarray | None:
    """The vector at length one in double precision; None where it has no direction."""
    if v is None or isinstance(v, float):
        return None
    try:
        x = np.array(v, np.float64)
    except (TypeError, ValueError):
        return None
    if not len(x) or not np.isfinite(x).all() or not (most := np.abs(x).max()):
        return None
    x = x / most
    return x / np.sqrt(x @ x)


def layout(least: float, rows: int) -> tuple[int, int, int]:
    """Bits of a substring, number of tables, and the largest Hamming distance, for labels of so many rows."""
    differ = math.acos(max(-1.0, min(1.0, least))) / math.pi
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, rows)))))
    agree = max((1 - differ) ** bits, 1e-9)
    tables = 1 if agree > 1 - MISSED else math.ceil(math.log(MISSED) / math.log(1 - agree))
    total = bits * tables
    return bits, tables, math.ceil(differ * total + SLACK * math.sqrt(total * differ * (1 - differ)))


def _described(rows: DataFrame, codes: Codes) -> DataFrame:
    """(vec_id, label, key, code, unit) of each row; the last three are null for what links with nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts, units = [None] * len(batch), [None] * len(batch), [None] * len(batch)
            sizes: dict[int, list[int]] = {}
            for i, (label, v) in enumerate(zip(batch["label"], batch["embedding"], strict=True)):
                x = unit_vector(v) if isinstance(label, str) else None
                if x is not None:
                    # Equal components, either zero, in the same label.
                    exact = (np.array(v, np.float64) + 0.0).tobytes()
                    keys[i] = hashlib.blake2b(exact + label.encode(), digest_size=16, salt=len(x).to_bytes(8, "little")).digest()
                    units[i] = x
                    sizes.setdefault(len(x), []).append(i)
            for at in sizes.values():
                for i, code in zip(at, codes.of(np.stack([units[i] for i in at])), strict=True):
                    texts[i] = code.astype(_WORD).tobytes()
            columns = {"key": keys, "code": texts, "unit": [None if u is None else u.tobytes() for u in units]}
            yield batch[["vec_id", "label"]].assign(**{c: pd.Series(x, batch.index, dtype=object) for c, x in columns.items()})

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"vec_id {kind}, label string, key binary, code binary, unit binary")


def _agreement(codes: np.ndarray, table: int, most: int) -> np.ndarray:
    """Which pairs of rows meet in ``table`` before any other and are within ``most`` bits."""
    n = len(codes)
    far, earlier = np.zeros((n, n), np.uint16), np.zeros((n, n), bool)
    for t, column in enumerate(codes.T):
        differ = column[:, None] ^ column[None, :]
        far += np.bitwise_count(differ)
        if t < table:
            earlier |= differ == 0
    out = (far <= most) & ~earlier & (codes[:, table][:, None] == codes[:, table][None, :])
    np.fill_diagonal(out, False)
    return out


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """(root, member) pairs that connect what ``link`` connects."""
    open_, out = link.any(axis=1), []
    while open_.any():
        root = int(np.argmax(open_))
        open_[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(link[front].any(axis=0) & open_)
            open_[front] = False
            out += [(root, int(j)) for j in front]
    return out


def _spanning(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """The pairs that join what earlier ones have not."""
    root: dict[int, int] = {}
    out = []
    for a, b in zip(left, right, strict=True):
        x, y = a, b
        while root.get(x, x) != x:
            x = root[x] = root.get(root[x], root[x])
        while root.get(y, y) != y:
            y = root[y] = root.get(root[y], root[y])
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


_PLACE = ["label", "bucket", "table", "first", "second"]


def _whole_places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of complete places, numbered by ``place``; a task streams them in order."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held.drop(columns="place"), batch], ignore_index=True)
        keys = rows[_PLACE]
        rows = rows.assign(place=(keys != keys.shift()).any(axis=1).cumsum())
        last = rows["place"] == rows["place"].iloc[-1]
        held = rows[last]
        if not last.all():
            yield rows[~last].reset_index(drop=True)
    if held is not None:
        yield held.reset_index(drop=True)


def _candidates(rows: pd.DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Candidate pairs: those of small places as (i, j) for all at once, and for each large place its rows and a matrix."""
    codes = np.frombuffer(b"".join(rows["code"]), _WORD).astype(np.uint32).reshape(len(rows), -1)
    place = rows["place"].to_numpy()
    table, block = rows["table"].to_numpy(), rows["block"].to_numpy()
    across = (rows["first"] != rows["second"]).to_numpy()
    place = place - place[0]
    size = np.bincount(place)[place]
    small = size <= SMALL
    left, right = [], []
    for step in range(1, int(size[small].max(initial=1))):
        i = np.flatnonzero(small[:-step] & (place[:-step] == place[step:]))
        j = i + step
        differ = codes[i] ^ codes[j]
        earlier = ((differ == 0) & (np.arange(codes.shape[1]) < table[i][:, None])).any(axis=1)
        fits = ~earlier & (np.bitwise_count(differ).sum(axis=1) <= most) & (~across[i] | (block[i] != block[j]))
        left.append(i[fits])
        right.append(j[fits])
    large = []
    for number in np.unique(place[~small]).tolist():
        at = np.flatnonzero(place == number)
        met = _agreement(codes[at], int(table[at[0]]), most)
        if across[at[0]]:
            met &= block[at][:, None] != block[at][None, :]
        large.append((at, met))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), large


def _placed(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE, "node")


def _retrieved(classes: DataFrame, bits: int, tables: int, most: int) -> DataFrame:
    """(place, block, node): what has a candidate in a bucket."""
    word = lambda t: F.conv(F.hex(F.substring("code", 4 * t + 1, 4)), 16, 10).cast("long")
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("table"), word(t).alias("bucket")) for t in range(tables)])).alias("at")
    rows = classes.select("label", "node", "code", each).select("label", "at.bucket", "at.table", "node", "code")
    whole = Window.partitionBy("label", "bucket", "table")
    blocks = F.ceil(F.count("*").over(whole) / BLOCK)
    rows = rows.withColumn("n", F.count("*").over(whole)).withColumn("blocks", blocks).where("n > 1")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "label", "bucket", "table", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "node", "code"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_places(batches):
            i, j, large = _candidates(rows, most)
            found = np.zeros(len(rows), bool)
            found[i] = found[j] = True
            for at, met in large:
                found[at] = met.any(axis=1)
            yield rows[found][[*_PLACE, "block", "node"]]

    return _placed(rows).mapInPandas(run, "label string, bucket long, table int, first long, second long, block long, node long")


def _reranked(found: DataFrame, classes: DataFrame, least: float, most: int) -> DataFrame:
    """Rows (node, links) with the linked rows of other classes, and (node, other) that connect classes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_places(batches):
            units = [np.frombuffer(u, np.float64) for u in rows["unit"]]
            nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
            links, pairs = np.zeros(len(rows), np.int64), []
            i, j, large = _candidates(rows, most)
            near = np.array([len(units[a]) == len(units[b]) and units[a] @ units[b] >= least for a, b in zip(i, j, strict=True)], bool)
            i, j = i[near], j[near]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            pairs += _spanning(i.tolist(), j.tolist())
            for at, met in large:
                link = np.zeros_like(met)
                sizes = np.array([len(units[a]) for a in at])
                for size in np.unique(sizes).tolist():
                    same = np.flatnonzero(sizes == size)
                    unit = np.stack([units[at[a]] for a in same])
                    link[np.ix_(same, same)] = unit @ unit.T >= least
                link &= met
                links[at] += link @ copies[at]
                pairs += [(at[a], at[b]) for a, b in _forest(link)]
            some = links > 0
            yield pd.DataFrame({"node": nodes[some], "links": links[some]}).reindex(columns=_LINKS)
            yield pd.DataFrame({"node": [nodes[a] for a, _ in pairs], "other": [nodes[b] for _, b in pairs]}).reindex(columns=_LINKS)

    full = found.join(classes.select("node", "code", "unit", "copies"), "node")
    return _placed(full).mapInPandas(run, "node long, links long, other long")


_LINKS = ["node", "links", "other"]


def near_duplicates(vectors: DataFrame, *, least: float = 0.98, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows of one label link where the cosine is at least ``least``.  component_id is the smallest id that
    links reach, the row itself included; kept tells whether it is the row's own.  Null labels, and vectors that are null, empty, zero or hold
    null or non-finite components, link with nothing; so do vectors of different lengths.  Repeated rows link with each other; a
    null id counts as a link and is never a component's name beside another id.  Other columns are not read; an empty table gives an empty result.
    Rotations are learnt from the ``sample`` rows with the smallest hashes; all rows are indexed.  The index brings together 0.999 of the pairs
    at the least cosine, and more of nearer ones; no pair below it is linked.
    """
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    facts = rows.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"))
    facts = facts.agg(F.sum("n").alias("all"), F.max("n").alias("largest"), F.max("d").alias("d")).first()
    largest = facts["largest"] or 1
    wanted = max(2, min(sample, SAMPLE_NUMBERS // max(1, facts["d"] or 1)))
    # Tasks offer rows with small hashes only, a few times as many as are wanted altogether.
    place = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 40))
    usable = rows.where("label is not null and size(embedding) > 0").where(place < int(min(1.0, 4 * wanted / (facts["all"] or 1)) * (1 << 40)))
    taken: list[np.ndarray] = []
    # At most SAMPLE_NUMBERS numbers.
    for r in usable.orderBy(place, "vec_id").limit(wanted).select("embedding").collect():
        x = unit_vector(r["embedding"])
        if x is not None:
            taken.append(x)
    bits, tables, most = layout(least, largest)
    described = shared_table(_described(rows, Codes(taken, bits, tables)), compact=False)
    classes = described.where("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("code").alias("code"), F.first("unit").alias("unit"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    # Numbers are fixed by being written.
    classes = shared_table(classes.withColumn("node", F.monotonically_increasing_id()), compact=False)
    found = shared_table(_retrieved(classes, bits, tables, most))
    links = shared_table(_reranked(found, classes, least, most))
    counted = links.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("key", "node", "least", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = named.join(names, "root").join(counted, "node", "left").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("group_size")
    )
    alone = described.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = attach_groups(described.where("key is not null").select("vec_id", "key"), shared_table(groups), "key")
    out = out.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
