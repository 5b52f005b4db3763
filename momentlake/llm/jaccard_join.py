"""Exact n-gram Jaccard join as a metric-space join.

Jaccard distance is a metric, but two unrelated documents are at distance 1 from each other and from
any third one, so documents alone cannot serve as pivots: every window would take in every region.
The first level therefore uses the sets of one shingle as pivots.  A document is nearer than 1 to
exactly the pivots it holds; of those, all equally near, the rarest is its home.  A document within
the radius misses at most a known number of its shingles (the triangle inequality on set sizes), so
replicating it to that many next pivots makes every linked pair meet in a region.

Inside a region two documents are compared by bitmaps that hold the parity of their shingles' hashes: the
Hamming distance of bitmaps is never above the number of shingles in which the sets differ, so what it rules out is not
linked.  Documents that it leaves linked join into cells.  A cell that fits in a task is joined there exactly, by
pivot rows: one document against all, until those left are known to be connected.  In a cell that does
not fit, each region is joined for itself, and a region that still does not fit is divided again by
document pivots: Voronoi homes, windows of twice the radius, recursively; what does not
shrink is joined by pairs of blocks.  Only links that join components leave a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import attach_groups, boxed, gram_hashes, hashed_words, shared_table, words_in
from momentlake.llm.components import components

#: Counters in which word frequencies are kept (hashed; the order of shingles needs no exact counts).
COUNTERS = 1 << 18
#: Shingles of all documents of a cell, region or block that one task joins.
TASK_SHINGLES = 1_000_000
#: Documents of a region's block.
BLOCK_DOCS = 2048
#: Documents that share a region with others up to which their ids are broadcast.
BROADCAST_CHOSEN = 500_000
#: Document pivots of a region that is divided, and how often it is divided again.
PIVOTS, LEVELS = 16, 2


@dataclass(frozen=True)
class Rule:
    """Two sets link when ``of * intersection >= least * union``; shingles are ``gram`` words."""

    gram: int = 3
    least: int = 90
    of: int = 100

    def sets(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Sorted distinct hashes of each text's shingles; of fewer words, the whole sequence as one."""
        for words in hashed_words(texts):
            yield self.of_words(words)[0]

    def of_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A text's set, and where each shingle first stands."""
        return np.unique(gram_hashes(words, self.length(words)), return_index=True)

    def length(self, words: np.ndarray) -> int:
        return self.gram if len(words) >= self.gram else max(1, len(words))

    def rarity(self, words: np.ndarray, at: np.ndarray, commonness: np.ndarray) -> np.ndarray:
        """Order of the shingles that stand at ``at``: how common they would be if words were independent."""
        each = commonness[_counter(words)]
        return sum(each[at + i] for i in range(self.length(words)))

    def window(self, n: int) -> int:
        """Pivots of a set of n shingles among which the first shared with a linked set must be."""
        return n - -(-self.least * n // self.of) + 1

    def linked(self, common: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
        return self.of * common >= self.least * (n + sizes - common)

    def size_class(self, n: int) -> int:
        """Sets of linked documents are in the same class or in adjacent ones."""
        return int(np.log(n) / (np.log(self.of / self.least) * (1 + 1e-9))) if self.least < self.of else n

    def bitmap(self, shingles: np.ndarray) -> bytes:
        """Parity of the hashes by their last bits, in as many bits as the next power of two (64 at least)."""
        bits = max(64, 1 << (len(shingles) - 1).bit_length())
        odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    def may_link(self, n: int, bits: bytes, m: int, other: bytes) -> bool:
        """False only for sets that are not linked: sizes and the distance of bitmaps tell."""
        if self.of * min(n, m) < self.least * max(n, m):
            return False
        x, y, width = int.from_bytes(bits, "little"), int.from_bytes(other, "little"), 8 * min(len(bits), len(other))
        differ = (_folded(x, 8 * len(bits), width) ^ _folded(y, 8 * len(other), width)).bit_count()
        return differ * (self.of + self.least) <= (n + m) * (self.of - self.least)

    @property
    def radius(self) -> float:
        return 1 - self.least / self.of


def _counter(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(46)).astype(np.int64)


def _folded(bits: int, width: int, to: int) -> int:
    """The bitmap of ``to`` bits that the one of ``width`` bits implies."""
    while width > to:
        width //= 2
        bits = (bits >> width) ^ (bits & ((1 << width) - 1))
    return bits


def _node(shingles: np.ndarray) -> int:
    """One number for a set: equal sets have equal ones."""
    import xxhash

    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def _describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per row doc_id, digest of the text, n, node and bitmap (null for an empty set), and per task counts of words by counter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            ns, nodes, bits, held = [], [], [], []
            for words in hashed_words(batch["text"]):
                s, _ = rule.of_words(words)
                ns.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                bits.append(rule.bitmap(s) if len(s) else None)
                held.append(_counter(words))
                if sum(map(len, held)) >= COUNTERS or len(ns) == len(batch):
                    counts += np.bincount(np.concatenate(held), minlength=COUNTERS)
                    held = []
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": ns, "node": pd.array(nodes, "Int64"), "bits": bits, "digest": batch["digest"].astype(object)})
        full = np.flatnonzero(counts)
        for at in range(0, len(full), 65536):
            part = full[at : at + 65536]
            yield pd.DataFrame({"counter": part, "count": counts[part]})

    def filled(batches):
        for out in run(batches):
            out = out.reindex(columns=["doc_id", "n", "node", "counter", "count", "bits", "digest"])
            numbers = {c: "Int64" for c in out.columns if c not in ("bits", "digest")}
            texts = {c: out[c].astype(object).where(out[c].notna(), None) for c in ("bits", "digest")}
            yield out.assign(**texts).astype(numbers)

    named = docs.select("doc_id", "text", _digest(F.col("text")).alias("digest"))
    return named.mapInPandas(filled, "doc_id long, n long, node long, counter long, count long, bits binary, digest binary")


def _digest(text: Column) -> Column:
    """128 bits that name a text; with its doc_id, null included, they name a row."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _region_rows(docs: DataFrame, rule: Rule, order) -> DataFrame:
    """(pivot, class, node, n): each document in the regions of its window, with its class of size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        commonness, seen = np.frombuffer(order.value, np.int64), set()
        for batch in batches:
            pivots, classes, nodes, ns = [], [], [], []
            for words in hashed_words(batch["text"]):
                s, at = rule.of_words(words)
                if not len(s) or (node := _node(s)) in seen:
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(node)
                first = np.lexsort((s, rule.rarity(words, at, commonness)))[: rule.window(len(s))]
                pivots.append(s[first].view(np.int64))
                classes.append(np.full(len(first), rule.size_class(len(s))))
                nodes.append(np.full(len(first), node))
                ns.append(np.full(len(first), len(s)))
            if pivots:
                yield pd.DataFrame({"pivot": np.concatenate(pivots), "class": np.concatenate(classes), "node": np.concatenate(nodes), "n": np.concatenate(ns)})

    return docs.select("text").mapInPandas(run, "pivot long, class int, node long, n int")


def _regions(rows: DataFrame) -> DataFrame:
    """(region, node, n, docs): regions of two or more documents, one of those with equal documents.

    The empty set is one more pivot: distances to it are sizes, and its windows cut each region
    into classes of size, where a document is in its own class and, as a visitor, in the next one.
    """
    distinct = rows.repartition("pivot").dropDuplicates(["pivot", "node"])
    windows = F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class")
    distinct = distinct.select("pivot", "node", "n", windows)
    whole = Window.partitionBy("pivot", "class")
    marked = distinct.select(
        F.xxhash64("pivot", "class").alias("region"),
        "node",
        "n",
        F.count("*").over(whole).alias("docs"),
        F.min("node").over(whole).alias("least"),
        F.bit_xor(F.xxhash64("node")).over(whole).alias("mark_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).over(whole).alias("mark_b"),
    )
    marked = shared_table(marked.where("docs > 1"), compact=False)
    same = ["docs", "least", "mark_a", "mark_b"]
    first = marked.groupBy(*same).agg(F.min("region").alias("region")).select("region")
    return marked.join(first, "region", "left_semi").select("region", "node", "n", "docs")


def _near(regions: DataFrame, marks: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): what connects the documents of each region that sizes and bitmaps do not tell apart.

    A region of many documents is compared by pairs of blocks, so a task holds two blocks at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, out = None, [], []
        for batch in batches:
            for region, first, second, node, n, bits in batch.itertuples(index=False, name=None):
                if (region, first, second) != now:
                    out += _close(held, rule)
                    now, held = (region, first, second), []
                held.append((n, node, bits))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        if out := _close(held, rule):
            yield pd.DataFrame(out, columns=["a", "b"])

    blocks = F.ceil(F.col("docs") / BLOCK_DOCS)
    cut = regions.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "region", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "node"
    )
    key = ["region", "first", "second"]
    ordered = paired.join(marks, "node").select(*key, "node", "n", "bits").repartition("region", "first", "second")
    return ordered.sortWithinPartitions(*key, "n", "node").mapInPandas(run, "a long, b long")


def _close(held: list[tuple[int, int, bytes]], rule: Rule) -> list[tuple[int, int]]:
    """Links that connect what may be linked among (n, node, bitmap) in the order of n."""
    label = list(range(len(held)))

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    out = []
    for i, (n, node, bits) in enumerate(held):
        for j in range(i + 1, len(held)):
            m, other, more = held[j]
            if rule.of * n < rule.least * m:
                break
            if (x := find(i)) != (y := find(j)) and rule.may_link(n, bits, m, more):
                label[max(x, y)] = min(x, y)
                out.append((node, other))
    return out


class Sets:
    """The sets of a task's documents in one numbering of shingles, for rows of overlaps."""

    def __init__(self, rule: Rule, sets: list[np.ndarray]) -> None:
        self.rule, self.sizes = rule, np.array([len(s) for s in sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        values, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.held = np.zeros(len(values), bool)

    def overlaps(self, i: int) -> np.ndarray:
        """Size of the intersection of set i with every set."""
        own = self.flat[self.ends[i] - self.sizes[i] : self.ends[i]]
        self.held[own] = True
        out = np.bincount(self.owner[self.held[self.flat]], minlength=len(self.sizes))
        self.held[own] = False
        return out


def joined(rule: Rule, sets: list[np.ndarray]) -> np.ndarray:
    """Component number of each set, by rows of pivots.

    Each row compares one set with all.  A set needs no row of its own if every other set without
    one is in its component, or differs from it by more than the radius in its distance to
    some pivot.
    """
    index, n = Sets(rule, sets), len(sets)
    label = np.arange(n)
    open_ = np.ones(n, bool)
    distances: list[np.ndarray] = []
    while True:
        counts = np.bincount(label[open_], minlength=n)
        if np.count_nonzero(counts) <= 1:
            return label
        # Not from the largest component: once all that is open lies in one, the join is complete.
        pivot = np.flatnonzero(open_ & (label != np.argmax(counts)))[0]
        rivals = open_ & (label != label[pivot])
        for d in distances:
            rivals &= np.abs(d - d[pivot]) <= rule.radius + 1e-9
        open_[pivot] = False
        if not rivals.any():
            continue
        common = index.overlaps(pivot)
        union = index.sizes + index.sizes[pivot] - common
        distances = [*distances[-7:], 1 - common / union]
        near = np.unique(label[rule.linked(common, index.sizes[pivot], index.sizes)])
        label[np.isin(label, near)] = near.min()


def _links(nodes: list[int], label: np.ndarray) -> list[tuple[int, int]]:
    """(a, b): each document beside the least node of its component."""
    least: dict[int, int] = {}
    for node, at in zip(nodes, label.tolist(), strict=True):
        least[at] = min(node, least.get(at, node))
    return [(node, least[at]) for node, at in zip(nodes, label.tolist(), strict=True) if node != least[at]]


def _join_groups(texts: DataFrame, key: list[str], rule: Rule) -> DataFrame:
    """Links inside each group of (*key, node, text).  Tasks stream groups in the order of their key
    and hold one at a time; its size is bounded by the callers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, out = None, {}, []

        def links() -> list[tuple[int, int]]:
            return _links(list(held), joined(rule, list(rule.sets(held.values())))) if len(held) > 1 else []

        for batch in batches:
            for group, node, text in zip(batch[key].itertuples(index=False, name=None), batch["node"], batch["text"], strict=True):
                if group != now:
                    out += links()
                    now, held = group, {}
                held.setdefault(node, text)
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        if out := links():
            yield pd.DataFrame(out, columns=["a", "b"])

    ordered = texts.select(*key, "node", "text").repartition(*key).sortWithinPartitions(*key, "node")
    return ordered.mapInPandas(run, "a long, b long")


def _divided(texts: DataFrame, rule: Rule, level: int) -> tuple[DataFrame, DataFrame]:
    """One Voronoi division of regions (region, node, n, text): links to pivots, and the new regions.

    Pivots: the documents of a region with the smallest hashes.  Each document goes to the region of its nearest
    pivot and, as a visitor, to every region whose pivot is at most twice the radius farther.
    """
    by_hash = Window.partitionBy("region").orderBy(F.xxhash64(F.lit(level), "node"))
    slim = texts.select("region", "node").withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= PIVOTS)
    pivots = texts.join(slim, ["region", "node"]).select(
        F.col("region").alias("region"), F.col("node").alias("pivot"), F.col("text").alias("pivot_text")
    )
    chunk = F.pmod(F.xxhash64("node"), F.lit(64))
    members = texts.withColumn("chunk", chunk)
    pivots = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))

    def assign(member: pd.DataFrame, pivot: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(member) and len(pivot):
            pivot = pivot.sort_values("pivot")
            own, names = list(rule.sets(pivot["pivot_text"])), pivot["pivot"].to_numpy()
            for m, s in zip(member.itertuples(), rule.sets(member["text"]), strict=True):
                common = np.array([len(np.intersect1d(s, p, assume_unique=True)) for p in own])
                sizes = np.array([len(p) for p in own])
                away = 1 - common / (len(s) + sizes - common)
                home = int(np.argmin(away))
                for j in np.flatnonzero(away <= away[home] + 2 * rule.radius + 1e-9):
                    link = bool(rule.linked(common[j : j + 1], len(s), sizes[j : j + 1])[0])
                    rows.append((m.region, m.node, m.n, names[j], link))
        return pd.DataFrame(rows, columns=["region", "node", "n", "pivot", "link"])

    placed = shared_table(
        members.groupBy("region", "chunk")
        .cogroup(pivots.groupBy("region", "chunk"))
        .applyInPandas(assign, "region long, node long, n int, pivot long, link boolean")
    )
    links = placed.where("link").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    inner = placed.withColumn("region", F.xxhash64("region", "pivot"))
    return links, inner.select("region", "node", "n")


def _fits(members: DataFrame, limit: int) -> DataFrame:
    return members.groupBy("region").agg((F.sum("n") <= limit).alias("fits"))


def _large_links(members: DataFrame, node_texts: DataFrame, rule: Rule, limit: int) -> DataFrame:
    """Links of regions (region, node, n) outside the cells that fit in a task."""
    found = None
    add = lambda more: more if found is None else found.unionByName(more)
    for level in range(LEVELS + 1):
        sized = shared_table(members.distinct().join(_fits(members, limit), "region"))
        small = sized.where("fits").join(node_texts, "node")
        found = add(_join_groups(small, ["region"], rule))
        large = sized.where("not fits").drop("fits")
        if large.isEmpty():
            return found
        if level < LEVELS:
            links, members = _divided(large.join(node_texts, "node"), rule, level)
            found = add(links)
    # What does not shrink: every pair of blocks is a group of two blocks at most.
    blocks = large.groupBy("region").agg(F.ceil(F.sum("n") * 4 / limit).alias("blocks"))
    cut = large.join(blocks, "region").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = cut.withColumn("other", other).select(
        "region", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "node"
    )
    return found.unionByName(_join_groups(paired.join(node_texts, "node"), ["region", "first", "second"], rule))


def jaccard_components(docs: DataFrame, *, rule: Rule | None = None, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    component_id is the smallest ``doc_id`` that links reach, the row itself included.  Equal sets
    are one node, so copies add no pairs.  Null, empty and blank texts have no shingles and link
    with nothing; a row with a null ``doc_id`` links as any other and names no component beside an id; repeated
    rows are copies of each other; other columns are not read; an empty table gives an empty result.
    Sets are compared by 64-bit hashes of their shingles.
    """
    rows = _labelled(docs, rule or Rule(), task_shingles)
    groups = shared_table(
        rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("group_size"))
    )
    out = attach_groups(rows.select("doc_id", "n", "component"), groups, "component")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def _labelled(docs: DataFrame, rule: Rule, task_shingles: int) -> DataFrame:
    """(doc_id, digest, n, component) of each row; the component is null for an empty set."""
    spark = docs.sparkSession
    # As it comes: a task's counts stand apart from its documents, so reads of either skip the other.
    described = shared_table(_describe(docs, rule), compact=False)
    rows = described.where("counter is null").select("doc_id", "digest", "n", "node", "bits")
    totals = described.where("counter is not null").groupBy("counter").agg(F.sum("count").alias("count"))
    ranks = np.zeros(COUNTERS, np.int64)
    for r in totals.collect():  # at most COUNTERS rows
        ranks[r["counter"]] = r["count"]
    # In steps of 1/64 of a doubling.
    commonness = np.rint(64 * np.log2(ranks + 1)).astype(np.int64)
    order = spark.sparkContext.broadcast(commonness.tobytes())
    regions = shared_table(_regions(_region_rows(docs, rule, order)))
    marks = rows.where("node is not null").groupBy("node").agg(F.max("n").alias("n"), F.max("bits").alias("bits"))
    # Written, so that no task holds two Python workers at once.
    roots = components(shared_table(_near(regions, marks, rule)))
    least = roots.select(F.col("root").alias("node"), "root")
    sizes = rows.where("node is not null").groupBy("node").agg(F.max("n").alias("n"))
    cells = sizes.join(roots.unionByName(least).distinct(), "node").withColumnRenamed("root", "cell")
    weight = cells.groupBy("cell").agg((F.sum("n") <= task_shingles).alias("whole"))
    cells = shared_table(cells.join(weight, "cell"))
    # One row per node that shares a region.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("one")
    chosen = rows.join(cells, "node").groupBy("node", "cell", "whole").agg(one)
    chosen = shared_table(chosen.select("node", "cell", "whole", _row_name(F.col("one.doc_id"), F.col("one.digest")).alias("row")))
    labels = _join_groups(_texts_of(docs, chosen.where("whole"), rule), ["cell"], rule)
    labels = labels.select(F.col("a").alias("node"), F.col("b").alias("root"))
    large = chosen.where("not whole")
    if not large.isEmpty():
        node_texts = shared_table(_texts_of(docs, large, rule).select("node", "text"), compact=False)
        apart = regions.join(large.select("node"), "node", "left_semi").select("region", "node", "n")
        labels = labels.unionByName(components(shared_table(_large_links(apart, node_texts, rule, task_shingles))))
    labels = shared_table(labels)
    return rows.drop("bits").join(labels, "node", "left").withColumn("component", F.coalesce("root", "node"))


def _row_name(doc_id: Column, digest: Column) -> Column:
    return F.concat(digest, F.coalesce(doc_id.cast("string"), F.lit("-")).cast("binary"))


def _texts_of(docs: DataFrame, chosen: DataFrame, rule: Rule) -> DataFrame:
    """(cell, node, text) of the chosen (cell, node, row)."""
    named = chosen.select("row", "node", "cell")
    # Beyond the bound both sides are shuffled by their unique names.
    if chosen.limit(BROADCAST_CHOSEN + 1).count() <= BROADCAST_CHOSEN:
        named = F.broadcast(named)
    rows = docs.select(_row_name(F.col("doc_id"), _digest(F.col("text"))).alias("row"), "text")
    return rows.join(named, "row").select("cell", "node", "text")


def one_per_component(docs: DataFrame, *, rule: Rule | None = None, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the smallest ``doc_id`` (null last), of
    rows with that id the one with the least digest of its text, of equal rows any.

    Rows of null, empty and blank texts are no copies of each other and all stay; an empty table stays empty.
    """
    rows = _labelled(docs, rule or Rule(), task_shingles).where("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("one")
    kept = shared_table(rows.groupBy("component").agg(first).select(_row_name(F.col("one.doc_id"), F.col("one.digest")).alias("row")))
    text = F.col("text")
    named = boxed(docs, _row_name(F.col("doc_id"), _digest(text)).alias("row"), (words_in(text) == 0).alias("blank"))
    ours = named.where("not blank").join(kept, "row", "left_semi")
    # Equal rows, on the partitioning of the join.
    ours = ours.withColumn("r", F.row_number().over(Window.partitionBy("row").orderBy(F.lit(0)))).where("r = 1")
    return ours.select("box.*").unionByName(named.where("blank").select("box.*"))
