"""Ranked lexical search without random access (NRA) over an index that is divided by documents.

A first scan writes the index: blocks of documents with the counts of all query terms in them, and adds up the
statistics of the corpus.  A second scan searches it.  In a block the entries of all lists are read in the order
of falling impact.  A document's lower bound for an item is the sum over the entries read; its upper bound adds, for
each term of the item not yet seen in it, the impact at which reading stands.  A pair of item and document whose
upper bound is below the item's k-th best score is given up; the others are read to the end, so their scores are exact and ties
are settled by id.  A task keeps the best k of each item from block to block, which raises the bar for later blocks;
the lists of all tasks meet in two levels of windows.

Items are searched in chunks of bounded size, each with a scan of its own.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import shared_table
from momentlake.llm.words import Cutter, Vocabulary

#: A term is a run of anything but these; fixed by the contract of the query.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAPS = [c for c in range(128) if not chr(c).isalnum()]

#: Documents of an index block, and its entries, which more documents do not exceed.
BLOCK_DOCS, BLOCK_ENTRIES = 2048, 400_000
#: Rows (item, term) and items that one scan searches; a single longer item is searched whole.
CHUNK_TERMS, CHUNK_ITEMS = 200_000, 1000
#: Reads of equal length in which a block is searched.
READS = 12
#: Highest impact an entry can have, before the weight of its term.
TOP_IMPACT = 1_000_000


def terms_of(text: Column) -> Column:
    """All terms of a text in order, A-Z lowered; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(TERM_PATTERN), 0)


def _index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Blocks (ids, sizes, doc, term, tf as arrays in bytes) and, per task, rows of counts: (term, df), N as term -1, L as -2."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, vocabulary = Cutter(_GAPS), Vocabulary([t.encode("utf-8", "surrogatepass") for t in terms])
        v = max(1, len(terms))
        df, n_docs, n_terms = np.zeros(v, np.int64), 0, 0
        held: list[tuple] = []
        for batch in batches:
            sizes = np.zeros(len(batch), np.int64)
            keys, counts = [], []
            for words in cutter.words(batch["text"]):
                sizes += np.bincount(words.owner, minlength=len(batch))
                found = vocabulary.find(words)
                known = found >= 0
                key, tf = np.unique(words.owner[known] * v + found[known], return_counts=True)
                keys.append(key)
                counts.append(tf)
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            tf = np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)
            doc, term = key // v, key % v
            df += np.bincount(term, minlength=v)
            n_docs, n_terms = n_docs + int(np.count_nonzero(sizes)), n_terms + int(sizes.sum())
            ids = batch["doc_id"].astype("Int64")
            # A null id sorts after all others.
            held.append((ids.fillna(0).to_numpy(np.int64), ids.isna().to_numpy(), sizes, doc, term, tf))
            if sum(len(h[0]) for h in held) >= BLOCK_DOCS or sum(len(h[3]) for h in held) >= BLOCK_ENTRIES:
                yield _block(held)
                held = []
        if held:
            yield _block(held)
        full = np.concatenate([np.flatnonzero(df), [-1, -2]])
        yield pd.DataFrame({"term": full, "count": np.concatenate([df[full[:-2]], [n_docs, n_terms]])}).reindex(columns=_FIELDS)

    return docs.select("doc_id", "text").mapInPandas(run, "term long, count long, ids binary, nulls binary, sizes binary, docs binary, terms binary, tfs binary")


_FIELDS = ["term", "count", "ids", "nulls", "sizes", "docs", "terms", "tfs"]


def _block(held: list[tuple]) -> pd.DataFrame:
    ids, nulls, sizes, doc, term, tf = (list(x) for x in zip(*held, strict=True))
    before = np.cumsum([0] + [len(x) for x in ids[:-1]])
    doc = [d + b for d, b in zip(doc, before, strict=True)]
    parts = (ids, nulls, sizes, doc, term, tf)
    kinds = (np.int64, np.uint8, np.int64, np.int32, np.int32, np.int32)
    row = [np.concatenate(x).astype(kind).tobytes() for x, kind in zip(parts, kinds, strict=True)]
    return pd.DataFrame([[None, None, *row]], columns=_FIELDS)


class Search:
    """The items of a chunk in the numbers of its terms, and the best k documents of each so far."""

    def __init__(self, rows: list[tuple[int, int, int]], n_items: int, weights: np.ndarray, k: int) -> None:
        """rows: (item, term, times)."""
        items, terms, times = (np.array(x, np.int64) for x in zip(*sorted(rows, key=lambda r: r[1]), strict=True))
        self.k, self.n_items = k, n_items
        self.item, self.weight = items, weights[terms] * times
        self.first = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.term = terms
        total = np.bincount(items, self.weight, n_items)
        #: Sums of doubles are exact below this.
        self.kind = np.float64 if (total * TOP_IMPACT < 2**53).all() else np.int64
        self.best: list[list[tuple[int, bool, int]]] = [[] for _ in range(n_items)]
        self.bar = np.ones(n_items, self.kind)

    def _sum(self, cell: np.ndarray, values: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        if self.kind is np.float64:
            return np.bincount(cell, values, shape[0] * shape[1]).reshape(shape)
        out = np.zeros(shape[0] * shape[1], np.int64)
        np.add.at(out, cell, values)
        return out.reshape(shape)

    def read(self, ids: np.ndarray, nulls: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Search one block."""
        order = np.argsort(-impact, kind="stable")
        doc, term, impact = doc[order], term[order], impact[order]
        present = np.zeros(len(self.first) - 1, bool)
        present[term] = True
        # A list without entries in the block cannot add to a score.
        total = np.bincount(self.item, np.where(present[self.term], self.weight, 0), self.n_items).astype(self.kind)
        shape = (self.n_items, len(ids))
        lower, seen = np.zeros(shape, self.kind), np.zeros(shape, self.kind)
        alive = np.repeat(total[:, None] > 0, len(ids), axis=1)
        size = -(-len(doc) // READS)
        for start in range(0, len(doc), max(1, size)):
            part = slice(start, start + size)
            wanted = alive.any(axis=0)[doc[part]]
            d, t, s = doc[part][wanted], term[part][wanted], impact[part][wanted]
            times = self.first[t + 1] - self.first[t]
            entry = np.repeat(np.arange(len(t)), times)
            at = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times) + self.first[t][entry]
            item, weight = self.item[at], self.weight[at]
            cell = item * len(ids) + d[entry]
            lower += self._sum(cell, weight * s[entry], shape)
            seen += self._sum(cell, weight, shape)
            frontier = impact[start + size] if start + size < len(doc) else 0
            alive &= lower + frontier * (total[:, None] - seen) >= self.bar[:, None]
            if not alive.any():
                return
        alive &= lower > 0
        for i in np.flatnonzero(alive.any(axis=1)).tolist():
            at = np.flatnonzero(alive[i])
            found = zip((-lower[i, at]).astype(np.int64).tolist(), nulls[at].tolist(), ids[at].tolist(), strict=True)
            self.best[i] = sorted([*self.best[i], *found])[: self.k]
            if len(self.best[i]) == self.k:
                self.bar[i] = -self.best[i][-1][0]


def _searched(index: DataFrame, rows: list[tuple[int, int, int]], n_items: int, weights: np.ndarray, n: int, total: int, k: int) -> DataFrame:
    """(item, doc_id, score): the best k documents of each item in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = Search(rows, n_items, weights, k)
        for batch in batches:
            for ids, nulls, sizes, docs, terms, tfs in batch.itertuples(index=False, name=None):
                doc, tf = np.frombuffer(docs, np.int32), np.frombuffer(tfs, np.int32).astype(np.int64)
                m = 25 + 75 * np.frombuffer(sizes, np.int64) * n // max(1, total)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                search.read(np.frombuffer(ids, np.int64), np.frombuffer(nulls, np.uint8), doc, np.frombuffer(terms, np.int32), impact)
        found = [(i, None if null else doc, -score) for i, best in enumerate(search.best) for score, null, doc in best]
        out = pd.DataFrame(found, columns=["item", "doc_id", "score"])
        yield out.astype({"doc_id": "Int64"})

    return index.select(*_FIELDS[2:]).mapInPandas(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, k: int = 10) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Scores are integers: the weight of a term falls with the documents that hold it, its impact
    rises with its count and falls with the document's length.  Equal scores rank by ascending doc_id, null last.
    Null and blank texts have no terms: such documents are never found, such items find nothing.  Items are told apart by id and
    text: repeated rows give one list, equal ids with different texts one each, a null id is an id.  Documents repeated under one id
    are separate rows.  Other columns are not read.  Without documents or items the result is empty.  Documents are indexed whole,
    in bounded buffers; the terms of one item must fit in a task.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    item = F.xxhash64("item_id", F.sha2("text", 256)).alias("item")
    wanted = shared_table(
        asked.select(item, "item_id", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))
    )
    size = wanted.agg(F.count("*").alias("terms"), F.approx_count_distinct("item").alias("items")).first()
    chunks = max(1, math.ceil(size["terms"] / CHUNK_TERMS), math.ceil(size["items"] / CHUNK_ITEMS))
    found = None
    for chunk in range(chunks):
        # At most about CHUNK_TERMS rows.
        own = wanted.where(F.pmod("item", F.lit(chunks)) == chunk).orderBy("item", "term").collect()
        if not own:
            continue
        terms = sorted({r["term"] for r in own})
        number = {t: i for i, t in enumerate(terms)}
        names = list(dict.fromkeys((r["item"], r["item_id"]) for r in own))
        place = {name: i for i, name in enumerate(names)}
        index = shared_table(_index(docs, terms), compact=False)
        counts = {r["term"]: r["n"] for r in index.where("term is not null").groupBy("term").agg(F.sum("count").alias("n")).collect()}
        n, total = counts.pop(-1, 0), counts.pop(-2, 0)
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(terms))], np.int64)
        rows = [(place[r["item"], r["item_id"]], number[r["term"]], r["times"]) for r in own]
        best = _searched(index.where("term is null"), rows, len(names), weights, n, total, k)
        named = spark.createDataFrame([(i, name[1]) for i, name in enumerate(names)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        one = shared_table(_merged(best, k)).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        found = one if found is None else found.unionByName(one)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


def _merged(best: DataFrame, k: int) -> DataFrame:
    """The lists of all tasks in one; parts of an item's rows first, so no task reads them all."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    near = Window.partitionBy("item", "part").orderBy(*order)
    parts = best.withColumn("part", part).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    return parts.drop("part").withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
