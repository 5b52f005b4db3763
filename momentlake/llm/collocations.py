"""Collocations: phrases that occur far more often than chance, by a distributed multikey quicksort of suffixes.

A suffix is a word position with the words that follow it in its piece, up to the longest phrase.  Tasks
combine equal suffixes of a block of text and route them by their leading word to buckets; a word
with more suffixes than a bucket should hold is routed by its first two words, a pair like that by all.  Which ones those are is
told by fixed arrays of hashed counters from a first scan, so the rule needs no list that grows with the vocabulary.

In a bucket pointers to suffixes are sorted by three-way partitions on one word at a time, all partitions of a
depth side by side: the size of an equal partition is the count of its prefix, and a
partition with fewer suffixes than a candidate needs is given up unsorted.  Words are compared as themselves, never by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import mixed, shared_table
from momentlake.llm.words import Cutter, Words

#: Words are runs of anything but these, pieces end at the stops; fixed by the contract of the query.
GAPS, STOPS = b"\x20\x09", b"\n.,;:!?\x0b\x0c\x0d"
NO_LANG = "und"

#: Suffixes that a bucket should hold, and those of one leading word (or pair) from which its suffixes are routed by one more word.
BUCKET, HOT = 1_000_000, 250_000
#: Partitions that buckets are dealt to at most.
MOST_PARTITIONS = 20_000
#: Counters of leading words, and of pairs.
COUNTERS = 1 << 16
#: Parts in which the phrases of a language are ranked first.
PARTS = 16
#: Bytes of one language that a task combines at a time; a block seldom has 2^21 distinct words.
BLOCK = 6 << 20
_BITS = 21


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Words]]:
    """The words of a task's documents, by language, in bounded blocks."""
    cutter = Cutter(GAPS, STOPS)
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            if not isinstance(text, str) or not text:
                continue
            held.setdefault(lang if isinstance(lang, str) else NO_LANG, []).append(text)
            size += len(text)
            if size >= BLOCK:
                yield from ((name, w) for name, texts in held.items() for w in cutter.words(texts, BLOCK))
                held, size = {}, 0
    yield from ((name, w) for name, texts in held.items() for w in cutter.words(texts, BLOCK))


def _suffixes(words: Words, ids: np.ndarray, longest: int) -> np.ndarray:
    """Numbers from 1 of the words of each suffix, one column each; 0 beyond the end of its piece."""
    out = np.zeros((longest, len(ids)), np.int64)
    for i in range(min(longest, len(ids))):
        n = len(ids) - i
        out[i, :n] = np.where(words.piece[:n] == words.piece[i:], ids[i:] + 1, 0)
    return out


def _hashes(lang: str, names: list[bytes]) -> np.ndarray:
    """A 64-bit value of each word in its language, the same in every task; the first is that of no word."""
    values = pd.util.hash_array(np.array([b"", *names, lang.encode("utf-8", "surrogatepass")], object), categorize=False)
    return mixed(values[:-1] ^ mixed(values[-1:]))


def _prefix_hashes(hashes: np.ndarray, columns: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the first word of each suffix, of the first two, and so on."""
    now = hashes[columns[0]]
    yield now
    for column in columns[1:]:
        now = mixed(now + hashes[column])
        yield now


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) % COUNTERS


def _sizes(docs: DataFrame, longest: int) -> DataFrame:
    """(lang, n) words of each language, and (depth, counter, n) hashed counts of prefixes that could be hot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((max(1, longest - 1), COUNTERS), np.int64)
        totals: dict[str, int] = {}
        for lang, words in _blocks(batches):
            ids, names = words.ids()
            totals[lang] = totals.get(lang, 0) + len(ids)
            columns = _suffixes(words, ids, longest)
            for depth, hashes in zip(range(longest - 1), _prefix_hashes(_hashes(lang, names.to_pylist()), columns), strict=False):
                counts[depth] += np.bincount(_counter(hashes[columns[depth] > 0]), minlength=COUNTERS)
        named = pd.DataFrame({"lang": pd.Series(list(totals), dtype=object), "n": list(totals.values())})
        yield named.reindex(columns=["lang", "depth", "counter", "n"])
        depth, counter = np.nonzero(counts)
        yield pd.DataFrame({"lang": pd.Series([None] * len(depth), dtype=object), "depth": depth, "counter": counter, "n": counts[depth, counter]})

    return docs.mapInPandas(run, "lang string, depth int, counter int, n long")


def _combined(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, and how often each occurs."""
    if len(columns) <= 3 and columns.max(initial=0) < 1 << _BITS:
        key = np.zeros(columns.shape[1], np.uint64)
        for column in columns:
            key = (key << np.uint64(_BITS)) | column.astype(np.uint64)
        key, counts = np.unique(key, return_counts=True)
        shifts = [np.uint64(_BITS * i) for i in reversed(range(len(columns)))]
        return np.stack([(key >> s).astype(np.int64) & ((1 << _BITS) - 1) for s in shifts]), counts
    return np.unique(columns, axis=1, return_counts=True)


def _routed(docs: DataFrame, longest: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Rows (bucket, lang, words, ids, counts): combined suffixes of a block, with a word list of their own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, words in _blocks(batches):
            if not len(words.starts):
                continue
            ids, names = words.ids()
            columns, counts = _combined(_suffixes(words, ids, longest))
            hashes = _hashes(lang, names.to_pylist())
            route, open_ = None, np.ones(columns.shape[1], bool)
            for depth, prefix in enumerate(_prefix_hashes(hashes, columns)):
                route = prefix if route is None else np.where(open_, prefix, route)
                if depth < longest - 1:
                    open_ &= hot[depth][_counter(prefix)]
            bucket = (mixed(route) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            present, first = np.unique(bucket[order], return_index=True)
            rows = []
            for b, at in zip(present.tolist(), np.split(order, first[1:]), strict=True):
                used, own = np.unique(columns[:, at], return_inverse=True)
                own = own.reshape(longest, len(at)) + (0 if used[0] == 0 else 1)
                own_words = names.take(pa.array(used[used > 0] - 1)).to_pylist()
                kind = np.uint16 if len(own_words) < 1 << 16 else np.uint32
                rows.append((b, lang, b"\n".join(own_words), own.astype(kind).tobytes(), counts[at].astype(np.uint32).tobytes()))
                if len(rows) == 64:
                    yield pd.DataFrame(rows, columns=_ROW, dtype=object)
                    rows = []
            yield pd.DataFrame(rows, columns=_ROW, dtype=object)

    return docs.mapInPandas(run, "bucket int, lang string, words binary, ids binary, counts binary")


_ROW = ["bucket", "lang", "words", "ids", "counts"]


def frequent_prefixes(columns: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to suffixes, given up where a partition weighs less than ``least``.

    Yields, for each depth from 1, a pointer into every equal partition that weighs enough and its weight.
    """
    pointers = np.arange(columns.shape[1])
    lengths = np.array([len(pointers)])
    for depth, column in enumerate(columns, 1):
        equal, equal_lengths = [], []
        while len(pointers):
            lengths, pointers = _heavy(pointers, lengths, weights, least)[:2]
            if not len(pointers):
                break
            first = np.cumsum(lengths) - lengths
            keys = column[pointers]
            three = np.sort(np.stack([keys[first], keys[first + lengths // 2], keys[first + lengths - 1]]), axis=0)
            pivot = np.repeat(three[1], lengths)
            parts = []
            for side in (keys < pivot, keys == pivot, keys > pivot):
                n = np.add.reduceat(side.astype(np.int64), first)
                parts.append((pointers[side], n[n > 0]))
            (low, low_n), (same, same_n), (high, high_n) = parts
            equal.append(same)
            equal_lengths.append(same_n)
            pointers, lengths = np.concatenate([low, high]), np.concatenate([low_n, high_n])
        if not equal:
            return
        lengths, pointers, heavy = _heavy(np.concatenate(equal), np.concatenate(equal_lengths), weights, least)
        if not len(pointers):
            return
        first = np.cumsum(lengths) - lengths
        # The partition of suffixes that end here is no prefix and goes no deeper.
        goes_on = column[pointers[first]] > 0
        pointers = pointers[np.repeat(goes_on, lengths)]
        yield depth, pointers[:0] if not goes_on.any() else pointers[np.cumsum(lengths[goes_on]) - lengths[goes_on]], heavy[goes_on]
        lengths = lengths[goes_on]
        if not len(lengths):
            return


def _heavy(pointers: np.ndarray, lengths: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, pointers and weights of the partitions that weigh at least ``least``."""
    total = np.add.reduceat(weights[pointers], np.cumsum(lengths) - lengths)
    keep = total >= least
    return lengths[keep], pointers[np.repeat(keep, lengths)], total[keep]


def _counted(routed: DataFrame, longest: int, least: int, hot: np.ndarray) -> DataFrame:
    """(lang, phrase, f): counts of the prefixes in each bucket.  Those that are routed by more
    words lie in several buckets and get a row in each; others occur ``least`` times at least."""

    def one(lang: str, held: list[tuple[bytes, bytes, bytes]]) -> pd.DataFrame:
        lists = [words.split(b"\n") for words, _, _ in held]
        coded = pa.array([w for own in lists for w in own], pa.binary()).dictionary_encode()
        numbers, names = coded.indices.to_numpy().astype(np.int32) + 1, coded.dictionary.to_pylist()
        parts, at = [], 0
        for own, (_, ids, _) in zip(lists, held, strict=True):
            kind = np.uint16 if len(own) < 1 << 16 else np.uint32
            table = np.concatenate([[0], numbers[at : at + len(own)]]).astype(np.int32)
            parts.append(table[np.frombuffer(ids, kind)].reshape(longest, -1))
            at += len(own)
        columns = np.concatenate(parts, axis=1)
        weights = np.concatenate([np.frombuffer(c, np.uint32) for _, _, c in held]).astype(np.int64)
        del parts, lists, coded
        text = lambda ids: b" ".join(names[i - 1] for i in ids).decode("utf-8", "surrogatepass")
        spread = np.ones(columns.shape[1], bool)
        out: list[tuple[str, int]] = []
        split: list[np.ndarray] = []
        for depth, prefix in zip(range(longest - 1), _prefix_hashes(_hashes(lang, names), columns), strict=False):
            spread &= hot[depth][_counter(prefix)] & (columns[depth] > 0)
            split.append(spread.copy())
            if not spread.any():
                break
            keys, which = np.unique(columns[: depth + 1, spread], axis=1, return_inverse=True)
            sums = np.bincount(which.ravel(), weights[spread], keys.shape[1]).astype(np.int64)
            out += [(text(key), int(n)) for key, n in zip(keys.T.tolist(), sums.tolist(), strict=True)]
        for depth, pointers, sizes in frequent_prefixes(columns, weights, least):
            if depth <= len(split):
                whole = ~split[depth - 1][pointers]
                pointers, sizes = pointers[whole], sizes[whole]
            out += [(text(key), int(n)) for key, n in zip(columns[:depth, pointers].T.tolist(), sizes.tolist(), strict=True)]
        rows = pd.DataFrame([(lang, p) for p, _ in out], columns=["lang", "phrase"], dtype=object)
        return rows.assign(f=np.array([n for _, n in out], np.int64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in batches:
            for bucket, lang, words, ids, counts in batch.itertuples(index=False, name=None):
                if (bucket, lang) != now:
                    if held:
                        yield one(now[1], held)
                    now, held = (bucket, lang), []
                held.append((words, ids, counts))
        if held:
            yield one(now[1], held)

    return routed.mapInPandas(run, "lang string, phrase string, f long")


def phrase_counts(docs: DataFrame, *, longest: int = 3, least: int = 10, bucket: int = BUCKET, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times, and (lang, n)."""
    docs = docs.select("lang", "text")
    sizes = shared_table(_sizes(docs, longest))
    totals = sizes.where("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    # At most COUNTERS rows a depth.
    over = sizes.where("lang is null").groupBy("depth", "counter").agg(F.sum("n").alias("n")).where(F.col("n") > hot).collect()
    is_hot = np.zeros((max(1, longest - 1), COUNTERS), bool)
    for r in over:
        is_hot[r["depth"], r["counter"]] = True
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket))
    # A task sorts its buckets one after the other.
    parts = min(buckets, MOST_PARTITIONS)
    routed = _routed(docs, longest, buckets, is_hot).repartitionById(parts, F.pmod("bucket", F.lit(parts)))
    routed = routed.sortWithinPartitions("bucket", "lang")
    counted = _counted(routed, longest, least, is_hot).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return shared_table(counted.where(F.col("f") >= least), compact=False), totals


def collocations(docs: DataFrame, *, longest: int = 3, least: int = 10, covered: int = 50, k: int = 2000, **sizes: int) -> DataFrame:
    """The ``k`` best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``longest`` words of one piece and occur at least ``least`` times.  A phrase is scored by the cut that
    explains it best: floor(10^6 a^2 / (l r)) with the counts of phrase and parts, the least over its cuts, of equal ones the first.
    A phrase inside a longer candidate with at least ``covered`` percent of its count is dropped.  Equal scores rank by
    count, then by phrase.  Null languages count as ``und``; null, empty and blank texts have no words; repeated rows count each
    time; other columns are not read; an empty table gives an empty result.  Texts are read whole, in bounded blocks that
    are cut at the ends of pieces only.
    """
    counts, totals = phrase_counts(docs, longest=longest, least=least, **sizes)
    words = F.split("phrase", " ")
    n_words = F.size(words)
    candidates = counts.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).where(n_words > 1)
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumn("left", part(F.lit(1), F.col("cut"))).withColumn("right", part(F.col("cut") + 1, F.size("words") - F.col("cut")))
    of = lambda name, as_: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(as_))
    scored = cuts.drop("words").join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    scored = scored.withColumn("top", F.lit(10**6).cast("decimal(7,0)") * (wide("a") * wide("a"))).withColumn("below", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("top div below"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    longer = candidates.where(F.size("words") > 2)
    inner = longer.withColumn("length", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)))
    inner = inner.select("lang", part(F.col("start"), F.col("length")).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {int(covered)} * a"))
    order = [F.desc("best.score"), F.desc("a"), "phrase"]
    # In parts first: a language's last ranking sees k rows of each part at most.
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    parts = kept.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
    top = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= k)
    out = top.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
