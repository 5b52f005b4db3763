"""What several operators of this package share: word rules, shared tables, bounded lookups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from momentlake.runtime import salted_lookup, shared_folder

#: A word is a run of anything but these; fixed by the contracts of the queries.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows of a lookup table up to which it is broadcast; a larger one is joined by salted keys.
BROADCAST_ROWS = 10_000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: A helper table is written in so many times fewer files than a shuffle has partitions.
FILES_SHARE = 16


def shared_table(df: DataFrame, *, compact: bool = True) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Lineage ends there, so later stages survive lost executors by rereading.  Helper tables are
    small beside the documents: ``compact`` deals their rows to fewer, larger files, whose row
    groups stay small enough to be read by many tasks.  Tables of texts are written as they come.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "table")
    if compact:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(max(1, partitions // FILES_SHARE))
    df.write.option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_lookup(fact: DataFrame, table: DataFrame, on: list[str], spread_by: list[str]) -> DataFrame:
    """Left join with a written table: broadcast after a check of its rows, salted beyond the bound."""
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return fact.join(F.broadcast(table), on, "left")
    return salted_lookup(fact, table, on, spread_by=spread_by)


#: A group with at least this fraction of all rows counts as hot: there are at most as many such groups.
HOT_GROUPS = 1000


def attach_groups(slim: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Left join rows with the written table of their groups (``key``, ``group_size``, ...).

    Hot groups, at most ``HOT_GROUPS`` by their share of the rows, are broadcast; no other key has
    more than that share, so the shuffled join is even.
    """
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("n")).first()["n"]
    others = [c for c in groups.columns if c != key]
    hot = groups.where((F.col("group_size") * HOT_GROUPS >= total) & (F.col("group_size") > 1))
    marked = slim.join(F.broadcast(hot.select(key, F.struct(*others).alias("_hot"))), key, "left")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(groups, key, "left")
    return marked.where(F.col("_hot").isNotNull()).select(*slim.columns, "_hot.*").unionByName(rest)


def boxed(docs: DataFrame, *columns: Column | str, without: Iterable[str] = ()) -> DataFrame:
    """The columns of ``docs`` as one, ``box``, so that no name an operator uses inside can meet theirs, and ``columns``.

    Columns ``without`` are left out: the operator's result replaces them.
    """
    left_out = set(without)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in left_out]).alias("box"), *columns)


def words_in(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


#: Bytes of text that are hashed at a time.
HASH_BYTES = 1 << 18
_BASE = 0x5851F42D4C957F2D  # odd, so its powers have inverses modulo 2^64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value of each byte, the same for both cases of A-Z, and whether it is white space."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    space = np.zeros(256, bool)
    space[list(SPACES.encode())] = True
    return values, space


_VALUES, _SPACE = _byte_tables()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; those of usual length are kept."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS
    n = max(n, 2 * HASH_BYTES)
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        made.append(np.multiply.accumulate(factors))
    if n <= 2 * HASH_BYTES:
        _POWERS[:] = made
    return made


def _hashes(raw: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of each text: polynomials over byte values, by differences of one running sum."""
    joined = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[joined]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    power, inverse = _powers(len(joined))
    running = np.cumsum(_VALUES[joined] * power[: len(joined)])
    own = (running[ends - 1] - running[starts - 1]) * inverse[starts]
    own = mixed(own + (ends - starts).astype(np.uint64))
    limits = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raw]) + 1)
    return np.split(own, limits[:-1])


def _cut(raw: bytes, most: int) -> Iterator[bytes]:
    """Parts of a long text, cut at white space; a longer word stays whole."""
    start = 0
    while len(raw) - start > most:
        at = max(raw.rfind(c, start, start + most) for c in SPACES.encode())
        if at < 0:
            at = min((x for c in SPACES.encode() if (x := raw.find(c, start + most)) >= 0), default=len(raw))
        yield raw[start:at]
        start = at + 1
    yield raw[start:]


def hashed_words(texts: Iterable[str | None], most: int = HASH_BYTES) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of each text in order, A-Z lowered; none for null and blank texts."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > most:
            yield from _hashes(held)
            held, size = [], 0
        if len(raw) > most:
            yield np.concatenate([_hashes([part])[0] for part in _cut(raw, most)])
            continue
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield from _hashes(held)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; order within a run matters."""
    if len(words) < n:
        return words[:0]
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = mixed(out) + words[i : len(words) - n + 1 + i]
    return mixed(out)
