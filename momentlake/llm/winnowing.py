"""Document fingerprints by winnowing, with built-in functions only.

The gram unit is the word: every run of ``gram`` words gets a polynomial (rolling) hash, each
window of ``window`` consecutive grams keeps its smallest hash, the rightmost of equal ones, and
positions stay with the hashes.  Any passage of ``gram + window - 1`` words that two texts share
therefore leaves a common hash in both fingerprints.  Words too long to be words (text without white
space) count by their code points, as does a text with fewer words than a gram and what it is compared with.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import SPACES, boxed

GRAM, WINDOW = 5, 4
#: Code points from which on a word is taken apart.
LONG_WORD = 40
#: Modulus and base of the rolling hash: products of two residues stay below 2^62.
_P, _BASE = (1 << 31) - 1, 1_000_003
_POSITIONS = 1 << 31
#: Documents in a block of neighbours, and the most blocks; the table of block heads is that long.
BLOCK_ROWS, MAX_BLOCKS = 512, 1 << 16


def _shifted(values: str, by: int) -> tuple[Column, Column]:
    """The array without its last ``by`` elements, and without its first ``by``."""
    left = F.greatest(F.size(values) - by, F.lit(0))
    return F.slice(F.col(values), F.lit(1), left), F.slice(F.col(values), F.lit(by + 1), left)


def _joined(factor: int):
    """The hash of a run from those of its two halves, the second as long as ``factor`` says."""
    return lambda x, y: (x * F.lit(factor) + y) % F.lit(_P)


def _roll(df: DataFrame, words: str, out: str, gram: int) -> DataFrame:
    """Polynomial hashes of all runs of ``gram`` words from the word hashes, by doubling run lengths."""
    df = df.withColumn(f"{out}_1", F.col(words))
    names = {1: f"{out}_1"}
    length = 1
    while length * 2 <= gram:
        a, b = _shifted(names[length], length)
        names[2 * length] = f"{out}_{2 * length}"
        df = df.withColumn(names[2 * length], F.zip_with(a, b, _joined(pow(_BASE, length, _P))))
        length *= 2
    have, done = names[length], length
    for part in sorted((p for p in names if p < length), reverse=True):
        if done + part <= gram:
            left = F.greatest(F.size(names[part]) - done, F.lit(0))
            a = F.slice(F.col(have), F.lit(1), left)
            b = F.slice(F.col(names[part]), F.lit(done + 1), left)
            done += part
            have = f"{out}_{done}"
            df = df.withColumn(have, F.zip_with(a, b, _joined(pow(_BASE, part, _P))))
    return df.withColumnRenamed(have, out).drop(*[n for n in (*names.values(), have) if n not in (words, out)])


def _window_minima(df: DataFrame, keys: str, window: int) -> DataFrame:
    """Replace the array by the minima of its windows; of fewer elements than a window, their minimum."""
    width = 1
    df = df.withColumn("_few", F.when((F.size(keys) < window) & (F.size(keys) > 0), F.array(F.array_min(keys))))
    while width < window:
        step = min(width, window - width)
        a, b = _shifted(keys, step)
        df = df.withColumn(keys, F.zip_with(a, b, lambda x, y: F.least(x, y)))
        width += step
    return df.withColumn(keys, F.coalesce("_few", F.array_distinct(keys))).drop("_few")


def _words(text: str) -> Column:
    return F.split(F.btrim(F.col(text), F.lit(SPACES)), r"[\x20\x09-\x0D]+")


def _taken_apart(words: Column, chosen: Column) -> Column:
    """The words, those for which ``chosen`` holds or that are long as their code points."""
    apart = lambda w: F.when(chosen | (F.length(w) >= LONG_WORD), F.split(w, "")).otherwise(F.array(w))
    return F.when(chosen | F.exists(words, lambda w: F.length(w) >= LONG_WORD), F.flatten(F.transform(words, apart))).otherwise(words)


def with_fingerprint(df: DataFrame, text: str, out: str, *, gram: int = GRAM, window: int = WINDOW, points: Column | None = None) -> DataFrame:
    """Add ``out``: the chosen grams in order, each hash * 2^32 + (2^31 - 1 - position).

    The units are words, and the code points of a word of LONG_WORD or more.  A text of fewer units than a
    gram, or one for which ``points`` holds, counts by code points, white space aside.  One of fewer code
    points than a gram has one entry from the whole text at position 0; an empty one has none.
    """
    words, grams = f"{out}_w", f"{out}_g"
    whole = F.pmod(F.xxhash64(text), F.lit(_P))
    df = df.withColumn(words, _words(text))
    df = df.withColumn(words, _taken_apart(F.col(words), F.lit(False)))
    few = F.size(words) < gram
    df = df.withColumn(words, _taken_apart(F.col(words), few if points is None else few | points))
    df = df.withColumn(words, F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(_P))))
    df = _roll(df, words, grams, gram)
    # One number to compare: the smallest hash first, of equal ones the rightmost.
    keyed = F.transform(grams, lambda h, i: h * F.lit(1 << 32) + (F.lit(_POSITIONS - 1) - i))
    short = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(whole * F.lit(1 << 32) + F.lit(_POSITIONS - 1)))
    df = df.withColumn(out, F.when(F.size(words) < gram, short).otherwise(keyed)).drop(words, grams)
    return _window_minima(df, out, window)


def few_words(text: str, gram: int = GRAM) -> Column:
    """Whether a text has fewer units than a gram and counts by code points."""
    return F.size(_taken_apart(_words(text), F.lit(False))) < gram


def as_text(fingerprint: Column) -> Column:
    """hash:position pairs, hashes in hexadecimal, in text order."""
    mask = F.lit((1 << 32) - 1)
    pair = lambda x: F.concat(F.hex(F.shiftright(x, 32)), F.lit(":"), (F.lit(_POSITIONS - 1) - x.bitwiseAND(mask)).cast("string"))
    return F.array_join(F.transform(fingerprint, pair), ",")


def hash_set(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 32)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two hash sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def fingerprint_documents(docs: DataFrame, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``fingerprint`` (array, see ``with_fingerprint``); null texts count as empty,
    repeated rows are kept, a ``fingerprint`` column of the input is replaced."""
    rows = boxed(docs, F.coalesce("text", F.lit("")).alias("t"), without=["fingerprint"])
    return with_fingerprint(rows, "t", "fingerprint", gram=gram, window=window).select("box.*", "fingerprint")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: each row beside the next one in descending ``doc_id``, the last beside the first.

    Null ids come last; rows with the same id follow each other by a hash of their text; a single
    row is its own next.  Rows meet in blocks of near ids, each with the head of the block that
    follows as a guest, so no task orders all rows.  Also carries ``fingerprint`` and
    ``next_fingerprint``.
    """
    ids = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = ids["low"] or 0, ids["high"] or 0
    blocks = min(MAX_BLOCKS - 1, max(1, ids["n"] // BLOCK_ROWS))
    width = (high - low) // blocks + 1
    wide = F.col("doc_id").cast("decimal(20,0)")
    block = F.coalesce(F.floor((wide - F.lit(Decimal(low))) / F.lit(Decimal(width))).cast("long"), F.lit(-1))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), block.alias("block"))
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head"))
    down = Window.orderBy(F.desc("block"))
    above = F.coalesce(F.lag("block").over(down), F.min("block").over(Window.partitionBy(F.lit(1))))
    # At most MAX_BLOCKS rows.
    heads = F.broadcast(heads.select("block", "head", above.alias("above")))
    own = F.struct(F.col("block").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("above").alias("at"), F.lit(True).alias("guest"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, guest)).otherwise(F.array(own))
    placed = rows.join(heads, "block").select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.at", "p.guest")
    placed = with_fingerprint(placed.repartition("at"), "text", "fingerprint")
    order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return (
        placed.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .where(~F.col("guest"))
        .drop("at", "guest")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its edited text and of the next document.

    Edited: the last floor(n / 3) code points replaced by the first as many of the next document.
    ``near_edited`` and ``near_next`` are the likeness of the document to both, in the same units.
    Null texts count as empty, null ids come last, repeated rows have a row each; other columns are not
    read; an empty table gives an empty result.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_fingerprint")
    # Beside a text that counts by code points the other one does, too.
    for name, other, print_ in (("edited", "edited", "edited_fingerprint"), ("next", "next_text", "next_fingerprint")):
        own, others = few_words("text"), few_words(other)
        rows = rows.withColumn("_text", F.when(others & ~own, F.col("text")).otherwise("")).withColumn("_other", F.when(own & ~others, F.col(other)).otherwise(""))
        for text in ("_text", "_other"):
            rows = with_fingerprint(rows, text, f"{text}_print", points=F.lit(True))
        mine = F.when(F.col("_text") != "", F.col("_text_print")).otherwise(F.col("fingerprint"))
        theirs = F.when(F.col("_other") != "", F.col("_other_print")).otherwise(F.col(print_))
        rows = rows.withColumn(f"near_{name}", likeness(hash_set(mine), hash_set(theirs))).drop("_text", "_other", "_text_print", "_other_print")
    return rows.drop("text", "next_text")
