"""Which titles of a video resemble given ones, by inverted indexes instead of comparing texts.

Two titles resemble each other if their stem sets have a Jaccard similarity of at least
``DUPLICATE_JACCARD``, or if one normal form lies inside the other.

* Sets that similar share a stem among the rarest of each (prefix filter), and their sizes are close.
* A normal form inside another has all its inner words as whole words there, so its rarest inner word,
  its anchor, is one.  Forms of one or two words have no inner word and are searched as text.

Rows found by an index are compared in full, so the result is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.titles import DUPLICATE_JACCARD, similar_titles
from ..runtime import checkpointed, salted_lookup

_TITLE = ["vod_id", "clip_id"]
#: Normal forms of fewer words have no inner word.
_ANCHORED = 3


def _terms(titles: DataFrame, terms: Column, *keep: str) -> DataFrame:
    return titles.select(*_TITLE, *keep, F.explode(terms).alias("term"))


def _frequencies(terms: DataFrame) -> DataFrame:
    return terms.groupBy("vod_id", "term").agg(F.count(F.lit(1)).alias("_df"))


def _rarest_first(terms: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Adds ``_r``: the place of a term in its title, rare ones first; unknown terms are rarest."""
    known = terms.join(frequencies, ["vod_id", "term"], "left")
    order = Window.partitionBy(*_TITLE).orderBy(F.coalesce("_df", F.lit(0)), "term")
    return known.withColumn("_r", F.row_number().over(order)).drop("_df")


class TitleIndex:
    """Index of ``titles``: vod_id, clip_id, norm (normal form), tok (distinct stems); a clip_id is in a video once."""

    def __init__(self, titles: DataFrame) -> None:
        self.titles = titles
        self.stem_counts = checkpointed(_frequencies(_terms(titles, F.col("tok"))))
        self.prefixes = checkpointed(self._prefixes(titles))
        self.words = checkpointed(_terms(titles, F.array_distinct(F.split("norm", " "))))
        self.word_counts = checkpointed(_frequencies(self.words))
        self.anchors = checkpointed(self._anchors(titles))
        self.short = titles.where(F.size(F.split("norm", " ")) < _ANCHORED).select(*_TITLE, "norm")

    def _prefixes(self, titles: DataFrame) -> DataFrame:
        """(vod_id, clip_id, n, term): of sets of n stems, those among which similar sets share one."""
        n = F.size("tok")
        # In whole numbers: a share of 0.75 is 3 of 4.
        needed = F.ceil(n * F.lit(int(DUPLICATE_JACCARD * 100)) / 100)
        rows = _terms(titles.withColumn("n", n).withColumn("_most", n - needed + 1), F.col("tok"), "n", "_most")
        return _rarest_first(rows, self.stem_counts).where(F.col("_r") <= F.col("_most")).select(*_TITLE, "n", "term")

    def _anchors(self, titles: DataFrame) -> DataFrame:
        """(vod_id, clip_id, term): the rarest inner word of every normal form that has one."""
        words = F.split("norm", " ")
        inner = F.array_distinct(F.slice(words, 2, F.size(words) - 2))
        rows = _terms(titles.where(F.size(words) >= _ANCHORED), inner)
        return _rarest_first(rows, self.word_counts).where("_r = 1").drop("_r")

    def resembling(self, given: DataFrame) -> DataFrame:
        """(vod_id, clip_id) of the indexed titles that resemble one of ``given`` (the same columns, few per video)."""
        as_given = lambda df: df.withColumnRenamed("clip_id", "g_id").withColumnRenamed("n", "g_n")
        on = ["vod_id", "term"]
        close = F.least("n", "g_n") >= F.greatest("n", "g_n") * DUPLICATE_JACCARD
        pair = ["vod_id", "g_id", "clip_id"]
        found = [
            as_given(self._prefixes(given)).join(self.prefixes, on).where(close).select(*pair),
            as_given(self._anchors(given)).join(self.words, on).select(*pair),
            as_given(_terms(given, F.array_distinct(F.split("norm", " ")))).join(self.anchors, on).select(*pair),
        ]
        given_texts = given.select("vod_id", F.col("clip_id").alias("g_id"), F.col("norm").alias("g_norm"), F.col("tok").alias("g_tok"))
        texts = reduce(DataFrame.unionAll, found).distinct().join(self.titles.select(*_TITLE, "norm", "tok"), _TITLE)
        compared = salted_lookup(texts, given_texts, ["vod_id", "g_id"], spread_by=["clip_id"], how="inner")
        similar = compared.where(similar_titles(F.col("norm"), F.col("tok"), F.col("g_norm"), F.col("g_tok")))
        brief = given_texts.where(F.size(F.split("g_norm", " ")) < _ANCHORED).drop("g_tok")
        holding = salted_lookup(self.titles.select(*_TITLE, "norm"), brief, ["vod_id"], spread_by=["clip_id"], how="inner")
        held = salted_lookup(self.short, given_texts.drop("g_tok"), ["vod_id"], spread_by=["clip_id"], how="inner")
        both = F.col("norm").contains(F.col("g_norm")) | F.col("g_norm").contains(F.col("norm"))
        direct = holding.unionByName(held).where((F.col("norm") != "") & (F.col("g_norm") != "") & both)
        return similar.select(*_TITLE).unionAll(direct.select(*_TITLE)).distinct()
