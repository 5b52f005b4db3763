"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from momentlake.llm.common import SPACES, attach_groups, boxed, shared_table

_ID_TOP, _ID_BASE = Decimal(1 << 63), Decimal(1 << 65)


def without_spaces(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _rank_code(n_chars: Column, doc_id: Column) -> Column:
    """Largest for the most code points, then the smallest id (null last), as one decimal."""
    id_code = F.coalesce(F.lit(_ID_TOP) - doc_id.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return (n_chars.cast("decimal(11,0)") * F.lit(_ID_BASE) + id_code).cast("decimal(38,0)")


def duplicate_groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row per content: digest, content, best, group_size.

    ``rows``: digest, content, code, salt source ``doc_id``.  The grouping key holds the full
    content at every stage: the map side combines what a task has read, the first shuffle
    spreads one content over ``salts`` tasks, the second combines their winners.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    salted = rows.groupBy("digest", "content", salt.alias("salt")).agg(F.max("code").alias("code"), F.count("*").alias("n"))
    return (
        salted.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("code").alias("code"), F.sum("n").alias("group_size"))
    )


def exact_duplicates(
    docs: DataFrame,
    *,
    salts: int = 16,
    digest=lambda content: F.sha2(content, 256),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty, and empty texts
    are equal to each other.  Of equal texts the row with most code points stays, then the
    smallest ``doc_id`` (null after all others).  Of repeated rows with that id one stays.  Two
    different contents under one digest are told apart by their content.  Other columns of
    ``docs`` are not read.  An empty table gives an empty result.
    """
    content = without_spaces(F.col("text"))
    # F.length counts code points of the original text.
    rows = docs.select(
        "doc_id",
        content.alias("content"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
    ).withColumn("digest", digest(F.col("content")))
    groups = duplicate_groups(rows.withColumn("code", _rank_code(F.col("n_chars"), F.col("doc_id"))), salts)
    contents = F.count("*").over(Window.partitionBy("digest"))
    id_code = F.col("code") % F.lit(_ID_BASE)
    keep = F.when(id_code > 0, (F.lit(_ID_TOP) - id_code).cast("long"))
    groups = shared_table(
        groups.withColumn("contents", contents).select(
            "digest",
            F.when(F.col("contents") > 1, F.col("content")).alias("content"),
            keep.alias("keep_id"),
            ((F.col("code") - id_code) / F.lit(_ID_BASE)).cast("long").alias("keep_chars"),
            "group_size",
        )
    )
    slim = rows.drop("content")
    single = groups.where(F.col("content").isNull()).drop("content")
    joined = attach_groups(slim, single, "digest")
    if not groups.where(F.col("content").isNotNull()).isEmpty():
        clashing = groups.where(F.col("content").isNotNull())
        joined = joined.where(F.col("group_size").isNotNull()).unionByName(
            rows.join(clashing, ["digest", "content"]).drop("content")
        )
    winner = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    first = F.row_number().over(Window.partitionBy("doc_id", "digest", "keep_id").orderBy(F.desc("n_chars"))) == 1
    return joined.select(
        "doc_id", "keep_id", "group_size", (winner & first).alias("kept"), F.col("digest").alias("text_sha256")
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one per content.

    A null text is an empty one; of equal rows one stays; a null id is an id; an empty table stays empty.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    stays = exact_duplicates(docs, **options).where("kept").select(key, F.col("text_sha256").alias("digest"))
    text = F.col("text")
    rows = boxed(docs, key, F.sha2(without_spaces(text), 256).alias("digest"), F.length(F.coalesce(text, F.lit(""))).alias("n"))
    both = rows.join(stays, ["id", "digest"])
    # Rows repeated under one id: the longest original, on the partitioning of the join.
    order = Window.partitionBy("id", "digest").orderBy(F.desc("n"))
    return both.withColumn("r", F.row_number().over(order)).where("r = 1").select("box.*")
