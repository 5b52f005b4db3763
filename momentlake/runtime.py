"""Session settings and the two helpers every larger job needs: reliable
checkpoints and skew-safe lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is repeated this many times so that one hot key of the fact
# table is read by this many tasks instead of one.
LOOKUP_SALTS = 8


def build_session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches.  Clusters bring their own."""
    spark = (
        SparkSession.builder.master(master)
        .appName("momentlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a skewed join partition even where that costs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Rows hold whole texts: small batches bound the memory of Python workers.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="momentlake-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# Spark removes the shuffle files of a query that was made while this holds as soon as it has run.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage, so a
    lost executor re-reads the files instead of replaying earlier rounds.

    The shuffle files behind it are removed: nothing reads them any more, and Spark by itself keeps them until the
    driver collects its garbage.
    """
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        # A query of its own, which is run only here.
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, before)


def salted_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    spread_by: Sequence[str],
    how: str = "left",
    salts: int = LOOKUP_SALTS,
) -> DataFrame:
    """Join a large table with a smaller, already aggregated one on ``on``.

    The fact rows of one key are spread over ``salts`` join keys by a hash of
    ``spread_by`` (a deterministic value, so retried tasks agree), and the
    lookup row is repeated for each.  ``how`` must keep or drop fact rows only
    (``left``, ``inner``, ``left_semi``, ``left_anti``).
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type for a salted lookup: {how}")
    salt: Column = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts)).cast("int")
    left = fact.withColumn("_salt", salt)
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
