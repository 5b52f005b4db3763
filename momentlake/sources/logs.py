"""Observation logs, voice profile files and table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profiles import recent_observations, upsert_claims
from ..operators.quality import split_by_contract
from ..runtime import checkpointed

OBSERVATION = (
    "struct<vod_id:string,timestamp_start:double,timestamp_end:double,type:string,claim:string,"
    "evidence:array<string>,source:string,confidence:double,evidence_refs:array<string>,created_at:string,_bad:string>"
)
VOICE_PROFILE = (
    "struct<profile_id:string,display_name:string,role:string,embedding:array<double>,"
    "thresholds:struct<accept_similarity:double,high_confidence_similarity:double>,_bad:string>"
)


def _parsed(rows: DataFrame, text: str, schema: str) -> DataFrame:
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_bad"})
    return rows.withColumn("_o", parsed).where(F.col("_o").isNotNull() & F.col("_o._bad").isNull())


def observations_from_lines(lines: DataFrame) -> DataFrame:
    """Valid observations of a log (streamer_id, pos, line); broken lines and rows are skipped."""
    rows = _parsed(lines, "line", OBSERVATION).select("streamer_id", "pos", "_o.*").drop("_bad")
    good, _ = split_by_contract(rows, "observation")
    return good


def load_recent_observations(lines: DataFrame, limit: int = 200) -> DataFrame:
    """The last ``limit`` valid observations of each streamer."""
    return recent_observations(observations_from_lines(lines), limit)


def append_observations(observations: DataFrame, path: str, batch: str) -> DataFrame:
    """Appends a batch of valid observations to the log table, one folder per streamer and batch,
    and returns the quarantined ones.

    A retried append replaces what the batch has written, so it adds nothing.
    """
    good, bad = split_by_contract(observations, "observation")
    _replace(good.withColumn("batch_id", F.lit(batch)), path, "streamer_id", "batch_id")
    return bad


def _replace(rows: DataFrame, path: str, *folders: str) -> None:
    """Writes a table with such folders; only the folders of ``rows`` are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


PROFILE = (
    "pos bigint, added boolean, kind string, claim string, description string, context string, impact string, confidence double, "
    "evidence_refs array<string>, updated boolean, batches array<string>, streamer_id string"
)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """The stored claims of all streamers; none before the first write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], PROFILE)
    return spark.read.schema(PROFILE).parquet(path)


def merge_claims(accepted: DataFrame, path: str, batch: str) -> None:
    """Merges a batch of accepted observations into the stored claims of their streamers.

    Rows know the batches they hold, so a batch that is merged again, also after a failure that left
    part of it behind, is in the table once.
    """
    spark = accepted.sparkSession
    stored = read_profile(spark, path)
    theirs = stored.join(accepted.select("streamer_id").distinct(), "streamer_id", "left_semi")
    # Written apart first: the folders it is read from are the ones to replace.
    merged = checkpointed(upsert_claims(theirs, accepted, batch))
    _replace(merged, path, "streamer_id")


def profiles_from_documents(documents: DataFrame) -> DataFrame:
    """Voice profiles from JSON documents (path, doc, optionally pos); malformed ones are
    skipped.  Of several under a path the one with the smallest pos counts, then the
    least document."""
    rows = _parsed(documents, "doc", VOICE_PROFILE)
    first = F.struct("pos", "doc") if "pos" in documents.columns else F.struct("doc")
    return rows.groupBy("path").agg(F.min_by("_o", first).alias("o")).select(
        "path",
        "o.profile_id",
        "o.display_name",
        "o.role",
        "o.embedding",
        F.col("o.thresholds.accept_similarity").alias("accept_similarity"),
        F.col("o.thresholds.high_confidence_similarity").alias("high_confidence_similarity"),
    )


def referenced_profiles(profiles: DataFrame, references: DataFrame, run_paths: DataFrame) -> DataFrame:
    """Profiles of a run: those given for it and those its streamers refer to.

    ``references``: streamer_id, path.  ``run_paths``: path.
    """
    wanted = run_paths.select("path").unionAll(references.where(F.trim("path") != "").select("path")).distinct()
    return profiles.join(wanted, "path", "left_semi")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    from .chat import read_documents

    return profiles_from_documents(read_documents(spark, path))


def write_stage(rows: DataFrame, path: str) -> None:
    """A stage table, one folder per video; only the videos in ``rows`` are replaced."""
    _replace(rows, path, "vod_id")


def as_documents(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as JSON text (vod_id, doc) for export."""
    payload: Column = F.struct(*(columns or rows.columns))
    return rows.select("vod_id", F.to_json(payload).alias("doc"))
