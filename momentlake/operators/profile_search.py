"""The most similar voice profile of every cluster, exactly, without comparing all pairs.

The angle between vectors is a metric.  Every profile belongs to its nearest pivot, and the profiles of a pivot are cut
by their angle to it into blocks of bounded size.  A cluster at angle ``a`` to a pivot is at least
``a - hi`` and ``lo - a`` from the profiles of a block whose angles lie in ``lo``..``hi``.  A
cluster is compared with its most promising block first; then only with the blocks
that this bound does not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import checkpointed, salted_lookup
from .intervals import celled

#: Pivots of one vector size, and of all; vectors of a size without pivots form one region.
PIVOTS, ALL_PIVOTS = 64, 256
#: Clusters that are compared with a block at a time.
SLICE = 4096
#: Angles are known to about 1e-8 only.
SLACK = 1e-6

_CLUSTER = ["vod_id", "speaker_label"]
_BLOCK = ["_dim", "_pivot", "_cell"]
_BEST = ["profile_id", "role", "accept", "high"]


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(F.col(v), F.lit(0.0), lambda acc, x: acc + x * x))


def _with_angles(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``_angles`` to the pivots of the vector's size, one 0 where there are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            angles = [np.zeros(1)] * len(batch)
            for dim in batch["_dim"].unique():
                if dim in pivots:
                    at = np.flatnonzero(batch["_dim"] == dim)
                    v = np.stack(batch["_v"].iloc[at].to_list())
                    cosine = (v / np.linalg.norm(v, axis=1)[:, None]) @ pivots[dim].T
                    for i, row in zip(at, np.arccos(np.clip(cosine, -1, 1)), strict=True):
                        angles[i] = row
            yield batch.assign(_angles=angles)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{fields}, _angles array<double>")


def _compared(asked: DataFrame, voices: DataFrame, placed: DataFrame) -> DataFrame:
    """For each asked (cluster, block) the best profile of the block (equal ones: the first) and the pairs compared."""
    sized = asked.groupBy(*_BLOCK).agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("_slices"))
    slice_ = F.pmod(F.xxhash64(*_CLUSTER), F.col("_slices"))
    left = asked.join(sized, _BLOCK).withColumn("_slice", slice_).drop("_slices")
    left = left.join(voices.select(*_CLUSTER, "_v"), _CLUSTER)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1))
    right = placed.join(sized.toDF(*sized.columns), _BLOCK).withColumn("_slice", every).drop("_slices")
    # The two sides share lineage: new names for the columns of one.
    left, at = left.toDF(*left.columns), ["_slice", *_BLOCK]

    def cell(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("pos", kind="stable").reset_index(drop=True)
        if not len(a) or not len(b):
            return pd.DataFrame()
        x, y = np.stack(a["_v"].to_list()), np.stack(b["_v"].to_list())
        cosine = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :])
        best = cosine.argmax(axis=1)
        picked = b.iloc[best].reset_index(drop=True)[["pos", *_BEST]]
        own = a[_CLUSTER].reset_index(drop=True).assign(score=cosine[np.arange(len(x)), best], compared=len(y))
        return pd.concat([own, picked], axis=1)

    types = dict(voices.dtypes) | dict(placed.dtypes)
    schema = ", ".join(
        [*[f"{c} {types[c]}" for c in _CLUSTER], "score double", "compared bigint", *[f"{c} {types[c]}" for c in ("pos", *_BEST)]]
    )
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(cell, schema)


def nearest_profiles(clusters: DataFrame, profiles: DataFrame) -> DataFrame:
    """The most similar profile of each cluster by cosine (ties: least ``pos``), with the number of profiles
    it was ``compared`` with.

    ``clusters``: vod_id, speaker_label, embedding; ``profiles``: pos, profile_id, role, embedding, accept, high.
    Zero vectors and vectors of different sizes are at similarity 0.
    """
    kind = F.when(_norm("_v") > 0, F.size("_v")).otherwise(0)
    vector = lambda df, *keep: df.withColumn("_v", F.col("embedding").cast("array<double>")).select(*keep, "_v", kind.alias("_dim"))
    known = checkpointed(vector(profiles, "pos", *_BEST))
    voices = checkpointed(vector(clusters.where(F.col("embedding").isNotNull()), *_CLUSTER))
    by_hash = Window.partitionBy("_dim").orderBy(F.xxhash64("pos", "profile_id"), "pos")
    # At most ALL_PIVOTS vectors.
    chosen = known.where("_dim > 0").withColumn("_r", F.row_number().over(by_hash)).where(F.col("_r") <= PIVOTS)
    pivots: dict[int, list] = {}
    for r in chosen.orderBy("_dim", "_r").limit(ALL_PIVOTS).select("_dim", "_v").collect():
        pivots.setdefault(r["_dim"], []).append(np.array(r["_v"]) / np.linalg.norm(r["_v"]))
    matrices = {dim: np.stack(v) for dim, v in pivots.items()}

    near = F.array_min(F.transform("_angles", lambda a, i: F.struct(a.alias("a"), i.alias("i"))))
    placed = _with_angles(known.where("_dim > 0"), matrices).withColumn("_near", near)
    placed = placed.select("pos", *_BEST, "_v", "_dim", F.col("_near.i").alias("_pivot"), F.col("_near.a").alias("_away"))
    placed = checkpointed(celled(placed, order=["_away", "pos"], block=F.lit(0), keys=["_dim", "_pivot"]).drop("_block"))
    blocks = checkpointed(
        placed.groupBy(*_BLOCK).agg(F.min("_away").alias("_lo"), F.max("_away").alias("_hi"))
    )
    seen = _with_angles(voices.where("_dim > 0"), matrices).select(*_CLUSTER, "_dim", F.posexplode("_angles").alias("_pivot", "_a"))
    bound = F.greatest(F.lit(0.0), F.col("_a") - F.col("_hi"), F.col("_lo") - F.col("_a"))
    # A size without pivots has one region, whose angles bound nothing.
    bound = F.when(F.col("_dim").isin(*matrices), bound).otherwise(0.0) if matrices else F.lit(0.0)
    offers = salted_lookup(seen, blocks, ["_dim", "_pivot"], spread_by=_CLUSTER, how="inner").withColumn("_least", bound)
    first = offers.groupBy(*_CLUSTER).agg(F.min_by(F.struct(*_BLOCK), F.struct("_least", "_a", "_cell")).alias("_b"))
    first = checkpointed(first.select(*_CLUSTER, "_b.*"))
    found = checkpointed(_compared(first, voices, placed))
    reach = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("score")))) + SLACK
    others = (
        offers.join(found.select(*_CLUSTER, reach.alias("_reach")), _CLUSTER)
        .where(F.col("_least") <= F.col("_reach"))
        .select(*_CLUSTER, *_BLOCK)
        .join(first, [*_CLUSTER, *_BLOCK], "left_anti")
    )
    found = found.unionByName(_compared(others, voices, placed))
    for other in _unlike(known):
        none = {c: F.lit(other[c]).cast(known.schema[c].dataType) for c in ("pos", *_BEST)}
        unlike = voices.where((F.col("_dim") == 0) | (F.col("_dim") != other["_dim"]))
        found = found.unionByName(unlike.select(*_CLUSTER, F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("compared"), *[c.alias(n) for n, c in none.items()]))
    best = F.min_by(F.struct("score", *_BEST), F.struct(-F.col("score"), F.col("pos"))).alias("_best")
    return found.groupBy(*_CLUSTER).agg(best, F.sum("compared").alias("compared")).select(*_CLUSTER, "_best.*", "compared")


def _unlike(known: DataFrame) -> list:
    """The first profile, and the first one of another kind: one of them is the first that is unlike a cluster."""
    whole = F.struct("pos", *_BEST, "_dim")
    first = known.agg(F.min_by(whole, "pos").alias("p")).first()["p"]
    if first is None:
        return []
    second = known.where(F.col("_dim") != first["_dim"]).agg(F.min_by(whole, "pos").alias("p")).first()["p"]
    return [p for p in (first, second) if p is not None]
