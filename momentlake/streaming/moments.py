"""Moments that arrive in any order, merged into islands as soon as nothing can change them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Media seconds are read as seconds after this time, so that second 0 is not before every watermark.
EPOCH = 1_000_000
#: The one store that keeps lists and timers.
_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_ISLAND = (
    "start_s bigint, end_s bigint, score double, signals array<string>, src int, pos bigint, text string, "
    "message_count bigint, members bigint"
)
_FIELDS = [f.split()[0] for f in _ISLAND.split(", ")]


class _Islands(StatefulProcessor):
    """Keeps the open islands of a video; an island closes when the watermark has passed its end by the gap."""

    def __init__(self, key: str, gap: int, side: int) -> None:
        self.key, self.gap, self.side = key, gap, side

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _ISLAND)
        self.closed = handle.getValueState("closed", "until bigint")

    def _due(self, end: int) -> int:
        return 1000 * (EPOCH + end + self.gap - self.side)

    def _rows(self, key: Any, kind: str, islands: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame([[key[0], kind, *[i[c] for c in _FIELDS]] for i in islands], columns=[self.key, "kind", *_FIELDS], dtype=object)
        return out.drop(columns=["src", "pos"])

    def _merged(self, a: dict, b: dict) -> dict:
        first = min(a, b, key=lambda x: (x["start_s"], x["src"], x["pos"]))
        return first | {
            "end_s": max(a["end_s"], b["end_s"]), "score": max(a["score"], b["score"]),
            "signals": sorted({*a["signals"], *b["signals"]}), "members": a["members"] + b["members"],
        }

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        until = (self.closed.get() or (None,))[0]
        islands = [dict(zip(_FIELDS, row, strict=True)) for row in self.open.get()]
        before = {i["end_s"] for i in islands}
        late = []
        for batch in rows:
            for row in batch.sort_values("start_s").itertuples(index=False):
                optional = {c: None if pd.isna(getattr(row, c)) else getattr(row, c) for c in ("text", "message_count")}
                now = {"start_s": int(row.start_s), "end_s": int(row.end_s), "score": float(row.score), "signals": [row.signal], "src": int(row.src), "pos": int(row.pos), "members": 1}
                now |= {"text": optional["text"], "message_count": None if optional["message_count"] is None else int(optional["message_count"])}
                if until is not None and now["start_s"] < until:
                    late.append(now)
                    continue
                touched = lambda i, x=now: x["start_s"] < i["end_s"] + self.gap and i["start_s"] < x["end_s"] + self.gap
                # What the grown island touches has touched one of its parts.
                for island in [i for i in islands if touched(i)]:
                    islands.remove(island)
                    now = self._merged(now, island)
                islands.append(now)
        self.open.put([tuple(i[c] for c in _FIELDS) for i in islands]) if islands else self.open.clear()
        for end in {i["end_s"] for i in islands} - before:
            self.handle.registerTimer(self._due(end))
        yield self._rows(key, "late", late)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        islands = [dict(zip(_FIELDS, row, strict=True)) for row in self.open.get()]
        done = [i for i in islands if self._due(i["end_s"]) <= watermark]
        left = [i for i in islands if self._due(i["end_s"]) > watermark]
        self.open.put([tuple(i[c] for c in _FIELDS) for i in left]) if left else self.open.clear()
        if done:
            until = max(i["end_s"] for i in done) + self.gap
            held = self.closed.get()
            self.closed.update((max(until, held[0]) if held else until,))
        yield self._rows(key, "island", sorted(done, key=lambda i: i["start_s"]))

    def close(self) -> None:
        pass


def streamed_islands(moments: DataFrame, *, gap_seconds: int = 5, late_seconds: int = 60, side_seconds: int = 3600) -> DataFrame:
    """Islands of a stream of moments, each once, as an append stream.

    ``moments``: the columns of ``moment_signals``, in any order of arrival.  Rows out: vod_id, kind, start_s, end_s,
    score, signals, text, message_count, members.  An ``island`` equals the one of a batch run over all its
    moments and is put out when the newest moment of all videos starts ``late_seconds`` after its end and gap.  A moment
    that comes after an island it should have been part of, or that precedes one, is put out as ``late`` and changes
    nothing, for ``side_seconds`` more; what is later than that is dropped by the watermark and counted in the
    stream's metrics.  State is the open islands of each video.
    """
    moments.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    at = F.timestamp_seconds(F.col("start_s") + EPOCH)
    timed = moments.withColumn("at", at).withWatermark("at", f"{late_seconds + side_seconds} seconds")
    kind = moments.schema["vod_id"].dataType.simpleString()
    fields = ", ".join(f for f in _ISLAND.split(", ") if f.split()[0] not in ("src", "pos"))
    return timed.groupBy("vod_id").transformWithStateInPandas(
        statefulProcessor=_Islands("vod_id", gap_seconds, side_seconds), outputStructType=f"vod_id {kind}, kind string, {fields}",
        outputMode="Append", timeMode="EventTime",
    )


def run_islands(spark: SparkSession, landed: str, out: str, checkpoint: str, schema: str, *, files_at_once: int = 1000, **options: int) -> DataFrame:
    """Works off the Parquet files of moments in ``landed`` and appends islands to ``out``; a later call goes on from the checkpoint."""
    moments = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(landed)
    islands = streamed_islands(moments, **options)
    writer = islands.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)
