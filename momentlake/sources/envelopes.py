"""JSON envelopes of any size: the elements of a list inside a document, read in parallel.

A file is read in splits, as text that ends at every ``}``, so neither a document nor its list has to fit into a row.
What a split cannot know by itself is whether it begins inside a string and which brackets are open there.  A first
pass notes, for either case, the brackets that a split leaves unmatched; carried from split to split of a
file they tell how each one begins.  The second pass cuts out the elements, and an element that crosses splits is put together
from its parts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import checkpointed

#: Splits up to which their states are broadcast.
BROADCAST_SPLITS = 50_000
_OPEN, _CLOSE = b"{[", b"}]"


def _tokens(raw: bytes, in_string: bool) -> tuple[list[int], bool]:
    """Positions of the brackets outside strings, and whether the end lies in a string."""
    data = np.frombuffer(raw, np.uint8)
    quotes = np.flatnonzero(data == ord('"'))
    escaped, before = np.zeros(len(quotes), bool), quotes - 1
    open_ = np.ones(len(quotes), bool)
    while True:
        open_ &= before >= 0
        open_[open_] = data[before[open_]] == ord("\\")
        if not open_.any():
            break
        escaped[open_] ^= True
        before = before - 1
    quotes = quotes[~escaped]
    brackets = np.flatnonzero(np.isin(data, np.frombuffer(_OPEN + _CLOSE, np.uint8)))
    inside = (np.searchsorted(quotes, brackets) + in_string) % 2 == 1
    return brackets[~inside].tolist(), bool((len(quotes) + in_string) % 2)


def _opener(raw: bytes, at: int) -> str:
    """A bracket with the key it is the value of, if any."""
    head = raw[:at].rstrip()
    key = ""
    if head.endswith(b":"):
        head = head[:-1].rstrip()
        key = head[head.rfind(b'"', 0, len(head) - 1) + 1 : len(head) - 1].decode("utf-8", "replace")
    return chr(raw[at]) + key


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, bytes, pd.DataFrame]]:
    """The text of each run of pieces of one split."""
    for batch in batches:
        split = (batch["path"] != batch["path"].shift()) | (batch["start"] != batch["start"].shift())
        for _, run in batch.groupby(split.cumsum(), sort=False):
            raw = b"".join(p.encode("utf-8", "surrogatepass") + b"}" for p in run["piece"])
            yield (run["path"].iloc[0], int(run["start"].iloc[0])), raw, run


class _Unmatched:
    """The brackets that a text leaves unmatched: so many closed ones, then the open ones."""

    def __init__(self, in_string: bool) -> None:
        self.in_string, self.closed, self.stack = in_string, 0, []

    def read(self, raw: bytes) -> None:
        at, self.in_string = _tokens(raw, self.in_string)
        for i in at:
            if raw[i] in _OPEN:
                self.stack.append(_opener(raw, i))
            elif self.stack:
                self.stack.pop()
            else:
                self.closed += 1


def _effects(pieces: DataFrame) -> DataFrame:
    """Per split and case (it begins inside a string or not): how it ends and the brackets it leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, cases = None, []

        def row() -> pd.DataFrame:
            return pd.DataFrame(
                [(*now, begins, c.in_string, c.closed, json.dumps(c.stack)) for begins, c in zip((False, True), cases, strict=True)],
                columns=["path", "start", "begins", "ends", "closed", "opened"], dtype=object,
            )

        for split, raw, _ in _pieces(batches):
            if split != now:
                if now is not None:
                    yield row()
                now, cases = split, [_Unmatched(False), _Unmatched(True)]
            for case in cases:
                case.read(raw)
        if now is not None:
            yield row()

    return pieces.mapInPandas(run, "path string, start long, begins boolean, ends boolean, closed int, opened string")


def _states(effects: DataFrame) -> DataFrame:
    """(path, start, begins, stack): how each split of a file begins, from what those before it leave."""

    def run(splits: pd.DataFrame) -> pd.DataFrame:
        begins, stack, out = False, [], []
        cases = {(r.start, r.begins): r for r in splits.itertuples()}
        for start in sorted({r.start for r in splits.itertuples()}):
            out.append((splits["path"].iloc[0], start, begins, json.dumps(stack)))
            own = cases[start, begins]
            stack = stack[: max(0, len(stack) - own.closed)] + json.loads(own.opened)
            begins = own.ends
        return pd.DataFrame(out, columns=["path", "start", "begins", "stack"])

    # A file has one row a split and case.
    return effects.groupBy("path").applyInPandas(run, "path string, start long, begins boolean, stack string")


class _Cutter:
    """Cuts the elements of the wanted lists out of the text of a split."""

    def __init__(self, begins: bool, stack: list[str], wanted: set[tuple[str, ...]]) -> None:
        self.in_string, self.stack, self.wanted = begins, stack, wanted
        self.deepest = max(map(len, wanted))
        #: Depth of the list whose element is being read, and the parts of that element so far.
        self.depth = next((d for d in range(1, len(stack)) if tuple(stack[:d]) in wanted and stack[d][0] == "{"), None)
        self.parts: list[bytes] = []
        self.crosses = self.depth is not None

    def read(self, raw: bytes) -> Iterator[tuple[str, bytes]]:
        """(kind, text): ``whole`` elements, and the ``tail`` of one that began in an earlier split."""
        at, self.in_string = _tokens(raw, self.in_string)
        begin = 0
        for i in at:
            if raw[i] in _OPEN:
                if self.depth is None and raw[i] == ord("{") and tuple(self.stack) in self.wanted:
                    self.depth, begin = len(self.stack), i
                self.stack.append(_opener(raw, i) if len(self.stack) <= self.deepest else chr(raw[i]))
                continue
            if self.stack:
                self.stack.pop()
            if self.depth is not None and len(self.stack) == self.depth:
                yield ("tail" if self.crosses else "whole"), b"".join([*self.parts, raw[begin : i + 1]])
                self.depth, self.parts, self.crosses = None, [], False
        if self.depth is not None:
            self.parts.append(raw[begin:])

    def rest(self) -> Iterator[tuple[str, bytes]]:
        """The ``head`` of an element that goes on in the next split, or ``through`` a whole one."""
        if self.depth is not None:
            yield ("through" if self.crosses else "head"), b"".join(self.parts)


_CUT = "path string, start long, pos long, kind string, item string"


def _cut(pieces: DataFrame, wanted: set[tuple[str, ...]]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, cutter, n = None, None, 0

        def rows(found: Iterator[tuple[str, bytes]]) -> pd.DataFrame:
            nonlocal n
            out = []
            for kind, text in found:
                out.append((*now, n, kind, text.decode("utf-8", "surrogatepass")))
                n += 1
            return pd.DataFrame(out, columns=["path", "start", "pos", "kind", "item"], dtype=object)

        for split, raw, first in _pieces(batches):
            if split != now:
                if now is not None:
                    yield rows(cutter.rest())
                now, n = split, 0
                cutter = _Cutter(bool(first["begins"].iloc[0]), json.loads(first["stack"].iloc[0]), wanted)
            yield rows(cutter.read(raw))
        if now is not None:
            yield rows(cutter.rest())

    return pieces.mapInPandas(run, _CUT)


def _joined(parts: DataFrame) -> DataFrame:
    """Elements that cross splits, from their parts."""

    def run(of: pd.DataFrame) -> pd.DataFrame:
        out, held = [], None
        for r in of.sort_values(["start", "pos"]).itertuples(index=False):
            if r.kind == "head":
                held = [r.path, r.start, r.pos, "whole", r.item]
            elif held is not None:
                held[4] += r.item
                if r.kind == "tail":
                    out.append(held)
                    held = None
        return pd.DataFrame(out, columns=["path", "start", "pos", "kind", "item"], dtype=object)

    # A file has at most two parts a split.
    return parts.groupBy("path").applyInPandas(run, _CUT)


def read_elements(spark: SparkSession, path: str, lists: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """The objects in lists of JSON documents: path, pos (a number that grows within a file), item (JSON text).

    ``lists`` name where a list may stand, by the keys that lead to it: ``()`` is a document that is a list,
    ``("transcript", "segments")`` the list ``{"transcript": {"segments": [...]}}``.  A file may hold several documents, one
    after the other.  Other content, and elements that are no objects, are passed over.  Memory is bounded by a batch
    of pieces and one element.
    """
    wanted = {("[",) if not keys else tuple(["{", *["{" + k for k in keys[:-1]], "[" + keys[-1]]) for keys in lists}
    text = spark.read.option("lineSep", "}").text(path)
    pieces = text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece")
    )
    states = checkpointed(_states(_effects(pieces)))
    if states.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        known = pieces.join(F.broadcast(states), ["path", "start"])
    else:
        place = F.monotonically_increasing_id()
        known = pieces.withColumn("_at", place).join(states, ["path", "start"]).repartition("path", "start")
        known = known.sortWithinPartitions("path", "start", "_at").drop("_at")
    cut = checkpointed(_cut(known.select("path", "start", "piece", "begins", "stack"), wanted))
    found = cut.where("kind = 'whole'").unionByName(_joined(cut.where("kind <> 'whole'")))
    return found.select("path", (F.col("start") * F.lit(1 << 20) + F.col("pos")).alias("pos"), "item")
