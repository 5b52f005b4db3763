"""Words of many texts at once, as positions in one buffer of bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut into words at a time.
BUFFER = 1 << 21
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Words:
    """Where words stand in ``raw`` (A-Z lowered), whose text each is of, and how many pieces ended before it."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    piece: np.ndarray

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """Number of each word among the distinct ones, and those (as bytes)."""
        offsets = np.empty(2 * len(self.starts) + 1, np.int32)
        offsets[:-1:2], offsets[1::2], offsets[-1] = self.starts, self.ends, len(self.raw)
        if not len(self.starts):
            return np.zeros(0, np.int32), pa.array([], pa.binary())
        # Words and what lies between them, in turn.
        both = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(self.raw)])
        coded = both.take(pa.array(np.arange(0, len(both), 2))).dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary


class Cutter:
    """Words are runs of bytes other than ``gaps`` and ``stops``; a stop also ends a piece."""

    def __init__(self, gaps: Iterable[int], stops: Iterable[int] = b"\n") -> None:
        self.stops = bytes(stops)
        self.stop = np.zeros(256, bool)
        self.stop[list(self.stops)] = True
        self.gap = self.stop.copy()
        self.gap[list(gaps)] = True

    def _parts(self, raw: bytes, most: int) -> Iterator[bytes]:
        """A long text cut at stops; what holds none stays whole."""
        start = 0
        while len(raw) - start > most:
            at = max(raw.rfind(c, start, start + most) for c in self.stops)
            if at < 0:
                at = min((x for c in self.stops if (x := raw.find(c, start + most)) >= 0), default=len(raw))
            yield raw[start:at]
            start = at + 1
        yield raw[start:]

    def words(self, texts: Iterable[str | None], most: int | None = None) -> Iterator[Words]:
        """Words of the texts, in order and in bounded buffers; a long text may span several."""
        most = most or BUFFER
        held: list[bytes] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            raw = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass")
            for part in self._parts(raw, most):
                if held and size + len(part) > most:
                    yield self._cut(held, owners)
                    held, owners, size = [], [], 0
                held.append(part)
                owners.append(i)
                size += len(part) + 1
        if held:
            yield self._cut(held, owners)

    def _cut(self, parts: list[bytes], owners: list[int]) -> Words:
        between = self.stops[:1]
        raw = (between + between.join(parts) + between).translate(_LOWER)
        data = np.frombuffer(raw, np.uint8)
        gap = self.gap[data]
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        piece = np.searchsorted(np.flatnonzero(self.stop[data]), starts)
        first = np.cumsum([1] + [len(p) + 1 for p in parts[:-1]])
        owner = np.array(owners)[np.searchsorted(first, starts, side="right") - 1]
        return Words(raw, starts, ends, owner, piece)


class Vocabulary:
    """Finds given words among the words of texts, by value."""

    def __init__(self, words: list[bytes]) -> None:
        self.longest = max(map(len, words), default=0)
        raw = b"".join(words)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        at = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(words) else ends
        self.lengths = ends - at
        self.seed = np.uint64(0)
        while True:
            self.chunks = _chunks(raw, at, self.lengths, self.longest)
            codes = self._codes(self.chunks)
            if len(np.unique(codes)) == len(words):
                break
            self.seed += np.uint64(1)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]

    def _codes(self, chunks: list[np.ndarray]) -> np.ndarray:
        out = chunks[0] + self.seed if chunks else np.zeros(0, np.uint64)
        for more in chunks[1:]:
            out = np.where(more != 0, (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + more, out)
        return out

    def find(self, words: Words) -> np.ndarray:
        """Number of each word in the given list, -1 for others."""
        out = np.full(len(words.starts), -1, np.int64)
        lengths = words.ends - words.starts
        fit = np.flatnonzero(lengths <= self.longest)
        if not len(self.codes) or not len(fit):
            return out
        chunks = _chunks(words.raw, words.starts[fit], lengths[fit], self.longest)
        codes = self._codes(chunks)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[at] == codes
        found = self.order[at]
        hit &= self.lengths[found] == lengths[fit]
        for own, theirs in zip(chunks, self.chunks, strict=True):
            hit &= own == theirs[found]
        out[fit[hit]] = found[hit]
        return out


def _chunks(raw: bytes, starts: np.ndarray, lengths: np.ndarray, longest: int) -> list[np.ndarray]:
    """Each word as numbers of eight bytes, zero beyond its end.  Words hold no zero byte."""
    data = raw + bytes(longest + 16)
    view = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    out = []
    for i in range(0, max(longest, 1), 8):
        left = np.clip(lengths - i, 0, 8)
        out.append(view[np.minimum(starts + i, len(data) - 8)] & masks[left])
    return out
