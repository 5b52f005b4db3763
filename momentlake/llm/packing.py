"""Hierarchical multi-length packing of token ids into sequences of several context sizes."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Tokens of short pieces that a task holds before it packs them.
BUFFER_TOKENS = 1 << 21
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long, ids binary"
)


class Encoder:
    """The ids of a public byte-level vocabulary; strings of special tokens give their id.

    The vocabulary is there as ranks and as a tokenizer file, with the same ids; the ranks are
    several times faster, but give up on very long runs of white space.
    """

    def __init__(self, ranks_file: str, tokenizer_file: str, special: dict[str, int]) -> None:
        import public_tokenizers
        import tiktoken

        self.whole, self.tokenizer = public_tokenizers.path(tokenizer_file), None
        with open(public_tokenizers.path(ranks_file), "rb") as lines:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str | None) -> np.ndarray:
        try:
            return np.asarray(self.encoding.encode(text or "", allowed_special="all"), "<u4")
        except ValueError:
            from tokenizers import Tokenizer

            self.tokenizer = self.tokenizer or Tokenizer.from_file(self.whole)
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


class Piece:
    """A run of a document's ids that is still to be placed."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class Tiers:
    """Short pieces by length, the lengths up to each power of two for themselves."""

    def __init__(self) -> None:
        self.tiers: dict[int, list[tuple[int, int, Piece]]] = {}
        self.held: dict[int, int] = {}
        self.tokens = self.serial = 0

    def add(self, piece: Piece) -> None:
        n = len(piece.ids)
        tier = (n - 1).bit_length()
        insort(self.tiers.setdefault(tier, []), (n, self.serial, piece), key=lambda x: x[:2])
        self.held[tier] = self.held.get(tier, 0) + n
        self.serial, self.tokens = self.serial + 1, self.tokens + n

    def _pop(self, tier: int, at: int) -> Piece:
        n, _, piece = self.tiers[tier].pop(at)
        self.held[tier] -= n
        self.tokens -= n
        return piece

    def take(self, most: int) -> Piece | None:
        """The longest piece of at most ``most`` ids, from the longest tier that has one."""
        for tier in range((most - 1).bit_length(), -1, -1):
            if (held := self.tiers.get(tier)) and (at := bisect_right(held, most, key=lambda x: x[0])):
                return self._pop(tier, at - 1)
        return None

    def shortest(self) -> Piece:
        return self._pop(min(tier for tier, held in self.tiers.items() if held), 0)

    def ready(self, size: int, shorter: int) -> bool:
        """Whether the pieces above ``shorter`` ids fill a sequence of ``size``, with shorter ones in the gap."""
        own = [t for t in self.held if shorter < 1 << t <= size]
        return any(self.tiers[t] for t in own) and sum(n for t, n in self.held.items() if 1 << t <= size) >= size


def fill(tiers: Tiers, size: int) -> list[Piece]:
    """One full sequence: the longest piece, then its gap from shorter ones, the last one cut to fit.

    Needs ``size`` tokens in ``tiers``.
    """
    sequence, gap = [], size
    while gap:
        piece = tiers.take(gap)
        if piece is None:
            piece, rest = tiers.shortest().cut(gap)
            tiers.add(rest)
        sequence.append(piece)
        gap -= len(piece.ids)
    return sequence


def packed_tiers(tiers: Tiers, sizes: Sequence[int]) -> Iterator[list[Piece]]:
    """Sequences of every context size, the longest first: a tier's pieces make sequences of its own size,
    whose gaps are filled from shorter tiers.  What cannot fill a sequence of its tier stays."""
    for i, size in enumerate(sizes):
        shorter = sizes[i + 1] if i + 1 < len(sizes) else 0
        while tiers.ready(size, shorter):
            yield fill(tiers, size)


def pack_stream(documents: Iterator[tuple[object, np.ndarray]], sizes: Sequence[int], buffer_tokens: int) -> Iterator[list[Piece]]:
    """Sequences over a stream of (document, ids): whole windows of long documents at once, rests by tiers.

    ``sizes`` are the context sizes, the longest first.  Every sequence is as long as its tier but those of the
    end, whose lengths are the powers of two that make
    up the tokens left, so nothing is padded.  Memory: one document and ``buffer_tokens``.
    """
    tiers, window = Tiers(), sizes[0]
    for doc, ids in documents:
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [Piece(doc, start, ids[start : start + window], len(ids))]
        if whole < len(ids):
            tiers.add(Piece(doc, whole, ids[whole:].copy(), len(ids)))
        if tiers.tokens >= buffer_tokens:
            yield from packed_tiers(tiers, sizes)
    yield from packed_tiers(tiers, sizes)
    while tiers.tokens:
        yield fill(tiers, min(window, 1 << (tiers.tokens.bit_length() - 1)))


def step_groups(sequences: Iterator[list[Piece]], per_step: int) -> Iterator[tuple[int, list[Piece]]]:
    """Number sequences into steps of ``per_step`` of one length, with balanced attention cost.

    Of each run of ``per_step`` squared sequences of a length, sorted by the sum of their squared piece
    lengths, steps take one in turn, there and back.
    """
    base, held = 0, {}

    def deal(run: list[list[Piece]]):
        run.sort(key=lambda pieces: -sum(len(p.ids) ** 2 for p in pieces))
        steps = -(-len(run) // per_step)
        for i, pieces in enumerate(run):
            lap, at = divmod(i, steps)
            yield base + (at if lap % 2 == 0 else steps - 1 - at), pieces

    for pieces in sequences:
        run = held.setdefault(sum(len(p.ids) for p in pieces), [])
        run.append(pieces)
        if len(run) == per_step * per_step:
            yield from deal(run)
            base += per_step
            run.clear()
    for run in held.values():
        if run:
            yield from deal(run)
            base += -(-len(run) // per_step)


def pack(
    docs: DataFrame,
    *,
    sizes: Sequence[int] = (1024, 512, 256, 128),
    end_id: int = 0,
    ranks_file: str = "byte_bpe_50k.tiktoken",
    tokenizer_file: str = "byte_bpe_50k.json",
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),),
    buffer_tokens: int = BUFFER_TOKENS,
    per_step: int = 8,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where its ids lie in their document and in a sequence.

    A document's whole windows of the longest size are sequences; its rest goes to the tier of the least size that
    holds it.  ``tier`` is the length of the sequence.

    Null texts count as empty and are a document of the end id alone; equal rows are packed each
    for itself; other columns of ``docs`` are not read; an empty table gives an empty result.
    Packing is local to the tasks that read the documents: there is no shuffle, and a task that
    is run again gives the same pieces.  ``step_group`` counts within such a task as
    ``sequence_id`` does: partition number first.
    """
    sizes = sorted(sizes, reverse=True)
    if not sizes or any(size < 1 or size & (size - 1) for size in sizes):
        raise ValueError("context sizes are powers of two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks_file, tokenizer_file, dict(special))
        task = TaskContext.get().partitionId() << 40

        def encoded():
            for batch in batches:
                for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                    text = text if isinstance(text, str) else ""
                    yield (None if pd.isna(doc) else int(doc)), np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")

        rows: list[tuple] = []
        for number, (step, pieces) in enumerate(step_groups(pack_stream(encoded(), sizes, buffer_tokens), per_step)):
            length = sum(len(p.ids) for p in pieces)
            offset = 0
            for p in pieces:
                raw = p.ids.tobytes()
                rows.append(
                    (p.doc, p.start, len(p.ids), zlib.crc32(raw), p.total, task + number, offset, length, task + step, raw if with_ids else None)
                )
                offset += len(p.ids)
            if len(rows) >= 4096:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)

    return docs.select("doc_id", "text").mapInPandas(run, PIECES)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
    return out.assign(doc_id=out["doc_id"].astype("Int64"))
