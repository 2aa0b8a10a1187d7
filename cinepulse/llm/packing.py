"""Vector bin packing of token sequences.

Pieces of documents go to sequences under three limits at once: tokens, segments and
loss-bearing tokens. A sequence takes, piece after piece, the one whose demand has
the largest dot product with what the sequence has left (each dimension relative to
its limit); if nothing fits whole, the best piece is cut to what is left, so that
sequences are full and lose at most to the segment limit.

Documents are cut in full sequences first; their remainders are placed window by
window (``WINDOW`` documents) by the heuristic. A sequence that cannot be filled (the
last of a task, or one that ran out of segments) is split at powers of two, which are
lengths that need no padding. Every task packs the rows of its own partition, with
one window in memory: no shuffle, no group, no driver. Sequence ids are the partition
id and a number.

A document's ids end with ``end_id``, which bears no loss. All its other ids bear loss,
unless a column gives the spans that do (answers without their prompts). Without that
column the loss limit binds only if it is below the token limit. NULL and empty texts have
that one id only; runs of white space of any length are encoded (``tokens``). Repeated rows are packed as often as they occur; a NULL id stays
NULL; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.llm.common import lean
from cinepulse.llm.tokens import TextEncoder, default_vocabulary

MAX_TOKENS = 1024
MAX_SEGMENTS = 256
END_ID = 0
WINDOW = 1024
#: Sequence ids of a task are its partition id times this, and up.
SEQUENCES_PER_TASK = 1 << 40
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


@dataclass(frozen=True)
class Limits:
    tokens: int = MAX_TOKENS
    segments: int = MAX_SEGMENTS
    loss: int = MAX_TOKENS


@dataclass
class Piece:
    doc: int  # place of the document in its window
    start: int
    length: int
    loss: int


def place(
    items: list[Piece], limits: Limits, cut: Callable[[Piece, int], tuple[Piece, Piece]], reach: Callable[[int, int, int, int], int] | None = None
) -> Iterator[list[Piece]]:
    """Sequences of pieces, by the dot-product heuristic; all but the last are full or
    at a limit. ``cut(piece, n)`` splits a piece after n tokens; ``reach`` (of a
    ``Loss``) says how far a piece goes if not every token bears loss."""
    bound = np.array([limits.tokens, limits.segments, limits.loss], float)
    demand = np.array([[p.length, 1, p.loss] for p in items], float).reshape(-1, 3) / bound
    open_, items = np.ones(len(items), bool), list(items)
    remaining = len(items)
    while remaining:
        left, chosen = np.ones(3), []
        while remaining:
            score = demand @ left
            fits = open_ & (demand <= left + 1e-12).all(1)
            if fits.any():
                best = int(np.argmax(np.where(fits, score, -1.0)))
                chosen.append(items[best])
                left = left - demand[best]
                open_[best] = False
                remaining -= 1
                continue
            tokens, segments, loss = np.rint(left * bound).astype(int).tolist()
            room = min(tokens, loss) if limits.loss < limits.tokens else tokens
            if segments < 1 or (room < 1 and not (reach and tokens)):
                break
            # Nothing fits whole: cut the piece that promises most to what is left.
            best = int(np.argmax(np.where(open_, np.minimum(demand, left) @ left, -1.0)))
            if reach and (room := reach(items[best].doc, items[best].start, tokens, loss)) < 1:
                break
            head, tail = cut(items[best], room)
            chosen.append(head)
            items[best] = tail
            demand[best] = np.array([tail.length, 1, tail.loss]) / bound
            break
        yield chosen


def powers_of_two(pieces: list[Piece], cut: Callable[[Piece, int], tuple[Piece, Piece]]) -> Iterator[list[Piece]]:
    """The pieces again, as sequences whose lengths are powers of two, longest first."""
    total, todo = sum(p.length for p in pieces), list(pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out = []
        while room:
            p = todo.pop(0)
            if p.length > room:
                p, rest = cut(p, room)
                todo.insert(0, rest)
            out.append(p)
            room -= p.length
        yield out


def _cutter(n_loss: Callable[[int, int, int], int]) -> Callable[[Piece, int], tuple[Piece, Piece]]:
    def cut(p: Piece, n: int) -> tuple[Piece, Piece]:
        a = Piece(p.doc, p.start, n, n_loss(p.doc, p.start, n))
        return a, Piece(p.doc, p.start + n, p.length - n, p.loss - a.loss)

    return cut


class Loss:
    """Loss-bearing ids of documents, by prefix sums over the spans of each (None: all
    ids bear loss). The last id never does; overlapping spans count once."""

    def __init__(self, sizes: list[int], spans: list[list[tuple[int, int]] | None]):
        self.sums = []
        for size, found in zip(sizes, spans):
            bears = np.zeros(size, np.int32)
            for start, stop in [(0, size)] if found is None else found:
                bears[max(start, 0) : max(stop, 0)] = 1
            bears[-1:] = 0
            self.sums.append(np.concatenate([[0], np.cumsum(bears)]))

    def count(self, doc: int, start: int, n: int) -> int:
        return int(self.sums[doc][start + n] - self.sums[doc][start])

    def reach(self, doc: int, start: int, tokens: int, loss: int) -> int:
        """Ids from ``start`` on, at most ``tokens``, of which at most ``loss`` bear loss."""
        sums = self.sums[doc]
        return int(np.searchsorted(sums[start + 1 : start + tokens + 1], sums[start] + loss, side="right"))


def pack_window(
    sizes: list[int], limits: Limits, carry: list[Piece] | None = None, spans: list[list[tuple[int, int]] | None] | None = None
) -> Iterator[list[Piece]]:
    """Sequences for documents of ``sizes`` ids, the last of each without loss; with
    ``spans`` (of ids, per document) only the ids in them bear loss."""
    bearing = None if spans is None else Loss(sizes, spans)
    n_loss = bearing.count if bearing else (lambda doc, start, n: n - (start + n == sizes[doc]))
    cut = _cutter(n_loss)
    whole, rest = min(limits.tokens, limits.loss), []
    for d, size in enumerate(sizes):
        at = 0
        while size - at >= limits.tokens:
            n = whole if size - at - whole else limits.tokens
            n = bearing.reach(d, at, limits.tokens, limits.loss) if bearing else min(n, size - at)
            yield [Piece(d, at, n, n_loss(d, at, n))]
            at += n
        if at < size:
            rest.append(Piece(d, at, size - at, n_loss(d, at, size - at)))
    for sequence in place(rest, limits, cut, bearing and bearing.reach):
        length = sum(p.length for p in sequence)
        if length == limits.tokens or length & (length - 1) == 0:
            yield sequence
        else:
            yield from powers_of_two(sequence, cut)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    limits: Limits = Limits(),
    end_id: int = END_ID,
    window: int = WINDOW,
    loss_col: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    ``loss_col``: array<struct<start, stop>> of the ids of a row that bear loss (NULL: all)."""
    path = vocabulary or default_vocabulary()
    tail = int(end_id).to_bytes(4, "little")
    types = [pa.int64()] * 8
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(path)
        next_id = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        for batch in batches:
            for at in range(0, batch.num_rows, window):
                part = batch.slice(at, window)
                ids = [e + tail for e in encoder.encode([t or "" for t in part.column(1).to_pylist()])]
                keys, rows = part.column(0).to_pylist(), []
                spans = None
                if loss_col:
                    spans = [v and [(s["start"], s["stop"]) for s in v] for v in part.column(2).to_pylist()]
                for sequence in pack_window([len(i) // 4 for i in ids], limits, spans=spans):
                    offset = 0
                    for p in sequence:
                        crc = zlib.crc32(ids[p.doc][4 * p.start : 4 * (p.start + p.length)])
                        rows.append((keys[p.doc], p.start, p.length, crc, len(ids[p.doc]) // 4, next_id, offset, p.loss))
                        offset += p.length
                    next_id += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    loss = [F.col(loss_col).cast("array<struct<start: bigint, stop: bigint>>")] if loss_col else []
    return docs.select(F.col(id_col).cast("long"), F.col(text_col), *loss).mapInArrow(lean(run), PIECES)
