"""Packing into fixed sequences as vector bin packing.

Every example asks for tokens, one segment and loss-bearing tokens; a sequence
has a limit on each.  The open sequence takes the waiting example whose demand
has the largest dot product with what is left of the limits; a gap that no
whole example fits is filled with a cut one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.vocabulary import encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024  # loss-bearing tokens


#: For texts whose lines are prompts and answers in turn.
TURN_LIMITS = Limits(loss=896)


@dataclass
class Piece:
    """A run of an example's tokens; ``start`` counts the example's tokens before it."""

    key: int | None
    of: int  # the example's tokens
    start: int
    ids: np.ndarray
    loss: np.ndarray  # True where a token bears loss
    n_loss: int = -1  # counted unless it is known

    def __post_init__(self):
        if self.n_loss < 0:
            self.n_loss = int(np.count_nonzero(self.loss))

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        first = Piece(self.key, self.of, self.start, self.ids[:n], self.loss[:n])
        return first, Piece(self.key, self.of, self.start + n, self.ids[n:], self.loss[n:], self.n_loss - first.n_loss)


class Packer:
    """Packs a stream of examples; holds at most ``waiting`` sequences' worth of tokens and one example."""

    def __init__(self, limits: Limits, waiting: int = 256):
        self.limits, self.hold = limits, waiting * limits.tokens
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pool: list[Piece] = []
        self.demand = np.ones((64, 3))  # a row for each waiting piece, and room for more: tokens, one segment, loss
        self.held = 0
        self.free = 0  # tokens in the pool that bear no loss

    def add(self, key: int | None, ids: np.ndarray, loss: np.ndarray) -> Iterator[list[Piece]]:
        rest = Piece(key, len(ids), 0, ids, loss)
        while len(rest.ids):
            # No waiting piece is larger than an empty sequence.
            n = max(1, self._fitting(rest, self.limits.tokens, self.limits.loss))
            whole = n == len(rest.ids)
            piece, rest = (rest, None) if whole else rest.cut(n)
            if n == self.limits.tokens:
                yield [piece]
            else:
                self._put(piece)
            if whole:
                break
        if self.held >= self.hold:
            yield from self._pack(down_to=self.hold // 2)

    def _put(self, piece: Piece) -> None:
        if len(self.pool) == len(self.demand):
            self.demand = np.concatenate([self.demand, np.ones_like(self.demand)])
        self.demand[len(self.pool)] = len(piece.ids), 1, piece.n_loss
        self.pool.append(piece)
        self.held += len(piece.ids)
        self.free += len(piece.ids) - piece.n_loss

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._pack(down_to=1)

    def _size(self) -> int:
        """Tokens of a sequence that the pool can fill without padding: all, or else a power of two."""
        size = min(self.held, self.limits.tokens)
        if size == self.limits.tokens and self.free >= size - self.limits.loss:
            return size
        # What is left doesn't fill a sequence, or nearly all of it bears loss: powers of two need no padding.
        size = 1 << (size.bit_length() - 1)
        while size > 1 and self.free < size - self.limits.loss:
            size >>= 1
        return size

    def _fitting(self, piece: Piece, tokens: int, loss: int) -> int:
        """Tokens of ``piece`` that fit into what is left."""
        n = min(len(piece.ids), tokens)
        if piece.n_loss > loss:
            n = min(n, int(np.searchsorted(np.cumsum(piece.loss), loss, side="right")))
        return n

    def _pack(self, down_to: int) -> Iterator[list[Piece]]:
        while self.held >= max(down_to, 1):
            yield self._fill(self._size())

    def _fill(self, tokens: int) -> list[Piece]:
        left = np.array([tokens, self.limits.segments, self.limits.loss], float)
        demand = self.demand[: len(self.pool)]
        scaled, (need, _, loss) = demand / self.scale, demand.T
        alive, waiting = np.ones(len(self.pool), bool), len(self.pool)
        taken: list[int] = []
        pieces: list[Piece] = []
        cut: Piece | None = None
        while left[0] and left[1] and waiting:
            # A worth is above 0, as every piece has tokens.
            worth = scaled @ (left / self.scale)
            fits = alive & (need <= left[0]) & (loss <= left[2])
            if left[1] == 1:
                # The last segment must fill the sequence.
                fits &= need == left[0]
            i = int(np.argmax(worth * fits))
            if fits[i]:
                piece = self.pool[i]
            else:
                i = int(np.argmax(worth * alive))
                piece = self.pool[i]
                n = self._fitting(piece, int(left[0]), int(left[2]))
                if n and n < len(piece.ids):
                    piece, cut = piece.cut(n)
            alive[i] = False
            waiting -= 1
            if not fits[i] and not n:
                continue  # begins with tokens that bear loss, of which no more fit
            taken.append(i)
            pieces.append(piece)
            left -= (len(piece.ids), 1, piece.n_loss)
            if cut is not None:
                break
        demand = np.delete(demand, taken, 0)
        self.demand[: len(demand)] = demand
        for i in sorted(taken, reverse=True):
            del self.pool[i]
        self.held -= sum(len(p.ids) for p in pieces)
        self.free -= sum(len(p.ids) - p.n_loss for p in pieces)
        if cut is not None:
            self.held -= len(cut.ids)  # it is put back, and counted anew
            self.free -= len(cut.ids) - cut.n_loss
            self._put(cut)
        return pieces


def answers(text: str, starts: np.ndarray) -> np.ndarray:
    """Which tokens (by the places of their first bytes) lie in answers: a text's lines are prompts and
    answers in turn, and the last one that isn't blank is an answer."""
    data = np.frombuffer(text.rstrip().encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.flatnonzero(data == 10)
    return (len(ends) - np.searchsorted(ends, starts)) % 2 == 0


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
    turns: bool = False,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    segment, n_loss, ids``.

    A row's tokens are its text's ids by the file ``tokenizer`` and then
    ``separator``.  They bear loss unless ``loss_col`` is given and not true,
    or, with ``turns``, they lie in a prompt (see :func:`answers`);
    the separator never does.  No sequence exceeds ``limits``; all are filled
    to ``limits.tokens`` but for those that the segments or the loss close and, at the
    end of a partition or where the rest bears too much loss, sequences whose length is a power of two.

    Each input partition is packed as its rows stream by (no shuffle, memory
    bounded by the pool and the largest document); sequence ids are the
    partition's number times 2^40 plus a count, the same when a lost task runs
    again.  Null or empty text: only the separator.  Null or repeated ids: rows
    are packed one by one, ids are just carried.  Empty table: no rows.  Other
    columns are ignored.
    """
    schema = (
        f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "`offset` long, segment int, n_loss long, ids binary"
    )
    loss = F.col(loss_col) if loss_col else F.lit(True)
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"), loss.alias("loss"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), Packer(limits)
        at = TaskContext.get().partitionId() << 40
        out: list[tuple] = []

        def emit(sequences: Iterable[list[Piece]]) -> None:
            nonlocal at
            for sequence in sequences:
                offset = 0
                for segment, p in enumerate(sequence):
                    data = p.ids.astype("<u4").tobytes()
                    out.append((p.key, p.start, len(p.ids), zlib.crc32(data), p.of, at, offset, segment, p.n_loss, data))
                    offset += len(p.ids)
                at += 1

        def batch() -> pa.RecordBatch:
            table = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * len(types), types)], names=names
            )
            out.clear()
            return table

        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segment", "n_loss", "ids"]
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary()]
        for b in batches:
            for key, text, bears in zip(*(b.column(i).to_pylist() for i in range(3))):
                own, starts = encode(text) if text else (np.empty(0, np.uint32), np.empty(0, np.int64))
                ids = np.append(own, np.uint32(separator))
                flags = np.full(len(ids), bool(bears))
                flags[-1] = False
                if turns and bears and text:
                    flags[:-1] = answers(text, starts)
                emit(packer.add(key, ids, flags))
                if len(out) >= 2000:
                    yield batch()
        emit(packer.finish())
        yield batch()

    return rows.mapInArrow(pack, schema)

