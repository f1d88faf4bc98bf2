"""Vector bin packing of examples into sequences.

A piece of an example weighs (tokens, one segment, loss-bearing tokens); a sequence limits
all three at once. A sequence is filled from a pool of waiting pieces: of those that still
fit, it takes the one whose weight has the largest dot product with what is left, each
measured as a share of its limit. When none fits, the longest waiting piece is cut so that
it fills the sequence, and its rest goes on waiting. Examples longer than a sequence are
first cut into whole sequences. What waits at a task's end is less than one sequence; it is
cut into sequences whose lengths are powers of two, so nothing is padded there either.

Tasks pack their own rows as they stream through, without a shuffle; a pool holds at most
``POOL`` new examples, whatever the batches they come in. Sequence numbers hold the task's number in their upper bits.

Defined cases: a null text is empty and has its end token alone; repeated rows are packed
each; a null doc_id is kept; an example without tokens (only without an end token) has no
piece; ties take the earlier piece; an empty table gives an empty result; other columns are
not read. The segment limit may leave a sequence short if most examples are tiny.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickstar.llm.token_ids import TokenCache

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
         "sequence_id bigint, offset bigint, segment int, loss_tokens bigint")
_NO_IDS = np.empty(0, np.int32)
# Examples that are packed at once.
POOL = 2000
_caches: dict[str, TokenCache] = {}


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 4096
    loss: int = 4096

    def shares(self) -> np.ndarray:
        return 1.0 / np.array([self.tokens, self.segments, self.loss], np.float64)


@dataclass
class Example:
    """``loss_from``: the first token that bears loss; tokens before it are the prompt."""

    doc_id: int | None
    ids: np.ndarray
    loss_from: int = 1


@dataclass
class Piece:
    example: Example
    start: int
    end: int

    @property
    def tokens(self) -> int:
        return self.end - self.start

    @property
    def loss(self) -> int:
        return max(0, self.end - max(self.start, self.example.loss_from))

    def head(self, tokens: int, loss: int) -> int:
        """The most tokens of its beginning that fit."""
        return min(self.tokens, tokens, max(0, self.example.loss_from - self.start) + loss)


@dataclass
class Packer:
    limits: Limits
    number: int = 0
    waiting: list[Piece] = field(default_factory=list)
    done: list[tuple[Piece, int, int, int]] = field(default_factory=list)

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for segment, piece in enumerate(pieces):
            self.done.append((piece, self.number, offset, segment))
            offset += piece.tokens
        self.number += 1

    def add(self, examples: list[Example]) -> None:
        """Packs until less than a sequence waits."""
        limits = self.limits
        for example in examples:
            piece = Piece(example, 0, len(example.ids))
            while piece.tokens > limits.tokens or piece.loss > limits.loss:
                cut = piece.start + piece.head(limits.tokens, limits.loss)
                self.close([Piece(example, piece.start, cut)])
                piece = Piece(example, cut, piece.end)
            if piece.tokens == limits.tokens:
                self.close([piece])
            elif piece.tokens:
                self.waiting.append(piece)
        self.fill()

    def fill(self) -> None:
        waiting = sorted(self.waiting, key=lambda p: -p.tokens)
        weight = np.array([(p.tokens, 1, p.loss) for p in waiting], np.float64).reshape(-1, 3)
        sides = np.ascontiguousarray(weight.T)
        here = np.ones(len(waiting), bool)
        shares = self.limits.shares()
        total, first = int(weight[:, 0].sum()), 0
        while total >= self.limits.tokens:
            left = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], np.float64)
            taken: list[Piece] = []
            while left[0] >= 1 and left[1] >= 1:
                while first < len(here) and not here[first]:
                    first += 1
                fits = here[first:].copy()
                for side, most in zip(sides, left):
                    fits &= side[first:] <= most
                if fits.any():
                    gain = weight[first:] @ (left * shares * shares)
                    at = first + int(np.argmax(np.where(fits, gain, -1.0)))
                    taken.append(waiting[at])
                    here[at] = False
                    left -= weight[at]
                    continue
                if first == len(here):
                    break
                piece = waiting[first]
                n = piece.head(int(left[0]), int(left[2]))
                if not n:
                    break
                taken.append(Piece(piece.example, piece.start, piece.start + n))
                rest = Piece(piece.example, piece.start + n, piece.end)
                left -= np.array([n, 1, taken[-1].loss])
                waiting[first], weight[first] = rest, (rest.tokens, 1, rest.loss)
                sides[:, first] = weight[first]
            total -= sum(p.tokens for p in taken)
            self.close(taken)
        self.waiting = [p for p, h in zip(waiting, here) if h]

    def finish(self) -> None:
        """Cuts what waits into sequences of powers of two."""
        while self.waiting:
            total = sum(p.tokens for p in self.waiting)
            left = [1 << (total.bit_length() - 1), self.limits.segments, self.limits.loss]
            left[0] = min(left[0], self.limits.tokens)
            taken: list[Piece] = []
            while self.waiting and left[0] and left[1]:
                piece = self.waiting[0]
                n = piece.head(left[0], left[2])
                if not n:
                    break
                taken.append(Piece(piece.example, piece.start, piece.start + n))
                left = [left[0] - n, left[1] - 1, left[2] - taken[-1].loss]
                self.waiting[0] = Piece(piece.example, piece.start + n, piece.end)
                if not self.waiting[0].tokens:
                    self.waiting.pop(0)
            self.close(taken)

    def flush(self, base: int, with_ids: bool) -> pa.RecordBatch:
        rows, self.done = self.done, []
        out = [[], [], [], [], [], [], [], [], []]
        ids = []
        for piece, number, offset, segment in rows:
            own = np.ascontiguousarray(piece.example.ids[piece.start:piece.end], "<i4")
            values = (piece.example.doc_id, piece.start, piece.tokens,
                      zlib.crc32(own), len(piece.example.ids),
                      base + number, offset, segment, piece.loss)
            for column, value in zip(out, values):
                column.append(value)
            if with_ids:
                ids.append(own)
        arrays = [pa.array(c, pa.int32() if n == 7 else pa.int64()) for n, c in enumerate(out)]
        names = [p.split()[0] for p in PIECE.split(", ")]
        if with_ids:
            ends = np.cumsum([0, *map(len, ids)])
            arrays.append(pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate([_NO_IDS, *ids]))))
            names.append("ids")
        return pa.record_batch(arrays, names=names)


def pack_examples(examples: Callable[[pa.RecordBatch], list[Example]], limits: Limits,
                  with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits)
        base = TaskContext.get().partitionId() << 32
        new: list[Example] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, POOL - len(new))
                at += part.num_rows
                new += examples(part)
                if len(new) == POOL:
                    packer.add(new)
                    new = []
                    yield packer.flush(base, with_ids)
        packer.add(new)
        packer.finish()
        yield packer.flush(base, with_ids)

    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), with_ids: bool = True,
                   path: str | None = None) -> DataFrame:
    """One row per piece of each document of (doc_id, text), with its ids if asked for.

    A document's first token bears no loss, as nothing comes before it. ``path`` names the
    tokenizer file on the executors; by default they look up the public one.
    """
    def examples(batch: pa.RecordBatch) -> list[Example]:
        file = path or tokenizer_path()
        if file not in _caches:
            _caches[file] = TokenCache(file)
        encoded = _caches[file].encode(batch.column(1).to_pylist())
        return [Example(doc_id, np.append(ids, np.int32(END_ID)))
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoded)]

    return docs.select("doc_id", "text").mapInArrow(
        pack_examples(examples, limits, with_ids), PIECE + ", ids array<int>" * with_ids)


def pack_instructions(tokens: DataFrame, limits: Limits = Limits(), with_ids: bool = True
                      ) -> DataFrame:
    """The same for (doc_id, ids, loss_from): token ids, and where the answer begins."""
    def examples(batch: pa.RecordBatch) -> list[Example]:
        return [Example(d, np.array(i or [], np.int32), 1 if f is None else f)
                for d, i, f in zip(*(c.to_pylist() for c in batch.columns))]

    return tokens.select("doc_id", "ids", "loss_from").mapInArrow(
        pack_examples(examples, limits, with_ids), PIECE + ", ids array<int>" * with_ids)
