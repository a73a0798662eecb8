"""Packing of token pieces into sequences under several limits at once.

Vector bin packing: a piece demands tokens, one segment and loss-bearing tokens; a sequence offers ``Limits`` of each.
The open sequence takes, again and again, the waiting piece whose demand has the largest dot product with what is left
(both as shares of the limits) among those that fit. Where pieces may be cut, a piece that no longer fits whole fills the
rest and its remainder waits on. Packing is local to a partition, over a bounded pool of waiting pieces, so that it needs
no shuffle; sequence ids carry the partition in their upper bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import crc_of, default_tokenizer, encoder_of, in_rows

#: Waiting pieces among which the heuristic chooses.
POOL = 1024
#: Bits of a sequence id that count within a partition.
LOCAL_BITS = 40


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; by default its tokens alone bind."""

    tokens: int = 2048
    segments: int = 2048
    loss_tokens: int = 2048


class Packer:
    """Feeds on (key, tokens, loss tokens) and yields (key, start, length, sequence, offset), a sequence's rows once it is closed.

    Without ``cut`` a piece longer than a sequence, or with more loss-bearing tokens than one may have, raises ValueError.
    With it, loss-bearing tokens must be all or none of a piece, so that every part's share is known; and what is left for
    the last sequence is cut into sequences of powers of two, which need no padding.
    """

    def __init__(self, limits: Limits, cut: bool, pool: int = POOL):
        self.limits, self.cut = limits, cut
        self.shares = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.demand = np.zeros((pool, 3))
        self.start = np.zeros(pool, np.int64)
        self.keys: list = [None] * pool
        self.free = list(range(pool))[::-1]
        self.issued, self.left = 0, self.shares.copy()
        self.open: list[tuple] = []

    def issue(self) -> int:
        """The number of a new sequence."""
        self.issued += 1
        return self.issued - 1

    def _close(self) -> Iterator[tuple]:
        """The rows of the open sequence, which is then empty again."""
        if self.open:
            sequence, offset = self.issue(), 0
            for key, start, tokens in self.open:
                yield key, start, tokens, sequence, offset
                offset += tokens
        self.open, self.left = [], self.shares.copy()

    def _place(self, i: int, tokens: int) -> None:
        loss = self.demand[i, 2] if tokens == self.demand[i, 0] else tokens if self.demand[i, 2] else 0
        self.open.append((self.keys[i], int(self.start[i]), tokens))
        self.left -= (tokens, 1, loss)
        self.start[i] += tokens
        self.demand[i] -= (tokens, 0, loss)
        if self.demand[i, 0] == 0:
            self.demand[i] = 0
            self.keys[i] = None
            self.free.append(i)

    def _step(self) -> Iterator[tuple]:
        """Places one waiting piece, or part of one, or closes the open sequence."""
        fits = (self.demand[:, 0] > 0) & (self.demand <= self.left).all(axis=1)
        if fits.any():
            score = np.where(fits, (self.demand / self.shares) @ (self.left / self.shares), -1)
            i = int(score.argmax())
            self._place(i, int(self.demand[i, 0]))
        elif self.cut and min(self.left) >= 1:
            i = int(self.demand[:, 0].argmax())
            self._place(i, int(min(self.left[0], self.left[2]) if self.demand[i, 2] else self.left[0]))
        else:
            yield from self._close()
        if self.left[0] <= 0 or self.left[1] <= 0:
            yield from self._close()

    def feed(self, key, tokens: int, loss: int) -> Iterator[tuple]:
        if tokens <= 0:
            return
        if not self.cut and (tokens > self.limits.tokens or loss > self.limits.loss_tokens):
            raise ValueError(f"a piece of {tokens} tokens, {loss} with loss, fits in no sequence")
        if self.cut and loss not in (0, tokens):
            raise ValueError("a piece that may be cut bears loss on all of its tokens or on none")
        while not self.free:
            yield from self._step()
        i = self.free.pop()
        self.keys[i], self.start[i], self.demand[i] = key, 0, (tokens, 1, loss)

    def rest(self) -> Iterator[tuple]:
        """What still waits, and what is open."""
        while (self.demand[:, 0] > 0).any():
            yield from self._step()
        total, pieces = sum(x[2] for x in self.open), self.open[::-1]
        if self.cut and total < self.limits.tokens:
            self.open = []
            for power in [1 << i for i in reversed(range(total.bit_length())) if total >> i & 1]:
                while power:
                    key, start, tokens = pieces.pop()
                    part = min(tokens, power)
                    self.open.append((key, start, part))
                    if part < tokens:
                        pieces.append((key, start + part, tokens - part))
                    power -= part
                yield from self._close()
        yield from self._close()


def pack_pieces(pieces: DataFrame, limits: Limits = Limits(), pool: int = POOL) -> DataFrame:
    """Whole examples (``key``, ``tokens``, ``loss_tokens``) into sequences: adds ``sequence_id`` and ``offset``.

    For instruction data: an example is never cut; its loss-bearing tokens are those of the answers. Null or no tokens:
    the example takes no place and gets no row. Other columns are ignored.
    """
    from pyspark import TaskContext

    kind = pieces.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, high = Packer(limits, cut=False, pool=pool), TaskContext.get().partitionId() << LOCAL_BITS

        def given(rows: list[tuple], like: pa.Field) -> pa.RecordBatch:
            keys, _, length, sequence, offset = zip(*rows, strict=True)
            keys, loss = zip(*keys, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, like.type), pa.array(length, pa.int64()), pa.array(loss, pa.int64()), pa.array([high + x for x in sequence], pa.int64()), pa.array(offset, pa.int64())], ["key", "tokens", "loss_tokens", "sequence_id", "offset"])

        field = None
        for batch in batches:
            field = batch.schema.field("key")
            rows: list[tuple] = []
            for r in batch.to_pylist():
                rows += packer.feed((r["key"], r["loss_tokens"]), r["tokens"], r["loss_tokens"])
            if rows:
                yield given(rows, field)
        if rows := list(packer.rest()):
            yield given(rows, field)

    own = pieces.select("key", F.coalesce(F.col("tokens").cast("long"), F.lit(0)).alias("tokens"), F.coalesce(F.col("loss_tokens").cast("long"), F.lit(0)).alias("loss_tokens"))
    return own.mapInArrow(run, f"key {kind}, tokens long, loss_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, limits: Limits = Limits(), end_id: int = 1, tokenizer: str | None = None, with_ids: bool = False, pool: int = POOL) -> DataFrame:
    """Documents, cut freely, into sequences: one row per piece.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), with ``with_ids`` also the ids themselves. All
    tokens of a document bear loss. Runs of a whole sequence's length go straight into sequences of their own; the
    remainders go through the heuristic. A null text is empty: the end id alone. Rows that repeat are packed as often.
    An empty table gives no rows; other columns are ignored.
    """
    from pyspark import TaskContext

    path = tokenizer or default_tokenizer()
    most = min(limits.tokens, limits.loss_tokens)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    own = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, high = encoder_of(path), Packer(limits, cut=True, pool=pool), TaskContext.get().partitionId() << LOCAL_BITS
        out: list[tuple] = []

        def place(rows) -> None:
            for (doc_id, ids, before), start, length, sequence, offset in rows:
                part = ids[start : start + length]
                out.append((doc_id, before + start, length, crc_of(part), before + len(ids), high + sequence, offset) + ((part,) if with_ids else ()))

        def given(like: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array(x, like if i == 0 else pa.int64()) for i, x in enumerate(list(zip(*out, strict=True))[:7])]
            if with_ids:
                ends = np.cumsum([0, *(len(x[7]) for x in out)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([x[7] for x in out]).astype(np.int32))))
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        like = pa.int64()
        for batch in in_rows(batches):
            like = batch.schema.field("doc_id").type
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), encoder(batch.column("text").to_pylist(), end_id), strict=True):
                ids, at = np.frombuffer(blob, encoder.width), 0
                while len(ids) - at >= most:
                    part = ids[at : at + most]
                    out.append((doc_id, at, most, crc_of(part), len(ids), high + packer.issue(), 0) + ((part,) if with_ids else ()))
                    at += most
                place(packer.feed((doc_id, ids[at:], at), len(ids) - at, len(ids) - at))
            if out:
                yield given(like)
        place(packer.rest())
        if out:
            yield given(like)

    return own.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids)


#: Turns of a conversation that make one example.
TURNS = 16


def conversation_examples(turns: DataFrame, limits: Limits, end_id: int = 1, tokenizer: str | None = None, block: int = TURNS) -> DataFrame:
    """(key, tokens, loss_tokens) from (conv_id, turn, role, text): instruction examples, each so many turns of a conversation.

    A turn has the tokens of its text and the end id; those of the assistant's turns bear loss. Counts are summed before and
    after one shuffle, so that a conversation of any length is no burden. ``key`` is (conv_id, block, part): an example that
    no sequence holds is cut in parts, of which each counts as bearing as much loss as it can. A null text is empty, a null
    turn makes a block of its own, a null role bears no loss; repeated turns count as often; other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    own = turns.select("conv_id", F.floor(F.col("turn") / block).alias("block"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("loss"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in in_rows(batches):
            n = [len(x) // encoder.width.itemsize for x in encoder(batch.column("text").to_pylist(), end_id)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "block", "loss")), pa.array(n, pa.int64())], ["conv_id", "block", "loss", "n"])

    kind = own.schema["conv_id"].dataType.simpleString()
    counted = own.mapInArrow(run, f"conv_id {kind}, block long, loss boolean, n long")
    summed = counted.groupBy("conv_id", "block").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("loss"), F.col("n"))), F.lit(0)).alias("m"))
    fits, most = (F.col("n") <= limits.tokens) & (F.col("m") <= limits.loss_tokens), min(limits.tokens, limits.loss_tokens)
    parts = F.when(fits, F.array(F.struct(F.lit(0).cast("long").alias("part"), F.col("n").alias("tokens"), F.col("m").alias("loss_tokens")))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most)), lambda k: F.struct(k.alias("part"), F.least(F.lit(most), F.col("n") - k * most).alias("tokens"), F.least(F.lit(most), F.col("n") - k * most, F.col("m")).alias("loss_tokens")))
    )
    each = summed.select("conv_id", "block", F.explode(parts).alias("p"))
    return each.select(F.struct("conv_id", "block", "p.part").alias("key"), "p.tokens", "p.loss_tokens")


def pack_conversations(turns: DataFrame, limits: Limits = Limits(2048, 16, 1024), end_id: int = 1, tokenizer: str | None = None, pool: int = POOL) -> DataFrame:
    """The examples of ``conversation_examples`` in sequences: (conv_id, block, part, tokens, loss_tokens, sequence_id, offset)."""
    packed = pack_pieces(conversation_examples(turns, limits, end_id, tokenizer), limits, pool)
    return packed.select("key.*", "tokens", "loss_tokens", "sequence_id", "offset")
