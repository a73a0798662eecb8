"""Substring dedup: words covered by a window that occurs more than once are removed.

1. Every task hashes the windows of its texts and sends, for each batch of texts, a sparse count-min sketch of them: for each
   of its rows the cells that it hit, sorted, as coded gaps, at most twice each. The sketches are merged shard by shard of
   the cells, and each batch gets back one bit per cell that it hit: whether the merged count is two or more. A window whose
   least count is one occurs once, for certain.
2. A second pass looks only at windows estimated repeated. A window met twice within a batch of texts is repeated; the batch
   settles that itself and sends one witness. All others go into an exact grouping. Here and there a window is named by 128
   bits of BLAKE2b over its words, not by the sketch's hash, so that windows count as equal only if their words are. No group
   gets more entries than there are batches, however common its window. What a batch sends to a shard of the hashes is one row of
   plain arrays, with the keys of the documents concerned, so that a row stands for itself whatever task is run again.
3. The places of repeated windows return by batch to their documents, which drop the covered words.

The sketch is never in one place, so that it can grow with the corpus. Should a task of the second pass meet other batches
than that of the first one had, because its input came in another order, it takes all their windows as perhaps repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import SPACED, Hasher, Joined, U, chunks, joined, string_array, words_of
from .shared import row_key, shared_dir
from .tokens import file_system

WINDOW = 35
#: The sketch has DEPTH rows, each of at least CELLS cells for an expected window; a word takes about WORD_BYTES.
DEPTH, CELLS, WORD_BYTES = 2, 3, 6
#: Cells of a shard of a sketch row at most, a byte each while the shard is merged.
LOG_SHARD = 24
#: Words of the texts of a batch.
BATCH_WORDS = 2_000_000
#: Places that a batch has settled go in rows of so many, dealt over the tasks.
SETTLED_ROW = 1 << 15


def encode_gaps(cells: np.ndarray) -> bytes:
    """Sorted numbers as Golomb-Rice coded gaps: the lower bits of all, then what is above them in unary."""
    gaps = np.diff(cells, prepend=0)
    low = max(0, int(0.69 * gaps.mean()).bit_length() - 1) if len(gaps) else 0
    ends = np.cumsum((gaps >> low) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    lower = (gaps[:, None] >> np.arange(low) & 1).astype(np.uint8)
    return np.array([len(gaps), low], "<u4").tobytes() + np.packbits(lower).tobytes() + np.packbits(unary).tobytes()


def decode_gaps(blob: bytes) -> np.ndarray:
    n, low = np.frombuffer(blob, "<u4", 2).tolist()
    at = 8 + (n * low + 7) // 8
    lower = np.unpackbits(np.frombuffer(blob, np.uint8, at - 8, 8), count=n * low).reshape(n, low)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, -1, at)))[:n]
    gaps = np.diff(ends, prepend=-1) - 1 << low
    for i in range(low):
        gaps += lower[:, i].astype(np.int64) << i
    return np.cumsum(gaps)


@dataclass(frozen=True)
class Shape:
    """Rows of the sketch; shards of a row, and of the window hashes, as a power of two; cells of a shard."""

    depth: int
    log_shards: int
    shard_cells: int

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        """The cell of each window in a row, by its hash, for further rows by its multiples: upper bits shard, then place."""
        h = hashes if row == 0 else hashes * U(2 * row * 0x9E3779B97F4A7C15 + 1 & 0xFFFFFFFFFFFFFFFF)
        shard = (h >> U(64 - self.log_shards)).astype(np.int64) if self.log_shards else np.zeros(len(h), np.int64)
        place = ((h << U(self.log_shards)) >> U(32)) * U(self.shard_cells) >> U(32)
        return shard * self.shard_cells + place.astype(np.int64)

    def starts(self) -> np.ndarray:
        """The first cell of each shard, and the end."""
        return np.arange((1 << self.log_shards) + 1) * self.shard_cells


def choose_shape(text_bytes: int, partitions: int, depth: int = DEPTH, cells: int = CELLS) -> Shape:
    """Enough cells for the windows that so many bytes of text are likely to have, and several shards for a task."""
    total = max(1 << 16, cells * text_bytes // WORD_BYTES)
    log_shards = max((4 * partitions).bit_length(), (total - 1).bit_length() - LOG_SHARD)
    return Shape(depth, log_shards, -(-total >> log_shards) if total >> log_shards else 1)


@dataclass
class Batch:
    """Windows of consecutive texts: their hashes, which text each is of (numbered from 0), where it starts; keys of the texts.

    ``parts`` has, for as many windows in turn, the words they are of and which word each begins with.
    """

    number: int
    hashes: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    parts: list[tuple[Joined, np.ndarray]]

    @property
    def digest(self) -> int:
        """Tells batches of other windows, or as many in another order of texts, apart."""
        return int((self.hashes * (self.doc.astype(U) + U(1))).sum().view(np.int64)) if len(self.doc) else 0

    def digests(self, which: np.ndarray, window: int) -> np.ndarray:
        """The digests of some windows, by a mask over all, of their words."""
        out, at = [np.zeros((0, 2), U)], 0
        for words, first in self.parts:
            out.append(words.digests(first[which[at : at + len(first)]], window))
            at += len(first)
        return np.concatenate(out)


def _batches(rows: Iterator[pa.RecordBatch], window: int, with_words: bool) -> Iterator[Batch]:
    """The texts of a task in batches, cut alike in either pass; the words themselves only if asked."""
    hasher = Hasher(7)
    held: list[tuple] = []
    parts: list[tuple[Joined, np.ndarray]] = []
    docs = words = number = 0

    def whole() -> Batch:
        return Batch(number, *(np.concatenate(x) for x in zip(*held, strict=True)), parts)

    for batch in rows:
        keys = [batch.column(n).to_numpy() for n in ("_k1", "_k2")]
        for at, to, data, offsets in chunks(string_array(batch.column("text"))):
            classed = SPACED[data]
            found = words_of(classed, offsets)
            count = np.diff(found.first)
            some = np.flatnonzero(count >= window)
            lengths = count[some] - window + 1
            total = int(lengths.sum())
            doc = np.repeat(some, lengths)
            place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            starts = found.first[doc] + place
            hashes = hasher.runs(hasher.words(classed, found), window)[starts] if total else np.zeros(0, U)
            held.append((hashes, (doc + docs).astype(np.uint32), place.astype(np.uint32), *(k[at:to] for k in keys)))
            if with_words and total:
                parts.append((joined(classed, found), starts.astype(np.uint32)))
            docs += to - at
            words += int(found.first[-1])
            if words >= BATCH_WORDS:
                yield whole()
                held, parts, docs, words, number = [], [], 0, 0, number + 1
    if held:
        yield whole()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("_k1", "_k2", F.coalesce("text", F.lit("")).alias("text"))


def sketch(docs: DataFrame, shape: Shape, window: int = WINDOW) -> DataFrame:
    """(task, number, digest, shard, n, bits): for each batch and shard, of the n distinct cells hit there, in order, which count two or more in all.

    ``shard`` counts through all rows of the sketch. ``docs``: (_k1, _k2, text).
    """
    from pyspark import TaskContext

    def send(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for batch in _batches(rows, window, False):
            shards, blobs = [], []
            for row in range(shape.depth):
                cells = np.sort(shape.cells(batch.hashes, row))
                cells = cells[np.concatenate([[True, True], cells[2:] != cells[:-2]])[: len(cells)]]  # at most twice
                cuts = np.searchsorted(cells, shape.starts())
                for shard in np.flatnonzero(np.diff(cuts)).tolist():
                    shards.append(row << shape.log_shards | shard)
                    blobs.append(encode_gaps(cells[cuts[shard] : cuts[shard + 1]] - shard * shape.shard_cells))
            n = len(shards)
            yield pa.RecordBatch.from_arrays([pa.array([task] * n, pa.int32()), pa.array([batch.number] * n, pa.int32()), pa.array([batch.digest] * n, pa.int64()), pa.array(shards, pa.int32()), pa.array(blobs, pa.binary())], ["task", "number", "digest", "shard", "cells"])

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def answers() -> pa.RecordBatch:
            counts = np.zeros(shape.shard_cells, np.uint8)
            own = []
            for *_, blob in held:
                cells = decode_gaps(blob)
                again = np.concatenate([[False], cells[1:] == cells[:-1]])
                counts[cells] = np.minimum(counts[cells], 2) + 1
                counts[cells[again]] = 2
                own.append(cells[~again])
            tasks, numbers, digests, _ = zip(*held, strict=True)
            bits = [np.packbits(counts[x] >= 2).tobytes() for x in own]
            return pa.RecordBatch.from_arrays([pa.array(tasks, pa.int32()), pa.array(numbers, pa.int32()), pa.array(digests, pa.int64()), pa.array([current] * len(held), pa.int32()), pa.array(list(map(len, own)), pa.int32()), pa.array(bits, pa.binary())], ["task", "number", "digest", "shard", "n", "bits"])

        for batch in rows:
            for task, number, digest, shard, blob in zip(*(batch.column(n).to_pylist() for n in ("task", "number", "digest", "shard", "cells")), strict=True):
                if shard != current:
                    if held:
                        yield answers()
                    current, held = shard, []
                held.append((task, number, digest, blob))
        if held:
            yield answers()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = _keyed(docs).mapInArrow(send, "task int, number int, digest long, shard int, cells binary")
    return sent.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(merge, "task int, number int, digest long, shard int, n int, bits binary")


def _answers(folder: str, task: int) -> dict[tuple[int, int, int], tuple[int, bytes]]:
    """A task's answers by (batch, its digest, shard); none if the folder has none."""
    import pyarrow.parquet as pq

    fs, path = file_system(f"{folder}/task={task}")
    if fs.get_file_info(path).type != pafs.FileType.Directory:
        return {}
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")]
    rows = [pq.read_table(f, filesystem=fs, columns=["number", "digest", "shard", "n", "bits"], partitioning=None).to_pylist() for f in files]
    return {(r["number"], r["digest"], r["shard"]): (r["n"], r["bits"]) for x in rows for r in x}


def _estimated(batch: Batch, shape: Shape, answers: dict) -> np.ndarray:
    """Which windows of a batch may be repeated."""
    maybe, digest = np.ones(len(batch.doc), bool), batch.digest
    for row in range(shape.depth):
        cells, back = np.unique(shape.cells(batch.hashes, row), return_inverse=True)
        cuts = np.searchsorted(cells, shape.starts())
        bits = np.ones(len(cells), bool)
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            n, said = answers.get((batch.number, digest, row << shape.log_shards | shard), (-1, b""))
            if n == cuts[shard + 1] - cuts[shard]:
                bits[cuts[shard] : cuts[shard + 1]] = np.unpackbits(np.frombuffer(said, np.uint8), count=n)
        maybe &= bits[back]
    return maybe


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one blob; unsigned 32-bit ones with small numbers take 16 bits."""
    small = [x.dtype == np.uint32 and (not len(x) or int(x.max()) < 1 << 16) for x in arrays]
    arrays = [x.astype(np.uint16) if s else x for x, s in zip(arrays, small, strict=True)]
    head = np.array([n for x, s in zip(arrays, small, strict=True) for n in (len(x), s)], "<u4")
    return b"".join([head.tobytes(), *(np.ascontiguousarray(x).tobytes() for x in arrays)])


def _unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    head, out, at = np.frombuffer(blob, "<u4", 2 * len(kinds)).tolist(), [], 8 * len(kinds)
    for kind, n, s in zip(kinds, head[::2], head[1::2], strict=True):
        kind = np.dtype(np.uint16 if s else kind)
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * kind.itemsize
    return out


#: Keys of documents, which of them each entry is of, where it starts; for pending ones their digests, and those of witnesses.
_PLACES = [np.int64, np.int64, np.uint32, np.uint32]
_PENDING = [*_PLACES, *[np.uint64] * 4]


def _places(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Only the keys of documents that entries are of, and those numbered anew."""
    used, doc = np.unique(doc, return_inverse=True)
    return [k1[used], k2[used], doc.astype(np.uint32), place.astype(np.uint32)]


def _same(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by digest, and in it how often each entry's digest occurs."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    times = np.diff(np.concatenate([np.flatnonzero(new), [len(a)]]))
    return order, np.repeat(times, times)


def _look(docs: DataFrame, folder: str, shape: Shape, window: int) -> DataFrame:
    """(shard, batch, settled, blob): what each batch of texts has settled, and what it asks of the shards."""
    from pyspark import TaskContext

    def asked(b: Batch, maybe: np.ndarray, task: int) -> pa.RecordBatch:
        (one, two), doc, place, rows, batch = b.digests(maybe, window).T, b.doc[maybe], b.place[maybe], [], task << 32 | b.number
        order, times = _same(one, two)
        one, two, doc, place = one[order], two[order], doc[order], place[order]
        first = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        settled = np.flatnonzero(times > 1)
        settled = settled[np.lexsort((place[settled], doc[settled]))]
        for i in range(0, len(settled), SETTLED_ROW):
            some = settled[i : i + SETTLED_ROW]
            rows.append(((batch + i // SETTLED_ROW * 7919) % (1 << shape.log_shards), batch, True, _pack(_places(b.k1, b.k2, doc[some], place[some]))))
        parts = []
        for mask in (times == 1, first & (times > 1)):
            i = np.flatnonzero(mask)
            parts.append((i, np.searchsorted((one[i] >> U(64 - shape.log_shards)).astype(np.int64), np.arange((1 << shape.log_shards) + 1))))
        (alone, cuts), (witness, marks) = parts
        for shard in np.flatnonzero(np.diff(cuts) + np.diff(marks)).tolist():
            i, w = alone[cuts[shard] : cuts[shard + 1]], witness[marks[shard] : marks[shard + 1]]
            rows.append((shard, batch, False, _pack([*_places(b.k1, b.k2, doc[i], place[i]), one[i], two[i], one[w], two[w]])))
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], ["shard", "batch", "settled", "blob"])

    def look(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, answers = TaskContext.get().partitionId(), None
        for batch in _batches(rows, window, True):
            if answers is None:
                answers = _answers(folder, task)
            maybe = _estimated(batch, shape, answers)
            if maybe.any():
                yield asked(batch, maybe, task)

    return _keyed(docs).mapInArrow(look, "shard int, batch long, settled boolean, blob binary")


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the rows of whole shards, one after another: (batch, blob) with the places of repeated windows, by their digests."""
    shard, held = None, []

    def answered() -> Iterator[pa.RecordBatch]:
        asked = [_unpack(blob, _PENDING) for _, blob in held]
        one, two = (np.concatenate([x[i] for x in asked] + [x[i + 2] for x in asked]) for i in (4, 5))
        if not len(one):
            return
        order, times = _same(one, two)
        again = np.empty(len(one), bool)
        again[order] = times > 1
        at, ids, out = 0, [], []
        for (batch, _), (k1, k2, doc, place, *_rest) in zip(held, asked, strict=True):
            mine = again[at : at + len(doc)]
            at += len(doc)
            if mine.any():
                ids.append(batch)
                out.append(_pack(_places(k1, k2, doc[mine], place[mine])))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["batch", "blob"])

    for rows in batches:
        for s, batch, settled, blob in zip(*(rows.column(n).to_pylist() for n in ("shard", "batch", "settled", "blob")), strict=True):
            if settled:
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([blob], pa.binary())], ["batch", "blob"])
                continue
            if s != shard:
                if held:
                    yield from answered()
                shard, held = s, []
            held.append((batch, blob))
    if held:
        yield from answered()


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the answers to whole batches, one after another: (_k1, _k2, starts) per document."""
    current, held = None, []

    def gathered() -> pa.RecordBatch:
        found = [_unpack(blob, _PLACES) for blob in held]
        k1, k2 = (np.concatenate([x[i][x[2]] for x in found]) for i in (0, 1))
        place = np.concatenate([x[3] for x in found]).astype(np.int32)
        order = np.lexsort((place, k2, k1))
        k1, k2, place = k1[order], k2[order], place[order]
        starts = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(k1)).astype(np.int32)), pa.array(place))
        return pa.RecordBatch.from_arrays([pa.array(k1[starts]), pa.array(k2[starts]), lists], ["_k1", "_k2", "starts"])

    for rows in batches:
        for batch, blob in zip(rows.column("batch").to_pylist(), rows.column("blob").to_pylist(), strict=True):
            if batch != current:
                if held:
                    yield gathered()
                current, held = batch, []
            held.append(blob)
    if held:
        yield gathered()


def repeated_windows(docs: DataFrame, window: int = WINDOW, shape: Shape | None = None) -> DataFrame:
    """(_k1, _k2, starts): for documents that have any, the sorted places of their repeated windows, words counted from 0.

    ``docs``: (_k1, _k2, text). Rows with equal keys hold the same text, and count as often as they occur. ``shape`` is
    chosen by the bytes of text if not given; it has no influence on the result.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if shape is None:
        shape = choose_shape(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, n)
    folder = f"{shared_dir(spark)}/substrings"
    sketch(docs, shape, window).repartition(n, "task").sortWithinPartitions("task", "number").write.partitionBy("task").parquet(folder)
    asked = _look(docs, folder, shape, window).repartition(n, "shard").sortWithinPartitions("settled", "shard")
    found = asked.mapInArrow(_answer, "batch long, blob binary").repartition(n, "batch").sortWithinPartitions("batch").mapInArrow(_gather, "_k1 long, _k2 long, starts array<int>")
    # a text that occurs in several batches has an answer from each
    return found.groupBy("_k1", "_k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, shape: Shape | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, n_words, n_removed, kept): its words that no repeated window covers, joined by spaces.

    Words are runs of characters other than ASCII white space. A window of ``window`` words counts as repeated if it starts
    anywhere else too, in this text or another; all are judged on the input. A null text has no words; one of fewer than
    ``window`` words keeps them all. Rows that repeat are copies of one another. Other columns are ignored. Windows are equal
    if 128 bits of BLAKE2b over their words are.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.select("doc_id", "text", *row_key(F.col("doc_id"), F.col("text")))
    starts = repeated_windows(docs.select("_k1", "_k2", "text"), window, shape)
    met = docs.join(starts, ["_k1", "_k2"], "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("starts")
            total, removed, kept = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words, at = text.encode().split(), starts[i]
                gone = np.zeros(len(words) + 1, np.int32)
                if at.is_valid:
                    places = at.values.to_numpy()
                    np.add.at(gone, places, 1)
                    np.add.at(gone, places + window, -1)
                covered = np.cumsum(gone)[:-1] > 0
                total.append(len(words))
                removed.append(int(covered.sum()))
                kept.append(b" ".join([w for w, c in zip(words, covered.tolist(), strict=True) if not c] if removed[-1] else words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")
