"""Token ids by the tokenizers library, and files of them.

Format, one trio of files per partition, ``part-00000`` upwards in ascending document order:

* ``.bin``: the ids of its documents one after another, flat, little-endian, of 16 bits where the vocabulary allows, else 32;
* ``.idx``: n + 1 unsigned 64-bit little-endian offsets, counted in ids from the start of the *whole* corpus;
* ``.doc``: the document ids, an Arrow file with the column ``doc_id``.

``.bin`` and ``.idx`` are made for ``numpy.memmap``. A partition's base is the prefix sum of the id counts before it.

A text is encoded as ``Tokenizer.encode(text, add_special_tokens=False)`` does: a special token's name in it, such as
``<|endoftext|>``, gets the token's own id. With ``special_as_text`` it is encoded as the characters it is written with, so
that no text can forge the end of a document.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_dir, staged

#: Between two characters that are no white space a space always begins a new piece of byte-level BPE, so that what lies
#: between two such spaces is encoded alike wherever it stands.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: All white space but the space; where none of it, nor a second space, is beside a space, a plain split does the same.
_WHITE = [chr(x) for x in (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Most of what lies there is letters, then marks, then perhaps both again on the next line; BPE never joins these parts.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ſ", r"!-&(-/:-@\[-`{-~"
_PARTS = re.compile(f"( ?[{_LETTERS}]+)([{_MARKS}]+)?(?:(\n)([{_LETTERS}]+)([{_MARKS}]+)?)?").fullmatch
#: Pieces a worker remembers, the longest of them, and those that stay when there are too many: the first met, so the commonest.
#: A piece takes about 200 bytes.
REMEMBERED, LONGEST, KEPT = 200_000, 48, 100_000
#: Rows of which a worker holds the ids at a time.
ROWS = 512


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable ones stand for themselves, the others come after 255 in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in printable]
    return {x: chr(x) for x in printable} | {x: chr(256 + i) for i, x in enumerate(others)}


def _cut(text: str) -> list[str]:
    """A text cut at its single spaces, which begin all pieces but the first and are left out."""
    if "  " in text or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _WHITE):
        return _CUT.split(text)
    return text.split(" ")


class Encoder:
    """Byte-level BPE of whole texts, equal to ``Tokenizer.encode``; pieces between single spaces are remembered."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # texts that hold the name of an added token go through the library whole
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and x.special)]
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        #: each id's bytes
        self.bytes = [struct.pack(f"<{self.code}", x) for x in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.space = self.letters[ord(" ")]
        self.ends = {x: self._piece(x) for x in ".,;:!?"}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _letters(self, letters: str) -> bytes:
        """The ids of what BPE never joins to anything else, in byte-level letters."""
        each = self.bytes
        return b"".join([each[x.id] for x in self.model.tokenize(letters)])

    def _part(self, part: str) -> bytes:
        if (found := self.parts.get(part)) is None:
            found = self._letters(part.encode().decode("latin-1").translate(self.letters))
            if len(part) <= LONGEST:
                self.parts[part] = found
        return found

    def _piece(self, piece: str) -> bytes:
        if m := _PARTS(piece):
            return b"".join([self._part(x) for x in m.groups() if x])
        return self._packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _spaced(self, x: str) -> bytes:
        """A space and a piece that is not remembered. Plain letters, with or without a mark at their end, take a short way."""
        if x.isascii():
            if x.isalpha():
                return self._letters(self.space + x)
            if (end := self.ends.get(x[-1:])) is not None and (stem := x[:-1]).isalpha():
                if (blob := self.known.get(stem)) is None:
                    blob = self._letters(self.space + stem)
                    if len(stem) <= LONGEST:
                        self.known[stem] = blob
                return blob + end
        return self._piece(" " + x)

    def __call__(self, texts: list[str], end_id: int) -> list[bytes]:
        """The ids of each text and ``end_id``, as little-endian bytes of ``width``."""
        end, known, out = self._packed([end_id]), self.known, []
        for memory in (known, self.parts):
            if len(memory) > REMEMBERED:
                first = dict(islice(memory.items(), KEPT))
                memory.clear()
                memory.update(first)
        look = known.get
        for text in texts:
            if any(x in text for x in self.added):
                out.append(self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids) + end)
                continue
            first, *rest = _cut(text)
            blobs = [self._piece(first)]
            blobs += map(look, rest)
            i = 0
            for _ in range(blobs.count(None)):
                i = blobs.index(None, i)
                x = rest[i - 1]
                blobs[i] = blob = self._spaced(x)
                if len(x) <= LONGEST:
                    known[x] = blob
            blobs.append(end)
            out.append(b"".join(blobs))
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder_of(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder per worker process and way, kept from task to task."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def in_rows(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system for a path with or without a scheme, and the path on it."""
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (pafs.LocalFileSystem(), os.path.abspath(path))


def put(fs: pafs.FileSystem, path: str, parts: Iterator[bytes]) -> None:
    """Written under a name of this attempt's own, then moved: a retried task leaves whole files only."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(temporary) as out:
            for x in parts:
                out.write(x)
        fs.move(temporary, path)
    except BaseException:
        if fs.get_file_info(temporary).type == pafs.FileType.File:
            fs.delete_file(temporary)
        raise


def write_tokens(docs: DataFrame, folder: str, end_id: int = 2, tokenizer: str | None = None, partitions: int | None = None, text: str = "text", doc_id: str = "doc_id", special_as_text: bool = False) -> DataFrame:
    """Writes the ids of all documents below ``folder`` in ascending order of ``doc_id``; returns (part, n_docs, n_ids, base, width).

    Null ids come first; equal ids go by text. A null text is empty and has the end id alone. Rows that repeat are
    written as often; other columns are ignored. An empty table has no files and no rows.
    """
    from pyspark import TaskContext

    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = partitions or max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # many ids can be equal, so that the text's hash helps to cut evenly
    ordered = docs.withColumn("_h", F.xxhash64("text")).repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "_h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", "text").drop("_h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(path, special_as_text), TaskContext.get().partitionId()
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        counts: list[np.ndarray] = []
        names: list[pa.Array] = []

        def encoded() -> Iterator[bytes]:
            for batch in in_rows(batches):
                blobs = encoder(batch.column("text").to_pylist(), end_id)
                counts.append(np.array([len(x) for x in blobs], "<u8") // encoder.width.itemsize)
                names.append(batch.column("doc_id"))
                yield b"".join(blobs)

        name = f"{base}/part-{part:05d}"
        put(fs, f"{name}.bin", encoded())
        if not names:
            fs.delete_file(f"{name}.bin")
            return
        lengths = np.concatenate(counts)
        table = pa.table({"doc_id": pa.chunked_array(names)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.schema) as out:
            out.write_table(table)
        put(fs, f"{name}.doc", iter([sink.getvalue()]))
        put(fs, f"{name}.len", iter([lengths.astype("<u8").tobytes()]))
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [len(lengths)], "n_ids": [int(lengths.sum())], "width": [encoder.width.itemsize]})

    parts = staged(ordered.mapInArrow(write, "part long, n_docs long, n_ids long, width long"), folder, "parts")
    base = 0
    rows = []
    for r in sorted(parts.collect()):  # one row per partition
        rows.append((r["part"], r["n_docs"], r["n_ids"], base, r["width"]))
        base += r["n_ids"]
    schema = "part long, n_docs long, n_ids long, base long, width long"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = file_system(folder)
        for batch in batches:
            for r in batch.to_pylist():
                name = f"{where}/part-{r['part']:05d}"
                with fs.open_input_stream(f"{name}.len") as f:
                    lengths = np.frombuffer(f.read(), "<u8")
                put(fs, f"{name}.idx", iter([(np.concatenate([[0], np.cumsum(lengths)]) + r["base"]).astype("<u8").tobytes()]))
            yield batch

    if not rows:
        return spark.createDataFrame([], schema)
    return staged(spark.createDataFrame(rows, schema).repartition(len(rows), "part").mapInArrow(index, schema), folder, "bases")


def read_tokens(parts: DataFrame, folder: str, kind: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that ``parts`` lists; ids are of the type ``kind``, their own."""
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = file_system(folder)
        for batch in batches:
            for r in batch.to_pylist():
                name, width = f"{where}/part-{r['part']:05d}", np.dtype(f"<u{r['width']}")
                if isinstance(fs, pafs.LocalFileSystem):
                    ids, at = np.memmap(f"{name}.bin", width, "r"), np.memmap(f"{name}.idx", "<u8", "r")
                    names = pa.ipc.open_file(pa.memory_map(f"{name}.doc")).read_all()
                else:
                    ids, at = (np.frombuffer(fs.open_input_file(f"{name}{x}").read(), t) for x, t in ((".bin", width), (".idx", "<u8")))
                    names = pa.ipc.open_file(fs.open_input_file(f"{name}.doc")).read_all()
                names, base = names.column("doc_id").combine_chunks(), int(at[0])
                for i in range(0, len(names), 4096):
                    a = at[i : i + 4097].astype(np.int64)
                    crc = [crc_of(ids[s - base : e - base]) for s, e in zip(a[:-1].tolist(), a[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict({"doc_id": names.slice(i, 4096), "start": a[:-1], "n_tokens": np.diff(a), "ids_crc32": pa.array(crc, pa.int64())})

    n = max(1, parts.count())
    return parts.repartition(n, "part").mapInArrow(read, schema)


def token_files(docs: DataFrame, end_id: int = 2, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """Writes the files into a new shared folder (or ``folder``) and reads them back: one row per document.

    A null or empty text has the end id alone; equal ids go by text, repeated rows come out as often as they went in, an
    empty table gives no files and no rows; other columns are ignored.
    """
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens"
    return read_tokens(write_tokens(docs, folder, end_id, tokenizer), folder, docs.schema["doc_id"].dataType.simpleString())
