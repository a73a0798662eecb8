"""Words of many texts at once, hashes and digests of runs of them, by array operations on their bytes.

The hashes are quick and nominate: equal runs have equal hashes, but who knows the bases can make other runs that collide.
What is to count as equal is held against a digest of the words themselves, 128 bits of BLAKE2b.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; one longer text is worked on alone.
CHUNK = 1 << 20

U = np.uint64
#: Stands for a separator among classed bytes; no UTF-8 text has such a byte.
SEPARATOR = 0xFF


def _byte_class(separators: bytes, lower: bool) -> np.ndarray:
    """256 byte values: ``SEPARATOR`` for a separator, else the byte, A-Z in lower case if asked."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = SEPARATOR
    return table


#: Words between ASCII white space, unchanged.
SPACED = _byte_class(bytes([0x20, *range(0x09, 0x0E)]), lower=False)
#: Words of ASCII letters, digits and all beyond ASCII, A-Z in lower case.
PLAIN = _byte_class(bytes(x for x in range(128) if not chr(x).isalnum()), lower=True)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))


@dataclass
class Words:
    """Words of consecutive texts: text k has words first[k] to first[k + 1]."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


class Hasher:
    """Hash of a byte run as a polynomial in an odd base; a run's is the difference of two prefix sums, moved to place 0."""

    def __init__(self, salt: int):
        self.values = seeds(256, 2 * salt)
        self.base = int(seeds(1, 2 * salt + 1)[0]) | 1
        self.back = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, U)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(CHUNK + 64, n)
            self.up, self.down = (np.concatenate([[U(1)], np.cumprod(np.full(size - 1, b, U), dtype=U)]) for b in (self.base, self.back))

    def words(self, data: np.ndarray, words: Words) -> np.ndarray:
        """One hash per word of ``data``, whose bytes are classed already."""
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return mixed((sums[words.end] - sums[words.start]) * self.down[words.start])

    def runs(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """One hash for each n consecutive words; those that cross texts are there too."""
        if len(hashes) < n:
            return np.zeros(0, U)
        self._powers(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, U)
        np.cumsum(hashes * self.up[: len(hashes)], out=sums[1:])
        return mixed((sums[n:] - sums[:-n]) * self.down[: len(hashes) - n + 1])


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, bytes and offsets) over rows of a string array without nulls, about ``size`` bytes each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words_of(classed: np.ndarray, offsets: np.ndarray) -> Words:
    """Where the words of the texts lie; a word never goes on from one text into the next."""
    if not len(classed):
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(len(offsets), np.int64), empty, empty)
    inside = classed != SEPARATOR
    before = np.concatenate([[False], inside[:-1]])
    cuts = offsets[1:-1]
    before[cuts[cuts < len(classed)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return Words(np.searchsorted(start, offsets), start, np.flatnonzero(inside & ~after) + 1)


@dataclass
class Joined:
    """Words of consecutive texts with one space between those of a text: word k is ``data[start[k]:end[k]]``."""

    data: bytes
    start: np.ndarray
    end: np.ndarray

    def digests(self, first: np.ndarray, n: int) -> np.ndarray:
        """128 bits, as two columns, of each run of n words from the ones numbered ``first``."""
        data, runs = self.data, zip(self.start[first].tolist(), self.end[first + (n - 1)].tolist(), strict=True)
        return np.frombuffer(b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in runs]), U).reshape(-1, 2)


def joined(classed: np.ndarray, words: Words) -> Joined:
    inside = classed != SEPARATOR
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    start = (np.cumsum(kept, dtype=np.int64) - 1)[words.start] if len(words.start) else words.start
    return Joined(np.where(inside, classed, 0x20).astype(np.uint8)[kept].tobytes(), start.astype(np.uint32), (start + (words.end - words.start)).astype(np.uint32))


def string_array(column: pa.Array) -> pa.Array:
    """Null as the empty string."""
    return column.fill_null("")
