"""Whole texts as byte arrays: words, lines and hashes of any byte range, many documents at a time.

Texts stay UTF-8 bytes as Arrow delivers them.  One pass of running sums over a batch gives the
hash of every byte range in it, so words, shingles, lines and windows cost a few array operations.
Hashes are two polynomials modulo the prime 2**31 - 1 under random bases, 62 bits together: unlike
sums modulo a power of two, no text makes them collide by its structure alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_PRIME = (1 << 31) - 1
#: The bases of the two polynomials.
_BASES = (1_357_924_687, 864_197_533)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Two random numbers below 2**31 - 1 for each byte value, in the halves of one.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
#: The same after lower-casing A-Z.
LOWER_BYTE = BYTE[np.where(_UPPER, np.arange(256) + 32, np.arange(256))]
#: Bytes that belong to a word when words are split at white space.
IN_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _folded(x: np.ndarray) -> np.ndarray:
    """A number of the same remainder modulo 2**31 - 1, at most 2**31 + x / 2**31."""
    high = x >> np.uint64(31)
    high += x & np.uint64(_PRIME)
    return high


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers modulo 2**31 - 1."""
    x = _folded(_folded(x))
    return np.minimum(x, x - np.uint64(_PRIME))  # a difference below 0 wraps round and is the larger


class _Powers:
    """Powers of both bases and of their inverses, as many as the longest batch so far needs."""

    up = [np.ones(1, np.uint32), np.ones(1, np.uint32)]
    down = [np.ones(1, np.uint32), np.ones(1, np.uint32)]

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        powers = np.ones(n, np.uint32)
        known = 1
        while known < n:  # twice as many: the known ones times the next power
            more = powers[: min(known, n - known)].astype(np.uint64) * np.uint64(pow(base, known, _PRIME))
            powers[known : known + len(more)] = _reduced(more)
            known += len(more)
        return powers

    @classmethod
    def upto(cls, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        if len(cls.up[0]) < n:
            size = max(n, BATCH_BYTES + 1)
            up = [cls._table(base, size) for base in _BASES]
            down = [cls._table(pow(base, -1, _PRIME), size) for base in _BASES]
            if n > 4 * BATCH_BYTES:  # a very long text: not kept
                return up, down
            cls.up, cls.down = up, down
        return cls.up, cls.down


class Ranges:
    """Hashes of byte ranges of one array; equal bytes give equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray, table: np.ndarray = BYTE) -> None:
        up, self._down = _Powers.upto(len(data) + 1)
        self._sums = []
        for powers, shift in zip(up, (0, 32), strict=True):
            values = ((table >> np.uint64(shift)) & np.uint64(_PRIME)) % np.uint64(_PRIME)
            sums = np.zeros(len(data) + 1, np.uint64)
            terms = values[data]
            terms *= powers[: len(data)]
            # below 2**64 as long as a batch has fewer than 2**31 bytes
            np.cumsum(_folded(terms), out=sums[1:])
            self._sums.append(sums)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of data[start:end], mixed with the length."""
        one, two = (
            _reduced(_folded(_folded(sums[end] - sums[start])) * down[start])
            for sums, down in zip(self._sums, self._down, strict=True)
        )
        return mix((one << np.uint64(31) | two) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def rolling(self, width: int) -> np.ndarray:
        """Numbers for all ranges of ``width`` bytes that depend on their bytes alone, of one polynomial: to choose by."""
        sums, down = self._sums[0], self._down[0]
        return mix(_reduced(_folded(_folded(sums[width:] - sums[:-width])) * down[: len(sums) - width]))


class Texts:
    """The bytes of some documents, end to end; document i is data[offsets[i]:offsets[i + 1]]."""

    def __init__(self, column: pa.Array) -> None:
        column = pc.fill_null(column, "")
        wide = pa.types.is_large_string(column.type)
        raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
        raw = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
        held = column.buffers()[2]
        whole = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
        self.data = whole[raw[0] : raw[-1]]
        self.offsets = raw - raw[0]
        self.n = len(column)

    def documents(self, positions: np.ndarray) -> np.ndarray:
        """The document of each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """Per document, the sum of one value per byte."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def words(self, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every word, in order."""
        inside = in_word[self.data]
        first = np.zeros(len(inside) + 1, bool)
        first[self.offsets] = True
        before = np.concatenate([[False], inside])
        starts = np.flatnonzero(inside & (~before[:-1] | first[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        return starts, ends, self.documents(starts)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut so that each holds some megabytes of text; a longer text comes alone, whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        filled, start = 0, 0
        for i, size in enumerate(sizes):
            if filled and filled + size > BATCH_BYTES:
                part = batch.slice(start, i - start)
                yield part, Texts(part.column(column))
                filled, start = 0, i
            filled += int(size)
        part = batch.slice(start)
        yield part, Texts(part.column(column))
    # workers are used again: what this task no longer needs goes back
    pa.default_memory_pool().release_unused()


def runs(documents: np.ndarray, n: int) -> np.ndarray:
    """Where each document's entries begin in an array ordered by document, and where the last end."""
    return np.searchsorted(documents, np.arange(n + 1))


def shingles(word_hashes: np.ndarray, documents: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one document, and their documents."""
    if len(word_hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = len(word_hashes) - width + 1
    whole = documents[:n] == documents[width - 1 :]
    value = np.zeros(n, np.uint64)
    for i in range(width):
        value = mix(value * np.uint64(3) + word_hashes[i : i + n])
    return value[whole], documents[:n][whole]
