"""Array helpers for tasks that work through Arrow batches of texts.

A batch is cut into blocks of a few hundred kilobytes of text. A block is one byte array with the row offsets
beside it; words, shingles and lines are found for all its rows at once. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
CACHED = 1 << 14  # values that are worked through together, so that they stay in a core's cache

U64 = np.uint64
# Polynomials modulo the prime 2**31 - 1 at two random points, with a random value per byte. A modulus of 2**64 would make
# texts of a regular build (those after Thue and Morse) collide at every odd point.
PRIME_BITS = U64(31)
PRIME = U64((1 << 31) - 1)
_rng = np.random.Generator(np.random.PCG64(20240229))
# One table per point; the second pair folds A-Z onto a-z.
BYTE_VALUES = _rng.integers(1, int(PRIME), (2, 256), dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[:, LOWER]
PLACES = _rng.integers(1, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)
POINTS = [int(x) for x in _rng.integers(1 << 20, int(PRIME), 2)]

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
CONTINUED = np.zeros(256, bool)
CONTINUED[0x80:0xC0] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint32)] * 4


def _fold(x: np.ndarray) -> np.ndarray:
    """Equal modulo the prime, and below 2**33 for any 64-bit number."""
    return (x & PRIME) + (x >> PRIME_BITS)


def _residues(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= PRIME, x - PRIME, x)


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of both points, then of their inverses, each table twice as long as the one before it."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        tables = []
        for step in (*POINTS, *[pow(x, -1, int(PRIME)) for x in POINTS]):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate((out, _residues(out * U64(pow(step, len(out), int(PRIME))))))
            tables.append(out[:size].astype(np.uint32))
        _powers = tables
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Block:
    """Rows ``first`` to ``first + rows`` of a batch: their bytes and, per row, where its text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags (one per byte) in every row."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def text_blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a column of texts into blocks; a null is an empty text, a longer text is a block of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + block_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield Block(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def prefix_hash(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Running sums, one row per point, from which ``span_hash`` takes the hash of any span."""
    powers = _powers_to(len(data) + 1)
    out = np.zeros((2, len(data) + 1), np.uint64)
    for at in range(0, len(data), CACHED):
        end = min(at + CACHED, len(data))
        part = data[at:end]
        for i in range(2):
            terms = values[i].take(part)
            terms *= powers[i][at:end]
            # below 2**32 each, so sums over any block stay far below 2**64
            terms = _fold(terms)
            terms[0] += out[i, at]
            np.cumsum(terms, out=out[i, at + 1 : end + 1])
    return out


def prefix_digits(digits: np.ndarray) -> np.ndarray:
    """As ``prefix_hash`` for a sequence of 64-bit hashes, such as those of words; 31 bits of each count per point."""
    powers = _powers_to(len(digits) + 1)
    out = np.zeros((2, len(digits) + 1), np.uint64)
    for i in range(2):
        part = (digits >> U64(33 * i)) & PRIME
        np.cumsum(_fold(part * powers[i][: len(digits)]), out=out[i, 1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every span, 62 bits and its length; equal bytes give equal hashes wherever they stand.

    Of a prefix cut to its first row, one point is used: half the bits for half the work.
    """
    tables = _powers_to(prefix.shape[1])
    out = (ends - starts).astype(np.uint64) * PLACES[15]
    for i in range(len(prefix)):
        total = _residues(prefix[i][ends] - prefix[i][starts])
        out += _residues(total * tables[2 + i][starts]) << (PRIME_BITS * U64(i))
    return mix(out)


def window_digests(prefix: np.ndarray, width: int) -> np.ndarray:
    """Digest below 2**31, at the first point, of every run of ``width`` bytes; equal bytes have equal digests."""
    back = _powers_to(prefix.shape[1])[2]
    sums = prefix[0]
    out = np.empty(max(len(sums) - width, 0), np.uint64)
    for at in range(0, len(out), CACHED):
        end = min(at + CACHED, len(out))
        total = _fold(sums[at + width : end + width] - sums[at:end])  # below 2**32
        total *= back[at:end]
        out[at:end] = _residues(total)
    return out


@dataclass
class Words:
    """Words of a block: where they start and end, and the row each belongs to."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    per_row: np.ndarray


def words_of(block: Block) -> Words:
    """Words are maximal runs of bytes other than blank, tab, newline, VT, FF and CR."""
    n = len(block.data)
    edges = np.zeros(n + 1, np.int8)
    inside = ~SPACE[block.data]
    edges[:n] = inside
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    at = block.offsets[(block.offsets > 0) & (block.offsets < n)]
    opens[at] = inside[at]
    closes[at - 1] = inside[at - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    firsts = np.searchsorted(starts, block.offsets)
    per_row = np.diff(firsts)
    return Words(starts, ends, np.repeat(np.arange(block.rows), per_row), per_row)


def shingle_hashes(word_hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the rows they are in; a row with fewer words has one run."""
    n = len(word_hashes)
    sums = np.zeros(max(n - size + 1, 0), np.uint64)
    for j in range(size):
        sums += word_hashes[j : n - size + 1 + j] * PLACES[j] if n >= size else U64(0)
    whole = words.row[: n - size + 1] == words.row[size - 1 :] if n >= size else np.zeros(0, bool)
    hashes, rows = mix(sums[whole]), words.row[: n - size + 1][whole] if n >= size else words.row[:0]
    short = np.flatnonzero((words.per_row > 0) & (words.per_row < size))
    if len(short):
        first = np.concatenate(([0], np.cumsum(words.per_row)))[short]
        h = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            there = words.per_row[short] > j
            h[there] += word_hashes[first[there] + j] * PLACES[j]
        h = mix(h + words.per_row[short].astype(np.uint64) * PLACES[14])
        hashes, rows = np.concatenate((hashes, h)), np.concatenate((rows, short))
    return hashes, rows


def packed(values: list[np.ndarray]) -> pa.Array:
    """Arrays of one type as a list column."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
