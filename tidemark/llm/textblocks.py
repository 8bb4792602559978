"""Vectorised passes over the UTF-8 bytes of many texts at once.

``blocks`` cuts Arrow record batches into runs of rows with at most
``max_bytes`` of text (a longer single text is a run of its own), so a task's
memory does not depend on how many rows Arrow hands over.  ``Block`` finds
words and hashes them for all texts of a run with a few numpy passes.

Null texts count as empty.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18

try:
    _TRIM = ctypes.CDLL(None).malloc_trim  # glibc's
except (OSError, AttributeError):
    _TRIM = None

U64 = np.uint64
_RNG = np.random.RandomState(20240501)


def _random_u64(n: int) -> np.ndarray:
    return _RNG.randint(0, 1 << 32, n, dtype=np.uint64) << U64(32) | _RNG.randint(0, 1 << 32, n, dtype=np.uint64)


SLOT = _random_u64(64) | U64(1)  # odd multipliers for positions inside a window
SLOT.setflags(write=False)

# A span hash is the pair of its bytes' polynomials at two points modulo a prime:
# different spans of n bytes agree at both for at most (n / PRIME)^2 of all pairs of
# points.  (Modulo a power of two, some short texts collide at every point.)
PRIME = (1 << 31) - 1
POINTS = (1_556_430_253, 987_654_353)
_SUM_BYTES = 1 << 23  # sums of so many products of a byte and a power stay under 2^64
_KEPT_POWERS = 1 << 20
_POWERS: dict = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """A number under 2^31 + 4 that equals x modulo PRIME."""
    for _ in range(2):
        high = x >> U64(31)
        x = x & U64(PRIME)
        x += high
    return x


def _powers(point: int, n: int) -> np.ndarray:
    """point^0 ... point^(n-1) modulo PRIME; only short tables are kept."""
    held = _POWERS.get(point)
    if held is None or len(held) < n:
        held = np.ones(1, U64)
        while len(held) < n:
            held = np.concatenate([held, _fold(held * U64(pow(point, len(held), PRIME)))])
        if len(held) <= _KEPT_POWERS:
            _POWERS[point] = held
    return held[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def byte_set(spec) -> np.ndarray:
    """A 256-entry truth table of byte values."""
    table = np.zeros(256, bool)
    table[list(spec)] = True
    return table


SPACE = byte_set([0x20, *range(0x09, 0x0E)])
NOT_SPACE = ~SPACE
# Digits, lower-case ASCII letters, and every byte of a non-ASCII character.
WORD_LOWER = byte_set([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of each text and the end) of a string array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def small_batches(spark) -> None:
    """Rows come to Python a few hundred at a time: texts and gram sets are long,
    and both sides of the exchange hold a whole batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def release() -> None:
    """Give freed memory back to the system.  Workers are used again by later stages
    or stay idle for a while, and what each of them keeps for itself adds up."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def blocks(batches, text: str = "text", max_bytes: int = BLOCK_BYTES):
    """Yield slices of the record batches with at most ``max_bytes`` of text each;
    freed memory goes back to the system before the first and after the last."""
    release()
    yield from _blocks(batches, text, max_bytes)
    release()


def _blocks(batches, text: str, max_bytes: int):
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Block:
    """The texts of one run of rows."""

    def __init__(self, column, lower: bool = False):
        data, self.offsets = text_buffers(column)
        self.data = LOWER[data] if lower else data
        self.n = len(self.offsets) - 1
        self._prefix = None

    def words(self, table: np.ndarray):
        """Maximal runs of bytes of ``table``: (starts, ends, word index of each
        text's first word and the end).  Runs never cross texts."""
        m = table[self.data]
        size = len(m)
        edge = np.zeros(size + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(size, bool)
        before[1:] = m[:-1]
        starts = np.flatnonzero(m & (~before | edge[:-1]))
        after = np.zeros(size, bool)
        after[:-1] = m[1:]
        ends = np.flatnonzero(m & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte span; equal spans hash alike everywhere."""
        n = len(self.data) + 1
        if self._prefix is None:
            value = self.data.astype(U64) + U64(1)
            self._prefix = []
            for point in POINTS:
                terms = value * _powers(point, n)[:-1]
                if n > _SUM_BYTES:
                    terms = _fold(terms)
                sums = np.zeros(n, U64)
                np.cumsum(terms, out=sums[1:])
                self._prefix.append(sums)
        h = (ends - starts).astype(U64) * SLOT[63]
        for shift, point, sums in zip((31, 0), POINTS, self._prefix, strict=True):
            value = _fold(_fold(sums[ends] - sums[starts]) * _powers(pow(point, -1, PRIME), n)[starts])
            value -= U64(PRIME) * (value >= U64(PRIME))
            h += value << U64(shift)
        return mix(h)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def rolling(word_hashes: np.ndarray, k: int, offsets=None) -> np.ndarray:
    """Hash of each window of the words at ``offsets`` (default: k in a row).
    Windows may cross texts; the caller masks them by position."""
    offsets = range(k) if offsets is None else offsets
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = np.full(n, U64(k), U64)
    for slot, j in enumerate(offsets):
        h += word_hashes[j : j + n] * SLOT[slot]
    return mix(h)


def owners(ptr: np.ndarray) -> np.ndarray:
    """Text index of every word, from the word pointers."""
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def inside(ptr: np.ndarray, k: int) -> np.ndarray:
    """Mask of the windows of k words that lie in one text."""
    owner = owners(ptr)
    n = len(owner) - k + 1
    return owner[:n] == owner[k - 1 :] if n > 0 else np.zeros(0, bool)


def repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found at least twice in its text, not the first of its kind there)."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1])
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same  # lexsort is stable: the first of equals comes first
    twice = later.copy()
    twice[order[:-1]] |= same
    return twice, later
