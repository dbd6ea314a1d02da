"""Word spans and word hashes of Arrow text batches, in numpy.

The text operators of this package work on the UTF-8 bytes of whole Arrow
batches.  A *word* is a maximal run of bytes that a 256-entry table marks as
word bytes; separators are ASCII, so byte runs and character runs agree.

Hashes are polynomial prefix hashes modulo 2**64, finished by a 64-bit mixer.
Such a polynomial cannot tell some long words apart, whatever its base (a
Thue-Morse word of 1,024 letters and its complement), so a word of more than
``SHORT`` bytes is hashed by keyed BLAKE2b instead.
Work goes in slices of about ``SLICE`` bytes cut at separators, so the
temporary arrays stay small however long one text is (a single word longer
than a slice is the only thing that makes a slice longer).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
SHORT = 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (a bijection on 64-bit words)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003 + 1)) * _GOLD)


def byte_table(separators) -> np.ndarray:
    """256 booleans, True where the byte belongs to a word."""
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


#: Words `[^\x20\x09-\x0D]+`.
SPACE_WORDS = byte_table([0x20, *range(0x09, 0x0E)])
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM_WORDS = byte_table(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90))
PLAIN = np.arange(256, dtype=np.uint8)
LOWER = PLAIN.copy()
LOWER[65:91] += 32


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=8)
def _powers(n: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = int(seeds(1, salt)[0]) | 1
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, inverse, np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return seeds(256, salt + 17), up, down


def _room(n: int) -> int:
    """Table size for ``n``: few different ones, so tables are shared."""
    return 1 << 16 if n <= 1 << 16 else SLICE + (1 << 15) if n <= SLICE + (1 << 15) else 1 << n.bit_length()


def _hash(data, starts, ends, fold, salt):
    """Hash of each byte span [start, end) of ``data`` after ``fold``."""
    n = len(data)
    table, up, down = _powers(_room(n), salt)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[fold][data] * up[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts]
        h += (ends - starts).astype(np.uint64) * _GOLD
    h = mix64(h)
    key = salt.to_bytes(8, "little", signed=True)
    for k in np.flatnonzero(ends - starts > SHORT).tolist():
        h[k] = long_hash(fold[data[starts[k]:ends[k]]].tobytes(), key)
    return h


def long_hash(data: bytes, key: bytes) -> int:
    """64 bits of keyed BLAKE2b."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, key=key).digest(), "little")


class Words:
    """Words of a batch: byte spans, hashes and per-text word ranges.

    ``first[i]:first[i + 1]`` are the words of text i.
    """

    __slots__ = ("start", "end", "first", "hashes")

    def __init__(self, start, end, first, hashes):
        self.start, self.end, self.first, self.hashes = start, end, first, hashes


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray,
                fold: np.ndarray = PLAIN, salts: tuple[int, ...] = (1,)) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i+1]]`` with one hash
    array per salt."""
    n, starts, ends, hashes = len(data), [], [], [[] for _ in salts]
    at = 0
    edges = np.zeros(n + 1, bool)
    edges[offsets] = True
    while at < n:
        stop = min(n, at + SLICE)
        while stop < n and table[data[stop - 1]] and not edges[stop]:
            gap = np.flatnonzero(~table[data[stop:stop + SLICE]] | edges[stop:stop + SLICE][:n - stop])
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(n, stop + SLICE)
        part = data[at:stop]
        word = table[part]
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = word[:-1]
        begin = word & (~before | edges[at:stop])
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = word[1:]
        finish = word & (~after | edges[at + 1:stop + 1])
        s, e = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        starts.append(s + at)
        ends.append(e + at)
        for k, salt in enumerate(salts):
            hashes[k].append(_hash(part, s, e, fold, salt))
        at = stop
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = cat(starts, np.int64)
    return Words(start, cat(ends, np.int64), np.searchsorted(start, offsets), [cat(h, np.uint64) for h in hashes])


def windows(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (prefix hash, so
    the cost does not grow with ``width``); empty when there are too few."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    _, up, down = _powers(_room(n), salt + 101)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * up[:n], out=sums[1:])
        return mix64((sums[width:] - sums[:n - width + 1]) * down[:n - width + 1])


def groups(first: np.ndarray, limit: int):
    """Consecutive text ranges [a, b) of about ``limit`` words."""
    a, n = 0, len(first) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(first, first[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)
