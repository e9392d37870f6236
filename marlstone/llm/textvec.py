"""Vectorised text handling on Arrow buffers: words, word hashes and shingles as numpy arrays.

All functions work on whole texts.  A batch is cut into blocks of rows of about
BLOCK_BYTES, so that temporaries stay small whatever the batch size; one text
longer than that forms a block of its own.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

BLOCK_BYTES = 1 << 21

#: Bytes that separate words: ASCII white space; or everything in ASCII but letters and digits.
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
NON_WORD_BYTES = bytes(b for b in range(0x80) if not (48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90))


@functools.cache
def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


@functools.cache
def word_table(separators: bytes) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[np.frombuffer(separators, np.uint8)] = False
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary column; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n, at = len(column), column.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if large else np.int32)[at : at + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(column, limit: int = BLOCK_BYTES):
    """(first row, rows, bytes, offsets) of consecutive rows of about limit bytes."""
    data, offs = buffers(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j - i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def pieces(batches, name: str, limit: int = 8 * BLOCK_BYTES):
    """The batches, cut where the column's bytes reach the limit."""
    for batch in batches:
        for row, n, _, _ in blocks(batch.column(name), limit):
            yield batch.slice(row, n)


def spans(data: np.ndarray, offs: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in data, and for each row the index of its first word (one more at the end)."""
    inside = word_table(separators)[data]
    full = offs[:-1] < offs[1:]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    before[offs[:-1][full]] = False
    after[offs[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


#: Words of up to so many eight-byte lanes are hashed by numpy, longer ones one by one.
LANES = 4


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    Each lane is mixed in by a bijection that is no polynomial, so words of one
    length of up to eight bytes never share a hash, and longer ones by chance only.
    """
    n = ends - starts
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    inside = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    out = mix(n.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(LANES):
        live = slice(None) if k == 0 else np.flatnonzero(n > 8 * k)
        if k and not len(live):
            break
        lane = lanes[starts[live] + 8 * k] & inside[np.minimum(n[live] - 8 * k, 8)]
        out[live] = mix(out[live] ^ lane)
    for i in np.flatnonzero(n > 8 * LANES):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words, row by row; a row of fewer words, but not none, is one shingle.

    first: index of each row's first word, as spans() returns it.  Returns the
    hashes and for each row the index of its first shingle.
    """
    n_words = np.diff(first)
    count = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(n_words.dtype))
    at = np.zeros(len(first), np.int64)
    np.cumsum(count, out=at[1:])
    total = int(at[-1])
    row = np.repeat(np.arange(len(count)), count)
    begin = first[:-1][row] + (np.arange(total) - at[:-1][row])
    full = (n_words >= k)[row]
    out = np.zeros(total, np.uint64)
    b = begin[full]
    acc = np.full(len(b), np.uint64(k), np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x9FB21C651E98DF25) + hashes[b + j]
    out[full] = mix(acc)
    for r in np.flatnonzero((n_words > 0) & (n_words < k)):
        one = np.full(1, np.uint64(n_words[r]), np.uint64)
        for h in hashes[first[r] : first[r + 1]]:
            one = mix(one * np.uint64(0x9FB21C651E98DF25) + h)
        out[at[r]] = one[0] ^ np.uint64(n_words[r])
    return out, at
