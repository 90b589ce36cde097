"""Vectorised word and shingle hashing over the UTF-8 buffers of Arrow columns.

A batch is handled in chunks of about ``CHUNK`` bytes (a longer text is a chunk
of its own), so temporary arrays stay small whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
LONG = 128
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``limit`` bytes each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lut(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Table of 256 flags, True within the (first, last) byte ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a:b + 1] = True
    return table


NOT_SPACE = ~lut([(0x20, 0x20), (0x09, 0x0D)])
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, U(_BASE)), np.full(n, U(inverse))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 2 * CHUNK
    while size < n:
        size *= 2
    return _powers(size)


def word_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, past) byte positions of all words of the texts [starts, ends) in
    ``data``; the texts adjoin and words never cross from one to the next."""
    m = is_word[data]
    if not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prev = np.empty_like(m)
    prev[0] = False
    prev[1:] = m[:-1]
    prev[starts[starts < ends]] = False
    after = np.empty_like(m)
    after[-1] = False
    after[:-1] = m[1:]
    after[ends[starts < ends] - 1] = False
    return np.flatnonzero(m & ~prev), np.flatnonzero(m & ~after) + 1


def span_hashes(data: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, spans may overlap at will: a sum over the
    span's bytes, so two long words made for it can agree (``word_hashes``)."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U(1)) * up[:len(data)], out=prefix[1:])
    return mix64((prefix[past] - prefix[first]) * down[first] + (past - first).astype(np.uint64))


def word_hashes(data: np.ndarray, first: np.ndarray, past: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, for spans that hardly overlap (words).

    Every 8 bytes are mixed into the hash before the next 8 are read, so that,
    unlike the sums of ``span_hashes``, no structure of a long word cancels out.
    Spans of more than ``LONG`` bytes are hashed one by one."""
    size = past - first
    h = mix64(size.astype(np.uint64) ^ U((seed * _BASE) & _MASK))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at, live = first, np.flatnonzero(size > 0)
    live = live[size[live] <= LONG]
    for k in range(0, LONG, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        block = eights[at[live] + k]
        short = np.minimum(size[live] - k, 8).astype(np.uint64)
        block &= U(_MASK) >> (U(64) - U(8) * short)
        h[live] = mix64((h[live] ^ block) * U(_BASE) + U(k + 1))
    for k in np.flatnonzero(size > LONG).tolist():
        digest = blake2b(data[first[k]:past[k]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        h[k] = U(int.from_bytes(digest, "little"))
    return h


def words_of(column: pa.Array, is_word: np.ndarray, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each chunk of rows: (lo, hi, word hashes, bounds); the words of row
    lo + k are hashes[bounds[k]:bounds[k + 1]]."""
    data, offsets = text_buffers(column)
    for lo, hi in chunks(offsets):
        part = data[offsets[lo]:offsets[hi]]
        if lower:
            part = ASCII_LOWER[part]
        at = offsets[lo:hi + 1] - offsets[lo]
        first, past = word_spans(part, at[:-1], at[1:], is_word)
        yield lo, hi, word_hashes(part, first, past), np.searchsorted(first, at)


_SHINGLE_KEYS = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of one text; fewer
    words make one shingle of the whole sequence, no words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, U(n))
    for k in range(n):
        out += words[k:len(words) - n + 1 + k] * U(_SHINGLE_KEYS[k])
    return np.unique(mix64(out))
