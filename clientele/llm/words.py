"""Vectorised word splitting and hashing over Arrow string columns (runs inside tasks).

A word is a maximal run of bytes of a given class after lower-casing A-Z. Every word gets
a 64-bit hash that depends on its bytes alone: a polynomial hash over per-byte random
values, cut out of a running sum, then mixed. Texts are handled in pieces of about
``PIECE`` bytes cut between words, so temporary arrays stay small however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
BLOCK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Words separated by space and U+0009..U+000D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
# Words of 0-9, a-z and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit with even chance."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, PIECE + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of a block of texts; text ``i`` owns words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def _piece(data: np.ndarray, lo: int, hi: int, is_word: np.ndarray, breaks: np.ndarray):
    part = data[lo:hi]
    word = is_word[part]
    fresh = np.zeros(hi - lo + 1, dtype=bool)
    inside = breaks[np.searchsorted(breaks, lo):np.searchsorted(breaks, hi)]
    fresh[inside - lo] = True
    fresh[0] = fresh[-1] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | fresh[:-1]))
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | fresh[1:])) + 1
    up, down = _power_tables(hi - lo)
    running = np.zeros(hi - lo + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[part] * up[:hi - lo], out=running[1:])
    return starts + lo, ends + lo, mix((running[ends] - running[starts]) * down[starts])


def split_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    data = _LOWER[data[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    pieces, lo, n = [], 0, len(data)
    while lo < n:
        hi = min(n, lo + PIECE)
        while hi < n:  # move the cut to the next byte outside a word, or the next text
            gap = np.flatnonzero(~is_word[data[hi:hi + 4096]])
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(n, hi + 4096)
        pieces.append(_piece(data, lo, hi, is_word, offsets))
        lo = hi
    starts, ends, hashes = (np.concatenate([p[k] for p in pieces]) if pieces
                            else np.zeros(0, dtype=np.uint64 if k == 2 else np.int64)
                            for k in range(3))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without nulls."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None
            else np.zeros(0, dtype=np.uint8)), offsets


def blocks(batch: pa.RecordBatch, text_column: str, is_word: np.ndarray,
           max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of a batch of about ``max_bytes`` of text (at least one row) with their words."""
    if batch.num_rows == 0:
        return
    data, offsets = utf8(batch.column(text_column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo), split_words(data, offsets[lo:hi + 1], is_word)
        lo = hi


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words (texts' borders not regarded)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)  # unrelated odd numbers
    for k in range(size):
        total += hashes[k:k + n] * factors[k]
    return mix(total)


def whole_shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the runs of ``size`` words that lie inside one text."""
    h = shingle_hashes(words.hashes, size)
    at = np.arange(len(h))
    text_end = words.first[np.searchsorted(words.first, at, side="right")]
    inside = at + size <= text_end
    return at[inside], h[inside]
