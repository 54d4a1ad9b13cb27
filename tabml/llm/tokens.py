"""Words of many texts at once, as arrays: segmentation and 64-bit hashes without a loop over words.

Runs inside tasks on Arrow batches. A batch is cut into pieces of about `PIECE_BYTES` of text, so that
memory follows the piece (or one very long text), never the batch.

Hashes are sums of random values of the bytes times powers of an odd constant, modulo 2**64, and then mixed.
Two different words or word windows of a corpus meet with a probability of about 2**-60; equal hashes
are taken for equal words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _classes(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


#: Byte classes, after lower-casing A-Z: words between white space, and words of letters, digits and non-ASCII.
SPACED = _classes(lambda b: not (b == 32 or 9 <= b <= 13))
ALNUM = _classes(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


@dataclass
class Words:
    """`text[i]`: index of the text of word i; `hash[i]`; `first`, `last`: its byte range in `data`;
    `bounds`: words of text t are `bounds[t]` to `bounds[t + 1]`."""

    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray
    bounds: np.ndarray
    data: np.ndarray


def pieces(column: pa.Array, limit: int = PIECE_BYTES, rows: int = 1 << 14) -> Iterator[tuple[int, int]]:
    """Row ranges `(from, to)` of at most `rows` rows and `limit` bytes of text, or of one row."""
    ends = np.cumsum(_lengths(column))
    at, before = 0, 0
    while at < len(column):
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + limit, side="right"))))
        yield at, to
        at, before = to, int(ends[to - 1])


def _lengths(column: pa.Array) -> np.ndarray:
    offsets, _ = _buffers(column)
    return np.diff(offsets)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; NULL texts have no bytes."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(column: pa.Array, inside: np.ndarray) -> Words:
    """Words of a piece of a text column: maximal runs of bytes of the class `inside`, A-Z lower-cased."""
    bounds, raw = _buffers(column)
    data = _LOWER[raw]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, np.zeros(0, np.uint64), none, none, np.zeros(len(column) + 1, np.int64), data)
    held = inside[data]
    fresh = np.ones(n + 1, bool)  # where a text begins, or at the end
    fresh[1:n] = ~held[:-1]
    fresh[bounds] = True
    first = np.flatnonzero(held & fresh[:-1])
    after = np.ones(n, bool)
    after[:-1] = ~held[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    last = np.flatnonzero(held & after) + 1
    value, a = np.empty(len(first), np.uint64), 0
    while a < len(first):  # words of one megabyte at a time, so that a very long text needs little more than its bytes
        b = max(a + 1, int(np.searchsorted(last, first[a] + PIECE_BYTES, side="right")))
        low, high = int(first[a]), int(last[b - 1])
        power, inverse = _power(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_VALUE[data[low:high]] * power, out=total[1:])
        value[a:b] = (total[last[a:b] - low] - total[first[a:b] - low]) * inverse[first[a:b] - low]
        a = b
    word_bounds = np.searchsorted(first, bounds)
    text = np.repeat(np.arange(len(column)), np.diff(word_bounds))
    return Words(text, mixed(value + (last - first).astype(np.uint64)), first, last, word_bounds, data)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each `k` consecutive entries, also across texts: the caller drops those windows."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), k
    for j in range(k):
        factor = factor * _STEP % (1 << 64)
        out += hashes[j : j + n] * np.uint64(factor)
    return mixed(out)


def whole(words: Words, k: int) -> np.ndarray:
    """Which windows of `k` words lie within one text."""
    n = len(words.text) - k + 1
    return words.text[:n] == words.text[k - 1 :] if n > 0 else np.zeros(0, bool)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column: row i holds `values[bounds[i]:bounds[i + 1]]`."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))


def distinct_pairs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs ordered by owner and value, and how often each occurs."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))
