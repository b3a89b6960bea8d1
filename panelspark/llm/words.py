"""Vectorised word hashing over Arrow string batches (numpy, used inside tasks).

A *word* is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``, i.e. ``[^\\x20\\x09-\\x0D]+``.
All texts of a batch are hashed in one pass over the Arrow value buffer: every word's 64-bit hash is a
polynomial over per-byte random values, taken from one running sum, then mixed.  Cost is linear in bytes
and independent of word count, and no Python string is created.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    have, step = 1, base
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * U64(step)
        have, step = have + take, step * step % 2**64
    return out


_BLOCK = 1 << 20
_POW: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POW["p"], _POW["i"] = _powers(_BASE, size), _powers(_INV, size)
    return _POW["p"], _POW["i"]


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null reads as empty."""
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (n + 1 entries)."""
    inside = ~_SPACE[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begin[cuts] = inside[cuts]  # a text border ends a word
    finish[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return start, end, np.searchsorted(start, off)


def _byte_values(raw: np.ndarray) -> np.ndarray:
    return _BYTE[raw]


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, values=_byte_values) -> np.ndarray:
    """64-bit hash of each span of bytes (or of what `values` gives a random 64-bit value for); equal spans give
    equal hashes wherever they stand.

    Spans are in order and do not overlap.  They are hashed in blocks of about `_BLOCK` bytes, which bounds the
    tables of powers.
    """
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = len(start)
        if int(end[-1]) - int(start[at]) > _BLOCK:
            to = max(at + 1, int(np.searchsorted(end, start[at] + _BLOCK, side="right")))
        base, stop = int(start[at]), int(end[to - 1])
        power, inverse = _tables(stop - base + 1)
        run = np.empty(stop - base + 1, np.uint64)
        run[0] = 0
        np.cumsum(values(raw[base:stop]) * power[: stop - base], out=run[1:])
        s, e = start[at:to] - base, end[at:to] - base
        out[at:to] = mix((run[e] - run[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def word_hashes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of the batch, index of each text's first word)."""
    raw, off = buffers(arr)
    start, end, first = spans(raw, off)
    return hash_spans(raw, start, end), first


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of n words; a text of fewer words has one window, all its words."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out * U64(0xD1342543DE82EF95) + words[k : len(words) - n + 1 + k] + U64(k + 1))
    return out


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20):
    """Cut a batch so that one slice holds about max_bytes of text at most (a longer text is a slice by itself)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(edge, edge[at] + max_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
