"""Words of whole batches at once, on the UTF-8 bytes: places, documents and 64-bit hashes, without a loop over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANE = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """``first[d]:first[d + 1]`` are the words of text ``d``, which starts at ``offsets[d]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray


def scan(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: none); ``lower`` folds A-Z first."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    off = off - off[0] if len(off) else np.zeros(1, np.int64)
    if lower:
        raw = _LOWER[raw]
    n = len(raw)
    ink = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    starts = np.flatnonzero(ink & (edge[:-1] | ~np.concatenate([[False], ink[:-1]]))) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(ink & (edge[1:] | ~np.concatenate([ink[1:], [False]]))) + 1 if n else np.zeros(0, np.int64)
    doc = np.searchsorted(off, starts, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(off)))
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((n + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = length.astype(np.uint64) * _ODD
    active, lane = np.arange(len(starts)), 0
    while len(active):
        left = np.minimum(length[active] - lane, 8)
        h[active] = mix(h[active] ^ (eight[starts[active] + lane] & _LANE[left]) + _ODD)
        lane += 8
        active = active[length[active] > lane]
    return Words(raw, starts, ends, doc, first, h, off)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive values."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out *= _ODD
        out += h[j : n + j]
    return mix(out)
