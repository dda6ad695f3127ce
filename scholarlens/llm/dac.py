"""Directly addressable codes for token ids.

Every value is split into chunks of 8 bits, lowest first. Level k holds the k-th chunk of the values that have one,
and a bitmap that says which of them continue; a rank directory (ones before each block of 512 bits) turns the place
of a value at level k into its place at level k + 1. Any token is read by itself: no block is decoded.

Blob: ``DAC1``, levels (u4), then for each level: values (u8), their bytes, bitmap bytes, directory (u4 each).
All numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC, BLOCK = b"DAC1", 512
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def encode(values: np.ndarray) -> bytes:
    rest, levels = np.asarray(values, dtype=np.uint64), []
    while True:
        more = rest >= 256
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        ones = _ONES[bits].reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + directory.tobytes())
        rest = rest[more] >> np.uint64(8)
        if not len(rest):
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Reader:
    """Random access to an encoded blob; arrays are views of it."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a DAC1 blob")
        at, self.levels = 8, []
        for _ in range(struct.unpack_from("<I", blob, 4)[0]):
            (n,) = struct.unpack_from("<Q", blob, at)
            blocks = -(-n // BLOCK)
            chunks = np.frombuffer(blob, np.uint8, n, at + 8)
            bits = np.frombuffer(blob, np.uint8, blocks * BLOCK // 8, at + 8 + n)
            directory = np.frombuffer(blob, "<u4", blocks, at + 8 + n + len(bits))
            self.levels.append((chunks, bits, directory))
            at += 8 + n + len(bits) + 4 * blocks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            ones = _ONES[bits[block * BLOCK // 8 : i >> 3]].sum() + _ONES[bits[i >> 3] & (1 << (i & 7)) - 1]
            i = int(directory[block]) + int(ones)
        return value

    def all(self) -> np.ndarray:
        """Every value, level by level."""
        out = self.levels[0][0].astype(np.uint32)
        where = np.arange(len(out))
        for k, (chunks, bits, _) in enumerate(self.levels[:-1]):
            where = where[np.unpackbits(bits, bitorder="little")[: len(chunks)].astype(bool)]
            out[where] |= self.levels[k + 1][0].astype(np.uint32) << np.uint32(8 * (k + 1))
        return out
