"""Token ids of whole texts, each distinct chunk of text encoded once while it is remembered.

A chunk is a word with the one blank or line end before it. Both vocabularies split a text there by themselves, so the
ids of a text are the ids of its chunks, one after another. Words are found, hashed and looked up for a whole batch at
once; only new chunks go to the encoder. Texts with other white space than single blanks and line ends go to the
encoder whole where white space matters.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

from . import words

BYTE_LEVEL, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
#: Places of the table of known chunks, and chunks after which it starts afresh: 60 to 150 MB in a Python worker.
PLACES, MOST = 1 << 22, 2_500_000


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Remembered:
    """Chunk hash -> number of an entry. A place holds one chunk; a new one takes the place of the old."""

    def __init__(self):
        self.keys = np.zeros(PLACES, np.uint64)
        self.entry = np.full(PLACES, -1, np.int32)
        self.size = 0

    def find(self, h: np.ndarray, learn: Callable[[np.ndarray], None]) -> np.ndarray:
        """Entries of ``h``; ``learn`` is given where in ``h`` each new chunk stands, and adds an entry for each."""
        place = (h >> np.uint64(42)).astype(np.int64)
        out = np.where(self.keys[place] == h, self.entry[place], -1)
        missed = np.flatnonzero(out < 0)
        if len(missed):
            new, first, inverse = np.unique(h[missed], return_index=True, return_inverse=True)
            learn(missed[first])
            number = np.arange(self.size, self.size + len(new), dtype=np.int32)
            out[missed] = number[inverse]
            place = (new >> np.uint64(42)).astype(np.int64)
            self.keys[place], self.entry[place] = new, number
            self.size += len(new)
        return out


class Arena:
    """Arrays of many entries in one: ``take(entries)`` puts those asked for one after another."""

    def __init__(self, kind: str):
        self.data, self.used = np.zeros(1 << 16, kind), 0
        self.starts, self.sizes, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        while len(self.data) < self.used + len(data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while len(self.starts) < self.n + len(sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.data[self.used : self.used + len(data)] = data
        self.starts[self.n : self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.n : self.n + len(sizes)] = sizes
        self.used, self.n = self.used + len(data), self.n + len(sizes)

    def take(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The data, and where the data of each entry starts (one more: the end)."""
        sizes = self.sizes[entries]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(self.starts[entries] - (ends - sizes), sizes)
        return self.data[at], np.concatenate([[0], ends])


_START, _BLANK, _LINE = (np.uint64(x) for x in (0x1B873593CC9E2D51, 0x52DCE729E6546B64, 0x38495AB5C2B2AE35))


def spaced(w: words.Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The kind of space before each word (0 none, 1 blank, 2 line end), and the texts that must go whole.

    Whole: any space but one blank or one line end between two words, space at either end, and bytes that may be part
    of white space beyond ASCII.
    """
    data, n = w.data, len(texts)
    odd = np.zeros(n, bool)
    inner = np.ones(len(w.starts), bool)
    has = w.first[1:] > w.first[:-1]
    inner[w.first[:-1][has]] = False
    before = np.where(w.starts > 0, w.starts - 1, 0)
    gap = np.zeros(len(w.starts), np.int64)
    gap[1:] = w.starts[1:] - w.ends[:-1]
    kind = np.where(data[before] == 32, 1, 2).astype(np.int8) if len(w.starts) else np.zeros(0, np.int8)
    bad = inner & ((gap != 1) | ~np.isin(data[before], (10, 32)) if len(w.starts) else False)
    odd[w.doc[bad]] = True
    kind[~inner] = 0
    edges = w.offsets
    odd[:] |= ~has
    first, last = w.first[:-1][has], w.first[1:][has] - 1
    odd[np.flatnonzero(has)[(w.starts[first] != edges[:-1][has]) | (w.ends[last] != edges[1:][has])]] = True
    lead, then = data[:-1], data[1:]
    strange = np.flatnonzero((lead >= 0xC2) & (lead <= 0xEF))
    a, b = lead[strange], then[strange]
    strange = strange[(a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE2) & (b <= 0x81) | (a == 0xE3) & (b == 0x80) | (a == 0xEF) & (b == 0xBB)]
    strange = np.concatenate([strange, np.flatnonzero((data >= 0x1C) & (data <= 0x1F))])
    odd[np.searchsorted(edges, strange, side="right") - 1] = True
    return kind, odd


class Encoder:
    """Ids of texts. ``encode`` gives the ids of new chunks: an array and their numbers."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], words_only: bool):
        self.encode, self.words_only = encode, words_only
        self._start()

    def _start(self) -> None:
        self.table, self.arena = Remembered(), Arena("u4")

    def learned(self, texts: list[str]) -> None:
        self.arena.add(*self.encode(texts))

    def entries(self, texts: pa.Array) -> tuple[words.Words, np.ndarray, np.ndarray]:
        """Words, the entry of each, and the texts that must go whole."""
        if self.table.size > MOST:
            self._start()
        w = words.scan(texts)
        if self.words_only:
            h, kind, whole = w.hashes, None, np.zeros(len(texts), bool)
        else:
            kind, whole = spaced(w, texts)
            h = w.hashes ^ np.array([_START, _BLANK, _LINE])[kind]
        data = w.data.tobytes()

        def learn(at: np.ndarray) -> None:
            starts, ends = w.starts[at].tolist(), w.ends[at].tolist()
            text = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends, strict=True)]
            if kind is not None:
                text = [("", " ", "\n")[k] + t for k, t in zip(kind[at].tolist(), text, strict=True)]
            self.learned(text)

        return w, self.table.find(h, learn), whole

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        w, entries, whole = self.entries(texts)
        data, at = self.arena.take(entries)
        cut = at[w.first].tolist()
        out = [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for i in np.flatnonzero(whole).tolist():
            if text := texts[i].as_py():
                out[i] = self.encode([text])[0]
        return out


class Library:
    """Chunks by the tokenizers library, many in one call: it splits at a special token before anything else."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.mark = "<|endoftext|>"
        self.mark_id = self.library.token_to_id(self.mark)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for a in range(0, len(texts), 512):
            some = texts[a : a + 512]
            if len(some) == 1 or any("<|" in t for t in some):
                found = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(some, add_special_tokens=False)]
                parts += found
                sizes.append([len(x) for x in found])
            else:
                (found,) = self.library.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)
                ids = np.array(found.ids, np.uint32)
                ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
                parts.append(ids[ids != self.mark_id])
                sizes.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(parts), np.concatenate(sizes).astype(np.int64)


_encoders: dict[tuple, Encoder] = {}
#: What Python workers keep from task to task, here and in other modules.
kept: list[dict] = [_encoders]


#: Memory blocks from this size are the system's again as soon as they are freed.
_RETURNED = 1 << 20
_libc: list = []


def _allocator():
    """The C library, told once in each worker to give large blocks back: its own limit grows with what is freed."""
    if not _libc:
        _libc.append(ctypes.CDLL(None))
        if hasattr(_libc[0], "mallopt"):
            _libc[0].mallopt(-3, _RETURNED)  # M_MMAP_THRESHOLD
    return _libc[0]


def release() -> None:
    """Gives up what earlier tasks of this Python worker have kept, before a task that has no use for it."""
    for held in kept:
        held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(_allocator(), "malloc_trim", None)
    if trim is not None:
        trim(0)


def encoder(path: str, words_only: bool = False) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    key = (path, words_only)
    if key not in _encoders:
        _allocator()
        _encoders[key] = Encoder(Library(path), words_only)
    return _encoders[key]


def groups(texts: pa.Array, size: int = 4_000_000) -> Iterable[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes."""
    import pyarrow.compute as pc

    if len(texts):
        held = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // size
        cut = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(texts)]
        yield from ((a, b) for a, b in zip(cut[:-1], cut[1:], strict=True) if a < b)
