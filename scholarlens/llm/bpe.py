"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a pretoken exactly one token can come last in its encoding. An automaton over the vocabulary
(with suffix links) lists the tokens that end at each place; the one whose start has a last token that it is
compatible with is stored, and the back-pointers from the end give the ids. Two tokens are compatible if merging
their joined bytes leaves them as they are, which the merge tree of each token decides without merging anything.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import encoding
from .common import table

# The vocabulary's split pattern, and the printable characters that stand for the bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
NEVER = 1 << 60
PAIRS = 2_000_000


def byte_characters() -> list[str]:
    rest = [b for b in range(256) if b not in _PRINTABLE]
    codes = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(rest)}
    return [chr(codes[b]) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        ids, added = read["model"]["vocab"], read["added_tokens"]
        self.special = {t["content"]: t["id"] for t in added}
        self.characters = byte_characters()
        self.table = {i: c for i, c in enumerate(self.characters)}  # for str.translate of latin-1 text
        self.born, self.parts, self.merged = {}, {}, {}
        for rank, merge in enumerate(read["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            token = ids[a + b]
            self.merged[ids[a], ids[b]] = rank
            if token not in self.born:
                self.born[token], self.parts[token] = rank, (ids[a], ids[b])
        self.automaton = ahocorasick.Automaton()
        for text, token in ids.items():
            if text not in self.special and (len(text) == 1 or token in self.parts):
                self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        value = {c: b for b, c in enumerate(self.characters)}
        self.bytes = {token: bytes(value[c] for c in text) for text, token in ids.items() if all(c in value for c in text)}
        self.bytes |= {i: text.encode() for text, i in self.special.items()}
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known_pairs: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart when their bytes are encoded together.

        Going back in time along the right edge of ``left`` and the left edge of ``right``: a pair of edge tokens that
        were neighbours must not have a merge that came before either of them went into a larger token. The merge on
        the left side goes first among equals.
        """
        key = left << 32 | right
        if (known := self.known_pairs.get(key)) is not None:
            return known
        born, parts, merged = self.born, self.parts, self.merged
        x, y, end_x, end_y, good = left, right, NEVER, NEVER, True
        while True:
            rank = merged.get((x, y))
            if rank is not None and rank < end_x and rank <= end_y:
                good = False
                break
            born_x, born_y = born.get(x, -1), born.get(y, -1)
            if born_x < 0 and born_y < 0:
                break
            if born_y >= born_x:
                y, end_y = parts[y][0], born_y
            else:
                x, end_x = parts[x][1], born_x
        if len(self.known_pairs) > PAIRS:
            self.known_pairs = {}
        self.known_pairs[key] = good
        return good

    def pretoken(self, data: bytes) -> list[int]:
        """Ids of one pretoken."""
        text = data.decode("latin-1").translate(self.table)
        n = len(text)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        pairs, compatible = self.known_pairs, self.compatible
        for end, (token, length) in self.automaton.iter(text):
            start = end + 1 - length
            if start:
                before = last[start]
                if before < 0 or last[end + 1] >= 0:
                    continue
                good = pairs.get(before << 32 | token)
                if not (compatible(before, token) if good is None else good):
                    continue
            last[end + 1], back[end + 1] = token, start
        out = []
        while n:
            if last[n] < 0:
                raise ValueError("a byte is missing from the vocabulary")
            out.append(last[n])
            n = back[n]
        return out[::-1]

    def ids(self, text: str) -> list[int]:
        """Ids of a text, special tokens in it included, without any cache of chunks."""
        out, at = [], 0
        for m in [*self.cut.finditer(text)] if self.cut else []:
            out += self._plain(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        return [i for p in self.split.findall(text) for i in self.pretoken(p.encode("utf-8", "replace"))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def chunk(self, text: str) -> tuple[str, int, bytes]:
        """Ids as decimals joined by commas, their number, and the bytes that they decode to."""
        found = self.ids(text)
        return ",".join(map(str, found)), len(found), self.decode(found)


class Encoder(encoding.Encoder):
    """Remembers for each chunk its ids as decimals joined by commas, their number and the bytes they decode to."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        super().__init__(None, words_only=False)

    def _start(self) -> None:
        self.table, self.decimals, self.numbers, self.decoded = encoding.Remembered(), [], [], []

    def learned(self, texts: list[str]) -> None:
        for text in texts:
            shown, number, decoded = self.vocabulary.chunk(text)
            self.decimals.append(shown)
            self.numbers.append(number)
            self.decoded.append(decoded)

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids, SHA-256 of the decoded text, for each text."""
        w, entries, whole = self.entries(texts)
        decimals, numbers, decoded, entries = self.decimals, self.numbers, self.decoded, entries.tolist()
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            if whole[i]:
                ids, n, out = self.vocabulary.chunk(texts[i].as_py() or "")
            else:
                mine = entries[a:b]
                ids, n, out = ",".join([decimals[e] for e in mine]), sum([numbers[e] for e in mine]), b"".join([decoded[e] for e in mine])
            if not out.isascii():
                out = out.decode("utf-8", "replace").encode()
            yield n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(out).hexdigest()


_encoders: dict[str, Encoder] = {}
encoding.kept.append(_encoders)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    A null or empty text has no ids and the digests of nothing. Every row is encoded by itself, whole: rows that repeat
    or have no doc_id have their own result. Other columns are not looked at; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [x for a, b in encoding.groups(texts) for x in encoder(path).digests(texts[a:b])]
            rows = [*zip(*found, strict=True)] or [(), (), ()]
            columns = [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), encoding.vocabulary(encoding.BYTE_LEVEL))
