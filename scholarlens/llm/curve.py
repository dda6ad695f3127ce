"""Packing along a space-filling curve: documents that are alike share sequences.

A text's words are hashed to a vector, the vector is projected to a few dimensions, and the place of the projection on
a Hilbert curve is the document's key. Documents are range-partitioned and sorted by key and laid one after another;
every 4096 tokens are a sequence. A part's last tokens make sequences of powers of two, which need no padding, so parts
need not know of each other: there is one shuffle, of token ids, and nothing but one row of sums comes to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import encoding, words
from .common import discard, mark, stored, table

SIZE, END_ID = 4096, 2
#: Places of the hashed vectors (a power of two), dimensions of the projection, and bits of the curve in each.
PLACES, DIMS, BITS = 4096, 8, 7
#: Bytes of token ids in a part, about, and ids in a row.
PART_BYTES, CHUNK = 8_000_000, 1 << 16

AXES = [f"x{k}" for k in range(DIMS)]


def projection(places: int = PLACES, dims: int = DIMS) -> np.ndarray:
    """Normal numbers, the same everywhere: a row for each place."""
    return np.random.default_rng(7).standard_normal((places, dims))


def projected(w: words.Words, texts: int, matrix: np.ndarray) -> np.ndarray:
    """A row for each text: its hashed words (a word's weight grows with the logarithm of its count), at unit length, projected. No words: zeros."""
    places = len(matrix)
    place = w.hashes >> np.uint64(64 - (places.bit_length() - 1))
    held, count = np.unique(w.doc * places + place.astype(np.int64), return_counts=True)
    doc, place, weight = held // places, held % places, 1 + np.log(count)
    size = np.sqrt(np.bincount(doc, weight * weight, minlength=texts))
    sums = [np.bincount(doc, weight * matrix[place, k], minlength=texts) for k in range(matrix.shape[1])]
    return np.stack(sums, axis=1) / np.where(size > 0, size, 1)[:, None]


def hilbert(axes: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """The place of each point on the curve through a cube of ``bits`` bits a side (bits x dimensions < 64).

    Axes are turned into the curve's own, cube by cube from the largest, then Gray-coded and their bits interleaved.
    """
    x = [a.astype(np.int64) for a in axes]
    side = 1 << bits - 1
    while side > 1:
        low = side - 1
        for k in range(len(x)):
            upper = (x[k] & side) > 0
            swap = np.where(upper, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
        side >>= 1
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn, side = np.zeros_like(x[0]), 1 << bits - 1
    while side > 1:
        turn = np.where((x[-1] & side) > 0, turn ^ (side - 1), turn)
        side >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for a in x:
            key = key << 1 | ((a ^ turn) >> bit & 1)
    return key


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, row, start, doc_tokens, ids, x0..: each document's ids with the end id, and its projection.

    Long documents have a row for every ``CHUNK`` ids, so no row grows with a text. ``row`` is a number of the
    document's own. Ids take two bytes where the vocabulary allows it, else four.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, matrix = encoding.encoder(path, words_only=True), projection()
        kind = _kind(encoder.encode.library.get_vocab_size(), end_id)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in encoding.groups(batch.column(1)):
                w, entries, _ = encoder.entries(batch.column(1)[a:b])
                data, at = encoder.arena.take(entries)
                ends = at[w.first[1:]]
                ids = np.insert(data, ends, end_id).astype(kind)
                size = np.diff(ends, prepend=0) + 1
                first = np.cumsum(size) - size
                chunks = -(-size // CHUNK)
                doc = np.repeat(np.arange(b - a), chunks)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * CHUNK
                offsets = np.append(first[doc] + start, len(ids)) * ids.itemsize
                blobs = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
                axes = projected(w, b - a, matrix)[doc]
                columns = [batch.column(0)[a:b].take(pa.array(doc)), *map(pa.array, (row + doc, start, size[doc])), blobs, *(pa.array(axes[:, k]) for k in range(DIMS))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "start", "doc_tokens", "ids", *AXES])
                row += b - a

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id bigint, row bigint, start bigint, doc_tokens bigint, ids binary, {', '.join(f'{x} double' for x in AXES)}")


def _kind(size: int, end_id: int) -> str:
    """How ids are held: two bytes where they are enough."""
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def curve_key(centre: list[float], width: list[float]) -> Column:
    """The Hilbert key of the projections, spread evenly over the cube by their mean and deviation over all documents."""

    def key(*axes):
        import pandas as pd

        cells = []
        for x, c, d in zip(axes, centre, width, strict=True):
            share = 1 / (1 + np.exp(-1.702 * (x.to_numpy() - c) / (d or 1.0)))  # about the normal distribution's
            cells.append(np.minimum(share * (1 << BITS), (1 << BITS) - 1).astype(np.int64))
        return pd.Series(hilbert(cells))

    return F.pandas_udf(key, LongType())(*AXES)


class Layer:
    """Lays documents one after another into sequences of ``size`` tokens, and gives rows of pieces."""

    def __init__(self, part: int, size: int):
        self.size, self.next = size, part << 32
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the sequence that is not full yet
        self.used = 0
        self.rows: list[tuple] = []

    def close(self) -> None:
        offset = 0
        for doc, start, ids, total in self.open:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids), total, self.next, offset))
            offset += len(ids)
        self.open, self.used = [], 0
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray, start: int, total: int) -> None:
        at = 0
        while at < len(ids):
            part = ids[at : at + self.size - self.used]
            self.open.append((doc, start + at, part, total))
            self.used += len(part)
            at += len(part)
            if self.used == self.size:
                self.close()

    def end(self) -> None:
        """What is left, in sequences of powers of two tokens."""
        rest, left, size = self.open, self.used, self.size
        self.open, self.used = [], 0
        for doc, start, ids, total in rest:
            at = 0
            while at < len(ids):
                self.size = 1 << left.bit_length() - 1 if not self.used else self.size
                part = ids[at : at + self.size - self.used]
                self.open.append((doc, start + at, part, total))
                self.used += len(part)
                at += len(part)
                if self.used == self.size:
                    left -= self.size
                    self.close()
        self.size = size

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(PIECE))], names=PIECE)


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def laid(ordered: DataFrame, kind: str, size: int = SIZE) -> DataFrame:
    """The pieces of ``ordered`` (doc_id, start, doc_tokens, ids; sorted within its partitions), each partition packed by itself."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layer = Layer(TaskContext.get().partitionId(), size)
        for batch in batches:
            for doc, start, total, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3), strict=True):
                layer.add(doc, np.frombuffer(ids.as_buffer(), kind).astype("<u4"), start, total)
            yield layer.taken()
        layer.end()
        yield layer.taken()

    return ordered.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(lay, ", ".join(f"{c} bigint" for c in PIECE))


def packed(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document.

    A null or empty text is the end id alone. Equal keys (copies, texts without words) are in the order of doc_id and
    row, and as many of them as there may be are dealt over several parts. Rows that repeat or have no doc_id are
    documents of their own; a text of any length is cut where sequences end. Other columns are not looked at; an empty
    table gives an empty one.
    """
    spark, since = docs.sparkSession, mark()
    held = stored(tokenized(docs, path, end_id))
    sums = held.agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)), *(f(x) for x in AXES for f in (F.avg, F.stddev_pop))).first()
    centre, width = ([float(x or 0) for x in sums[k::2]] for k in (1, 2))
    n = max(1, -(-int(sums[0]) // PART_BYTES))
    keyed = held.select("doc_id", "row", "start", "doc_tokens", "ids", curve_key(centre, width).alias("key"))
    order = ["key", "doc_id", "row", "start"]
    until, kind = mark(), _kind(encoding.Library(path).library.get_vocab_size(), end_id)
    out = stored(laid(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order), kind, size))
    discard(spark, since, until)
    return out


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), encoding.vocabulary(encoding.WORDS))
