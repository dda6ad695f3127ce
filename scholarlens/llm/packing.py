"""Best-fit packing of token sequences by exact-complement hashing.

Only the number of pieces of each length matters for the plan, so it is made from a histogram of at most ``size``
entries, whatever the corpus. A plan is a list of patterns (lengths of one sequence) and how often each is used; a
pattern is used as often as the counts allow, so each one exhausts a length and their number stays bounded too.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import encoding
from .common import compact, finished, mark, table

SIZE, END_ID = 4096, 1
#: Pieces of one length in a ranking group, about; longer lists of a length are salted into several.
GROUP = 1000


class Stock:
    """Available lengths: counts, and two bit sets that answer "which two lengths sum to g" in one shift."""

    def __init__(self, counts: dict[int, int], size: int):
        self.size, self.count = size, {k: v for k, v in counts.items() if v > 0}
        self.bits = sum(1 << k for k in self.count)
        self.mirror = sum(1 << size - k for k in self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.bits ^= 1 << length
            self.mirror ^= 1 << self.size - length

    def largest(self, most: int) -> int:
        """The largest length up to ``most``, 0 if none."""
        return (self.bits & (1 << most + 1) - 1).bit_length() - 1 if most > 0 and self.bits & (1 << most + 1) - 1 else 0

    def enough(self, pattern: tuple[int, ...]) -> int:
        return min(self.count.get(k, 0) // n for k, n in Counter(pattern).items())

    def pair(self, total: int, used: tuple[int, ...]) -> tuple[int, ...]:
        """The pair with the largest member that sums to ``total``."""
        if total < 2:
            return ()
        both = self.bits & self.mirror >> self.size - total
        while both:
            a = both.bit_length() - 1
            if self.enough((*used, a, total - a)):
                return (a, total - a)
            both ^= 1 << a
        return ()

    def filling(self, gap: int, used: tuple[int, ...]) -> tuple[int, ...]:
        """One, two or three available lengths that sum to ``gap`` exactly."""
        if self.count.get(gap) and self.enough((*used, gap)):
            return (gap,)
        if found := self.pair(gap, used):
            return found
        a = self.largest(gap - 2)
        while a * 3 >= gap:
            if self.enough((*used, a)) and (found := self.pair(gap - a, (*used, a))):
                return (a, *found)
            a = self.largest(a - 1)
        return ()


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(((length, copies), ...), times)]: exact fillings first, then best fit for what is left."""
    stock, out = Stock(counts, size), []

    def use(pattern: tuple[int, ...]) -> None:
        runs, times = Counter(pattern), stock.enough(pattern)
        for k, n in runs.items():
            stock.take(k, n * times)
        out.append((tuple(sorted(runs.items(), reverse=True)), times))

    if stock.count.get(size):
        use((size,))
    length = stock.largest(size - 1)
    while length:
        while stock.count.get(length) and (rest := stock.filling(size - length, (length,))):
            use((length, *rest))
        length = stock.largest(length - 1)
    while stock.count:
        pattern, gap = [stock.largest(size)], size - stock.largest(size)
        left = Counter({pattern[0]: 1})
        while (k := stock.largest(gap)):
            while k and not (copies := min(stock.count[k] - left[k], gap // k)):
                k = stock.largest(k - 1)
            if not k:
                break
            pattern += [k] * copies
            left[k] += copies
            gap -= k * copies
        use(tuple(pattern))
    return out


def slots(patterns: list) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, the ranges of its pieces' ranks: first rank, first sequence, copies in a sequence, offset."""
    found, ranks, sequence = defaultdict(list), Counter(), 0
    for runs, times in patterns:
        offset = 0
        for length, copies in runs:
            found[length].append((ranks[length], sequence, copies, offset))
            ranks[length] += times * copies
            offset += length * copies
        sequence += times
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for k, v in found.items()}


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces (null text: empty)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoding.encoder(path, words_only=True), np.array([end_id], np.uint32)
        for batch in batches:
            ids, texts, doc = batch.column(0), batch.column(1), []
            piece, start, length, crc = [], [], [], []
            for a, b in encoding.groups(texts):
                for i, found in enumerate(encode.ids(texts[a:b]), a):
                    found = np.concatenate([found, end])
                    for k in range(0, len(found), size):
                        part = found[k : k + size]
                        doc.append(i)
                        piece.append(k // size)
                        start.append(k)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (stored pieces) with sequence_id and offset.

    The histogram of lengths (at most ``size`` rows) and the plan made from it are all that the driver sees. Ranks
    within a length are counted in salted groups, so that a length shared by many pieces is no single group.
    """
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = slots(plan(counts, size))
    salts = cut.sparkSession.createDataFrame([(k, -(-n // GROUP)) for k, n in counts.items()], "length bigint, salts bigint")
    # At most ``size`` rows, so the broadcast is bounded.
    salted = cut.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), "salts")).select(*cut.columns, "salt")
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))

    names = [*cut.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length).tolist():
                mine = np.flatnonzero(length == k)
                first, base, copies, start = where[k]
                at = np.searchsorted(first, rank[mine], side="right") - 1
                turn, copy = np.divmod(rank[mine] - first[at], copies[at])
                sequence[mine], offset[mine] = base[at] + turn, start[at] + copy * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.select(*cut.columns, "rank").mapInArrow(place, schema)


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null or empty text is the end id alone. Rows that repeat or have no doc_id are documents of their own; equal
    lengths take their places in the order of doc_id and piece. Other columns are not looked at; an empty table gives
    an empty one.
    """
    since = mark()
    return finished(pack(compact(pieces(docs, encoding.vocabulary(encoding.WORDS)))), since)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
