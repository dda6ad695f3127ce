"""Token ids in binary files of directly addressable codes, in ascending order of doc_id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dac, encoding
from .common import compact, stored, table, text_bytes

#: Bytes of text in a part, about.
PART_BYTES = 16_000_000
#: Rows of the file format: one for each segment of consecutive documents of a part. ``codes`` is a blob of ``dac``.
SEGMENT = "part int, segment int, doc_ids array<bigint>, lengths array<bigint>, first bigint, n_tokens bigint, codes binary"
SEGMENT_BYTES = 4_000_000


def segments(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Range-partitioned, sorted documents as encoded segments (null text: empty, so the end id alone).

    Equal doc_ids (repeated rows) stay next to each other, in the order of a hash of their texts; null doc_ids come first. A text of any
    length is in one segment; an empty table has none. Other columns are not looked at.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding.encoder(path)
        part, at, first = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in encoding.groups(texts, SEGMENT_BYTES):
                found = encode.ids(texts[a:b])
                lengths = np.array([len(x) + 1 for x in found], dtype=np.int64)
                tokens = np.concatenate([x for ids_of_one in found for x in (ids_of_one, end)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([at], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids[a:b]),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.array(lengths)),
                        pa.array([first], pa.int64()),
                        pa.array([len(tokens)], pa.int64()),
                        pa.array([dac.encode(tokens)], pa.binary()),
                    ],
                    names=["part", "segment", "doc_ids", "lengths", "first", "n_tokens", "codes"],
                )
                at, first = at + 1, first + len(tokens)

    n = max(1, -(-text_bytes(docs) // PART_BYTES))
    # By a hash of the text too, so rows without doc_id, or with the same, need not fit in one part.
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    return ordered.mapInArrow(write, SEGMENT)


def documents(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the segments.

    Only a token count for each part (a task of the writing stage) comes to the driver.
    """
    parts = sorted(store.groupBy("part").agg(F.sum("n_tokens")).collect())
    base, total = {}, 0
    for part, n in parts:
        base[part] = total
        total += n

    def local(segments: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in segments:
            for row in batch.to_pylist():
                tokens = dac.Reader(row["codes"]).all().astype("<u4")
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + (base[row["part"]] + row["first"])), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return store.select("part", "first", "doc_ids", "lengths", "codes").mapInArrow(local, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, place, token of each row of ``wanted`` (doc_id, place: from 0) that the store has.

    Each token is read by itself from the codes of its segment. A doc_id that repeats in the store has a row for each
    of its documents; a place that is null, negative or beyond the end has none, like a doc_id that is null or unknown.
    """
    before = F.expr("aggregate(slice(lengths, 1, k), 0L, (a, x) -> a + x)")
    rows = store.select("part", "segment", "lengths", F.posexplode("doc_ids").alias("k", "doc_id")).select("part", "segment", "doc_id", before.alias("from"), F.element_at("lengths", F.col("k") + 1).alias("length"))
    asked = wanted.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("place").cast("bigint").alias("place")).where("place >= 0")
    asked = asked.join(rows, "doc_id").where("place < length").select("part", "segment", "doc_id", "place", (F.col("from") + F.col("place")).alias("at"))

    def read(asks: pa.Table, segment: pa.Table) -> pa.Table:
        codes = dac.Reader(segment.column("codes")[0].as_py()) if asks.num_rows else None
        tokens = [codes[i] for i in asks.column("at").to_pylist()]
        return pa.table({"doc_id": asks.column("doc_id"), "place": asks.column("place"), "token": pa.array(tokens, pa.int64())})

    held = store.select(F.col("part").alias("of"), F.col("segment").alias("number"), "codes").groupBy("of", "number")
    return asked.groupBy("part", "segment").cogroup(held).applyInArrow(read, "doc_id bigint, place bigint, token bigint")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(segments(table(spark, sf_dir, "documents"), encoding.vocabulary(encoding.BYTE_LEVEL), end_id=2))
    return compact(documents(store))
