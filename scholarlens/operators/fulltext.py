"""Ranked full-text search over stored postings of stems.

Postings are stored in segments, one for each batch of documents, as partitions by bucket of the term and sorted by
term within files: a search reads the buckets of its terms, and of their files the row groups that hold these terms.
A document that is replaced or removed is listed as gone from the segment that had it; ``compact`` makes one segment
of all. Documents are dealt over tasks by their key, in bounded portions, and each task has a file in every bucket: so a
term that every document has lies in as many files as there are portions (``files`` at least).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from scholarlens.functions import stem
from scholarlens.sources.keyed import Files, KeyedTable

#: Saturation of a term's frequency, and weight of a document's length, in the rank (BM25).
K1, B = 1.2, 0.75
#: The bucket of a segment that holds the sizes of its documents; bytes of text and postings of a task, at most about.
SIZES, TEXT, POSTS = -1, 8 << 20, 1_000_000


class FullTextIndex:
    """An index below ``root`` of documents by ``key`` (a field of their schema)."""

    def __init__(self, spark: SparkSession, root: str, key: StructField, buckets: int = 64, files: int = 1):
        self.spark, self.root, self.key, self.buckets, self.files = spark, root.rstrip("/"), key.name, buckets, files
        born, size = StructField("born", StringType()), StructField("size", IntegerType())
        self._postings = StructType([StructField("term", StringType()), key, StructField("tf", LongType()), size, born, StructField("segment", StringType()), StructField("bucket", IntegerType())])
        self._gone = StructType([key, born, StructField("segment", StringType())])
        counts = [StructField(c, LongType()) for c in ("docs", "words", "gone_docs", "gone_words")]
        self.segments = KeyedTable(spark, f"{self.root}/segments", StructType([StructField("segment", StringType()), *counts]), "segment", buckets=1)
        self.documents = KeyedTable(spark, f"{self.root}/documents", StructType([key, size, born]), key.name, buckets=buckets, files=files)

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _path(self, kind: str, segment: str) -> str:
        return f"{self.root}/{kind}/segment={segment}"

    def live(self) -> list[str]:
        return [r.segment for r in self.segments.read().select("segment").collect()]

    def add(self, rows: DataFrame, stream: str | None = None, number: int = 0) -> None:
        """Indexes ``rows`` (key, text), in place of documents with their keys; a null text has no words.

        Rows without a key are left out; a key that repeats counts once. A batch of a stream counts once too: its
        segment bears its number, and is written again only if it was not listed before a failure.
        """
        name = self._name(stream, number)
        new = name not in self.live()
        if new:
            self._index(rows.where(F.col(self.key).isNotNull()).select(self.key, "text"), name)
        self._list(self._stored("postings", self._postings, [name]).where(F.col("bucket") == SIZES).select(self.key, "size"), name, new)

    def remove(self, keys: DataFrame, stream: str | None = None, number: int = 0) -> None:
        """Takes documents out of the index."""
        name = self._name(stream, number)
        self._list(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), name, name not in self.live())

    @staticmethod
    def _name(stream: str | None, number: int) -> str:
        return uuid.uuid4().hex if stream is None else f"{stream}-{number:012d}"

    def _list(self, known: DataFrame, name: str, new: bool) -> None:
        """Lists a segment and its documents: ``known`` are their keys, with sizes if they were indexed."""
        indexed = "size" in known.columns
        if new:
            old = self.documents.lookup(known)
            old.select(self.key, "born").write.mode("overwrite").parquet(self._path("gone", name))
            gone = old.agg(F.count("*").alias("gone_docs"), F.coalesce(F.sum("size"), F.lit(0)).alias("gone_words"))
            held = known.agg(F.count("*").alias("docs"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")) if indexed else self.spark.range(1).select(F.lit(0).cast("bigint").alias("docs"), F.lit(0).cast("bigint").alias("words"))
            self.segments.merge(held.crossJoin(gone).select(F.lit(name).alias("segment"), "*"), lambda old, new: old.unionByName(new))  # one row each
        if indexed:
            sizes = known.withColumn("born", F.lit(name))
            self.documents.merge(sizes, lambda old, new: old.join(new, self.key, "left_anti").unionByName(new))
        else:
            self.documents.merge(known, lambda old, new: old.join(new, self.key, "left_anti"))

    def _index(self, rows: DataFrame, name: str) -> None:
        """One shuffle, of the texts by key: the words of a document are counted where it is. Each document has a row in bucket SIZES too."""
        size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
        known = rows.repartition(max(self.files, -(-size // TEXT)), self.key).groupBy(self.key).agg(F.max("text").alias("text"))
        found = known.select(self.key, stem.words(F.coalesce("text", F.lit(""))).alias("w"))
        found = found.select(self.key, F.size("w").alias("size"), F.explode(F.concat(F.array(F.lit(None).cast("string")), "w")).alias("w"))
        counted = found.select(self.key, "size", stem.stem(F.col("w")).alias("term")).groupBy(self.key, "size", "term").agg(F.count("*").alias("tf"))
        self._write(counted.withColumn("born", F.lit(name)), name)

    def _write(self, rows: DataFrame, name: str) -> None:
        """Writes each task's rows, sorted: it has a file in every bucket."""
        dealt = rows.withColumn("bucket", F.when(F.col("term").isNull(), SIZES).otherwise(self._bucket(F.col("term"))))
        dealt.sortWithinPartitions("bucket", "term", self.key).select("term", self.key, "tf", "size", "born", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._path("postings", name))

    def _stored(self, kind: str, schema: StructType, live: list[str]) -> DataFrame:
        files = Files(self.spark, f"{self.root}/{kind}")
        held = set(files.names(""))
        paths = [self._path(kind, s) for s in live if f"segment={s}" in held]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def terms(self, text: str) -> dict[str, int]:
        """The distinct stems of a query, with their buckets."""
        one = self.spark.range(1).select(F.explode(F.array_distinct(F.transform(stem.words(F.lit(text)), stem.stem))).alias("term"))
        return {r.term: r.bucket for r in one.select("term", self._bucket(F.col("term")).alias("bucket")).collect()}

    def postings(self, terms: dict[str, int] | None = None) -> DataFrame:
        """term, key, tf, size, born of documents that are there, of some terms or of all."""
        live = self.live()
        rows = self._stored("postings", self._postings, live)
        if terms is not None:
            rows = rows.where(F.col("bucket").isin(sorted(set(terms.values()))) & F.col("term").isin(sorted(terms)))
        else:
            rows = rows.where(F.col("bucket") != SIZES)
        gone = self._stored("gone", self._gone, live).select(self.key, "born")
        return rows.select("term", self.key, "tf", "size", "born").join(gone, [self.key, "born"], "left_anti")

    def search(self, text: str, k: int | None = 10, every: bool = True) -> DataFrame:
        """key, matched, score of the ``k`` documents (None: all) that rank first for a query; ties by key.

        Documents have every word of the query, or with ``every`` False any. The rank is BM25 over the documents that
        are there. A query without words finds nothing.
        """
        terms = self.terms(text)
        found = self.postings(terms)
        stats = self.segments.read().agg(F.sum(F.col("docs") - F.col("gone_docs")).alias("n"), F.sum(F.col("words") - F.col("gone_words")).alias("w")).first()
        n, mean = stats.n or 0, max(1.0, (stats.w or 0) / max(1, stats.n or 0))
        df = F.broadcast(found.groupBy("term").agg(F.count("*").alias("df")))  # a row for each word of the query
        idf = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        score = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / mean))
        ranked = found.join(df, "term").groupBy(self.key).agg(F.count("*").alias("matched"), F.sum(score).alias("score"))
        if every:
            ranked = ranked.where(F.col("matched") == len(terms))
        return ranked if k is None else ranked.orderBy(F.desc("score"), self.key).limit(k)

    def compact(self) -> None:
        """All that is there as one segment. Batches that arrive meanwhile keep theirs; older segments stay until ``expire``."""
        live, name = self.live(), uuid.uuid4().hex
        rows = self._stored("postings", self._postings, live).where(F.col("bucket") != SIZES).drop("bucket", "segment")
        gone = self._stored("gone", self._gone, live).groupBy(F.col(self.key).alias("_key")).agg(F.collect_set("born").alias("_borns"))
        # All of a document meets in one task, so one shuffle is enough to leave out what is gone and to write.
        dealt = rows.repartition(max(self.files, -(-rows.count() // POSTS)), self.key)
        self._write(dealt.join(gone, (F.col(self.key) == F.col("_key")) & F.array_contains("_borns", F.col("born")), "left_anti"), name)
        counted = self.segments.read().where(F.col("segment").isin(live)).agg(F.lit(name).alias("segment"), F.sum(F.col("docs") - F.col("gone_docs")).alias("docs"), F.sum(F.col("words") - F.col("gone_words")).alias("words"), F.lit(0).cast("bigint").alias("gone_docs"), F.lit(0).cast("bigint").alias("gone_words"))
        self.segments.merge(counted, lambda old, new: old.where(~F.col("segment").isin(live)).unionByName(new))

    def expire(self) -> int:
        """Removes segments that are no longer listed, and versions of the lists; run it when no batch is being added."""
        live, removed = set(self.live()), 0
        for kind in ("postings", "gone"):
            files = Files(self.spark, f"{self.root}/{kind}")
            for name in files.names(""):
                if name.removeprefix("segment=") not in live:
                    files.delete(name)
                    removed += 1
        return removed + self.segments.expire(1) + self.documents.expire(1)
