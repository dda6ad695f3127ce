"""Tables in buckets of a key, with versions: a merge rewrites the buckets that a batch names, and nothing else.

Under the root of a table, ``data`` holds a folder for each merge with its buckets as Parquet, ``manifests`` a small
JSON document for each version (the merge that last wrote each bucket, and the last batch of every stream), and
``commits`` a file for each version's number, which names its manifest. That file is created only if there is none, so
of two writers one commits a number and the other tries again on top of it. A manifest has an entry for each bucket:
at most ``buckets``, whatever the rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKET = "_bucket"


class Files:
    """Small files below a folder that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a new file; False if there is one."""
        try:
            stream = self._fs.create(self.path(name), False)
        except Py4JJavaError:
            if self._fs.exists(self.path(name)):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def changed(self, name: str) -> float:
        """When a file was last changed, in seconds."""
        return self._fs.getFileStatus(self.path(name)).getModificationTime() / 1000


@dataclass
class Version:
    """Which merge's folder holds each bucket, and the last batch of each stream that is in the table."""

    number: int = -1
    buckets: dict[str, str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


class KeyedTable:
    """Rows of ``schema`` by ``key``, in ``buckets`` buckets of ``files`` files each.

    A row's bucket is a hash of its key; rows without one are spread by all their columns. ``spread`` gives another
    bucket, a function of the key. Choose ``buckets`` once, so that one of them is a few hundred megabytes.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, buckets: int = 64, files: int = 1, spread: Column | None = None):
        self.spark, self.root, self.schema, self.key, self.files = spark, root.rstrip("/"), schema, key, files
        self._files = Files(spark, root)
        anywhere = F.pmod(F.xxhash64(F.to_json(F.struct(*schema.names))), F.lit(buckets))  # maps have no hash
        named = F.pmod(F.xxhash64(key), F.lit(buckets)) if spread is None else spread
        self._bucket = F.when(F.col(key).isNull(), anywhere).otherwise(named).cast("int")

    def versions(self) -> list[int]:
        return [int(name) for name in self._files.names("commits")]

    def version(self, number: int | None = None) -> Version:
        """A version, the last one unless its number is given. A number whose writer failed at once is passed over."""
        for known in [number] if number is not None else reversed(self.versions()):
            manifest = self._files.read(f"commits/{known:012d}")
            if manifest:
                held = json.loads(self._files.read(f"manifests/{manifest}.json"))
                return Version(known, held["buckets"], held["streams"])
        return Version()

    def read(self, version: Version | None = None, buckets: Iterable[str] | None = None, bucket: bool = False) -> DataFrame:
        """Rows of a version (the last one), of all its buckets or of some: no other file is looked at.

        With ``bucket`` there is a column _bucket too, a partition column: a filter on it leaves files unread.
        """
        version = version or self.version()
        chosen = version.buckets if buckets is None else [b for b in map(str, buckets) if b in version.buckets]
        paths = [f"{self.root}/data/{version.buckets[b]}/{BUCKET}={b}" for b in chosen]
        schema = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())]) if bucket else self.schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return (reader.option("basePath", f"{self.root}/data").parquet(*paths).drop("merge") if bucket else reader.parquet(*paths))

    def named_buckets(self, rows: DataFrame) -> list[str]:
        """Buckets of the rows' keys, at most as many as the table has; ``rows`` need only the key unless it is null."""
        bucketed = self._with_bucket(rows)
        return sorted(str(r[0]) for r in bucketed.select(BUCKET).distinct().collect())

    def _with_bucket(self, rows: DataFrame) -> DataFrame:
        missing = {c: F.lit(None).cast(self.schema[c].dataType) for c in self.schema.names if c not in rows.columns}
        return rows.withColumns(missing).withColumn(BUCKET, self._bucket) if missing else rows.withColumn(BUCKET, self._bucket)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with one of ``keys``, read from the buckets of these keys."""
        return self.read(buckets=self.named_buckets(keys)).join(keys.select(self.key).distinct(), self.key, "left_semi")

    def merge(self, batch: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], stream: str | None = None, number: int = 0, touched: Iterable[str] | None = None) -> bool:
        """``how(old, batch)`` as the new rows of the buckets that ``batch`` names (and of ``touched``); False if it was merged before.

        ``how`` sees the old rows of these buckets only, so it must be a merge on the key. ``number`` counts the
        batches of ``stream`` upwards; one that the table has already is left out. A writer that commits in between is
        built upon: where it wrote other buckets, its version and this one are joined; otherwise the merge is redone.
        """
        named = sorted({*self.named_buckets(batch), *map(str, touched or ())})
        while True:
            base = self.version()
            if stream is not None and base.streams.get(stream, -1) >= number:
                return False
            folder = f"merge=m-{uuid.uuid4().hex}"
            self._write(how(self.read(base, named), batch).select(self.schema.names), folder)
            written = [n.split("=")[1] for n in self._files.names(f"data/{folder}") if n.startswith(f"{BUCKET}=")]
            while True:
                now = self.version()
                if stream is not None and now.streams.get(stream, -1) >= number:
                    self._files.delete(f"data/{folder}")
                    return False
                if any(now.buckets.get(b) != base.buckets.get(b) for b in {*named, *written}):
                    self._files.delete(f"data/{folder}")
                    break
                kept = {b: f for b, f in now.buckets.items() if b not in named}
                streams = now.streams | ({stream: number} if stream is not None else {})
                if self._commit(kept | dict.fromkeys(written, folder), streams):
                    return True

    def _write(self, rows: DataFrame, folder: str) -> None:
        places = [BUCKET] if self.files == 1 else [BUCKET, F.pmod(F.xxhash64(F.lit("file"), self.key), F.lit(self.files))]
        self._with_bucket(rows).repartition(*places).write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")

    def _commit(self, buckets: dict[str, str], streams: dict[str, int]) -> bool:
        manifest = uuid.uuid4().hex
        self._files.create(f"manifests/{manifest}.json", json.dumps({"buckets": buckets, "streams": streams}))
        if self._files.create(f"commits/{max(self.versions(), default=-1) + 1:012d}", manifest):
            return True
        self._files.delete(f"manifests/{manifest}.json")
        return False

    def expire(self, keep: int = 2, older_than: float = 86_400) -> int:
        """Removes what only versions before the last ``keep`` hold, and what writers that failed left; the folders and buckets removed.

        Folders younger than ``older_than`` seconds that no version names may belong to a merge that is running, and stay.
        """
        known = [v for n in self.versions() if (v := self.version(n)).number >= 0]
        kept, gone = known[-keep:], known[:-keep]
        live = {(f, b) for v in kept for b, f in v.buckets.items()}
        folders, removed = {f for f, _ in live}, 0
        named = {(f, b) for v in known for b, f in v.buckets.items()}
        ours = {f for f, _ in named}
        for f, b in sorted(named - live):
            if f in folders:
                self._files.delete(f"data/{f}/{BUCKET}={b}")
                removed += 1
        for f in self._files.names("data"):
            if f not in folders and (f in ours or self._files.changed(f"data/{f}") < time.time() - older_than):
                self._files.delete(f"data/{f}")
                removed += 1
        for v in gone:
            manifest = self._files.read(f"commits/{v.number:012d}")
            self._files.delete(f"commits/{v.number:012d}")
            self._files.delete(f"manifests/{manifest}.json")
        return removed
