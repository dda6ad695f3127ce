"""What the operators share: tables, durable intermediate tables, and sizes."""

from __future__ import annotations

import threading
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.sources import tables
from scholarlens.sources.tables import importable, shared_folder

__all__ = ["clear", "compact", "discard", "finished", "fresh", "mark", "prepared", "stored", "table", "text_bytes"]


#: Rows and bytes of a batch that goes to Python: whole texts are held there and in the JVM's native memory.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepared(spark: SparkSession) -> None:
    """Lets workers import this library, and bounds Arrow batches by bytes as texts may be long."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return tables.table(spark, sf_dir, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class _Made(threading.local):
    """Folders of tables that a thread has stored and not removed yet, in the order of their making."""

    def __init__(self):
        self.paths: list[str] = []


_made = _Made()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/scholarlens/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def mark() -> int:
    """How many tables are stored now; ``finished`` removes those made since."""
    return len(_made.paths)


def discard(spark: SparkSession, since: int, until: int | None = None) -> None:
    """Removes the tables that were stored between two marks, once nothing reads them any more."""
    for path in _made.paths[since:until]:
        _remove(spark, path)
        _made.paths.remove(path)


def clear(spark: SparkSession) -> None:
    """Removes all that this application has stored, once its results have been written elsewhere."""
    _remove(spark, f"{shared_folder(spark)}/scholarlens/{spark.sparkContext.applicationId}")
    _made.paths.clear()


def compact(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``stored`` in files of about ``rows`` rows, however many tasks compute it.

    The tasks' results are kept on the executors' disks only until the files are written from them.
    """
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        return stored(held.coalesce(held.count() // rows + 1))
    finally:
        held.unpersist()


def finished(df: DataFrame, since: int, rows: int = 1_000_000) -> DataFrame:
    """``df`` stored in files of about ``rows`` rows, and every table that was stored for it removed."""
    until = len(_made.paths)
    out = compact(df, rows)
    discard(df.sparkSession, since, until)
    return out


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, from one pass over that column."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])
