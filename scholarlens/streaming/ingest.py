"""Incremental ingestion: a file stream that stops when it has caught up, one merge for each micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession

from scholarlens.sources.keyed import KeyedTable


def caught_up(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], plans_ahead: bool = True) -> None:
    """Runs ``each`` on every micro-batch of what has arrived since ``checkpoint``, then returns.

    A batch that ran before a failure may run again, so ``each`` must be a merge or keyed by the batch's number. Sources
    written in Python cannot plan all batches ahead; for them the query runs until nothing is left.
    """
    known_by_stream(stream, checkpoint, lambda batch, number, _: each(batch, number), plans_ahead)


def parquet_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def merge_stream(source: DataFrame, table: KeyedTable, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Every micro-batch of the stream ``source`` merged into ``table`` by ``merge(old, batch)``; the table's rows then.

    A version of the table holds the number of the last batch that it has of each stream, so a batch that runs again
    after a failure is left out, and streams with checkpoints of their own add to the same table. A stream is known by
    its query's id, which lives in its checkpoint: with a lost checkpoint the files are read again under another id and
    merged again, over the rows that are there.
    """

    def write(batch: DataFrame, number: int, stream: str) -> None:
        held = batch.persist()
        try:
            table.merge(held, merge, stream, number)
        finally:
            held.unpersist()

    known_by_stream(source, checkpoint, write)
    return table.read()


def known_by_stream(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int, str], None], plans_ahead: bool = True) -> None:
    """``caught_up``, where ``each`` is also given the query's id, the same for all runs with this checkpoint."""
    known: Future[str] = Future()
    writer = stream.writeStream.foreachBatch(lambda batch, number: each(batch, number, known.result())).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if plans_ahead else writer).start()
    known.set_result(query.id)
    if plans_ahead:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def ingest_parquet(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Rows of ``source`` through ``transform`` into ``sink`` exactly once, and ``sink`` read back."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    caught_up(parquet_stream(spark, source, schema), checkpoint, write)
    return spark.read.parquet(sink)
