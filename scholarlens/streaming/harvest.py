"""State of a harvest as streams: sources that are paused after failures in a row, and arrivals that count once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scholarlens.functions import extract

#: Failures in a row, for want of a network, after which a source is paused.
MOST_ERRORS = 20
STATE = "source string, consecutive bigint, pauses bigint, is_paused boolean, pause_reason string, at timestamp"


class Pauses(StatefulProcessor):
    """For each source: failures in a row, pauses so far, and the reason of the present one."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "consecutive bigint, pauses bigint, reason string, at timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(rows).sort_values(["at", "key"], kind="stable")
        consecutive, pauses, reason, at = self.state.get() if self.state.exists() else (0, 0, None, None)
        for network in found["network"]:
            if not network:
                consecutive, reason = 0, None
                continue
            consecutive += 1
            if consecutive == self.most:
                pauses, reason = pauses + 1, f"Network disconnected - {self.most} consecutive failures"
        last = found["at"].iloc[-1].to_pydatetime()
        at = last if at is None or last > at else at
        self.state.update((consecutive, pauses, reason, at))
        yield pd.DataFrame({"source": [key[0]], "consecutive": [consecutive], "pauses": [pauses], "is_paused": [reason is not None], "pause_reason": [reason], "at": [at]})

    def close(self) -> None:
        pass


def pauses(attempts: DataFrame, most: int = MOST_ERRORS) -> DataFrame:
    """source, consecutive, pauses, is_paused, pause_reason, at: the state of each source that a batch names, after it.

    ``attempts`` is a stream of source, key, at, ok, error; those of a source are counted in the order of time and key
    within a batch, and batch after batch. A success, or a failure of another kind, ends the row of failures and the
    pause. A source's attempts of one batch are held by one task; a batch is bounded by its files. The state is kept by
    RocksDB, which this sets for the session.
    """
    spark = attempts.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    network = ~F.coalesce("ok", F.lit(False)) & extract.is_network_error(F.col("error"))
    rows = attempts.select("source", "key", F.col("at").cast("timestamp").alias("at"), network.alias("network"))
    return rows.groupBy("source").transformWithStateInPandas(Pauses(most), STATE, "Update", "None")


def last_states(spark: SparkSession, folder: str) -> DataFrame:
    """The last state of every source, from the states that batches wrote to ``folder``/batch=n."""
    rows = spark.read.schema(f"{STATE}, batch bigint").option("basePath", folder).parquet(folder)
    return rows.groupBy("source").agg(F.max_by(F.struct("consecutive", "pauses", "is_paused", "pause_reason", "at"), "batch").alias("s")).select("source", "s.*")


def arrivals(stream: DataFrame, key: str = "url", at: str = "at", delay: str = "1 day") -> DataFrame:
    """Rows of a stream, each key once, across batches: those that come again within ``delay`` and those later than it are left out.

    The keys are state for as long as ``delay`` after the newest row, so the state does not grow with the stream.
    """
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
