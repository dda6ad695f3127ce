"""Pauses and arrivals across micro-batches and restarts."""

import random

from pyspark.sql import functions as F

from scholarlens.streaming import harvest, ingest

ATTEMPT = "source string, key string, ok boolean, error string, at timestamp"


def land(spark, folder, rows):
    df = spark.createDataFrame([(s, k, ok, e) for s, k, ok, e, _ in rows], "source string, key string, ok boolean, error string")
    at = spark.createDataFrame([(k, t) for _, k, _, _, t in rows], "key string, t int")
    df.join(at, "key").withColumn("at", F.timestamp_seconds("t")).select("source", "key", "ok", "error", "at").coalesce(1).write.mode("append").parquet(folder)


def test_pauses(spark, tmp_path):
    """Each source's failures in a row, over batches that start again; other failures, successes and null errors end them."""
    rng, attempts = random.Random(1), {"a": [], "b": [], "c": []}
    for n in range(4):
        rows = []
        for source, tries in attempts.items():
            for _ in range(rng.randrange(0, 12) if n else 6):
                kind = rng.choices(["net", "ok", "other", "null"], [12, 1, 1, 1])[0]
                row = (source, f"k{len(tries):04d}{source}", kind == "ok", {"net": "x net::ERR_NAME", "ok": None, "other": "Timeout", "null": None}[kind], n * 1000 + len(tries))
                tries.append(kind)
                rows.append(row)
        rng.shuffle(rows)
        land(spark, str(tmp_path / "in"), rows)
        stream = ingest.parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], ATTEMPT).schema, 1)
        ingest.caught_up(harvest.pauses(stream, 5), str(tmp_path / "state"), lambda batch, number: batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={number}")))
    want = {}
    for source, tries in attempts.items():
        row = pauses = 0
        for kind in tries:
            row = row + 1 if kind == "net" else 0
            pauses += row == 5
        want[source] = (row, pauses, row >= 5, "Network disconnected - 5 consecutive failures" if row >= 5 else None)
    got = {r.source: (r.consecutive, r.pauses, r.is_paused, r.pause_reason) for r in harvest.last_states(spark, str(tmp_path / "out")).collect()}
    assert got == want and any(v[1] for v in got.values())


def test_arrivals(spark, tmp_path):
    """A key that comes again within the delay counts once, also after a restart; what comes later than it is left out."""
    def arrive(*rows):
        df = spark.createDataFrame(list(rows), "url string, t int").select("url", F.timestamp_seconds("t").alias("at"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = harvest.arrivals(ingest.parquet_stream(spark, str(tmp_path / "in"), df.schema, 1), delay="100 seconds")
        ingest.caught_up(stream, str(tmp_path / "state"), lambda batch, number: batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch={number}")))
        return sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert arrive(("a", 1000), ("a", 1001), ("b", 1000)) == ["a", "b"]
    assert arrive(("a", 1050), ("c", 1100)) == ["a", "b", "c"]
    assert arrive(("late", 900), ("d", 1010), ("c", 1120)) == ["a", "b", "c", "d"]
    assert arrive(("e", 2000)) == ["a", "b", "c", "d", "e"]
    assert arrive(("a", 1950), ("e", 2050)) == ["a", "a", "b", "c", "d", "e"]  # long after: a new arrival
