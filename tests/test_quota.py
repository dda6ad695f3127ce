"""A model's quota: no call follows the error, the rows that are left stay pending, and the next run finishes."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarlens.operators import embedding
from scholarlens.sources.keyed import KeyedTable

SCHEMA = "url string, title string, embedding array<float>"


def model(folder, quota, wait=0.0):
    """A model that notes its calls in a folder, and raises once it has ``quota``."""

    def embed(texts):
        name = f"{folder}/{time.time_ns()}-{os.getpid()}"
        with open(name, "x") as call:
            call.write("\n".join(texts))
        if len(os.listdir(folder)) > quota:
            raise embedding.QuotaExhausted("daily")
        time.sleep(wait)
        if "bad" in texts:
            raise ValueError("no")
        return np.ones((len(texts), 3), np.float32)

    return embed


@pytest.fixture
def table(spark, tmp_path):
    held = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, "url", 8)
    rows = [(f"u{k:03d}", "bad" if k == 5 else f"title {k}", [9.0] if k % 10 == 0 else None) for k in range(60)]
    held.merge(spark.createDataFrame(rows, SCHEMA), lambda _, new: new)
    return held


def test_no_call_follows(spark, tmp_path):
    """In one task: the calls end with the one that failed; nothing is sent after it."""
    (tmp_path / "calls").mkdir()
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(40)], "k int, t string").coalesce(1)
    stop = embedding.Stop(str(tmp_path / "stop"))
    got = embedding.embedded(rows, "t", model(tmp_path / "calls", 3), 5, stop).collect()
    assert len(os.listdir(tmp_path / "calls")) == 4
    assert [r.embedding is not None for r in got] == [True] * 15 + [False] * 25
    assert {r.error for r in got[15:]} == {"QuotaExhausted: daily"} == {stop.reason()}


def test_other_tasks_stop(spark, tmp_path):
    """Tasks that start after the mark call nothing; those that run then end with the call they are in."""
    (tmp_path / "calls").mkdir()
    rows = spark.range(64).select("id", F.col("id").cast("string").alias("t")).repartition(32)
    got = embedding.embedded(rows, "t", model(tmp_path / "calls", 6, 0.3), 1, embedding.Stop(str(tmp_path / "stop"))).collect()
    calls = len(os.listdir(tmp_path / "calls"))
    assert len(got) == 64 and calls <= 6 + 4  # four tasks run at a time
    assert 0 < sum(r.embedding is not None for r in got) <= 6


def test_the_next_run_finishes(spark, table, tmp_path):
    (tmp_path / "calls").mkdir()
    folder = str(tmp_path / "work")
    embed = model(tmp_path / "calls", 4)
    first = embedding.embed_pending(table, F.col("title"), embed, folder, batch=3)
    assert first["succeeded"] + first["failed"] + first["left"] == 54 and first["left"] > 0 and embedding.Stop(folder).reason()
    assert table.read().where("embedding IS NULL").count() == 54 - first["succeeded"]
    second = embedding.embed_pending(table, F.col("title"), model(tmp_path / "calls", 10**6), folder, batch=1)
    assert second["left"] == 0 and second["failed"] == 1 and embedding.Stop(folder).reason() is None
    left = table.read().where("embedding IS NULL").collect()
    assert [r.title for r in left] == ["bad"] and table.read().count() == 60
    assert table.read().where("embedding[0] = 9").count() == 6  # those that had one keep it
