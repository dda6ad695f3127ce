"""Keyed tables: what a merge touches, streams that start again, writers that meet, and what is removed."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from scholarlens.operators import merge
from scholarlens.sources.keyed import KeyedTable
from scholarlens.streaming import ingest

SCHEMA = "url string, title string"


def upsert(old, new):
    return merge.upsert_research(old, new, [F.desc("title")])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


@pytest.fixture
def make(spark, tmp_path):
    def made(name="t", **more):
        return KeyedTable(spark, str(tmp_path / name), spark.createDataFrame([], SCHEMA).schema, "url", **more)

    return made


@pytest.fixture
def frame(spark):
    return lambda *some: spark.createDataFrame(list(some), SCHEMA)


def test_only_named_buckets_are_rewritten(make, frame, tmp_path):
    held = make(buckets=16)
    assert rows(held.read()) == [] and held.version().number == -1
    held.merge(frame(*[(f"u{k}", "old") for k in range(200)]), upsert)
    before, version = files(tmp_path / "t" / "data"), held.version()
    assert len(version.buckets) == 16
    batch = frame(("u3", "new"), ("n1", "new"))
    named = held.named_buckets(batch)
    held.merge(batch, upsert)
    after = held.version()
    assert {b for b in after.buckets if after.buckets[b] != version.buckets[b]} == set(named) and len(named) <= 2
    now = files(tmp_path / "t" / "data")
    assert {f: now[f] for f in before} == before  # nothing is written in place, and the rest not at all
    assert rows(held.read()) == sorted([("u3", "new"), ("n1", "new"), *[(f"u{k}", "old") for k in range(200) if k != 3]], key=str)
    assert rows(held.read(version)) == sorted([(f"u{k}", "old") for k in range(200)], key=str)
    found = held.lookup(frame(("u3", None), ("none", None)).select("url"))
    assert rows(found) == [("u3", "new")]
    assert len(found.inputFiles()) <= 2


def test_null_keys_and_files(make, frame, tmp_path):
    """Rows without a key are added, and spread; a bucket may have several files; an empty batch changes nothing."""
    held = make(buckets=4, files=3)
    add = lambda old, new: merge.merge(old, new, "url")
    held.merge(frame(*[(None, f"t{k}") for k in range(40)], ("a", "x")), add)
    held.merge(frame((None, "t1"), ("a", "y")), add)
    assert rows(held.read()) == sorted([("a", "y"), *[(None, f"t{k}") for k in range(40)], (None, "t1")], key=str)
    assert len(held.version().buckets) > 1
    before = held.version().buckets
    held.merge(frame(("a", "z")).limit(0), add)
    assert held.version().buckets == before


def test_rows_that_go(make, frame):
    held = make(buckets=4)
    held.merge(frame(("a", "1"), ("b", "2"), ("c", "3")), upsert)
    held.merge(frame(("a", None), ("b", None)), lambda old, new: old.join(new, "url", "left_anti"))
    assert rows(held.read()) == [("c", "3")]


def stream(spark, tmp_path, held, source, state, per_batch=1):
    return rows(ingest.merge_stream(ingest.parquet_stream(spark, str(tmp_path / source / "*"), held.schema, per_batch), held, str(tmp_path / state), upsert))


def test_streams_lose_nothing(spark, make, frame, tmp_path):
    """Two sources, a checkpoint that is lost, a batch that is replayed: each gives the union, every batch once."""
    land = lambda name, *some: frame(*some).coalesce(1).write.parquet(str(tmp_path / name))
    held = make(buckets=4)
    held.merge(frame(("o", "old")), upsert)
    land("one/1", ("a", "1"), ("c", "x"), ("c", "y"), (None, "z"))
    land("one/2", ("b", "1"))
    want = [("a", "1"), ("b", "1"), ("c", "y"), ("o", "old")]
    assert stream(spark, tmp_path, held, "one", "s1") == want == stream(spark, tmp_path, held, "one", "s1")
    known = held.version()
    assert len(known.streams) == 1 and list(known.streams.values()) == [1]
    land("two/1", ("d", "2"), ("a", "2"))
    want = [("a", "2"), ("b", "1"), ("c", "y"), ("d", "2"), ("o", "old")]
    assert stream(spark, tmp_path, held, "two", "s2") == want
    shutil.rmtree(tmp_path / "s2")
    assert stream(spark, tmp_path, held, "two", "s2") == want
    shutil.rmtree(tmp_path / "s1")
    land("one/3", ("e", "3"))
    assert [r for r in stream(spark, tmp_path, held, "one", "s1") if r[0] != "a"] == [*want[1:4], ("e", "3"), want[4]]
    assert len(held.version().streams) == 4


def test_a_batch_that_failed_before_its_offsets_were_kept(spark, make, frame, tmp_path):
    """The table has the batch, the checkpoint does not: it runs again and is left out."""
    frame(("a", "1")).coalesce(1).write.parquet(str(tmp_path / "in" / "1"))
    held, calls = make(buckets=2), []

    def fails_after(old, new):
        calls.append(1)
        return upsert(old, new)

    def each(batch, number, name):
        held.merge(batch, fails_after, name, number)
        if len(calls) == 1 and not os.path.exists(tmp_path / "failed"):
            (tmp_path / "failed").touch()
            raise RuntimeError("lost")

    source = lambda: ingest.parquet_stream(spark, str(tmp_path / "in" / "*"), held.schema, 1)
    with pytest.raises(Exception, match="lost"):
        ingest.known_by_stream(source(), str(tmp_path / "s"), each)
    number = held.version().number
    ingest.known_by_stream(source(), str(tmp_path / "s"), each)
    assert calls == [1] and held.version().number == number and rows(held.read()) == [("a", "1")]


def test_writers_that_meet(make, frame):
    """A writer that commits in between: other buckets are joined, the same one is merged again on top of it."""
    held, other = make(buckets=8), make(buckets=8)
    held.merge(frame(*[(f"u{k}", "old") for k in range(50)]), upsert)
    of = {f"u{k}": held.named_buckets(frame((f"u{k}", None)))[0] for k in range(50)}
    apart = next(u for u in of if of[u] != of["u0"])
    beside = next(u for u in of if u != "u0" and of[u] == of["u0"])
    for theirs, times in ((apart, 1), (beside, 2)):
        calls = []

        def how(old, new, theirs=theirs, calls=calls):
            if not calls:
                other.merge(frame((theirs, "theirs")), upsert)
            calls.append(1)
            return upsert(old, new)

        held.merge(frame(("u0", f"ours {times}")), how)
        got = dict(rows(held.read()))
        assert len(calls) == times and got["u0"] == f"ours {times}" and got[theirs] == "theirs" and len(got) == 50


def test_expire(make, frame, tmp_path):
    held = make(buckets=2)
    for k in range(4):
        held.merge(frame(*[(f"u{i}", str(k)) for i in range(10)] if k in (0, 3) else [("u0", str(k))]), upsert)
    (tmp_path / "t" / "data" / "merge=m-failed").mkdir()
    (tmp_path / "t" / "commits" / f"{held.version().number + 1:012d}").touch()  # a writer that failed while it committed
    now = rows(held.read())
    assert held.expire(keep=2) > 0 and (tmp_path / "t" / "data" / "merge=m-failed").exists()
    assert rows(held.read()) == now and rows(held.read(held.version(held.version().number - 1)))
    held.expire(keep=1, older_than=-5)
    assert rows(held.read()) == now and len(os.listdir(tmp_path / "t" / "data")) == 1
    held.merge(frame(("u0", "last")), upsert)
    assert dict(rows(held.read()))["u0"] == "last" and len(held.versions()) == 3
