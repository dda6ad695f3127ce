import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarlens.operators import embedding, flows, merge, profile, select, stats, vector
from scholarlens.plans import functions as sql_functions


def test_match(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [2.0, 0.0])], "id int, embedding array<double>")
    got = vector.match(df, [1.0, 0.0], ["id"], threshold=0.0, k=3)
    assert [(r.id, r.similarity) for r in got.collect()] == [(1, 1.0), (5, 1.0), (2, 0.0)]
    assert vector.match(df, [0.0, 0.0], ["id"]).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


def test_centroids(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("z", [0.0, 0.0])], "k string, embedding array<double>")
    got = {r.k: r.centroid for r in vector.centroids(df, "k").collect()}
    assert got["a"] == pytest.approx([math.sqrt(0.5)] * 2) and got["z"] == [0.0, 0.0]


def test_vector_text(spark):
    df = spark.createDataFrame([([1.5, -2.0],)], "v array<double>")
    assert df.select(vector.from_text(vector.to_text(F.col("v"))).alias("v")).first().v == [1.5, -2.0]


def test_profiles(spark):
    rows = [("1", [1.0, 0.0], "D", ["  Dr.  A   B., ", "x", "Dr. A B"]), ("2", [0.0, 1.0], "", ["Dr. A B"]), ("3", None, "E", ["Dr. A B"]), ("4", [1.0, 1.0], "E", None)]
    df = spark.createDataFrame(rows, "id string, embedding array<double>, dept string, supervisors array<string>")
    (r,) = profile.profiles(df).collect()
    assert (r.name, r.dept, r.research_count) == ("Dr. A B", "D", 3)
    assert np.linalg.norm(r.expertise_vector) == pytest.approx(1.0)


def test_merge(spark):
    old = spark.createDataFrame([("a", "1", 1), ("b", "2", 2), (None, "9", 9)], "sinta_id string, nidn string, h int")
    new = spark.createDataFrame([("a", None, 5), ("c", "3", 3), (None, "8", 8)], "sinta_id string, nidn string, h int")
    merged = merge.merge(old, new, "sinta_id", keep_if_null=("nidn",))
    want = [("a", "1", 5), ("b", "2", 2), ("c", "3", 3), (None, "8", 8), (None, "9", 9)]
    key = lambda r: (r[0] is None, r[0] or "", r[1])
    assert sorted(map(tuple, merged.collect()), key=key) == want
    named = new.where("sinta_id IS NOT NULL")
    once = merge.merge(old, named, "sinta_id", keep_if_null=("nidn",))
    twice = merge.merge(once, named, "sinta_id", keep_if_null=("nidn",))
    assert sorted(map(tuple, once.collect()), key=key) == sorted(map(tuple, twice.collect()), key=key)


def test_upsert_research(spark):
    old = spark.createDataFrame([("u1", "t1", "x")], "url string, title string, updated_at string")
    new = spark.createDataFrame([("u1", "t2"), ("u1", "t0"), ("", "t"), ("u2", None), ("u3", "t3")], "url string, title string")
    got = merge.upsert_research(old, new, [F.col("title")], now=F.lit("now"))
    assert sorted(map(tuple, got.collect())) == [("u1", "t0", "now"), ("u3", "t3", None)]
    assert tuple(merge.batch_counts(new).first()) == (3, 2)


def test_shaped(spark):
    rows = [("t" * 3000, "a", "", ["", "x", None], "S1", 1, "", "u", 0.5, "plain"), ("t", None, "au" * 300, [], "S1", None, "d", "u", 0.5, '{"a": 1}')]
    df = spark.createDataFrame(rows, "title string, abstract string, author string, supervisors array<string>, degree string, year int, dept string, url string, data_confidence double, metadata string")
    a, b = merge.shaped(df).collect()
    assert (len(a.title), a.author, a.supervisors, a.dept, a.metadata) == (2000, "Unknown", ["x"], None, '{"raw":"plain"}')
    assert (len(b.author), b.supervisors, b.metadata) == (500, None, '{"a": 1}')


def test_publications(spark):
    rows = [("p", "scopus", 1, i, f"a long title {i:02d}", 2020) for i in range(50)] + [("p", "googlescholar", 1, i, f"another title {i}", 2020) for i in range(10)]
    rows += [("q", "scopus", 1, 0, "published 2014", 2014), ("q", "scopus", 1, 1, "published 2015", 2015), ("q", "scopus", 1, 2, "no year given", None)]
    rows += [("q", "scopus", 2, 3, "short", 2020), ("q", "scopus", 3, 4, "after a page of none", 2020)]
    df = spark.createDataFrame(rows, "author_id string, source string, page int, pos int, title string, year int")
    got = {r.author_id: r.publications for r in select.publications(df).collect()}
    assert len(got["p"]) == 50 and {x.source for x in got["p"]} == {"scopus"}
    assert [(x.title, x.year) for x in got["q"]] == [("published 2015", 2015), ("no year given", None)]


@pytest.mark.parametrize("n, long", [(50, False), (51, True)])
def test_research_text(spark, n, long):
    df = spark.createDataFrame([("T", " " + "a" * n + " ")], "t string, a string")
    got = df.select(embedding.research_text(F.col("t"), F.col("a")).alias("c")).first().c
    assert (". Abstract: " in got) == long


def test_expertise_text(spark):
    df = spark.createDataFrame([("N", None, [("a title of some length",), ("short",)]), ("M", "D", [("short",)]), ("L", "D", None)], "n string, d string, p array<struct<title:string>>")
    got = [r.c for r in df.select(embedding.expertise_text(F.col("n"), F.col("d"), F.col("p")).alias("c")).collect()]
    assert "Unknown Department" in got[0] and got[0].endswith("a title of some length") and got[1:] == ["", ""]


def test_embedder_isolates_failures(spark):
    plain = embedding.hashing_embedder(8)

    def sometimes(texts):
        if "bad" in texts:
            raise ValueError("bad text")
        return plain(texts)

    df = spark.createDataFrame([(i, "bad" if i == 3 else f"text {i}") for i in range(6)], "id int, t string").coalesce(1)
    got = {r.id: (r.embedding is not None, r.error) for r in embedding.embedded(df, "t", sometimes, batch=2).collect()}
    assert [i for i, (ok, _) in got.items() if not ok] == [2, 3] and got[2][1] == "ValueError: bad text"


def test_stats_and_sql(spark):
    columns = "id string, title string, abstract string, author string, supervisors array<string>, degree string, year int, dept string, url string, embedding array<float>"
    rest = ("a", "b", ["s"], "S1", 2020, "d", "u")
    spark.createDataFrame([("1", "t", *rest, [1.0, 0.0]), ("2", "u", *rest, None)], columns).createOrReplaceTempView("researches")
    people = spark.createDataFrame([("1", "n", "d", 2, [1.0, 0.0], "s", ["p"]), ("2", "m", "d", 1, None, None, []), ("3", "o", "d", 1, None, "t", ["q"])], "id string, name string, dept string, research_count int, expertise_vector array<float>, sinta_id string, sinta_publications array<string>")
    people.createOrReplaceTempView("lecturers")
    sql_functions.register(spark)
    assert tuple(stats.embedding_stats(spark.table("researches"), people).first()) == (2, 1, 1, 3, 1) == tuple(spark.sql("SELECT * FROM get_embedding_stats()").first())
    assert tuple(stats.profile_stats(people).first()) == (3, 2, 2, 1, 1) == tuple(spark.sql("SELECT * FROM get_sinta_stats()").first())
    (found,) = spark.sql("SELECT * FROM match_research(array(1D, 0D))").collect()
    assert tuple(found) == ("1", "t", *rest, 1.0)
    assert [r.name for r in spark.sql("SELECT * FROM match_lecturers_all(array(1D, 0D), 0.5D)").collect()] == ["n"]


def test_selections(spark):
    df = spark.createDataFrame([(1, None), (2, ["a"]), (3, []), (4, None)], "id int, supervisors array<string>")
    assert [r.id for r in select.without_supervisors(df, "id", 2).collect()] == [1, 3]
    assert [r.id for r in select.without_supervisors(df, "id", 2, limit_first=True).collect()] == [1]
    people = spark.createDataFrame([("x", 1), ("y", None), ("a", 1)], "name string, research_count int")
    assert [r.name for r in profile.top_lecturers(people, 2).collect()] == ["y", "a"]
    assert select.full_text(spark.createDataFrame([("Deep Learning", "for cats"), ("Deep", "dogs")], "title string, abstract string"), ["deep", "cats"]).count() == 1


def test_centroids_add_whole_vectors(spark):
    rows = [("a", [3.0, 0.0]), ("a", [0.0, 3.0]), ("b", [0.0, 0.0]), ("c", None), (None, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "k string, embedding array<float>")
    got = vector.centroids(df, "k")
    assert {r.k: [round(x, 6) for x in r.centroid] for r in got.collect()} == {"a": [0.707107, 0.707107], "b": [0.0, 0.0], None: [0.0, 1.0]}
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_repeated_keys_in_a_batch_count_once(spark):
    old = spark.createDataFrame([("1", "n", "d")], "sinta_id string, nidn string, dept string")
    new = spark.createDataFrame([("1", "x", None), ("1", "y", "e"), (None, "z", "f"), (None, "z", "f")], old.schema)
    assert [tuple(r) for r in merge.upsert_profiles(old, new, [F.desc("nidn")]).orderBy("sinta_id").collect()] == [(None, "z", "f"), (None, "z", "f"), ("1", "y", "e")]
    names = spark.createDataFrame([("a", None, 1)], "name string, sinta_id string, n int")
    twice = spark.createDataFrame([("a", None, 3), ("a", None, 2)], names.schema)
    assert [tuple(r) for r in merge.upsert_by_name(names, twice).collect()] == [("a", None, 2)]


def test_progress_and_retries(spark):
    from datetime import datetime

    log = spark.createDataFrame([("a", True, None, datetime(2020, 1, 1)), ("b", False, "x", datetime(2020, 1, 1)), ("b", False, "y", datetime(2020, 1, 2)), ("c", False, "z", datetime(2020, 1, 1)), ("c", True, None, datetime(2020, 1, 3))], flows.PROGRESS)
    urls = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    assert {r.key: (r.ok, r.error, r.tries) for r in flows.progress(log).collect()} == {"a": (True, None, 1), "b": (False, "y", 2), "c": (True, None, 2)}
    assert tuple(flows.progress_counts(log, urls).first()) == (4, 3, 2, 1)
    keys = lambda df: sorted(r.key for r in df.collect())
    assert keys(flows.to_do(urls, log)) == ["d"] and keys(flows.to_do(urls, log, True)) == ["b", "d"] and keys(flows.to_do(urls, log, True, 2)) == ["d"]
