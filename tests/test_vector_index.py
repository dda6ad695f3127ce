"""The stored vector index: recall on clustered vectors, what a search reads, and rows that come, move and go."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scholarlens.operators import vector, vector_index
from scholarlens.operators.vector_index import VectorIndex

SCHEMA = "id string, embedding array<float>, title string"


def clustered(n=1200, groups=24, size=32, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size))
    return centres[rng.integers(groups, size=n)] + 0.35 * rng.standard_normal((n, size))


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(f"k{i:05d}", None if v is None else [float(x) for x in v], f"t{i}") for i, v in enumerate(vectors, start)], SCHEMA)


def exact(vectors, names, query, k):
    v = np.array([x / np.linalg.norm(x) for x in vectors], np.float32).astype(float)
    s = v @ (query / np.linalg.norm(query))
    return [names[j] for j in sorted(range(len(s)), key=lambda j: (-s[j], names[j]))[:k]]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    vectors = clustered()
    rows = frame(spark, vectors)
    index = VectorIndex(spark, str(tmp_path_factory.mktemp("index")), rows.schema).fit(rows, 24)
    index.upsert(rows)
    return vectors, rows, index


def test_recall_and_what_is_read(spark, built):
    vectors, rows, index = built
    queries = rows.where("id < 'k00100'").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    probes = index.probes_for(queries, 10, 0.95)
    assert probes <= 6  # of 24: vectors have neighbourhoods
    names = [f"k{i:05d}" for i in range(len(vectors))]
    asked = rows.where("id >= 'k00500' AND id < 'k00560'").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    got = {}
    for r in index.search_many(asked, 10, probes).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.key))
    hits = sum(len({k for _, k in got[f"k{i:05d}"]} & set(exact(vectors, names, vectors[i], 10))) for i in range(500, 560))
    assert hits >= 0.9 * 600 and all([n for n, _ in sorted(v)] == list(range(1, 11)) for v in got.values())
    one = index.search(vectors[7].tolist(), ["id", "title"], threshold=-1.0, k=5, probes=2)
    assert len(one.inputFiles()) == 2
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [_bucket" in plan and "TakeOrderedAndProject" in plan
    assert one.first().id == "k00007"
    assert index.search([0.0] * 32, ["id"]).count() == 0


def test_a_filter_on_cells_prunes(built):
    _, _, index = built
    cells = index.probed([1.0] * 32, 3)
    plan = index.read().where(F.col("_bucket").isin(cells))
    assert len(plan.inputFiles()) >= 3 and "PartitionFilters: [_bucket" in plan._jdf.queryExecution().toString()


def test_all_cells_are_exact(built):
    vectors, rows, index = built
    q = vectors[3].tolist()
    want = vector.match(rows, q, ["id"], threshold=-1.0, k=15).collect()
    assert [r.id for r in index.search(q, ["id"], -1.0, 15, 24).collect()] == [r.id for r in want]


def test_rows_come_move_and_go(spark, tmp_path):
    """Replaced rows leave their old cell; nulls, zeros and non-finite vectors only remove; a batch counts once."""
    vectors = clustered(300, 6, 8)
    rows = frame(spark, vectors)
    index = VectorIndex(spark, str(tmp_path / "ix"), rows.schema).fit(rows, 6)
    index.upsert(rows, "s", 0)
    assert index.read().count() == 300 and index.places.read().count() == 300
    moved = frame(spark, [-v for v in vectors[:20]])
    index.upsert(moved.union(moved).union(spark.createDataFrame([(None, [1.0] * 8, "x")], SCHEMA)), "s", 1)
    index.upsert(rows, "s", 1)  # came before
    held = {r.id: r for r in index.read().collect()}
    assert len(held) == 300 == index.read().count()
    assert all(np.allclose(held[f"k{i:05d}"].embedding, -vectors[i], atol=1e-5) for i in range(20))
    bad = [None, [0.0] * 8, [float("nan")] * 8, [float("inf")] * 8]
    index.upsert(frame(spark, bad))
    index.remove(spark.createDataFrame([("k00004",), ("none",)], "id string"))
    assert sorted(r.id for r in index.read().collect()) == [f"k{i:05d}" for i in range(5, 300)]
    assert index.places.read().count() == 295
    index.upsert(frame(spark, vectors[:2]))
    assert index.read().count() == 297


def test_a_failure_between_cells_and_places(spark, tmp_path, monkeypatch):
    vectors = clustered(60, 4, 8)
    rows = frame(spark, vectors)
    index = VectorIndex(spark, str(tmp_path / "ix"), rows.schema).fit(rows, 4)
    whole = index.places.merge
    monkeypatch.setattr(index.places, "merge", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.upsert(rows, "s", 0)
    monkeypatch.setattr(index.places, "merge", whole)
    index.upsert(rows, "s", 0)
    assert index.read().count() == 60 == index.places.read().count()
    index.upsert(frame(spark, [-v for v in vectors]), "s", 1)
    assert index.read().count() == 60


def test_tiles_and_ties(spark, tmp_path, monkeypatch):
    """A cell with most rows and queries is compared in tiles; of equal vectors the smaller keys come first."""
    monkeypatch.setattr(vector_index, "ROWS", 20)
    monkeypatch.setattr(vector_index, "QUERIES", 7)
    vectors = [*([np.ones(8)] * 150), *clustered(100, 3, 8)]
    rows = frame(spark, vectors)
    index = VectorIndex(spark, str(tmp_path / "ix"), rows.schema).fit(rows, 4)
    index.upsert(rows)
    queries = rows.where("id < 'k00040' OR id > 'k00230'").select(F.col("id").alias("query_id"), F.col("embedding").alias("vector"))
    queries = queries.union(spark.createDataFrame([("null", None), ("zero", [0.0] * 8)], queries.schema))
    names, got = [f"k{i:05d}" for i in range(250)], {}
    for r in index.search_many(queries, 12, 4).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.key)
    assert got.pop("k00000") == [f"k{i:05d}" for i in range(12)]
    assert "null" not in got and len(got) == 39 + 19
    assert sum(set(got[f"k{i:05d}"]) == set(exact(vectors, names, vectors[i], 12)) for i in range(231, 250)) == 19
    assert index.search_many(queries.limit(0), 3, 2).count() == 0


def called(monkeypatch, index, queries, k):
    """What search_many has Python do with a tile."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    held, whole = [], PandasCogroupedOps.applyInArrow
    with monkeypatch.context() as m:
        m.setattr(PandasCogroupedOps, "applyInArrow", lambda self, f, schema: held.append(f) or whole(self, f, schema))
        index.search_many(queries, k, 24)
    return held[0]


def tile(vectors, name):
    flat = pa.array(vectors.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32)), flat), pa.array(np.arange(len(vectors)) if name == "query_id" else np.arange(len(vectors))[::-1])


def tables(asks, rows):
    (v, q), (w, k) = tile(asks, "query_id"), tile(rows, "key")
    return pa.table({"cell": pa.array(np.zeros(len(q), np.int32)), "query_id": q, "vector": v}), pa.table({"cell": pa.array(np.zeros(len(k), np.int32)), "key": k, "vector": w})


def peak(f, *args):
    """The most that f has numpy hold at a time, in MB."""
    tracemalloc.start()
    try:
        f(*args)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_full_tile_takes_little_more_memory_than_a_small_one(built, monkeypatch):
    """scores were held for all rows of a tile at a time, so Python's memory grew until tiles were full."""
    _, rows, index = built
    compared = called(monkeypatch, index, rows.select(F.col("id").alias("query_id"), F.col("embedding").alias("vector")), 10)
    rng = np.random.default_rng(2)
    asks, many = rng.standard_normal((vector_index.QUERIES, 64)), rng.standard_normal((vector_index.ROWS, 64))
    small, full = peak(compared, *tables(asks, many[:2048])), peak(compared, *tables(asks, many))
    assert full < 20 and full < 1.5 * small
    got = compared(*tables(asks[:300], many)).to_pandas()
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    score = unit(asks[:300]) @ unit(many).T
    want = [(i, len(many) - 1 - j) for i in range(300) for j in np.argsort(-score[i])[:10]]
    assert list(zip(got.query_id, got.key, strict=True)) == want
    assert np.allclose(got.similarity, np.sort(score, axis=1)[:, :-11:-1].ravel(), rtol=0, atol=1e-12)


def test_placing_takes_little_memory_however_many_cells(built, monkeypatch):
    """a batch of 10,000 vectors was scored against all cells at a time, 1.3 GB for each of two arrays at 16,384 cells."""
    _, _, index = built
    rng = np.random.default_rng(3)
    centres, vectors, held = rng.standard_normal((1024, 32)), rng.standard_normal((10_000, 32)), []
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    monkeypatch.setattr(index, "centroids", lambda: (np.arange(1024) * 2, centres))
    monkeypatch.setattr(vector_index.F, "pandas_udf", lambda f, kind: held.append(f) or (lambda *c: c[0]))
    index._nearest(F.col("embedding"), 3)
    series = pd.Series(list(vectors))
    assert peak(held[0], series) < 32
    near = np.stack(held[0](series).to_numpy())
    score = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ centres.T
    assert (near == 2 * np.argsort(-score, axis=1)[:, :3]).all()
    index._place(F.col("embedding"), F.col("cell"))
    assert all((held[1](series, pd.Series(near[:, n])) == n).all() for n in range(3)) and len(held[1](series[:0], pd.Series([], dtype="int32"))) == 0


def test_equal_vectors_score_the_same_wherever_they_are(built, monkeypatch):
    """a matrix product's last bit depends on the place in it, so of equal vectors a larger key could come first."""
    _, rows, index = built
    compared = called(monkeypatch, index, rows.select(F.col("id").alias("query_id"), F.col("embedding").alias("vector")), 10)
    rng = np.random.default_rng(4)
    for size in (8, 32, 64, 768):
        asks, one = rng.standard_normal((3, size)), rng.standard_normal((1, size))
        many = np.repeat(one, 2049, 0)
        got = compared(*tables(asks, many)).to_pandas()
        assert list(got.key) == [*range(10)] * 3
        assert (got.similarity == compared(*tables(asks, one)).to_pandas().similarity.repeat(10).to_numpy()).all()
