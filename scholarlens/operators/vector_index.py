"""A stored index of vectors: coarse cells as the buckets of a keyed table, of which a search reads a few.

Cells are the neighbourhoods of centroids, fitted once on a bounded sample. Rows are added, replaced and removed by
merges that rewrite the cells they leave and enter. A search compares the query with the centroids, then reads only
the nearest cells and ranks their rows exactly. How many cells are enough is measured, not assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from scholarlens.sources.keyed import BUCKET, Files, KeyedTable

from . import merge, vector

#: Cells at most (their centroids are held whole by the driver and every task), and sample vectors for each cell.
MOST_CELLS, SAMPLE = 16_384, 64
#: Vectors and queries that meet in a tile, and how many of them are compared at a time: SLICE * BLOCK scores are held, 4 MB.
ROWS, QUERIES, SLICE, BLOCK = 8192, 2048, 256, 2048
#: The same vectors' matrix products differ by less, from one place or size of a matrix to another.
ROUNDING = 1e-11


def usable(v: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Each place's distance from the first one of its value."""
    return np.arange(len(ordered)) - np.searchsorted(ordered, ordered)


class VectorIndex:
    """Rows of ``schema`` by ``key``, each with a ``vector``, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "id", vector: str = "embedding", files: int = 1):
        self.spark, self.root, self.key, self.vector = spark, root.rstrip("/"), key, vector
        cell = StructField("cell", IntegerType())
        self.cells = KeyedTable(spark, f"{self.root}/cells", StructType([*schema.fields, cell]), key, files=files, spread=F.col("cell"))
        self.places = KeyedTable(spark, f"{self.root}/places", StructType([schema[key], cell]), key, files=files)

    def fit(self, rows: DataFrame, cells: int, sample: int = SAMPLE) -> VectorIndex:
        """Centroids from about ``sample`` vectors for each of ``cells`` cells, chosen by a hash of the key."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        known = rows.where(usable(F.col(self.vector)) & F.col(self.key).isNotNull())
        share = max(1, min(1 << 30, round((1 << 30) * min(cells, MOST_CELLS) * sample / max(1, known.count()))))
        some = known.where(F.pmod(F.xxhash64(self.key), F.lit(1 << 30)) < share)
        model = KMeans(k=min(cells, MOST_CELLS), distanceMeasure="cosine", seed=7, maxIter=10, featuresCol="_v").fit(some.select(array_to_vector(F.transform(self.vector, lambda x: x.cast("double"))).alias("_v")))
        found = [(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters()) if np.linalg.norm(c) > 0]
        self.spark.createDataFrame(found, "cell int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/centroids")
        return self

    def centroids(self) -> tuple[np.ndarray, np.ndarray]:
        """Cells' numbers, and their centroids at unit length."""
        found = sorted(self.spark.read.schema("cell int, centroid array<double>").parquet(f"{self.root}/centroids").collect())
        return np.array([r.cell for r in found], np.int64), _unit(np.array([r.centroid for r in found]))

    def _nearest(self, v: Column, n: int) -> Column:
        """The ``n`` nearest cells of a usable vector, nearest first."""
        held = self.spark.sparkContext.broadcast(self.centroids())  # at most MOST_CELLS rows

        def nearest(vectors):
            import pandas as pd

            numbers, centres = held.value
            step, found = max(1, SLICE * BLOCK // len(centres)), []
            for at in range(0, len(vectors), step):
                score = _unit(np.stack(vectors.iloc[at : at + step].to_numpy())) @ centres.T
                found += list(numbers[np.argsort(-score, axis=1, kind="stable")[:, :n]].astype(np.int32))
            return pd.Series(found)

        return F.pandas_udf(nearest, "array<int>")(v)

    def _place(self, v: Column, cell: Column) -> Column:
        """Which nearest cell of a usable vector, from 0, a cell is: where ``_nearest`` would name it."""
        held = self.spark.sparkContext.broadcast(self.centroids())

        def place(vectors, cells):
            import pandas as pd

            numbers, centres = held.value
            step, found = max(1, SLICE * BLOCK // len(centres)), []
            for at in range(0, len(vectors), step):
                score = _unit(np.stack(vectors.iloc[at : at + step].to_numpy())) @ centres.T
                own = np.searchsorted(numbers, cells.iloc[at : at + step].to_numpy())[:, None]
                least = np.take_along_axis(score, own, axis=1)
                found.append((score > least).sum(axis=1) + ((score == least) & (np.arange(len(numbers)) < own)).sum(axis=1))
            return pd.Series(np.concatenate(found) if found else [], dtype="int32")

        return F.pandas_udf(place, "int")(v, cell)

    def upsert(self, rows: DataFrame, stream: str | None = None, number: int = 0) -> None:
        """Adds ``rows``, in place of those with their keys. A row without a usable vector only removes.

        Rows without a key are left out; a key that repeats counts once. A batch of a stream counts once too: cells are
        written first, then the places of keys, so one that fails in between is merged again where it had no effect.
        """
        known = rows.where(F.col(self.key).isNotNull())
        known = merge.latest(known, self.key, [F.struct(*(F.col(c) for c in self.cells.schema.names if c not in (self.key, "cell")))])
        good = usable(F.col(self.vector))
        placed = known.where(good).withColumn("cell", F.get(self._nearest(F.col(self.vector), 1), F.lit(0))).unionByName(known.where(~good).withColumn("cell", F.lit(None).cast("int"))).persist()
        try:
            keys = placed.select(self.key)
            left = [r.cell for r in self.places.lookup(keys).select("cell").distinct().collect()]
            self.cells.merge(placed.where("cell IS NOT NULL"), lambda old, new: old.join(keys, self.key, "left_anti").unionByName(new.select(old.columns)), stream, number, touched=left)
            self.places.merge(placed.select(self.key, "cell"), lambda old, new: old.join(keys, self.key, "left_anti").unionByName(new.where("cell IS NOT NULL")), stream, number)
        finally:
            placed.unpersist()

    def remove(self, keys: DataFrame) -> None:
        gone = keys.select(self.key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in self.cells.schema.fields if f.name not in (self.key, "cell")))
        self.upsert(gone)

    def read(self) -> DataFrame:
        """Every row, with its cell as _bucket: a partition column, so a filter on it reads the files of these cells only."""
        return self.cells.read(bucket=True).drop("cell")

    def probed(self, query: Sequence[float], probes: int) -> list[int]:
        numbers, centres = self.centroids()
        score = centres @ _unit(np.array([query], np.float64))[0]
        return numbers[np.argsort(-score, kind="stable")[:probes]].tolist()

    def search(self, query: Sequence[float], columns: list[str], threshold: float = 0.7, k: int = 10, probes: int = 8) -> DataFrame:
        """``vector.match`` over the rows of the ``probes`` nearest cells; nothing else is read."""
        cells = self.probed(query, probes) if any(query) else []
        rows = self.cells.read(buckets=cells, bucket=True).where(F.col(BUCKET).isin(cells)) if cells else self.cells.read(buckets=[])
        return vector.match(rows, query, columns, self.vector, self.key, threshold, k)

    def search_many(self, queries: DataFrame, k: int = 10, probes: int = 8) -> DataFrame:
        """query_id, rank, key, similarity, cell of the ``k`` nearest rows in the ``probes`` nearest cells of each of ``queries`` (query_id, vector).

        Queries and rows of a cell meet in tiles of bounded size, however many there are of either, and a tile gives at
        most k rows for a query. Within a tile a block of rows is compared with a slice of queries at a time, so a task
        holds no more scores for a full tile than for a small one. Ties go to the smaller key: matrix products only
        choose, and what they choose is scored again row by row, so that equal vectors score the same wherever they
        are. Queries without a usable vector find nothing.
        """
        asked = queries.where(usable(F.col("vector"))).select("query_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
        cells = self.spark.read.schema("cell int").parquet(f"{self.root}/centroids")
        if probes < cells.count():
            asked = asked.select("query_id", "vector", F.explode(self._nearest(F.col("vector"), probes)).alias("cell"))
        else:  # no vector needs a list of all cells: at most MOST_CELLS
            asked = asked.crossJoin(F.broadcast(cells))
        rows = self.cells.read().select(F.col(self.key).alias("key"), F.transform(self.vector, lambda x: x.cast("double")).alias("vector"), "cell")
        count = lambda df, n, name: df.groupBy("cell").agg(F.ceil(F.count("*") / n).cast("int").alias(name))
        # One row for each cell: at most MOST_CELLS.
        sizes = F.broadcast(count(asked, QUERIES, "q").join(count(rows, ROWS, "r"), "cell"))
        part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asked = asked.join(sizes, "cell").select("cell", part("query_id", "q").alias("a"), copies("r").alias("b"), "query_id", "vector")
        rows = rows.join(sizes, "cell").select("cell", copies("q").alias("a"), part("key", "r").alias("b"), "key", "vector")

        def compared(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"query_id": left.column("query_id")[:0], "key": right.column("key")[:0], "similarity": pa.array([], pa.float64()), "cell": pa.array([], pa.int32())})
            order, vectors = pc.sort_indices(right.column("key")).to_numpy(), _matrix(right.column("vector"))
            asks = _unit(_matrix(left.column("vector")))
            best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)) for _ in range(0, len(asks), SLICE)]  # query of the slice, place in the order, similarity
            for start in range(0, len(order), BLOCK):
                block = _unit(vectors[order[start : start + BLOCK]])
                for n, (i, j, s) in enumerate(best):
                    ask = asks[n * SLICE : (n + 1) * SLICE]
                    score, last, full = ask @ block.T, max(0, len(block) - k), _runs(i) == k - 1
                    least = np.full((len(ask), 1), -np.inf)
                    least[i[full], 0] = s[full] - ROUNDING
                    near = score >= least
                    if near.sum() > 4 * k * len(ask):  # earlier blocks leave too many: the best of this one only
                        near &= score >= np.partition(score, last, axis=1)[:, last : last + 1] - ROUNDING
                    a, b = np.nonzero(near)
                    again = [(ask[a[c : c + BLOCK]] * block[b[c : c + BLOCK]]).sum(axis=1) for c in range(0, len(a), BLOCK)]
                    i, j, s = np.concatenate([i, a]), np.concatenate([j, b + start]), np.concatenate([s, *again])
                    first = np.lexsort((j, -s, i))
                    first = first[_runs(i[first]) < k]
                    best[n] = i[first], j[first], s[first]
            i, j, s = np.concatenate([i + n * SLICE for n, (i, _, _) in enumerate(best)]), np.concatenate([j for _, j, _ in best]), np.concatenate([s for _, _, s in best])
            return pa.table({"query_id": left.column("query_id").take(pa.array(i)), "key": right.column("key").take(pa.array(order[j])), "similarity": pa.array(s), "cell": pa.array(np.full(len(i), left.column("cell")[0].as_py(), np.int32))})

        kinds = f"query_id {queries.schema['query_id'].dataType.simpleString()}, key {self.cells.schema[self.key].dataType.simpleString()}, similarity double, cell int"
        near = asked.groupBy("cell", "a", "b").cogroup(rows.groupBy("cell", "a", "b")).applyInArrow(compared, kinds)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "key"))
        return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "key", "similarity", "cell")

    def probes_for(self, queries: DataFrame, k: int = 10, least: float = 0.95) -> int:
        """The fewest cells that hold ``least`` of the true ``k`` neighbours of ``queries``, measured against all cells.

        A neighbour is found if its cell is probed, so one exact search tells the recall of every number of cells.
        """
        cells = len(self.centroids()[0])
        asked = queries.where(usable(F.col("vector"))).select("query_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
        found = self.search_many(queries, k, cells).join(asked, "query_id")
        places = found.groupBy(self._place(F.col("vector"), F.col("cell")).alias("place")).agg(F.count("*").alias("n")).orderBy("place").collect()
        total, held = sum(r.n for r in places), 0
        for r in places:  # one row for each place: at most MOST_CELLS
            held += r.n
            if held >= least * total:
                return r.place + 1
        return cells

    def exists(self) -> bool:
        return bool(Files(self.spark, self.root).names("centroids"))
