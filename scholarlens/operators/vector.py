"""Vector operators: cosine, exact top-k, centroids, text form."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is null or zero (a zero vector has no direction)."""
    return F.try_divide(dot(a, b), F.nullif(norm(a) * norm(b), F.lit(0.0)))


def match(df: DataFrame, query: Sequence[float], columns: list[str], vector: str = "embedding", key: str = "id", threshold: float = 0.7, k: int = 10) -> DataFrame:
    """``columns`` and similarity of the ``k`` rows most similar to ``query``, at least ``threshold``; ties by ``key``.

    The query is a literal, so there is no join: each task keeps its own top k (TakeOrderedAndProject). The threshold
    is on the sort key, so applying it to the k rows gives the same rows and computes no similarity twice.
    """
    size = math.sqrt(sum(float(x) * float(x) for x in query))
    if not size:
        return df.select(*columns, F.lit(0.0).alias("similarity")).limit(0)
    literal = F.array(*[F.lit(float(x)) for x in query])
    similarity = F.try_divide(dot(F.col(vector), literal), F.nullif(norm(F.col(vector)) * F.lit(size), F.lit(0.0)))
    top = df.where(F.col(vector).isNotNull()).select(*columns, similarity.alias("similarity"))
    top = top.orderBy(F.col("similarity").desc_nulls_last(), key).limit(k)
    return top.where(F.col("similarity") >= threshold)


def match_research(df: DataFrame, query: Sequence[float], threshold: float = 0.7, k: int = 10) -> DataFrame:
    columns = ["id", "title", "abstract", "author", "supervisors", "degree", "year", "dept", "url"]
    return match(df, query, columns, "embedding", "id", threshold, k)


def match_lecturers(df: DataFrame, query: Sequence[float], threshold: float = 0.5, k: int = 10) -> DataFrame:
    return match(df, query, ["id", "name", "dept", "research_count"], "expertise_vector", "id", threshold, k)


def centroids(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """(key, centroid): the mean vector of each key, at unit length unless it is zero.

    Whole vectors are added up, before the shuffle and after it: one row of sums for each key and task, no row for each
    dimension and no list of vectors.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    rows = df.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    held = rows.groupBy(key).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("mean")).withColumn("size", norm(F.col("mean")))
    return held.select(key, F.when(F.col("size") > 0, F.transform("mean", lambda x: x / F.col("size"))).otherwise(F.col("mean")).alias("centroid"))


def to_text(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit("]"))


def from_text(c: Column) -> Column:
    return F.from_json(c, "array<double>")


def nearest_candidates(df: DataFrame, query: Sequence[float], columns: list[str], vector: str = "embedding", key: str = "id", threshold: float = 0.7, k: int = 10, tables: int = 8, width: float = 1.0) -> DataFrame:
    """``match`` over the candidates of a random-projection hash only; approximate where ``match`` is exact."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    rows = df.where(F.col(vector).isNotNull()).withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    unit = Normalizer(inputCol="_v", outputCol="_u", p=2.0).transform(rows)
    lsh = BucketedRandomProjectionLSH(inputCol="_u", outputCol="_h", bucketLength=width, numHashTables=tables, seed=7).fit(unit)
    size = math.sqrt(sum(float(x) ** 2 for x in query)) or 1.0
    found = lsh.approxNearestNeighbors(unit, Vectors.dense([float(x) / size for x in query]), 10 * k)
    return match(found, query, columns, vector, key, threshold, k)
