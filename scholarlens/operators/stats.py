"""Completeness statistics, each one pass over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scholarlens.functions.constants import TOTAL_LECTURERS


def embedding_stats(research: DataFrame, lecturers: DataFrame) -> DataFrame:
    a = research.agg(F.count("*").alias("total_researches"), F.count("embedding").alias("embedded_researches"), F.count_if(F.col("embedding").isNull()).alias("pending_researches"))
    b = lecturers.agg(F.count("*").alias("total_lecturers"), F.count("expertise_vector").alias("profiled_lecturers"))
    return a.crossJoin(b)  # one row each


def profile_stats(lecturers: DataFrame) -> DataFrame:
    """A null list of publications is not "not empty"."""
    listed = F.coalesce(F.size("sinta_publications") > 0, F.lit(False))
    return lecturers.agg(
        F.count("*").alias("total_lecturers"),
        F.count("sinta_id").alias("with_sinta_id"),
        F.count_if(listed).alias("with_publications"),
        F.count("expertise_vector").alias("with_expertise_vector"),
        F.count_if(listed & F.col("expertise_vector").isNull()).alias("pending_vectorization"),
    )


def coverage(lecturers: DataFrame, total: int = TOTAL_LECTURERS) -> DataFrame:
    found = lecturers.agg(F.count("sinta_id").alias("scraped"))
    return found.withColumn("percent", F.round(F.col("scraped") / total * 100, 1))


def union_ids(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out.distinct()


def remaining(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return wanted.join(done, key, "left_anti")


def field_presence(research: DataFrame) -> DataFrame:
    """Null, empty and filled lists of supervisors."""
    n = F.size("supervisors")
    return research.agg(F.count("*").alias("total"), F.count_if(F.col("supervisors").isNotNull()).alias("not_null"), F.count_if(F.coalesce(n > 0, F.lit(False))).alias("filled"))


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` that counts rows (and rows where each condition holds) as it is used, and where the counts will be."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("rows"), *(F.count_if(c).alias(name) for name, c in counts.items())), seen
