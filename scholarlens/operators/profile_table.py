"""Expertise profiles kept up to date: one state for each supervisor, to which batches add and from which they take.

A state is the sum of the vectors of a supervisor's research, their number, and how often each department occurs. Sums
can be added in any order and taken away again, so the profiles after any number of batches are those of all research
at once, and a batch reads and writes only the buckets of the people that it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from scholarlens.sources.keyed import KeyedTable

from . import profile
from .vector import norm

STATE = StructType([StructField("name", StringType()), StructField("total", ArrayType(DoubleType())), StructField("n", LongType()), StructField("depts", MapType(StringType(), LongType()))])


def states(research: DataFrame) -> DataFrame:
    """name, total, n, depts of every supervisor of ``research``; departments that are empty are not counted.

    Vectors are added up for each name and department within each task first, so a name that is in a third of all rows
    is one row for each task and department after the shuffle's first half.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    found = profile.links(research).select("name", F.coalesce("dept", F.lit("")).alias("dept"), array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("_v"))
    parts = found.groupBy("name", "dept").agg(Summarizer.sum(F.col("_v")).alias("_s"), F.count("*").alias("n"))
    counted = F.map_from_entries(F.filter(F.collect_list(F.struct("dept", "n")), lambda x: x["dept"] != ""))
    return parts.groupBy("name").agg(vector_to_array(Summarizer.sum(F.col("_s"))).alias("total"), F.sum("n").alias("n"), counted.alias("depts"))


def negative(state: DataFrame) -> DataFrame:
    return state.select("name", F.transform("total", lambda x: -x).alias("total"), (-F.col("n")).alias("n"), F.transform_values("depts", lambda _, v: -v).alias("depts"))


def added(a: DataFrame, b: DataFrame) -> DataFrame:
    """The states of both, of people who have research."""
    return change(a, b).where("n <> 0")


def change(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sums of both; a vector or department may change where the number does not."""
    x, y = a.alias("x"), b.alias("y")
    both = x.join(y, "name", "full_outer")
    none = F.create_map().cast("map<string,bigint>")

    def summed(p: Column, q: Column) -> Column:
        return F.when(p.isNull(), q).when(q.isNull(), p).otherwise(F.zip_with(p, q, lambda s, t: s + t))

    n = F.coalesce("x.n", F.lit(0)) + F.coalesce("y.n", F.lit(0))
    depts = F.map_filter(F.map_zip_with(F.coalesce("x.depts", none), F.coalesce("y.depts", none), lambda _, s, t: F.coalesce(s, F.lit(0)) + F.coalesce(t, F.lit(0))), lambda _, v: v != 0)
    return both.select("name", summed(F.col("x.total"), F.col("y.total")).alias("total"), n.alias("n"), depts.alias("depts"))


def profiles(state: DataFrame) -> DataFrame:
    """name, dept, research_count, expertise_vector, as ``profile.profiles`` gives them: the commonest department, the smallest of equally common ones."""
    mean = state.select("name", "n", "depts", F.transform("total", lambda x: x / F.col("n")).alias("mean")).withColumn("size", norm(F.col("mean")))
    best = F.array_min(F.transform(F.map_entries("depts"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("dept"))))["dept"]
    unit = F.when(F.col("size") > 0, F.transform("mean", lambda x: x / F.col("size"))).otherwise(F.col("mean"))
    return mean.select("name", F.coalesce(best, F.lit("")).alias("dept"), F.col("n").alias("research_count"), unit.alias("expertise_vector"))


class ProfileTable:
    """The states of all supervisors below ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.table = KeyedTable(spark, root, STATE, "name", buckets)

    def apply(self, new: DataFrame, old: DataFrame | None = None, stream: str | None = None, number: int = 0) -> bool:
        """Adds research, in place of ``old``: what the same records were before, where they are known already.

        A batch of a stream counts once; False if it was applied before.
        """
        held = (states(new) if old is None else change(states(new), negative(states(old)))).persist()
        try:
            return self.table.merge(held, added, stream, number)
        finally:
            held.unpersist()

    def profiles(self) -> DataFrame:
        return profiles(self.table.read())
