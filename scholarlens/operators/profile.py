"""Expertise profiles: one row for each supervisor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vector import centroids


def normal_name(c: Column) -> Column:
    """White space collapsed, blanks, dots and commas trimmed; the case stays."""
    return F.btrim(F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+", " "), F.lit("., "))


def links(research: DataFrame) -> DataFrame:
    """(name, id, embedding, dept): a row for each supervisor entry longer than two characters.

    An entry that occurs twice in one research is two links.
    """
    rows = research.where(F.col("embedding").isNotNull() & (F.coalesce(F.size("supervisors"), F.lit(0)) > 0))
    rows = rows.select("id", "embedding", "dept", F.explode("supervisors").alias("raw"))
    return rows.where(F.length(F.trim("raw")) > 2).select(normal_name(F.col("raw")).alias("name"), "id", "embedding", "dept").where("name <> ''")


def modal(c: Column) -> Column:
    """The commonest non-empty value; the smallest of equally common ones; empty if there is none."""
    return F.coalesce(F.mode(F.nullif(c, F.lit("")), True), F.lit(""))


def profiles(research: DataFrame) -> DataFrame:
    """name, dept, research_count, expertise_vector."""
    found = links(research)
    counts = found.groupBy("name").agg(modal(F.col("dept")).alias("dept"), F.count("*").alias("research_count"))
    vectors = centroids(found, "name").withColumnRenamed("centroid", "expertise_vector")
    return counts.join(vectors, "name")


def top_lecturers(lecturers: DataFrame, n: int = 10) -> DataFrame:
    return lecturers.orderBy(F.col("research_count").desc_nulls_first(), "name").limit(n)
