"""Record scoring and the cleaned record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import extract, text


def two_places(c: Column) -> Column:
    """Rounded half to even on the exact binary value, as C's and Python's formatting do."""
    return F.call_function("format_number", c, F.lit("0.00")).cast("double")


def confidence(title: Column, author: Column, abstract: Column, year: Column, dept: Column, supervisors: Column) -> Column:
    """0.3 abstract length, 0.2 supervisors, 0.3 filled fields, 0.2 encoding; clamped and rounded to two places."""
    empty = F.lit("")
    n, names = F.length(F.coalesce(abstract, empty)), F.coalesce(F.size(supervisors), F.lit(0))
    filled = sum((F.coalesce(c != "", F.lit(False)).cast("int") for c in (title, author, dept)), F.coalesce(year != 0, F.lit(False)).cast("int"))
    score = F.when(n >= 500, 0.3).when(n >= 200, 0.2).when(n >= 100, 0.1).otherwise(0.0)
    score = score + F.when(names >= 1, 0.1).otherwise(0.0) + F.when(names >= 2, 0.1).otherwise(0.0)
    score = score + F.lit(0.3) * (filled / 4.0)
    whole = F.concat_ws(" ", *(F.coalesce(c, empty) for c in (title, abstract, author)))
    score = score + F.lit(0.2) * text.encoding_integrity(whole)
    return two_places(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def clean_record(raw: DataFrame) -> DataFrame:
    """Raw records (title, author, abstract, year string or int, degree, dept, url, supervisors, metadata) cleaned and scored."""
    named = raw.select(
        text.clean_text("title").alias("title"),
        text.clean_abstract(F.col("abstract")).alias("abstract"),
        text.clean_text("author").alias("author"),
        "supervisors",
        extract.degree(F.col("degree")).alias("degree"),
        extract.year(F.col("year").cast("string")).alias("year"),
        text.clean_text("dept").alias("dept"),
        text.strip(F.coalesce("url", F.lit(""))).alias("url"),
        "metadata",
    )
    found = F.when(F.coalesce(F.size("supervisors"), F.lit(0)) > 0, F.col("supervisors")).otherwise(extract.supervisors(F.col("abstract")))
    named = named.withColumn("supervisors", F.when(F.size(found) > 0, found))
    return named.withColumn("data_confidence", confidence(*(F.col(c) for c in ("title", "author", "abstract", "year", "dept", "supervisors"))))
