"""Landed author profiles: JSON documents or the text of pages, as rows for the lecturers table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.functions import constants as k
from scholarlens.functions import extract

_ITEM = "array<struct<title:string,year:int>>"
PROFILE = f"sinta_id string, name string, nidn string, dept string, h_index_scopus int, h_index_gscholar int, publications array<struct<title:string,source:string,year:int>>, expertise_tags array<string>, researches {_ITEM}, services {_ITEM}, iprs {_ITEM}, books {_ITEM}, scraped_at string"
#: Landed pages: the text of the page, and the texts of its lists.
PAGE = "sinta_id string, name string, dept string, body string, tags array<string>, researches array<string>, services array<string>, iprs array<string>, books array<string>"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).json(path)


def authors(pages: DataFrame, processed: DataFrame, limit: int | None = None) -> DataFrame:
    """(sinta_id, name, dept) of author lists, each author once, without the processed ones.

    Of an author's repeated cards the one with a department, then the smallest name and department counts.
    """
    rows = pages.where("sinta_id IS NOT NULL").groupBy("sinta_id").agg(F.min(F.struct(F.col("dept").isNull(), "name", "dept")).alias("c")).select("sinta_id", "c.name", "c.dept")
    rows = rows.join(processed.select("sinta_id"), "sinta_id", "left_anti").orderBy("sinta_id")
    return rows if limit is None else rows.limit(limit)


def parse(pages: DataFrame) -> DataFrame:
    """Profiles (without publications, which have pages of their own) from landed pages."""
    index = extract.h_index(F.col("body"))
    return pages.select(
        "sinta_id",
        "name",
        extract.nidn(F.col("body")).alias("nidn"),
        "dept",
        index["scopus"].alias("h_index_scopus"),
        index["gscholar"].alias("h_index_gscholar"),
        extract.tags(F.col("tags")).alias("expertise_tags"),
        extract.items(F.col("researches"), 10).alias("researches"),
        extract.items(F.col("services"), 10).alias("services"),
        extract.items(F.col("iprs"), 5).alias("iprs"),
        extract.items(F.col("books"), 5).alias("books"),
    )


def lecturers(profiles: DataFrame) -> DataFrame:
    """Profiles as rows that ``merge.upsert_profiles`` takes; missing numbers are 0, missing lists empty."""
    listed = lambda c, name: F.coalesce(F.col(c), F.array().cast(profiles.schema[c].dataType)).alias(name)
    return profiles.select(
        "sinta_id",
        "name",
        F.nullif("nidn", F.lit("")).alias("nidn"),
        F.nullif("dept", F.lit("")).alias("dept"),
        F.coalesce("h_index_scopus", F.lit(0)).alias("h_index_scopus"),
        F.coalesce("h_index_gscholar", F.lit(0)).alias("h_index_gscholar"),
        F.slice(listed("publications", "p"), 1, k.PUBLICATIONS_MAX).alias("sinta_publications"),
        listed("expertise_tags", "expertise_tags"),
        *(listed(c, f"sinta_{c}") for c in ("researches", "services", "iprs", "books")),
        F.col("scraped_at").try_cast("timestamp").alias("sinta_scraped_at"),
    )


def sources_of(pubs: Column) -> Column:
    """Distinct sources of a list of publications."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(pubs, lambda p: p["source"]), lambda s: s.isNotNull())))
