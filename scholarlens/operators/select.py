"""Selections: pending rows, lookups, skip sets, harvest choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlens.functions import constants as k
from scholarlens.functions import extract


def count_rows(df: DataFrame, degree: str | None = None) -> DataFrame:
    if degree is not None:
        df = df.where(F.col("degree") == degree.upper())
    return df.agg(F.count("*").alias("n"))


def existing(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return keys.join(table.select(key), key, "left_semi").select(key).distinct()


def new_keys(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return keys.join(table.select(key), key, "left_anti")


def pending(df: DataFrame, vector: str, order: str, limit: int | None = None, least_publications: int | None = None) -> DataFrame:
    """Rows whose vector is missing, the first ``limit`` by ``order``; with ``least_publications`` those with as many publications.

    Without a limit there is nothing to choose, and no sort.
    """
    out = df.where(F.col(vector).isNull())
    if least_publications is not None:
        out = out.where(F.size("sinta_publications") >= least_publications)
    return out if limit is None else out.orderBy(order).limit(limit)


def without_supervisors(df: DataFrame, order: str, limit: int, limit_first: bool = False) -> DataFrame:
    """Rows with no supervisors. ``limit_first`` looks at the first ``limit`` rows only, so fewer may return."""
    empty = F.coalesce(F.size("supervisors"), F.lit(0)) == 0
    if limit_first:
        return df.orderBy(order).limit(limit).where(empty)
    return df.where(empty).orderBy(order).limit(limit)


def harvest(urls: DataFrame, processed: DataFrame, divisions: list[str] | None = None, degree: str | None = None, limit: int | None = None) -> DataFrame:
    """Links to fetch: of the named divisions (or those whose name holds the degree), not processed, each once; the first ``limit`` by url."""
    out = urls
    if divisions:
        out = out.where(F.col("division").isin(divisions))
    if degree:
        out = out.where(F.contains(F.col("division"), F.lit(degree)))
    out = out.groupBy("url").agg(F.min("division").alias("division")).join(processed.select("url"), "url", "left_anti")
    return out if limit is None else out.orderBy("url").limit(limit)


def with_tag(lecturers: DataFrame, tags: list[str]) -> DataFrame:
    return lecturers.where(F.arrays_overlap("expertise_tags", F.array(*map(F.lit, tags))))


def publication_years(pubs: Column) -> Column:
    years = F.filter(F.transform(pubs, lambda p: p["year"]), lambda y: F.coalesce(y, F.lit(0)) != 0)
    return F.array_sort(F.array_distinct(years))


def publications(pages: DataFrame, key: str = "author_id") -> DataFrame:
    """(key, publications) from (key, source, page, pos, title, year).

    A title has 10 characters or more and its year is missing or MIN_YEAR or later; reading a source stops after the
    first page with none of them; 50 of a source and 50 in all, scopus first.
    """
    rows = pages.withColumn("ok", F.coalesce(F.length("title") >= 10, F.lit(False)) & F.coalesce(F.col("year") >= k.MIN_YEAR, F.lit(True)))
    kept = rows.groupBy(key, "source", "page").agg(F.max("ok").alias("any"))
    stop = kept.where("NOT any").groupBy(key, "source").agg(F.min("page").alias("stop"))
    rows = rows.where("ok").join(stop, [key, "source"], "left").where(F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    by_source = Window.partitionBy(key, "source").orderBy("page", "pos")
    rows = rows.withColumn("n", F.row_number().over(by_source)).where(F.col("n") <= k.PUBLICATIONS_MAX)
    first = F.when(F.col("source") == "scopus", 0).otherwise(1).alias("first")
    held = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(first, "n", "title", "source", "year"))).alias("p"))
    return held.select(key, F.transform(F.slice("p", 1, k.PUBLICATIONS_MAX), lambda x: F.struct(x["title"].alias("title"), x["source"].alias("source"), x["year"].alias("year"))).alias("publications"))


def enriched(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Records with the abstract and supervisors of their parsed pages.

    An abstract that is missing or under 100 characters gives way to a longer one; supervisors come from the page's
    metadata, else from the abstract, where there are none.
    """
    found = pages.select("url", F.col("abstract").alias("_a"), F.col("supervisors").alias("_s"))
    out = records.join(found, "url", "left")
    old, new = F.coalesce("abstract", F.lit("")), F.coalesce("_a", F.lit(""))
    out = out.withColumn("abstract", F.when((F.length(old) < 100) & (F.length(new) > F.length(old)), new).otherwise(F.col("abstract")))
    none = F.coalesce(F.size("supervisors"), F.lit(0)) == 0
    meta = F.when(F.coalesce(F.size("_s"), F.lit(0)) > 0, F.col("_s")).otherwise(extract.supervisors(F.col("abstract")))
    return out.withColumn("supervisors", F.when(none, meta).otherwise(F.col("supervisors"))).drop("_a", "_s")


def full_text(df: DataFrame, words: list[str], columns: tuple[str, ...] = ("title", "abstract")) -> DataFrame:
    """Rows that have all the words in the columns."""
    tokens = F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+")
    hit = F.lit(True)
    for w in words:
        hit = hit & F.array_contains(tokens, w.lower())
    return df.where(hit)
