"""Flows over tables and landed files: enrichment, recovery, embedding of profiles, progress of a harvest.

Each returns what it found, so a caller can count it, show it or merge it (``merge.update``) into a new version.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlens.functions import extract
from scholarlens.sources import bibtex as bib
from scholarlens.sources import pdf

from . import embedding, merge, select

MIN_PUBLICATIONS = 1


def _first(rows: DataFrame, name: str, names: Column, order: Column) -> DataFrame:
    """(eprint_id, ``name``): the names in the first landed file of each record, if it has any."""
    some = rows.groupBy("eprint_id").agg(F.min_by(names, order).alias(name))
    return some.where(F.size(name) > 0)


def enrich(research: DataFrame, bibtex: DataFrame, pdfs: DataFrame, order: str = "id", limit: int = 1000) -> DataFrame:
    """id, eprint_id, supervisors, source of the first ``limit`` records without supervisors.

    ``bibtex`` is (eprint_id, path, value) and ``pdfs`` (eprint_id, path, text) of landed files. A BibTeX export comes
    before a PDF; of a record's PDFs only the first by the order of their names is read. source is null where neither names anyone, or where the url holds no record's number.
    """
    todo = select.without_supervisors(research, order, limit).select("id", extract.eprint_id(F.col("url")).alias("eprint_id"))
    named = todo.join(_first(bibtex, "_b", bib.supervisors(F.col("value")), F.struct("path")), "eprint_id", "left").join(_first(pdfs, "_p", extract.supervisors_pdf(F.col("text")), F.struct(pdf.turn(F.col("path"), F.col("eprint_id")), "path")), "eprint_id", "left")
    return named.select("id", "eprint_id", F.coalesce("_b", "_p").alias("supervisors"), F.when(F.col("_b").isNotNull(), "bibtex").when(F.col("_p").isNotNull(), "pdf").alias("source"))


def enrich_counts(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("checked"), F.count_if(F.col("source") == "bibtex").alias("bibtex"), F.count_if(F.col("source") == "pdf").alias("pdf"), F.count_if(F.col("source").isNull()).alias("failed"))


def recover(research: DataFrame, order: str = "id", limit: int | None = None) -> DataFrame:
    """id, supervisors found in title and abstract of records that have none; ``limit`` is of the records looked at."""
    rows = research if limit is None else research.orderBy(order).limit(limit)
    none = F.coalesce(F.size("supervisors"), F.lit(0)) == 0
    found = rows.where(none).select("id", extract.supervisors_anywhere(F.col("title"), F.col("abstract")).alias("supervisors"))
    return found.where(F.size("supervisors") > 0)


def updated(research: DataFrame, found: DataFrame) -> DataFrame:
    """``research`` with the supervisors that ``enrich`` or ``recover`` found."""
    return merge.update(research, found.where("supervisors IS NOT NULL"), "id", ["supervisors"])


def profile_texts(lecturers: DataFrame, key: str = "id", order: str = "id", limit: int | None = None, least: int = MIN_PUBLICATIONS) -> DataFrame:
    """(key, text) of people who have publications and no vector; an empty text is left out."""
    todo = select.pending(lecturers, "expertise_vector", order, limit, least)
    texts = todo.select(key, embedding.expertise_text(F.col("name"), F.col("dept"), F.col("sinta_publications")).alias("text"))
    return texts.where("text <> ''")


def embed_profiles(lecturers: DataFrame, embed: Callable[[list[str]], np.ndarray], key: str = "id", order: str = "id", limit: int | None = None, least: int = MIN_PUBLICATIONS, batch: int = 1) -> DataFrame:
    """(key, text, expertise_vector, error): what ``merge.update`` takes, and what failed."""
    return embedding.embedded(profile_texts(lecturers, key, order, limit, least), "text", embed, batch).withColumnRenamed("embedding", "expertise_vector")


#: Rows of a harvest's progress: one for each attempt at a key.
PROGRESS = "key string, ok boolean, error string, at timestamp"


def progress(log: DataFrame) -> DataFrame:
    """key, ok, error, tries: the last state of every key of a progress log; ``ok`` stays once it was reached."""
    return log.groupBy("key").agg(F.bool_or("ok").alias("ok"), F.max_by("error", "at").alias("error"), F.count("*").alias("tries")).withColumn("error", F.when(~F.col("ok"), F.col("error")))


def paused(log: DataFrame, most: int = 20) -> DataFrame:
    """is_paused, pause_reason: whether the last ``most`` attempts of a log all failed for want of a network."""
    last = log.orderBy(F.desc("at"), "key").limit(most)
    n = last.agg(F.count_if(~F.col("ok") & extract.is_network_error(F.col("error"))).alias("n"))
    reason = F.concat(F.lit("Network disconnected - "), F.col("n"), F.lit(" consecutive failures"))
    return n.select((F.col("n") >= most).alias("is_paused"), F.when(F.col("n") >= most, reason).alias("pause_reason"))


def progress_counts(log: DataFrame, discovered: DataFrame) -> DataFrame:
    """total_discovered, total_processed, total_success, total_failed."""
    state = progress(log)
    known = discovered.select(F.col("key").alias("key")).distinct().join(state, "key", "left")
    return known.agg(F.count("*").alias("total_discovered"), F.count("ok").alias("total_processed"), F.count_if("ok").alias("total_success"), F.count_if(~F.col("ok")).alias("total_failed"))


def to_do(discovered: DataFrame, log: DataFrame, retry: bool = False, most: int = 3) -> DataFrame:
    """Keys to fetch: never tried, or with ``retry`` failed fewer than ``most`` times."""
    state = progress(log)
    done = state.where(F.col("ok") | (F.col("tries") >= most)) if retry else state
    return discovered.select("key").distinct().join(done.select("key"), "key", "left_anti")
