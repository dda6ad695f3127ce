"""Landed OAI-PMH pages: an XML scan with an explicit string schema, and the record parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.functions import extract
from scholarlens.functions.constants import BASE_URL

#: Nothing is inferred: inference would turn partial dates into timestamps.
RECORD = (
    "header struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>, "
    "metadata struct<dc:struct<title:array<string>,creator:array<string>,date:array<string>,subject:array<string>,description:array<string>,type:array<string>>>"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", "true").schema(RECORD).load(path)


def records(raw: DataFrame, base: str = BASE_URL) -> DataFrame:
    """Raw research records; deleted ones and those without metadata or an identifier are dropped."""
    dc, none = F.col("metadata.dc"), F.array().cast("array<string>")
    rows = raw.where(F.col("metadata.dc").isNotNull() & (F.coalesce("header._status", F.lit("")) != "deleted") & (F.coalesce("header.identifier", F.lit("")) != ""))
    subjects = F.filter(F.coalesce(dc["subject"], none), lambda s: F.coalesce(s, F.lit("")) != "")
    return rows.select(
        F.get(dc["title"], F.lit(0)).alias("title"),
        F.coalesce(F.get(dc["creator"], F.lit(0)), F.lit("Unknown")).alias("author"),
        extract.first_year(F.coalesce(dc["date"], none)).alias("year"),
        extract.degree_of_record(dc["type"], subjects).alias("degree"),
        extract.dept_of_record(subjects).alias("dept"),
        F.coalesce(F.get(dc["description"], F.lit(0)), F.lit("")).alias("abstract"),
        F.concat(F.lit(base + "/"), F.element_at(F.split("header.identifier", ":"), -1), F.lit("/")).alias("url"),
        none.alias("supervisors"),
        F.to_json(F.struct(F.col("header.identifier").alias("oai_identifier"), F.col("header.datestamp").alias("oai_datestamp"), subjects.alias("subjects"))).alias("metadata"),
    )


def since(raw: DataFrame, date: str) -> DataFrame:
    """Records stamped on ``date`` (ISO) or later."""
    return raw.where(F.col("header.datestamp") >= date)


def in_set(raw: DataFrame, name: str) -> DataFrame:
    """Records of an OAI set, or of one below it."""
    return raw.where(F.exists(F.coalesce("header.setSpec", F.array().cast("array<string>")), lambda s: (s == name) | F.startswith(s, F.lit(f"{name}:"))))
