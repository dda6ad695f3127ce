"""CSV buffer, JSON checkpoints, versioned tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.functions.constants import CSV_COLUMNS

CSV = ", ".join(f"{c} string" for c in CSV_COLUMNS)
HARVEST = "total_discovered bigint, total_processed bigint, total_success bigint, total_failed bigint, last_url string, processed_urls array<string>, failed_urls array<struct<url:string,error:string>>, started_at string, updated_at string"
PROFILE = "current_page bigint, total_pages bigint, total_lecturers bigint, total_scraped bigint, total_failed bigint, processed_sinta_ids array<string>, failed_sinta_ids array<struct<sinta_id:string,error:string>>, cached_authors array<struct<sinta_id:string,name:string,dept:string>>, started_at string, updated_at string, is_paused boolean, pause_reason string"


def csv_shape(records: DataFrame) -> DataFrame:
    """The nine columns as strings; supervisors joined by "; "."""
    out = records.withColumn("supervisors", F.array_join("supervisors", "; "))
    return out.select(*(F.col(c).cast("string").alias(c) for c in CSV_COLUMNS))


def append_csv(records: DataFrame, path: str) -> None:
    csv_shape(records).write.mode("append").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CSV).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_checkpoint(spark: SparkSession, path: str, schema: str = HARVEST) -> DataFrame:
    """A checkpoint document as one row; keys that the schema lacks are dropped."""
    return spark.read.schema(schema).json(path, multiLine=True)


def processed(checkpoint: DataFrame, field: str = "processed_urls", key: str = "url") -> DataFrame:
    return checkpoint.select(F.explode(field).alias(key)).distinct()


def repaired_ids(spark: SparkSession, path: str, field: str = "processed_sinta_ids") -> DataFrame:
    """Ids listed in a broken checkpoint: quoted strings after ``field`` up to a closing bracket."""
    text = spark.read.text(path, wholetext=True)
    listed = F.regexp_extract("value", rf'(?s)"{field}"\s*:\s*\[(.*?)(?:\]|$)', 1)
    return text.select(F.explode(F.regexp_extract_all(listed, F.lit('"([^"]+)"'), F.lit(1))).alias("sinta_id")).distinct()


def write_version(df: DataFrame, root: str) -> str:
    """``df`` as a new version under ``root``: a merge never writes over the files that it reads."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def write_checkpoint(spark: SparkSession, path: str, state: DataFrame) -> None:
    """``state`` (one row, as ``read_checkpoint`` gives it) as a JSON document; a progress log holds a large harvest."""
    state.coalesce(1).write.mode("overwrite").json(path)


def replace_checkpoint(spark: SparkSession, path: str, state: DataFrame) -> None:
    """``write_checkpoint`` where ``state`` may be made from what ``path`` holds: it is written beside it first."""
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    write_checkpoint(spark, beside, state)
    place = spark._jvm.org.apache.hadoop.fs.Path
    held = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    held.delete(place(path), True)
    held.rename(place(beside), place(path))


def harvested(checkpoint: DataFrame, done: DataFrame) -> DataFrame:
    """A profile harvest's checkpoint (one row, or none yet) after the people ``done`` (sinta_id) were harvested: they are processed, and failed no more."""
    none = F.array().cast("array<string>")
    ids = done.select("sinta_id").distinct().agg(F.array_sort(F.collect_list("sinta_id")).alias("now"))
    both = ids.join(checkpoint.limit(1), how="left")  # one row each
    now = F.array_sort(F.array_union(F.coalesce("processed_sinta_ids", none), F.col("now")))
    failed = F.filter(F.coalesce("failed_sinta_ids", F.array().cast("array<struct<sinta_id:string,error:string>>")), lambda f: ~F.array_contains(F.col("now"), f["sinta_id"]))
    rows = both.withColumns({"processed_sinta_ids": now, "failed_sinta_ids": failed}).drop("now")
    return rows.withColumns({"total_scraped": F.size("processed_sinta_ids").cast("bigint"), "total_failed": F.size("failed_sinta_ids").cast("bigint")})
