"""Keyed merges as pure functions of DataFrames. Writing is the caller's: to a new version of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarlens.functions import constants as k


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order``; a batch may name a key twice, a merge must not."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def merge(old: DataFrame, new: DataFrame, key: str, keep_if_null: tuple[str, ...] = (), updated: tuple[str, Column] | None = None, only: Column | None = None) -> DataFrame:
    """Old rows overwritten by new ones of the same key, and the new rows of other keys.

    A null key matches nothing, so such rows are added. Columns in ``keep_if_null`` keep the old value where the new
    one is null. ``updated`` is a column set to a value on matched rows. ``only`` restricts the old rows that can match.
    Columns that only one side has are null on the other's rows.
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    match = F.col(f"o.{key}") == F.col(f"n.{key}")
    if only is not None:
        old, match = old.withColumn("_can", only), match & F.col("o._can")
    joined = old.withColumn("_old", F.lit(True)).alias("o").join(new.withColumn("_new", F.lit(True)).alias("n"), match, "full_outer")
    is_new, is_old = F.col("n._new").isNotNull(), F.col("o._old").isNotNull()
    out = []
    for c in columns:
        a = F.col(f"o.{c}") if c in old.columns else F.lit(None)
        b = F.col(f"n.{c}") if c in new.columns else a
        value = F.coalesce(b, a) if c in keep_if_null else F.when(is_new, b).otherwise(a)
        if updated is not None and c == updated[0]:
            value = F.when(is_new & is_old, updated[1]).otherwise(value)
        out.append(value.alias(c))
    return joined.select(*out)


def upsert_research(old: DataFrame, new: DataFrame, order: list[Column], now: Column | None = None) -> DataFrame:
    """Merge on url; rows without url or title are skipped, a url that repeats keeps its first row by ``order``."""
    valid = new.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))
    return merge(old, latest(valid, "url", order), "url", updated=("updated_at", now) if now is not None and "updated_at" in old.columns else None)


def _once(new: DataFrame, key: str, order: list[Column] | None) -> DataFrame:
    """Rows of a batch with each key once, the first by ``order`` (all columns, unless given); null keys stay."""
    named = latest(new.where(F.col(key).isNotNull()), key, order or [F.struct(*(c for c in new.columns if c != key))])
    return named.unionByName(new.where(F.col(key).isNull()))


def upsert_profiles(old: DataFrame, new: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Merge on sinta_id; nidn and dept stay where the new value is null. An id that repeats in the batch counts once."""
    return merge(old, _once(new, "sinta_id", order), "sinta_id", keep_if_null=("nidn", "dept"))


def upsert_by_name(old: DataFrame, new: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Merge on name, among rows that no sinta_id names: names are not unique beyond them. A repeated name counts once."""
    return merge(old, _once(new, "name", order), "name", only=F.col("sinta_id").isNull())


def update(old: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of the rows that ``changes`` names; nothing is added."""
    new = changes.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = old.join(new, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))


def appended(held: DataFrame, new: DataFrame) -> DataFrame:
    """What a dry run holds after a batch: valid rows are added as they come, a url that repeats too."""
    return held.unionByName(new.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "")), allowMissingColumns=True)


def batch_counts(new: DataFrame) -> DataFrame:
    """inserted, skipped: what an upsert of the batch counts."""
    ok = (F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "")
    return new.agg(F.count_if(ok).alias("inserted"), F.count_if(~ok).alias("skipped"))


def variant(metadata: Column) -> Column:
    """A string as a variant: the JSON value that it is, or {"raw": string}; null stays null."""
    raw = F.to_variant_object(F.struct(metadata.alias("raw")))
    return F.when(metadata.isNotNull(), F.coalesce(F.try_parse_json(metadata), raw))


def shaped(records: DataFrame, as_variant: bool = False) -> DataFrame:
    """Cleaned records as table rows: lengths cut, empty supervisors dropped, metadata a JSON object.

    ``metadata`` is a string; what is no JSON object is kept under "raw". With ``as_variant`` it becomes a variant, of
    whatever JSON value it is.
    """
    def cut(c: str, n: int) -> Column:
        return F.nullif(F.substring(c, 1, n), F.lit(""))

    names = F.filter("supervisors", lambda x: F.coalesce(x, F.lit("")) != "")
    is_object = F.try_parse_json("metadata").isNotNull() & F.trim("metadata").startswith("{")
    meta = F.when(F.coalesce("metadata", F.lit("")) == "", "{}").when(is_object, F.col("metadata")).otherwise(F.to_json(F.struct(F.col("metadata").alias("raw"))))
    return records.select(
        F.substring("title", 1, k.TITLE_MAX).alias("title"),
        "abstract",
        F.coalesce(cut("author", k.AUTHOR_MAX), F.lit("Unknown")).alias("author"),
        F.when(F.size(names) > 0, names).alias("supervisors"),
        F.substring("degree", 1, k.DEGREE_MAX).alias("degree"),
        "year",
        cut("dept", k.DEPT_MAX).alias("dept"),
        "url",
        "data_confidence",
        (variant(F.col("metadata")) if as_variant else meta).alias("metadata"),
    )
