"""Supervisors from BibTeX exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.functions import extract
from scholarlens.functions.constants import BIBTEX_FIELDS


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def supervisors(entry: Column) -> Column:
    """At most two cleaned names of the fields, field by field."""
    fields = [F.regexp_extract(entry, rf"(?is)(?:^|[\s,{{]){f}\s*=\s*[{{\"]([^}}\"]*)[}}\"]", 1) for f in BIBTEX_FIELDS]
    names = F.flatten(F.array(*[F.split(f, " and ") for f in fields]))
    return extract.distinct_names(F.transform(names, lambda x: extract.clean_name(x, "pdf")), 0)
