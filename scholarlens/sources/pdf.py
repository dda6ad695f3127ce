"""Text of landed PDF files by a plug-in: the library itself reads no PDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlens.functions.constants import PDF_NAMES

FIRST_BYTES, FIRST_PAGES = 500 * 1024, 5


def read(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files under ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


def turn(path: Column, eprint_id: Column) -> Column:
    """The place of a record's file in the order in which its names are tried; other names come last."""
    name = F.element_at(F.split(path, "/"), -1)
    out = F.lit(len(PDF_NAMES))
    for k, pattern in reversed([*enumerate(PDF_NAMES)]):
        before, _, after = pattern.partition("{id}")
        whole = F.concat(F.lit(before), eprint_id, F.lit(after)) if "{id}" in pattern else F.lit(pattern)
        out = F.when(name == whole, k).otherwise(out)
    return out


def texts(files: DataFrame, extract: Callable[[bytes, int], str], pages: int = FIRST_PAGES) -> DataFrame:
    """(path, text, error): ``extract(first bytes, pages)`` of each file; one that fails has its error instead."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out.append((path, extract(content[:FIRST_BYTES], pages), None))
                except Exception as e:  # noqa: BLE001  whatever the plug-in raises
                    out.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")
