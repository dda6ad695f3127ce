"""Embedding inputs, and the plug-in that turns texts into vectors."""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarlens.functions import constants as k
from scholarlens.functions.text import strip
from scholarlens.sources.keyed import KeyedTable

from . import merge


def research_text(title: Column, abstract: Column) -> Column:
    """The title, and the abstract if it has more than 50 characters."""
    long = F.length(strip(F.coalesce(abstract, F.lit("")))) > k.MIN_ABSTRACT
    named = F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")))
    return F.when(long, F.concat(named, F.lit(". Abstract: "), F.substring(abstract, 1, k.TEXT_MAX))).otherwise(named)


def expertise_text(name: Column, dept: Column, pubs: Column) -> Column:
    """A sentence on a person from the first twenty publications; empty without any usable title."""
    titles = F.filter(F.transform(F.slice(pubs, 1, k.ITEMS_MAX), lambda p: strip(p["title"])), lambda t: F.length(t) > 10)
    where = F.coalesce(F.nullif(dept, F.lit("")), F.lit("Unknown Department"))
    text = F.concat(F.lit(k.EXPERTISE[0]), name, F.lit(k.EXPERTISE[1]), where, F.lit(k.EXPERTISE[2]), F.array_join(titles, "; "))
    return F.when(F.coalesce(F.size(titles), F.lit(0)) > 0, F.substring(text, 1, k.TEXT_MAX)).otherwise("")


def hashing_embedder(dim: int = 768) -> Callable[[list[str]], np.ndarray]:
    """A deterministic stand-in for a model: signed word hashes at unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for row, text in zip(out, texts, strict=True):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.md5(word.encode(), usedforsecurity=False).digest()[:8], "big")
                row[h % dim] += 1.0 if h >> 63 else -1.0
            size = np.linalg.norm(row)
            if size:
                row /= size
        return out

    return embed


class RateLimited(Exception):
    """A model says: later."""


def retrying(embed: Callable[[list[str]], np.ndarray], tries: int = 10, first: float = 10.0, most: float = 300.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[list[str]], np.ndarray]:
    """``embed`` that waits, twice as long each time, when it is rate-limited; other errors go through."""

    def run(texts: list[str]) -> np.ndarray:
        for turn in range(tries):
            try:
                return embed(texts)
            except RateLimited:
                if turn == tries - 1:
                    raise
                sleep(min(most, first * 2**turn))
        raise ValueError("no try was allowed")

    return run


class QuotaExhausted(Exception):
    """A model says: no more today."""


class Stop:
    """A mark in a folder that all tasks share: once one has set it, none calls the model any more."""

    def __init__(self, folder: str):
        self.folder = folder

    def _mark(self):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", self.folder))
        return files, f"{root.rstrip('/')}/stopped"

    def reason(self) -> str | None:
        files, mark = self._mark()
        if files.get_file_info(mark).is_file:
            with files.open_input_stream(mark) as held:
                return held.read().decode()
        return None

    def set(self, reason: str) -> None:
        files, mark = self._mark()
        files.create_dir(mark.rsplit("/", 1)[0])
        with files.open_output_stream(mark) as held:
            held.write(reason.encode())

    def clear(self) -> None:
        files, mark = self._mark()
        if files.get_file_info(mark).is_file:
            files.delete_file(mark)


def embedded(df: DataFrame, text: str, embed: Callable[[list[str]], np.ndarray], batch: int = 50, stop: Stop | None = None) -> DataFrame:
    """``df`` with ``embedding`` and ``error``: a batch that fails marks its own rows and no other.

    A model that raises ``QuotaExhausted`` sets ``stop``, which every task looks at before it calls the model: the rows
    that are left have neither an embedding nor an error of their own, only the quota's.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors: list = [None] * len(frame)
            errors: list = [None] * len(frame)
            for a in range(0, len(frame), batch):
                rows = range(a, min(a + batch, len(frame)))
                if stop is not None and (reason := stop.reason()) is not None:
                    for i in rows:
                        errors[i] = reason
                    continue
                try:
                    for i, v in zip(rows, embed([frame[text].iat[i] or "" for i in rows]), strict=True):
                        vectors[i] = [float(x) for x in v]
                except Exception as e:  # noqa: BLE001  whatever the model raises
                    if stop is not None and isinstance(e, QuotaExhausted):
                        stop.set(f"{type(e).__name__}: {e}")
                    for i in rows:
                        errors[i] = f"{type(e).__name__}: {e}"
            yield frame.assign(embedding=vectors, error=errors)

    from pyspark.sql import types as T

    kept = df.drop("embedding", "error")
    schema = T.StructType([*kept.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("error", T.StringType())])
    return kept.mapInPandas(run, schema)


def embed_pending(table: KeyedTable, text: Column, embed: Callable[[list[str]], np.ndarray], folder: str, vector: str = "embedding", batch: int = 50) -> dict[str, int]:
    """Vectors for rows of ``table`` that have none, until there are no more or the model's quota is exhausted.

    The model's answers are written below ``folder`` before anything reads them, so no text is sent twice by a run; the
    rows that got a vector are merged into the table, bucket by bucket, and the others stay pending for the next run,
    which starts without the mark. succeeded, failed and left: the rows of each kind.
    """
    stop = Stop(folder)
    stop.clear()
    path = f"{folder.rstrip('/')}/answers-{uuid.uuid4().hex}"
    todo = table.read().where(F.col(vector).isNull() & F.col(table.key).isNotNull()).select(table.key, text.alias("_text"))
    embedded(todo, "_text", embed, batch, stop).drop("_text").write.parquet(path)
    answers = table.spark.read.parquet(path)
    done = answers.where("embedding IS NOT NULL").select(table.key, F.col("embedding").cast(table.schema[vector].dataType).alias(vector))
    table.merge(done, lambda old, new: merge.update(old, new, table.key, [vector]))
    quota = F.col("error").startswith(F.lit(f"{QuotaExhausted.__name__}:"))
    return answers.agg(F.count("embedding").alias("succeeded"), F.count_if(F.col("error").isNotNull() & ~quota).alias("failed"), F.count_if(quota).alias("left")).first().asDict()
