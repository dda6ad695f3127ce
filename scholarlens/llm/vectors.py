"""What the vector operators share: rows that can take part, and blocks of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> Column:
    """Not null, without null or non-finite components, not zero."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def with_length(rows: DataFrame, length: int, keep: bool = False) -> DataFrame:
    """vec_id, embedding of usable rows of that length: as doubles, or with ``keep`` as floats where they are floats."""
    kind = rows.schema["embedding"].dataType.simpleString()
    kind = kind if keep and kind == "array<float>" else "array<double>"
    rows = rows.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
    return rows.where(F.size("embedding") == length)


def of_main_length(rows: DataFrame, keep: bool = False) -> DataFrame:
    """``with_length`` of the commonest length; vectors of other lengths cannot be compared with them."""
    known = rows.where(usable() & F.col("vec_id").isNotNull())
    top = known.groupBy(F.size("embedding").alias("k")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "k").first()
    return with_length(rows, top["k"] if top else 0, keep)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def sample(rows: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` vectors, chosen by a hash of vec_id."""
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("embedding").toArrow()
    return matrix(found.column("embedding"))
