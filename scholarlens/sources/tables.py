"""Tables of a directory of Parquet files."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this library where it is only on the driver's path (local mode)."""
    found = spark.sparkContext.environment
    if _ROOT not in found.get("PYTHONPATH", "").split(":"):
        found["PYTHONPATH"] = f"{_ROOT}:{found.get('PYTHONPATH', '')}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set a local master gets a temporary folder (tests); on a cluster that would be a different one on
    each machine, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        global _own
        _own = found = _own or tempfile.mkdtemp(prefix="scholarlens-")
    return found.rstrip("/")
