"""The corpus pipeline: five stages over ``documents``, each stored before the next reads it.

Quality drops documents, near-dedup keeps one of each group, substring dedup cuts repeated passages out of texts (and
drops documents of which nothing is left), the secret scan replaces secrets by their kind, and packing returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholarlens.llm import minhash, packing, quality, secrets, substring
from scholarlens.llm.common import finished, mark, prepared, table

STAGES = [
    ("quality_classifier", lambda spark, docs, sf_dir: quality.kept(docs)),
    ("minhash_near_dedup", lambda spark, docs, sf_dir: minhash.deduplicated(docs)),
    ("substring_dedup", lambda spark, docs, sf_dir: substring.without_repeats(docs)),
    ("secret_scan", lambda spark, docs, sf_dir: secrets.redacted(docs)),
    ("best_fit_packing", lambda spark, docs, sf_dir: packing.packed(docs)),
]

#: A fitted classifier, hashes and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs, since = table(spark, sf_dir, "documents"), mark()
    for _, stage in STAGES:
        # What a stage has read and stored is removed as soon as its result is written.
        docs = finished(stage(spark, docs, sf_dir), since)
    return docs
