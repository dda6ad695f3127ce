"""Command line: ``python -m scholarlens COMMAND ...`` over Parquet tables and landed files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from scholarlens.functions import quality
from scholarlens.operators import embedding, flows, merge, profile, select, stats, vector
from scholarlens.sources import bibtex, files, oai, profiles
from scholarlens.sources.tables import importable


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scholarlens", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("ingest", help="landed OAI pages into a new version of the research table")
    a.add_argument("pages")
    a.add_argument("--table", help="the present version")
    a.add_argument("--out", required=True, help="where versions are written")
    a.add_argument("--since")
    a.add_argument("--degree")
    a.add_argument("--limit", type=int)
    a.add_argument("--skip-existing", action="store_true")
    a.add_argument("--buffer", help="a CSV folder that gets the rows too")
    a.add_argument("--division", help="the set that records belong to")
    a.add_argument("--list-divisions", action="store_true", help="the sets of the pages, and nothing else")
    a.add_argument("--checkpoint-file", help="a checkpoint whose urls --resume leaves out")
    a.add_argument("--resume", action="store_true")
    a.add_argument("--dry-run", action="store_true")
    a = sub.add_parser("enrich", help="supervisors from landed BibTeX exports and PDF texts, named by record number")
    a.add_argument("table")
    a.add_argument("--bibtex", help="a folder of NUMBER.bib files")
    a.add_argument("--texts", help="a folder of NUMBER.txt files, the texts of PDFs")
    a.add_argument("--out", required=True)
    a.add_argument("--limit", type=int, default=1000)
    a.add_argument("--dry-run", action="store_true")
    a = sub.add_parser("recover", help="supervisors from titles and abstracts of records that have none")
    a.add_argument("table")
    a.add_argument("--out", required=True)
    a.add_argument("--limit", type=int)
    a.add_argument("--dry-run", action="store_true")
    a = sub.add_parser("harvest-profiles", help="landed author profiles into a new version of the lecturers table")
    a.add_argument("profiles", help="JSON documents")
    a.add_argument("--table", help="the present version")
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint-file", help="a checkpoint whose ids --resume leaves out; the people harvested are added to it")
    a.add_argument("--resume", action="store_true")
    a.add_argument("--retry-failed", action="store_true", help="only the people that the checkpoint lists as failed")
    a.add_argument("--limit", type=int)
    a.add_argument("--dry-run", action="store_true")
    a = sub.add_parser("embed-profiles", help="vectors of people by their publications, by the offline embedder")
    a.add_argument("table")
    a.add_argument("--out", required=True)
    a.add_argument("--limit", type=int)
    a.add_argument("--min-publications", type=int, default=flows.MIN_PUBLICATIONS)
    a.add_argument("--batch-size", type=int, default=1)
    a.add_argument("--dim", type=int, default=768)
    a = sub.add_parser("search-research", help="research like a text")
    a.add_argument("table")
    a.add_argument("text")
    a.add_argument("--threshold", type=float, default=0.7)
    a.add_argument("-k", type=int, default=10)
    a = sub.add_parser("embed", help="vectors for rows that have none, by the offline embedder")
    a.add_argument("table")
    a.add_argument("--out", required=True)
    a.add_argument("--limit", type=int)
    a.add_argument("--batch-size", type=int, default=50)
    a.add_argument("--dim", type=int, default=768)
    a = sub.add_parser("profile", help="expertise profiles from embedded research")
    a.add_argument("table")
    a.add_argument("--out", required=True)
    a.add_argument("--top", type=int, default=10)
    a = sub.add_parser("search", help="people whose profile is like a text")
    a.add_argument("table")
    a.add_argument("text")
    a.add_argument("--threshold", type=float, default=0.3)
    a.add_argument("-k", type=int, default=10)
    a = sub.add_parser("stats", help="completeness of both tables")
    a.add_argument("research")
    a.add_argument("lecturers")
    return p


def _landed(spark: SparkSession, folder: str | None, name: str):
    """(eprint_id, path, ``name``) of the files of a folder, by the number that their names begin with."""
    if not folder:
        return spark.createDataFrame([], f"eprint_id string, path string, {name} string")
    rows = bibtex.read(spark, folder)
    return rows.select(F.regexp_extract("path", r"(\d+)[^/]*$", 1).alias("eprint_id"), "path", F.col("value").alias(name))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("scholarlens").getOrCreate()
    importable(spark)
    if args.command == "ingest":
        raw = oai.read(spark, args.pages)
        if args.list_divisions:
            raw.select(F.explode("header.setSpec").alias("division")).distinct().orderBy("division").show(1000, truncate=False)
            return
        if args.division:
            raw = oai.in_set(raw, args.division)
        rows = quality.clean_record(oai.records(oai.since(raw, args.since) if args.since else raw))
        if args.degree:
            rows = rows.where(F.col("degree") == args.degree.upper())
        old = spark.read.parquet(args.table) if args.table else None
        if args.skip_existing and old is not None:
            rows = select.new_keys(rows, old, "url")
        if args.resume and args.checkpoint_file:
            rows = select.new_keys(rows, files.processed(files.read_checkpoint(spark, args.checkpoint_file)), "url")
        if args.limit is not None:
            rows = rows.orderBy("url").limit(args.limit)
        if args.dry_run:
            rows.select("url", "title", "degree", "data_confidence").show(20)
            return
        if args.buffer:
            files.append_csv(rows, args.buffer)
        new = merge.shaped(rows)
        print(files.write_version(merge.upsert_research(old if old is not None else new.limit(0), new, [F.col("title")]), args.out))
    elif args.command == "embed":
        table = spark.read.parquet(args.table)
        if "embedding" not in table.columns:
            table = table.withColumn("embedding", F.lit(None).cast("array<float>"))
        todo = select.pending(table, "embedding", "url", args.limit).select("url", embedding.research_text(F.col("title"), F.col("abstract")).alias("text"))
        done = embedding.embedded(todo, "text", embedding.hashing_embedder(args.dim), args.batch_size).where("embedding IS NOT NULL")
        print(files.write_version(merge.update(table, done, "url", ["embedding"]), args.out))
    elif args.command in ("enrich", "recover"):
        table = spark.read.parquet(args.table).withColumn("id", F.col("url"))
        if args.command == "enrich":
            found = flows.enrich(table, _landed(spark, args.bibtex, "value"), _landed(spark, args.texts, "text"), "url", args.limit)
            flows.enrich_counts(found).show()
        else:
            found = flows.recover(table, "url", args.limit)
        if args.dry_run:
            found.where("supervisors IS NOT NULL").show(20, truncate=False)
            return
        print(files.write_version(flows.updated(table, found).drop("id"), args.out))
    elif args.command == "harvest-profiles":
        rows = profiles.read(spark, args.profiles)
        known = files.read_checkpoint(spark, args.checkpoint_file, files.PROFILE) if args.checkpoint_file else None
        if args.resume and known is not None:
            rows = select.new_keys(rows, files.processed(known, "processed_sinta_ids", "sinta_id"), "sinta_id")
        if args.retry_failed:
            if known is None:
                raise SystemExit("--retry-failed needs --checkpoint-file")
            rows = rows.join(known.select(F.inline("failed_sinta_ids")).select("sinta_id").distinct(), "sinta_id", "left_semi")
        if args.limit is not None:
            rows = rows.orderBy("sinta_id").limit(args.limit)
        new = profiles.lecturers(rows)
        if args.dry_run:
            new.select("sinta_id", "name", "dept").show(20)
            return
        path = files.write_version(merge.upsert_profiles(spark.read.parquet(args.table) if args.table else new.limit(0), new), args.out)
        if known is not None:
            files.replace_checkpoint(spark, args.checkpoint_file, files.harvested(known, new))
        print(path)
    elif args.command == "embed-profiles":
        people = spark.read.parquet(args.table)
        if "expertise_vector" not in people.columns:
            people = people.withColumn("expertise_vector", F.lit(None).cast("array<float>"))
        done = flows.embed_profiles(people, embedding.hashing_embedder(args.dim), "sinta_id", "sinta_id", args.limit, args.min_publications, args.batch_size).where("error IS NULL")
        print(files.write_version(merge.update(people, done, "sinta_id", ["expertise_vector"]), args.out))
    elif args.command == "search-research":
        table = spark.read.parquet(args.table)
        size = table.select(F.max(F.size("embedding"))).first()[0] or 1
        vector.match(table, embedding.hashing_embedder(size)([args.text])[0].tolist(), ["url", "title", "degree", "year"], "embedding", "url", args.threshold, args.k).show(args.k, truncate=False)
    elif args.command == "profile":
        people = profile.profiles(spark.read.parquet(args.table).withColumnRenamed("url", "id"))
        path = files.write_version(people, args.out)
        profile.top_lecturers(spark.read.parquet(path), args.top).select("name", "dept", "research_count").show(args.top, truncate=False)
        print(path)
    elif args.command == "search":
        people = spark.read.parquet(args.table)
        size = people.select(F.max(F.size("expertise_vector"))).first()[0] or 1
        query = embedding.hashing_embedder(size)([args.text])[0].tolist()
        vector.match(people, query, ["name", "dept", "research_count"], "expertise_vector", "name", args.threshold, args.k).show(args.k, truncate=False)
    else:
        people = spark.read.parquet(args.lecturers)
        stats.embedding_stats(spark.read.parquet(args.research), people).show()
        if {"sinta_id", "sinta_publications", "expertise_vector"} <= set(people.columns):
            stats.profile_stats(people).show()


if __name__ == "__main__":
    main()
