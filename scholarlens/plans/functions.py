"""SQL table functions over registered views ``researches`` and ``lecturers``."""

from __future__ import annotations

from pyspark.sql import SparkSession

_SIMILARITY = "try_divide(aggregate(zip_with({v}, q, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x), nullif(sqrt(aggregate({v}, 0D, (s, x) -> s + double(x) * double(x))) * sqrt(aggregate(q, 0D, (s, x) -> s + x * x)), 0D))"


#: A search: columns with their types, the vector, the view.
_SEARCHES = {
    "match_research": ("id STRING, title STRING, abstract STRING, author STRING, supervisors ARRAY<STRING>, degree STRING, year INT, dept STRING, url STRING", "embedding", "researches", "0.7D"),
    "match_lecturers": ("id STRING, name STRING, dept STRING, research_count INT", "expertise_vector", "lecturers", "0.5D"),
}


def register(spark: SparkSession) -> None:
    """match_research(q, t, k) and match_lecturers(q, t, k): the k rows most similar to q, at least t, in order.

    Threshold and number have the usual defaults. The same with _all has no limit and no order. get_embedding_stats()
    and get_sinta_stats() return one row each.
    """
    for name, (columns, vector, view, threshold) in _SEARCHES.items():
        names = ", ".join(c.split()[0] for c in columns.split(", "))
        rows = f"SELECT {names}, {_SIMILARITY.format(v=vector)} AS similarity FROM {view} WHERE {vector} IS NOT NULL"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_all(q ARRAY<DOUBLE>, t DOUBLE) RETURNS TABLE ({columns}, similarity DOUBLE) RETURN SELECT * FROM ({rows}) WHERE similarity >= t")
        # a function's limit must be a constant, so rows are numbered; Spark keeps the first k of each task
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(q ARRAY<DOUBLE>, t DOUBLE DEFAULT {threshold}, k INT DEFAULT 10) RETURNS TABLE ({columns}, similarity DOUBLE)
            RETURN SELECT {names}, similarity FROM (SELECT *, row_number() OVER (ORDER BY similarity DESC, id) AS place FROM ({rows}) WHERE similarity >= t) WHERE place <= k ORDER BY place
        """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION get_embedding_stats()
        RETURNS TABLE (total_researches BIGINT, embedded_researches BIGINT, pending_researches BIGINT, total_lecturers BIGINT, profiled_lecturers BIGINT)
        RETURN SELECT r.*, l.* FROM (SELECT count(*), count(embedding), count_if(embedding IS NULL) FROM researches) r CROSS JOIN (SELECT count(*), count(expertise_vector) FROM lecturers) l
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION get_sinta_stats()
        RETURNS TABLE (total_lecturers BIGINT, with_sinta_id BIGINT, with_publications BIGINT, with_expertise_vector BIGINT, pending_vectorization BIGINT)
        RETURN SELECT count(*), count(sinta_id), count_if(size(sinta_publications) > 0), count(expertise_vector), count_if(size(sinta_publications) > 0 AND expertise_vector IS NULL) FROM lecturers
    """)


#: Columns of the lecturers table, and those of them that keep their value where the new one is null.
LECTURERS = {
    "sinta_id": "STRING", "name": "STRING", "nidn": "STRING", "dept": "STRING", "h_index_scopus": "INT", "h_index_gscholar": "INT", "sinta_publications": "STRING", "expertise_tags": "ARRAY<STRING>",
    "sinta_researches": "STRING", "sinta_services": "STRING", "sinta_iprs": "STRING", "sinta_books": "STRING",
}
_KEPT = ("nidn", "dept")
_MERGED = ", ".join(["coalesce(n.sinta_id, o.sinta_id) AS sinta_id", *(f"coalesce(n.{c}, o.{c}) AS {c}" if c in _KEPT else f"if(n.seq IS NULL, o.{c}, n.{c}) AS {c}" for c in LECTURERS if c != "sinta_id")])

#: A SQL script: the rows of the view ``incoming`` (the columns above, and seq: of rows with one sinta_id the last counts)
#: into the next version of the table of lecturers, which the view ``lecturers`` then shows; the last two versions stay.
UPSERT_LECTURERS = f"""
BEGIN
  DECLARE old STRING DEFAULT lecturers_table || '_v' || lecturers_version;
  DECLARE target STRING DEFAULT lecturers_table || '_v' || (lecturers_version + 1);
  DECLARE gone STRING DEFAULT lecturers_table || '_v' || (lecturers_version - 1);
  EXECUTE IMMEDIATE 'CREATE TABLE ' || target || ' USING parquet AS
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY sinta_id ORDER BY seq DESC) AS place FROM incoming WHERE sinta_id IS NOT NULL),
    n AS (SELECT * EXCEPT (place) FROM ranked WHERE place = 1)
    SELECT {_MERGED}, if(n.seq IS NULL, o.sinta_scraped_at, now()) AS sinta_scraped_at, if(n.seq IS NULL OR o.sinta_id IS NULL, o.last_updated, now()) AS last_updated
    FROM ' || old || ' o FULL OUTER JOIN n ON o.sinta_id = n.sinta_id';
  SET lecturers_version = lecturers_version + 1;
  EXECUTE IMMEDIATE 'CREATE OR REPLACE TEMPORARY VIEW lecturers AS SELECT * FROM ' || target;
  IF lecturers_version > 1 THEN
    EXECUTE IMMEDIATE 'DROP TABLE IF EXISTS ' || gone;
  END IF;
END
"""


def lecturers(table: str) -> list[str]:
    """Statements that make an empty table of lecturers, versions of ``table``, for ``UPSERT_LECTURERS`` to fill."""
    columns = ", ".join(f"{c} {t}" for c, t in LECTURERS.items())
    return [
        f"DECLARE OR REPLACE VARIABLE lecturers_table STRING DEFAULT '{table}'",
        "DECLARE OR REPLACE VARIABLE lecturers_version INT DEFAULT 0",
        f"CREATE TABLE {table}_v0 ({columns}, sinta_scraped_at TIMESTAMP, last_updated TIMESTAMP) USING parquet",
        f"CREATE OR REPLACE TEMPORARY VIEW lecturers AS SELECT * FROM {table}_v0",
    ]
