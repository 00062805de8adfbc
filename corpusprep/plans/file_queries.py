"""The run from files to tables over the documents, written as raw objects in two drops with broken lines between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metadata
from ..functions.keys import object_key
from ..operators.clean import CleanConfig
from ..session import shuffles_removed, work_path
from ..sources import jsonl
from ..sources.runs import RunTables
from .files_run import COUNTERS, DOCUMENTS, FilesRun, run_files
from .record_queries import LATIN, RUN_AT, sql_clean
from .registry import Tables, query

BROKEN = '{"text": "no end'
# One object per source; a broken or an empty line stands before some documents.
SQL_LINES = """
    numbered AS (
      SELECT doc_id, source, sum(1 + (doc_id % 40 IN (3, 5))::INT) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS line_no
      FROM documents)"""
SQL_RUN = f"""
    {sql_clean()}, {SQL_LINES},
    judged AS (
      SELECT m.*, n.line_no, m.source || '_' || lpad(n.line_no::VARCHAR, 7, '0') || '.txt' AS title,
             char_count >= 10 AND ratio >= 0.5
             AND row_number() OVER (PARTITION BY m.source, checksum ORDER BY doc_id) = 1 AS kept
      FROM measured m JOIN numbered n USING (doc_id)),
    side AS (
      SELECT 'src' || page_id % 20 || '_' || lpad((page_id // 5 + 1)::VARCHAR, 7, '0') || '.txt' AS title, max(url) AS url
      FROM pages GROUP BY 1),
    inserted AS (
      SELECT * FROM judged WHERE kept
      QUALIFY row_number() OVER (PARTITION BY checksum ORDER BY source, doc_id) = 1)"""


def raw_objects(t: Tables, root: str, drop) -> None:
    """Documents as one JSON Lines object per source, in document order."""
    record = F.to_json(F.struct("text", "source"))
    first = F.when(F.col("doc_id") % 40 == 3, F.lit(BROKEN)).when(F.col("doc_id") % 40 == 5, F.lit(""))
    lines = F.array_compact(F.array(first, record))
    rows = t.documents.filter(drop).repartition("source").sortWithinPartitions("source", "doc_id")
    rows = rows.select(F.explode(lines).alias("value"), "source")
    with shuffles_removed(t.spark):
        rows.write.mode("append").partitionBy("source").text(f"{root}/raw")


def run_tables(t: Tables) -> RunTables:
    """Two drops, the run after each; one file per micro-batch would change nothing but the time it takes."""
    root, tables, checkpoint = (work_path(t.spark, name) for name in ("objects", "run-tables", "run-checkpoint"))
    rules = CleanConfig(min_chars=10, min_ratio=0.5, script=LATIN, script_language="latin")
    how = FilesRun(root=root, tables=tables, bucket="corpus", glob="part-*", rules=rules)
    page = F.col("page_id")
    number = F.lpad((F.floor(page / 5) + 1).cast("string"), 7, "0")
    names = F.concat(F.lit("src"), (page % 20).cast("string"), F.lit("_"), number, F.lit(".txt"))
    side = t.pages.groupBy(names.alias("filename")).agg(F.max("url").alias("url"), F.lit(1).cast("long").alias("line_no"))
    sets = t.documents.filter("source < 'src5'").select(
        F.concat(F.lit("ds-"), "source").alias("id"), F.concat(F.lit("source="), "source").alias("name")
    ).distinct()
    for drop in (F.col("source") < "src15", F.col("source") >= "src15"):
        raw_objects(t, root, drop)
        run_files(t.spark, how, side, sets, F.lit(RUN_AT), checkpoint)
    return RunTables(t.spark, tables)


def source_of(path: str):
    return F.regexp_extract(F.col(path), "^raw/source=([^/]*)/", 1)


@query(
    "pipeline_files",
    f"""
    WITH {SQL_RUN}
    SELECT source, line_no, i.title, CASE WHEN source < 'src5' THEN 'ds-' || source END AS dataset_id, s.url, checksum,
           char_count, 'ingested' AS status, 'corpus' AS bucket
    FROM inserted i LEFT JOIN side s ON s.title = i.title
    """,
)
def pipeline_files(t: Tables) -> DataFrame:
    documents = run_tables(t).read("documents", DOCUMENTS)
    return documents.select(
        source_of("content_ptr.object_path").alias("source"),
        "content_ptr.line_no",
        "title",
        "dataset_id",
        metadata.text_of(F.col("metadata"), "url").alias("url"),
        "checksum",
        "char_count",
        "status",
        "content_ptr.bucket",
    )


@query(
    "pipeline_counters",
    f"""
    WITH {SQL_RUN},
    broken AS (SELECT source, count(*) FILTER (doc_id % 40 IN (3, 5)) AS n FROM documents GROUP BY source)
    SELECT j.source, count(*) + any_value(b.n) AS n_in, any_value(b.n) AS n_broken, count(*) FILTER (j.kept) AS n_cleaned,
           count(*) FILTER (NOT j.kept) + any_value(b.n) AS n_failed, count(*) FILTER (j.kept) AS n_ok,
           count(*) FILTER (NOT j.kept) AS n_bad, count(*) FILTER (j.kept AND s.url IS NOT NULL) AS n_mapped,
           count(*) FILTER (j.kept AND s.url IS NULL) AS n_unmapped, count(i.doc_id) AS n_inserted
    FROM judged j JOIN broken b USING (source) LEFT JOIN side s ON s.title = j.title
    LEFT JOIN inserted i ON i.doc_id = j.doc_id GROUP BY j.source
    """,
)
def pipeline_counters(t: Tables) -> DataFrame:
    counters = run_tables(t).read("counters", COUNTERS)
    return counters.select(source_of("object_path").alias("source"), *counters.columns[1:])


@query(
    "quarantine",
    f"""
    WITH {SQL_LINES}
    SELECT source, line_no - 1 AS line_no, 'json_error' AS reason, CASE doc_id % 40 WHEN 3 THEN '{BROKEN}' ELSE '' END AS value
    FROM numbered WHERE doc_id % 40 IN (3, 5)
    """,
)
def quarantine(t: Tables) -> DataFrame:
    """Lines that are no record, with their object and physical number."""
    root = work_path(t.spark, "objects")
    raw_objects(t, root, F.lit(True))
    _, rejected = jsonl.split_parsed(jsonl.read_lines(t.spark, root, "part-*"))
    keyed = rejected.withColumn("object_path", object_key(F.col("file_path"), root))
    return keyed.select(source_of("object_path").alias("source"), "line_no", "reason", "value")
