"""Queries over keyed tables: new keys, ingest, upserts, logs and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ingest, quality
from ..session import materialize, work_path
from ..sources.keyed_table import KeyedTable, newest_wins
from ..sources.tables import prefer_mapped as take_mapped
from .record_queries import SQL_EXISTING, labelled_documents
from .registry import Tables, query
from .text_queries import sql_word_count


def documents_table(t: Tables) -> DataFrame:
    """The documents as a loaded table: load time from the event of the same number, some values absent."""
    loads = t.events.select(F.col("event_id").alias("doc_id"), F.col("ts").alias("created_at"), "event_type")
    docs = t.documents.join(loads, "doc_id")
    size = F.col("n_chars")
    return docs.select(
        "doc_id",
        F.concat(F.lit("ds-"), F.col("source")).alias("dataset_id"),
        F.when(size < 100, "   ").otherwise(F.col("text")).alias("content"),
        F.when(F.col("lang") == "es", "").otherwise(F.col("lang")).alias("language"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("type"),
        F.when(F.col("lang") == "fr", " ").otherwise(F.col("source")).alias("source"),
        F.when(F.col("event_type") != "click", size).alias("word_count"),
        F.when(F.col("event_type") != "signup", size).alias("char_count"),
        F.when(size < 2000, size / F.lit(2000)).alias("thai_ratio"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ingested").alias("status"),
        "created_at",
    )


def datasets_table(t: Tables) -> DataFrame:
    names = t.documents.select("source").distinct()
    return names.select(F.concat(F.lit("ds-"), "source").alias("id"), F.upper("source").alias("name"))


SQL_TABLES = """
    docs AS (
      SELECT d.doc_id, 'ds-' || d.source AS dataset_id, CASE WHEN n_chars < 100 THEN '   ' ELSE d.text END AS content,
             CASE WHEN lang = 'es' THEN '' ELSE lang END AS language,
             CASE WHEN event_type <> 'view' THEN event_type END AS type,
             CASE WHEN lang = 'fr' THEN ' ' ELSE d.source END AS source,
             CASE WHEN event_type <> 'click' THEN n_chars END AS word_count,
             CASE WHEN event_type <> 'signup' THEN n_chars END AS char_count,
             CASE WHEN n_chars < 2000 THEN n_chars / 2000 END AS thai_ratio,
             CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ingested' END AS status, e.ts AS created_at
      FROM documents d JOIN events e ON e.event_id = d.doc_id),
    sets AS (SELECT DISTINCT 'ds-' || source AS id, upper(source) AS name FROM documents)"""


@query(
    "records_per_batch",
    f"""
    WITH {SQL_TABLES}
    SELECT s.name AS dataset_name, strftime(created_at, '%Y-%m-%d') AS batch_day, count(*) AS records_cleaned
    FROM docs d JOIN sets s ON s.id = d.dataset_id WHERE d.status = 'ingested' GROUP BY ALL
    """,
)
def records_per_batch(t: Tables) -> DataFrame:
    return quality.records_per_batch(documents_table(t), datasets_table(t))


@query(
    "records_per_dataset",
    f"""
    WITH {SQL_TABLES}
    SELECT s.name, count(*) AS records_cleaned
    FROM docs d JOIN sets s ON s.id = d.dataset_id WHERE d.status = 'ingested' GROUP BY ALL
    """,
)
def records_per_dataset(t: Tables) -> DataFrame:
    return quality.records_per_dataset(documents_table(t), datasets_table(t))


@query(
    "null_ratio",
    f"""
    WITH {SQL_TABLES}
    SELECT d.dataset_id, s.name,
           sum((nullif(trim(language), '') IS NULL)::INT)::DOUBLE / count(*) AS language_null_ratio,
           sum((nullif(trim(content), '') IS NULL)::INT)::DOUBLE / count(*) AS content_null_ratio,
           sum((nullif(trim(type), '') IS NULL)::INT)::DOUBLE / count(*) AS type_null_ratio,
           sum((word_count IS NULL)::INT)::DOUBLE / count(*) AS word_count_null_ratio,
           sum((char_count IS NULL)::INT)::DOUBLE / count(*) AS char_count_null_ratio,
           sum((thai_ratio IS NULL)::INT)::DOUBLE / count(*) AS thai_null_ratio,
           sum((nullif(trim(source), '') IS NULL)::INT)::DOUBLE / count(*) AS source_null_ratio
    FROM docs d JOIN sets s ON s.id = d.dataset_id GROUP BY ALL
    """,
)
def null_ratio(t: Tables) -> DataFrame:
    return quality.null_ratios(documents_table(t), datasets_table(t))


@query(
    "daily_anomaly",
    """
    WITH daily AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL),
    framed AS (
      SELECT *, count(*) OVER w AS k, sum(n::DOUBLE) OVER w AS s1, sum(n::DOUBLE * n) OVER w AS s2 FROM daily
      WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT event_type, day, n AS n_records,
           CASE WHEN k > 1 AND k * s2 - s1 * s1 > 0 THEN (k * n - s1) / sqrt(k * s2 - s1 * s1) END AS z_score
    FROM framed
    """,
)
def daily_anomaly(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", quality.day(F.col("ts")).alias("day")).agg(F.count("*").alias("n_records"))
    return quality.daily_anomalies(daily, ["event_type"], "day", "n_records")


@query(
    "new_keys",
    """
    SELECT DISTINCT 'corpus' AS bucket, 'raw/' || source || '/' || lang || '/' || doc_id || '.jsonl' AS object_path
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def new_keys(t: Tables) -> DataFrame:
    """Objects are the documents; those of labelled documents were loaded before."""
    path = F.concat(
        F.lit("raw/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jsonl")
    )
    objects = t.documents.select("doc_id", F.lit("corpus").alias("bucket"), path.alias("object_path"))
    loaded = objects.join(t.labels.select("doc_id"), "doc_id")
    candidates = objects.select("bucket", "object_path")
    return ingest.new_keys(candidates, loaded, ["bucket", "object_path"])


def batch_documents(t: Tables) -> DataFrame:
    """All documents as an ingest batch; Spanish ones come without a checksum."""
    digest = text.checksum(F.col("text"))
    return t.spread("documents", "doc_id").select(
        F.concat(F.lit("new-"), F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("lang") != "es", digest).alias("checksum"),
        F.col("doc_id").alias("line_no"),
        F.col("source"),
        text.word_count(F.col("text")).alias("word_count"),
    )


@query(
    "ingest_new_docs",
    f"""
    WITH {SQL_EXISTING},
    batch AS (SELECT doc_id, CASE WHEN lang <> 'es' THEN sha256(text) END AS checksum, source FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY checksum ORDER BY doc_id) AS rn FROM batch)
    SELECT 'new-' || doc_id AS id, checksum, source FROM ranked
    WHERE checksum IS NULL OR (rn = 1 AND checksum NOT IN (SELECT checksum FROM existing))
    """,
)
def ingest_new_docs(t: Tables) -> DataFrame:
    return ingest.absent_rows(batch_documents(t), labelled_documents(t)).select("id", "checksum", "source")


def loaded_documents(t: Tables) -> DataFrame:
    """A documents table with one row per checksum: the labelled documents, first copy of each."""
    digest = text.checksum(F.col("text"))
    known = t.documents.join(t.labels.select("doc_id"), "doc_id").select(
        "doc_id", digest.alias("checksum"), "source", "n_chars"
    )
    return known.groupBy("checksum").agg(
        F.concat(F.lit("old-"), F.min("doc_id").cast("string")).alias("id"),
        F.min_by("source", "doc_id").alias("source"),
        F.min_by("n_chars", "doc_id").alias("word_count"),
    )


@query(
    "upsert_docs",
    f"""
    WITH existing AS (
      SELECT sha256(text) AS checksum, 'old-' || min(doc_id) AS id, arg_min(source, doc_id) AS source,
             arg_min(n_chars, doc_id) AS word_count
      FROM documents JOIN labels USING (doc_id) GROUP BY sha256(text)),
    batch AS (
      SELECT doc_id, CASE WHEN lang <> 'es' THEN sha256(text) END AS checksum, source,
             {sql_word_count("text")}::BIGINT AS word_count FROM documents),
    latest AS (
      SELECT checksum, 'new-' || min(doc_id) AS first_id, arg_max(source, doc_id) AS source,
             arg_max(word_count, doc_id) AS word_count
      FROM batch WHERE checksum IS NOT NULL GROUP BY checksum)
    SELECT coalesce(e.id, l.first_id) AS id, coalesce(l.checksum, e.checksum) AS checksum,
           CASE WHEN l.checksum IS NULL THEN e.source ELSE l.source END AS source,
           CASE WHEN l.checksum IS NULL THEN e.word_count ELSE l.word_count END AS word_count
    FROM latest l FULL OUTER JOIN existing e ON e.checksum = l.checksum
    UNION ALL SELECT 'new-' || doc_id, NULL, source, word_count FROM batch WHERE checksum IS NULL
    """,
)
def upsert_docs(t: Tables) -> DataFrame:
    """Loaded into a keyed table first; the batch then rewrites the buckets it may touch."""
    loaded = materialize(loaded_documents(t))
    table = KeyedTable(t.spark, work_path(t.spark, "documents-table"), loaded.schema, ["checksum"], spread_by="id")
    table.merge("load", loaded, newest_wins(["checksum"]))
    table.merge("batch", batch_documents(t), ingest.upsert_rows)
    return table.read().select("id", "checksum", "source", "word_count")


@query(
    "upsert_labels",
    """
    WITH existing AS (
      SELECT doc_id::VARCHAR AS target_id, 'sentiment' AS label_type, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative'
             END AS label_value, 50.0 + toxic AS confidence, 'hand' AS annotator, 0 AS created_at, -1 AS seq FROM labels),
    batch AS (
      SELECT user_id::VARCHAR, 'sentiment', event_type, value, 'model-' || event_type, floor(epoch(ts))::BIGINT, event_id
      FROM events),
    merged AS (SELECT * FROM existing UNION ALL SELECT * FROM batch)
    SELECT target_id, label_type, arg_max(label_value, seq) AS label_value, max(confidence) AS confidence,
           arg_min(annotator, seq) AS annotator, arg_max(created_at, seq)::BIGINT AS created_at
    FROM merged GROUP BY target_id, label_type
    """,
)
def upsert_labels(t: Tables) -> DataFrame:
    """Hand labels meet label events: the user number is the target, many events share one target."""
    existing = t.labels.select(
        F.col("doc_id").cast("string").alias("target_id"),
        F.lit("sentiment").alias("label_type"),
        F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label_value"),
        (F.lit(50.0) + F.col("toxic")).alias("confidence"),
        F.lit("hand").alias("annotator"),
        F.lit(0).cast("long").alias("created_at"),
    )
    batch = t.events.select(
        F.col("user_id").cast("string").alias("target_id"),
        F.lit("sentiment").alias("label_type"),
        F.col("event_type").alias("label_value"),
        F.col("value").alias("confidence"),
        F.concat(F.lit("model-"), "event_type").alias("annotator"),
        F.unix_seconds("ts").alias("created_at"),
        F.col("event_id").alias("seq"),
    )
    return ingest.upsert_labels(existing, batch)


def event_logs(t: Tables, second: bool) -> DataFrame:
    """Events as log rows; the second delivery repeats errors with a new status and brings other events anew."""
    prefix = F.when(F.col("event_type") == "error", "log-").otherwise("again-") if second else F.lit("log-")
    return t.events.select(
        F.concat(prefix, F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("doc-"), F.col("user_id").cast("string")).alias("document_id"),
        F.lit("validate" if second else "clean").alias("step"),
        F.lit("success" if second else "failed").alias("status"),
        F.col("props").alias("details"),
        F.lit("second" if second else "first").alias("executed_by"),
        (F.unix_seconds("ts") + (10 if second else 0)).alias("executed_at"),
        F.col("event_id").alias("seq"),
    )


@query(
    "upsert_logs",
    """
    SELECT 'log-' || event_id AS id, 'doc-' || user_id AS document_id, 'clean' AS step,
           CASE WHEN event_type = 'error' THEN 'success' ELSE 'failed' END AS status, props AS details,
           'first' AS executed_by,
           floor(epoch(ts))::BIGINT + CASE WHEN event_type = 'error' THEN 10 ELSE 0 END AS executed_at
    FROM events
    UNION ALL
    SELECT 'again-' || event_id, 'doc-' || user_id, 'validate', 'success', props, 'second', floor(epoch(ts))::BIGINT + 10
    FROM events WHERE event_type <> 'error'
    """,
)
def upsert_logs(t: Tables) -> DataFrame:
    return ingest.upsert_logs(event_logs(t, second=False).drop("seq"), event_logs(t, second=True))


@query(
    "log_union",
    """
    SELECT step, status, executed_by, count(*) AS n_rows, count(document_id) AS n_targets FROM (
      SELECT 'clean' AS step, 'failed' AS status, 'first' AS executed_by, user_id AS document_id FROM events
      UNION ALL SELECT 'validate', 'success', 'second', user_id FROM events
      UNION ALL SELECT 'load_csv', 'warn', 'mapper', NULL FROM pages)
    GROUP BY ALL
    """,
)
def log_union(t: Tables) -> DataFrame:
    """Cleaning and validation logs, and a mapping log without targets."""
    mapping = t.pages.select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("id"),
        F.lit("load_csv").alias("step"),
        F.lit("warn").alias("status"),
        F.lit("mapper").alias("executed_by"),
    )
    logs = ingest.union_logs(event_logs(t, second=False), event_logs(t, second=True), None, mapping)
    return logs.groupBy("step", "status", "executed_by").agg(
        F.count("*").alias("n_rows"), F.count("document_id").alias("n_targets")
    )


@query(
    "prefer_mapped",
    """
    SELECT d.doc_id AS id, d.source, p.url FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id
    """,
)
def prefer_mapped(t: Tables) -> DataFrame:
    validated = t.documents.select(F.col("doc_id").alias("id"), "source")
    urls = t.pages.select(F.col("page_id").alias("id"), "url")
    return take_mapped(validated.join(urls, "id"), validated).select("id", "source", "url")


@query(
    "json_filter",
    """
    SELECT event_id, (props->>'k')::BIGINT AS k FROM events
    WHERE json_exists(props, '$.k') AND event_type = 'error' AND props->>'k' = '42'
    """,
)
def json_filter(t: Tables) -> DataFrame:
    """Events whose JSON has a key, with a value equal to a text."""
    value = F.get_json_object("props", "$.k")
    kept = t.events.filter((F.col("event_type") == "error") & value.isNotNull() & (value == "42"))
    return kept.select("event_id", value.cast("long").alias("k"))
