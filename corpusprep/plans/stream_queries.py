"""Streaming jobs over the given tables, run to the end; each returns what its sink holds afterwards.

Inputs a stream needs as files (JSON lines, several drops) are first written by Spark below the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import chat, ingest
from ..session import work_path
from ..sources import jsonl
from ..sources.keyed_table import KeyedTable, newest_wins
from ..streaming import files, windows
from .metric_queries import SQL_STAMP, STAMP, stamp
from .record_queries import chat_rows
from .registry import Tables, query


def lines_folder(t: Tables) -> str:
    """The documents as JSON lines, several files."""
    folder = work_path(t.spark, "lines")
    docs = t.spread("documents", "doc_id").select("doc_id", "lang", "source", "text")
    docs.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    return folder


def event_stream(t: Tables) -> DataFrame:
    raw = t.spark.read.parquet(f"{t.folder}/events.parquet")
    stream = files.stream_table(t.spark, t.folder, raw.schema, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def kept_up(t: Tables, windows_of: Callable[[DataFrame], DataFrame], keys: list[str], name: str) -> DataFrame:
    """The events in two files, in order of time, with a restart between them; the windows a micro-batch changed are
    merged into a keyed table, which holds the open ones too."""
    folder, checkpoint = work_path(t.spark, f"{name}-files"), work_path(t.spark, f"{name}-checkpoint")
    events = t.events.select("event_id", "event_type", "ts")
    middle = events.agg(F.percentile_approx(F.unix_micros("ts"), 0.5)).first()[0] or 0
    table = None
    for part in (F.unix_micros("ts") < middle, F.unix_micros("ts") >= middle):
        events.filter(part).coalesce(1).write.mode("append").parquet(folder)
        counts = windows_of(files.stream_table(t.spark, folder, events.schema))
        table = table or KeyedTable(t.spark, work_path(t.spark, name), counts.schema, keys, buckets=4)
        files.merge_stream(counts, table, newest_wins(keys), checkpoint, name, "update")
    return table.read()


def drained(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """Run a stream into a Parquet folder and read the folder."""
    target, checkpoint = work_path(t.spark, name), work_path(t.spark, f"{name}-checkpoint")
    files.append_new_files(df, target, checkpoint)
    return t.spark.read.schema(df.schema).parquet(target)


@query(
    "jsonl_scan",
    """
    SELECT unnest(['n_docs', 'n_last', 'n_lines', 'n_numbers']) AS measure, n
    FROM (SELECT count(*) AS n FROM documents)
    """,
)
def jsonl_scan(t: Tables) -> DataFrame:
    """Numbered lines: per file they run from 1 to the number of lines, without gaps or repeats."""
    lines = jsonl.read_lines(t.spark, lines_folder(t), "part-*")
    good, _ = jsonl.split_parsed(lines)
    numbered = good.select("file_path", "line_no", jsonl.field(F.col("record"), "doc_id").alias("doc_id"))
    per_file = numbered.groupBy("file_path").agg(
        F.count("*").alias("lines"), F.countDistinct("line_no").alias("numbers"), F.max("line_no").alias("last")
    )
    docs = numbered.select("doc_id").distinct().agg(F.lit("n_docs").alias("measure"), F.count("*").alias("n"))
    totals = per_file.agg(
        F.sum("lines").alias("n_lines"), F.sum("numbers").alias("n_numbers"), F.sum("last").alias("n_last")
    )
    return totals.unpivot([], ["n_lines", "n_numbers", "n_last"], "measure", "n").unionByName(docs)


@query(
    "tolerant_scan",
    "SELECT doc_id::VARCHAR AS doc_id, sha256(text) AS checksum FROM documents WHERE trim(text) <> ''",
)
def tolerant_scan(t: Tables) -> DataFrame:
    """Texts under any of three field names, blank and broken lines between them."""
    folder = work_path(t.spark, "mixed")
    name = F.when(F.col("lang") == "fr", "body").when(F.col("lang") == "de", "content").otherwise("text")
    record = F.to_json(F.create_map(F.lit("doc_id"), F.col("doc_id").cast("string"), name, F.col("text")))
    lines = F.array(F.lit(""), F.concat(F.lit("{broken "), record), record, F.lit('{"text": "  "}'), F.lit("[1]"))
    t.spread("documents", "doc_id").select(F.explode(lines).alias("value")).write.text(folder)
    scanned = jsonl.tolerant_texts(jsonl.scan_lines(t.spark, folder, "part-*"))
    return scanned.select(jsonl.field(F.col("record"), "doc_id").alias("doc_id"), "checksum")


@query(
    "stream_rewrite",
    "SELECT doc_id, lang, sha256(upper(replace(text, 'ß', 'SS'))) AS checksum FROM documents",
)
def stream_rewrite(t: Tables) -> DataFrame:
    target, checkpoint = work_path(t.spark, "upper"), work_path(t.spark, "upper-checkpoint")
    files.rewrite_jsonl(t.spark, lines_folder(t), target, checkpoint, max_records=1000, glob="part-*")
    rewritten = t.spark.read.schema("doc_id long, lang string, text string").json(target)
    return rewritten.select("doc_id", "lang", text.checksum(F.col("text")).alias("checksum"))


@query("stream_new_files", "SELECT lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY lang")
def stream_new_files(t: Tables) -> DataFrame:
    """Two drops into one folder, the job run after each: every file is taken exactly once."""
    folder, target = work_path(t.spark, "drops"), work_path(t.spark, "picked")
    checkpoint = work_path(t.spark, "picked-checkpoint")
    docs = t.documents.select("doc_id", "lang", "n_chars")
    for drop in (F.col("lang") == "en", F.col("lang") != "en"):
        docs.filter(drop).write.mode("append").parquet(folder)
        files.append_new_files(files.stream_table(t.spark, folder, docs.schema), target, checkpoint)
    picked = t.spark.read.schema(docs.schema).parquet(target)
    return picked.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


@query(
    "stream_daily_counts",
    """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_events FROM events
    GROUP BY event_type, day
    """,
)
def stream_daily_counts(t: Tables) -> DataFrame:
    """Days as they are counted, the last one still open."""

    def counts(events: DataFrame) -> DataFrame:
        return windows.daily_counts(events, "ts", ["event_type"], "n_events", late="1 hour")

    days = kept_up(t, counts, ["event_type", "window_start"], "daily")
    return days.select("event_type", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_events")


@query(
    "stream_sliding_rate",
    f"""
    SELECT event_type, strftime(make_timestamp(w * 1000000), '{SQL_STAMP}') AS window_start, count(*) AS n_events,
           count(*) / 60::DOUBLE AS per_second
    FROM (SELECT event_type, (floor(epoch(ts) / 15) * 15)::BIGINT - k * 15 AS w
          FROM events, (SELECT unnest([0, 1, 2, 3]) AS k))
    GROUP BY ALL
    """,
)
def stream_sliding_rate(t: Tables) -> DataFrame:
    def rates(events: DataFrame) -> DataFrame:
        return windows.sliding_rate(events, "ts", ["event_type"], 60, 15, late="1 hour")

    return kept_up(t, rates, ["event_type", "window_start"], "sliding").select("event_type", stamp("window_start").alias("window_start"), "n_events", "per_second")


@query(
    "stream_batches",
    f"""
    WITH marked AS (
      SELECT event_type, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 900000000, TRUE) AS starts
      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    numbered AS (
      SELECT *, sum(starts::INT) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
      FROM marked)
    SELECT event_type, strftime(min(ts), '{SQL_STAMP}') AS first_arrival,
           strftime(max(ts) + INTERVAL 15 MINUTE, '{SQL_STAMP}') AS closes_at, count(*) AS n_objects,
           epoch_ms(max(ts) + INTERVAL 15 MINUTE) <= (SELECT epoch_ms(max(ts) - INTERVAL 1 HOUR) FROM events) AS closed
    FROM numbered GROUP BY event_type, island
    """,
)
def stream_batches(t: Tables) -> DataFrame:
    """Batches with state of their own, closed by timers; those still open are in the table too."""

    def batches(events: DataFrame) -> DataFrame:
        return windows.quiet_batches_with_open(events, "ts", "event_type", 900, "n_objects", "1 hour")

    with files.rocksdb_state(t.spark):
        found = kept_up(t, batches, ["event_type", "first_arrival"], "sessions").filter("n_objects > 0")
    return found.select(
        "event_type",
        stamp("first_arrival").alias("first_arrival"),
        F.date_format(F.col("last_arrival") + F.expr("INTERVAL 15 MINUTES"), STAMP).alias("closes_at"),
        "n_objects",
        "closed",
    )


@query("stream_dedup", "SELECT DISTINCT sha256(user_id || ' ' || event_type) AS checksum FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """First event of every user and type; the watermark reaches over the whole month."""
    key = text.checksum(F.concat(F.col("user_id").cast("string"), F.lit(" "), F.col("event_type")))
    keyed = event_stream(t).select("ts", key.alias("checksum"))
    return drained(t, windows.first_seen(keyed, "ts", ["checksum"], "40 days"), "first").select("checksum")


@query(
    "stream_upsert",
    """
    SELECT user_id::VARCHAR AS target_id, 'sentiment' AS label_type, arg_max(event_type, event_id) AS label_value,
           max(value) AS confidence, 'model-' || arg_min(event_type, event_id) AS annotator, max(event_id) AS seq
    FROM events GROUP BY user_id
    """,
)
def stream_upsert(t: Tables) -> DataFrame:
    """Label events in several files, one file per micro-batch, merged into a table that keeps their order."""
    folder, table = work_path(t.spark, "label-events"), work_path(t.spark, "label-table")
    rows = t.events.select(
        F.col("user_id").cast("string").alias("target_id"),
        F.lit("sentiment").alias("label_type"),
        F.col("event_type").alias("label_value"),
        F.col("value").alias("confidence"),
        F.concat(F.lit("model-"), "event_type").alias("annotator"),
        F.unix_seconds("ts").alias("created_at"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("first_seq"),
    )
    rows.repartition(4, "seq").write.parquet(folder)
    labels_table = KeyedTable(t.spark, table, rows.schema, ["target_id", "label_type"])
    stream = files.stream_table(t.spark, folder, rows.schema, files_per_batch=1)
    files.merge_stream(stream, labels_table, ingest.merge_labels, work_path(t.spark, "label-checkpoint"), "labels")
    return labels_table.read().select("target_id", "label_type", "label_value", "confidence", "annotator", "seq")


@query(
    "chat_export",
    """
    SELECT conv_id || '-' || turn AS chat_id, 'Chat ' || conv_id AS title, role, text AS content,
           CASE WHEN role = 'assistant' THEN CASE WHEN length(text) > 300 THEN 'long-form' ELSE 'assistant' END END AS model,
           strftime(make_timestamp((1700000000 + conv_id * 60 + turn) * 1000000), '%Y-%m-%dT%H:%M:%S') AS created_at
    FROM conversations
    """,
)
def chat_export(t: Tables) -> DataFrame:
    """The week's export written as JSON lines below a dated folder, read back."""
    exported = chat.export_chats(chat_rows(t))
    path = chat.write_export(exported, work_path(t.spark, "chat"), "2024-02-01")
    back = t.spark.read.schema(exported.schema).json(path)
    message = F.explode("messages").alias("m")
    rows = back.select("chat_id", "title", message, "created_at")
    return rows.select("chat_id", "title", "m.role", "m.content", "m.model", "created_at")
