"""One run from files to tables: new raw files are picked up, prepared and published together with their logs.

A micro-batch is a list of files. Documents, stage records, logs, counters and quarantined lines of a batch are one run
of :class:`RunTables`; the run is named after its files, so a batch that is delivered again is recognised.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import RAW, object_key, stage_paths
from ..operators import clean as cleaning
from ..operators import ingest, labels
from ..operators.clean import CLEANER, CleanConfig
from ..operators.keyed import outer_merge
from ..session import materialize, put, remove, work_path
from ..sources import jsonl
from ..sources.runs import RunTables
from ..streaming.files import run_to_end
from .prepare import Outputs, PrepareConfig, prepare

_POINTER = "struct<bucket: string, object_path: string, line_no: bigint>"
DOCUMENTS = (
    f"id string, dataset_id string, title string, content string, content_ptr {_POINTER}, language string, source string, "
    "checksum string, word_count long, char_count long, script_ratio double, metadata map<string, variant>, status string, "
    "created_at string"
)
STAGES = f"stage string, stage_path string, content_ptr {_POINTER}, value string"
LOGS = "id string, document_id string, step string, status string, details string, executed_by string, executed_at string"
QUARANTINE = "object_path string, line_no long, value string, reason string"
COUNTERS = (
    "object_path string, n_in long, n_broken long, n_cleaned long, n_failed long, n_ok long, n_bad long, n_mapped long, "
    "n_unmapped long, n_inserted long"
)
LABELS = "target_id string, label_type string, label_value string, confidence double, annotator string, created_at string"
SCHEMAS = {
    "documents": DOCUMENTS, "stages": STAGES, "logs": LOGS, "quarantine": QUARANTINE, "counters": COUNTERS, "labels": LABELS,
}
_FILES = "path string, modificationTime timestamp, length long, content binary"


@dataclass(frozen=True)
class FilesRun:
    """``root`` is the folder or bucket; raw objects lie below ``root/prefix``. ``tables`` is the folder of the tables.

    ``files_per_batch`` bounds a micro-batch; its list of names is what the driver holds. ``content=False`` leaves the
    text out of the documents, ``dataset_id`` sets one dataset for all, ``limit`` keeps the first lines of each file.
    With ``scorer`` and ``annotator`` the new documents are labelled in the same run.
    """

    root: str
    tables: str
    bucket: str = ""
    prefix: str = RAW
    glob: str = "*.jsonl"
    rules: CleanConfig = field(default_factory=CleanConfig)
    prefer_csv: bool = False
    files_per_batch: int = 1000
    content: bool = True
    dataset_id: str | None = None
    limit: int | None = None
    scorer: object | None = None
    annotator: str | None = None


def plain_key(path: str, root: str) -> str:
    """Key of a listed (not URI-encoded) path below ``root``; a path outside keeps all its folders."""
    bare = [re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", p).strip("/") for p in (path, root)]
    return bare[0][len(bare[1]) + 1 :] if bare[0].startswith(bare[1] + "/") else bare[0]


def run_name(keys: list[str]) -> str:
    return "files-" + hashlib.sha256("\n".join(sorted(keys)).encode()).hexdigest()[:24]


def _pointer(how: FilesRun, path: Column, line_no: Column) -> Column:
    return F.struct(F.lit(how.bucket).alias("bucket"), path.alias("object_path"), line_no.cast("long").alias("line_no"))


def _documents(out: Outputs, how: FilesRun, run_at: Column) -> DataFrame:
    dataset = F.lit(how.dataset_id) if how.dataset_id else F.col("dataset_id").cast("string")
    return out.documents.select(
        "id", dataset.alias("dataset_id"), "title", F.col("text").alias("content"),
        _pointer(how, F.col("file_path"), F.col("line_no")).alias("content_ptr"),
        "language", "source", "checksum", "word_count", "char_count", "script_ratio", "metadata", "status",
        run_at.alias("created_at"),
    )


def _stage_records(out: Outputs, how: FilesRun) -> DataFrame:
    """Records as each stage leaves them, one JSON object a line, under the stage's object key."""
    paths = stage_paths(F.col("file_path"), how.prefix)
    pointer = _pointer(how, F.col("file_path"), F.col("line_no"))
    shown = ["id", "filename", "source", "status", "word_count", "char_count", "script_ratio", "language", "metadata",
             "processed_at", "checksum", "text"]

    def lines(df: DataFrame, stage: str, path: Column) -> DataFrame:
        record = F.to_json(F.struct(*shown[:4], pointer.alias("content_ptr"), *shown[4:]), {"ignoreNullFields": "false"})
        return df.select(F.lit(stage).alias("stage"), path.alias("stage_path"), pointer.alias("content_ptr"), record.alias("value"))

    accepted = out.checked.filter("reason IS NULL")
    return (
        lines(out.cleaned, "cleaned", paths.cleaned)
        .unionByName(lines(accepted, "validated", paths.validated))
        .unionByName(lines(out.mapped, "mapped", paths.mapped))
    )


def _counters(out: Outputs, rejected: DataFrame, documents: DataFrame) -> DataFrame:
    """Per object; a broken line came in and failed, so in = cleaned + failed."""
    path = F.col("file_path")
    parts = [
        rejected.groupBy(path).agg(F.count("*").alias("n_broken")),
        out.counters["clean"].withColumnsRenamed({"n_in": "_in", "n_failed": "_failed"}),
        out.counters["validate"].drop("n_in"),
        out.counters["map"].drop("n_in", "n_out"),
        documents.groupBy(F.col("content_ptr.object_path").alias("file_path")).agg(F.count("*").alias("n_inserted")),
    ]
    merged = outer_merge(parts, ["file_path"]).na.fill(0)
    return merged.select(
        F.col("file_path").alias("object_path"),
        (F.col("_in") + F.col("n_broken")).alias("n_in"),
        "n_broken",
        "n_cleaned",
        (F.col("_failed") + F.col("n_broken")).alias("n_failed"),
        *["n_ok", "n_bad", "n_mapped", "n_unmapped", "n_inserted"],
    )


def seen_objects(tables: RunTables) -> DataFrame:
    """``object_path`` of all objects that any document points to or any run has counted."""
    pointed = tables.read("documents", DOCUMENTS).select("content_ptr.object_path")
    return pointed.union(tables.read("counters", COUNTERS).select("object_path")).distinct()


def ingest_files(
    spark: SparkSession,
    paths: list[str],
    how: FilesRun,
    url_map: DataFrame,
    datasets: DataFrame,
    run_at: Column,
    headers: list[str] | None = None,
) -> bool:
    """Prepare the given files as one run; False if there was nothing new to do.

    Objects seen before are left out, so the same call serves backfills. Objects outside the raw prefix are quarantined
    whole: one row without a line number. ``run_at`` is the run's time as text, ``headers`` comes from the side table.
    """
    tables = RunTables(spark, how.tables)
    listed = {plain_key(p, how.root): p for p in paths}
    if run_name(list(listed)) in tables.runs():
        return False
    candidates = spark.createDataFrame([(k,) for k in listed], "object_path string")
    fresh = ingest.new_keys(candidates, seen_objects(tables), ["object_path"])
    below = how.prefix.rstrip("/") + "/"
    fresh_keys = [r.object_path for r in fresh.collect()]  # at most files_per_batch, or what the caller listed
    chosen = sorted(k for k in fresh_keys if k.startswith(below))
    stray = sorted(k for k in fresh_keys if not k.startswith(below))
    if not chosen and not stray:
        return False
    strays = spark.createDataFrame([(k, None, None, "outside_prefix:" + how.prefix) for k in stray], QUARANTINE)
    run = run_name(list(listed))
    if not chosen:
        return tables.commit(run, {"quarantine": strays, "counters": _stray_counters(strays)})

    # Characters that a path pattern would interpret are escaped: these are names of files, not patterns.
    names = [re.sub(r"([\[\]{}*?\\])", r"\\\1", listed[k]) for k in chosen]
    scratch = work_path(spark, f"scratch-{run}")
    try:
        return _ingest(spark, tables, run, names, strays, scratch, how, url_map, datasets, run_at, headers)
    finally:
        remove(spark, scratch)


def _ingest(
    spark: SparkSession,
    tables: RunTables,
    run: str,
    names: list[str],
    strays: DataFrame,
    scratch: str,
    how: FilesRun,
    url_map: DataFrame,
    datasets: DataFrame,
    run_at: Column,
    headers: list[str] | None,
) -> bool:
    """Prepare and publish the named files; copies of their texts in ``scratch`` go as soon as the next step holds them."""
    copy, parsed, documents_copy = (f"{scratch}/{part}" for part in ("lines", "parsed", "documents"))
    lines = jsonl.read_lines(spark, names, "*", how.limit, copy)
    good, rejected = jsonl.split_parsed(lines, parsed)
    rejected = materialize(rejected.withColumn("file_path", object_key(F.col("file_path"), how.root)))
    remove(spark, copy)
    out = prepare(
        jsonl.raw_records(good),
        url_map,
        tables.read("documents", DOCUMENTS).select("checksum"),
        datasets,
        run_at,
        PrepareConfig(root=how.root, clean=how.rules, prefer_csv=how.prefer_csv),
        stage=f"{scratch}/stage",
        headers=headers,
        keep_mapped=True,
    )
    remove(spark, parsed)
    # The new rows are stored once, as the run's table; counters and labels read them there. A table without texts is no
    # place to read them for labels.
    documents = _documents(out, how, run_at)
    if not how.content:
        put(documents, documents_copy)
        documents = spark.read.schema(documents.schema).parquet(documents_copy)
    broken = cleaning.quarantine_log(rejected, "validate_input", CLEANER, run_at)
    written = {
        "documents": documents if how.content else documents.withColumn("content", F.lit(None).cast("string")),
        "stages": _stage_records(out, how),
        "logs": ingest.log_table(ingest.union_logs(out.logs, broken)),
        "quarantine": rejected.select(F.col("file_path").alias("object_path"), "line_no", "value", "reason").unionByName(strays),
        "counters": lambda read: _counters(out, rejected, read("documents")).unionByName(_stray_counters(strays)),
    }
    if how.scorer is not None:
        written["labels"] = lambda read: _labels(read("documents") if how.content else documents, how, run_at)
    return tables.commit(run, written)


def _labels(documents: DataFrame, how: FilesRun, run_at: Column) -> DataFrame:
    scored = labels.label_texts(documents.select("id", F.col("content").alias("text")), how.scorer)
    return scored.select(
        F.col("id").alias("target_id"), F.lit("sentiment").alias("label_type"), F.col("label").alias("label_value"),
        "confidence", F.lit(how.annotator).alias("annotator"), run_at.alias("created_at"),
    )


def _stray_counters(strays: DataFrame) -> DataFrame:
    """Quarantined objects count as seen: a row of zeros each."""
    names = [c.split()[0] for c in COUNTERS.split(", ")][1:]
    return strays.select("object_path", *[F.lit(0).cast("long").alias(c) for c in names])


def run_files(
    spark: SparkSession,
    how: FilesRun,
    url_map: DataFrame,
    datasets: DataFrame,
    run_at: Column,
    checkpoint: str,
    headers: list[str] | None = None,
) -> RunTables:
    """Take all files below the raw prefix that ``checkpoint`` does not know, in bounded batches, and stop.

    Call it every hour: each file is taken once. An empty listing is an error, as it means a wrong folder; finding
    nothing new is none. A batch that failed half-way is delivered again with the same files and starts over; one that
    was published but not recorded in the checkpoint is recognised and skipped.
    """
    folder = f"{how.root.rstrip('/')}/{how.prefix.strip('/')}"
    if jsonl.list_keys(spark, folder, how.glob).isEmpty():
        raise FileNotFoundError(f"no {how.glob} below {folder}")
    listing = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", how.glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", how.files_per_batch)
        .load(folder)
        .select("path")
    )

    def apply(batch: DataFrame, _: int) -> None:
        paths = [r.path for r in batch.collect()]  # at most files_per_batch names
        ingest_files(spark, paths, how, url_map, datasets, run_at, headers)

    run_to_end(listing.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    return RunTables(spark, how.tables)

