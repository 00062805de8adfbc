"""File streams: rewriting objects, picking up new files once, keyed upserts per micro-batch.

All jobs run with the ``availableNow`` trigger: they take what is there and stop; ``files_per_batch`` bounds what one
micro-batch takes. Run them again with the same checkpoint folder and only new files are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.metadata import METADATA, put
from ..functions.text import BLANKS
from ..sources.jsonl import field, json_value
from ..sources.keyed_table import KeyedTable, Rule


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which own state needs; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def run_to_end(writer: DataStreamWriter, path: str | None = None) -> StreamingQuery:
    """Start with ``availableNow`` and wait; a failed batch raises."""
    query = writer.trigger(availableNow=True).start(path) if path else writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_table(
    spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number of files per batch if wanted."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_lines(spark: SparkSession, folder: str, glob: str = "*.jsonl", files_per_batch: int | None = None) -> DataFrame:
    """Lines of a folder's text files as a stream, with their file; blank lines are skipped."""
    reader = spark.readStream.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(folder)
    with_file = lines.select("value", F.col("_metadata.file_path").alias("file_path"))
    return with_file.filter(F.btrim("value", F.lit(BLANKS)) != "")


def upper_texts(lines: DataFrame) -> DataFrame:
    """Every object with its ``text`` in upper case and all other fields kept; a broken line fails the job."""
    parsed = lines.withColumn("record", json_value(F.col("value")))
    fields = F.try_variant_get("record", "$", METADATA)
    checked = F.coalesce(fields, F.raise_error(F.concat(F.lit("not a JSON object in "), "file_path")).cast(METADATA))
    text = F.upper(F.coalesce(field(F.col("record"), "text"), F.lit("")))
    return parsed.select(F.to_json(put(checked, "text", text)).alias("value"))


def rewrite_jsonl(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_records: int = 50_000, glob: str = "*.jsonl"
) -> StreamingQuery:
    """Rewrite JSON lines to JSON lines in files of bounded length.

    The sink's log makes a batch visible as a whole or not at all: a failing line leaves no half-written result.
    """
    writer = (
        upper_texts(stream_lines(spark, source, glob))
        .writeStream.format("text")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records)
    )
    return run_to_end(writer, target)


def append_new_files(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream holds beyond the checkpoint to a Parquet folder."""
    return run_to_end(df.writeStream.format("parquet").option("checkpointLocation", checkpoint), target)


def merge_stream(stream: DataFrame, table: KeyedTable, rule: Rule, checkpoint: str, name: str, mode: str = "append") -> StreamingQuery:
    """Run ``rule(existing, batch)`` on a keyed table for every micro-batch of the stream.

    A batch that is delivered again after a failure has the same name, ``name`` and its number, and is merged once; a
    new checkpoint needs a new name. ``mode`` is the stream's output mode: with "update" a batch holds the rows that
    changed, windows that are still open included.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.merge(f"{name}-{batch_id}", batch, rule)

    writer = stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
    return run_to_end(writer)
