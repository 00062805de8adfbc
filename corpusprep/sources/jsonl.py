"""JSON Lines: numbered scan, strict parse, tolerant scan, sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import BLANKS, checksum, strip
from ..operators.keyed import measured_lookup
from ..session import put, staged, work_path


def scan_lines(spark: SparkSession, path: str | list[str], glob: str = "*.jsonl") -> DataFrame:
    """Lines of all matching files with their file and split, no numbering."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
            "value",
        )
    )


def read_lines(
    spark: SparkSession, path: str | list[str], glob: str = "*.jsonl", limit: int | None = None, copy: str | None = None
) -> DataFrame:
    """``file_path, line_no, value`` with 1-based physical line numbers; blank and broken lines count too.

    The lines are written once below the shared folder, each with its split and a number that rises inside the split.
    All else is computed from that copy, so numbers do not depend on how a later job would plan its splits. A narrow
    pass counts the lines of every split (no text is shuffled, one big file is counted by many tasks); the counts, one
    row per split, are joined back, and a line whose split has no count is an error. ``limit`` keeps the first lines of
    each file, ``None`` or 0 keeps all. ``copy`` names the folder of that copy, for callers that delete it.
    """
    scanned, copy = scan_lines(spark, path, glob), copy or work_path(spark, "lines")
    put(scanned, copy)
    lines = spark.read.schema(scanned.schema).parquet(copy)
    splits = lines.groupBy("file_path", "_block").agg(F.min("_seq").alias("_base"), F.count("*").alias("_lines"))
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "file_path", "_block", "_base", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_seq") - F.col("_base") + F.col("_offset") + 1
    numbered = measured_lookup(lines, offsets, ["file_path", "_block"], ["_seq"], "left").select(
        "file_path",
        F.coalesce(number, F.raise_error(F.lit("a line's split has no count"))).cast("long").alias("line_no"),
        "value",
    )
    return numbered.filter(F.col("line_no") <= limit) if limit else numbered


def list_keys(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """Distinct file paths below ``path`` that match, from the listing alone."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    )
    return files.select(F.col("path").alias("file_path"))


def first_key(keys: DataFrame, forced: str | None = None) -> DataFrame:
    """The first key in name order; a forced key replaces the listing."""
    if forced:
        return keys.sparkSession.range(1).select(F.lit(forced).alias("file_path"))
    return keys.orderBy("file_path").limit(1)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, wherever the whole is copied to: a filter would repeat it per use."""
    return F.transform(F.array(value), use)[0]


def json_value(line: Column) -> Column:
    """The line as a variant, null when it is not exactly one JSON value.

    The parser alone accepts text after the first value. So the line becomes the first of two items, the second being
    its own hash: a line that closes the list itself, or holds a second value, would have to contain its hash.
    """

    def only(wrapped: Column, digest: Column) -> Column:
        single = (
            F.variant_get(wrapped, "$[0]", "variant").isNotNull()
            & (F.try_variant_get(wrapped, "$[1]", "string") == digest)
            & F.variant_get(wrapped, "$[2]", "variant").isNull()
        )
        return F.when(single, F.variant_get(wrapped, "$[0]", "variant"))

    def parsed(text: Column, digest: Column) -> Column:
        return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]')))

    def hashed(text: Column) -> Column:
        return _once(F.sha2(text, 256), lambda digest: _once(parsed(text, digest), lambda wrapped: only(wrapped, digest)))

    return _once(F.btrim(line, F.lit(BLANKS)), hashed)


def field(value: Column, name: str) -> Column:
    """A text or number field as string, null when absent, null or nested."""
    return F.try_variant_get(value, f"$.{name}", "string")


def kind(value: Column, name: str | None = None) -> Column:
    """JSON type name of a value or of one of its fields; null when the field is absent."""
    part = value if name is None else F.variant_get(value, f"$.{name}", "variant")
    return F.regexp_extract(F.schema_of_variant(part), "^[A-Z]+", 0)


def split_parsed(lines: DataFrame, stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows with their parsed ``record``, and quarantined rows with a ``reason``.

    A line that parses but is no object, or whose text is no string, is rejected too. ``stage`` is a folder where the
    parsed lines are written once: whoever reads both parts parses every line once.
    """

    def judged(record: Column) -> Column:
        text_kind = kind(record, "text")
        reason = (
            F.when(record.isNull(), "json_error")
            .when(kind(record) != "OBJECT", "type:not_object")
            .when(text_kind.isNotNull() & ~text_kind.isin("STRING", "VOID"), "text:not_string")
        )
        return F.struct(record.alias("record"), reason.alias("reason"))

    both = lines.withColumn("_parsed", _once(json_value(F.col("value")), judged))
    parsed = both.select(*lines.columns, "_parsed.record", "_parsed.reason")
    if stage is not None:
        # The text of a good line is in its record.
        rejected = F.when(F.col("reason").isNotNull(), F.col("value"))
        parsed = staged(parsed.withColumn("value", rejected), stage, "parsed")
    good = parsed.filter("reason IS NULL").drop("reason", "value")
    return good, parsed.filter("reason IS NOT NULL").drop("record")


def raw_records(good: DataFrame) -> DataFrame:
    """Typed columns of the raw record: everything the cleaner reads."""
    record = F.col("record")
    text = F.coalesce(field(record, "text"), F.lit(""))
    meta = F.when(kind(record, "meta") == "STRING", field(record, "meta")).when(
        kind(record, "meta") == "OBJECT", F.to_json(F.variant_get(record, "$.meta", "variant"))
    )
    return good.select(
        "file_path",
        "line_no",
        text.alias("text"),
        field(record, "source").alias("source"),
        field(record, "filename").alias("filename"),
        field(record, "source_id").alias("source_id"),
        meta.alias("meta"),
        field(record, "created_date").alias("created_date"),
        field(record, "updated_date").alias("updated_date"),
    )


def tolerant_texts(lines: DataFrame, fields: tuple[str, ...] = ("text", "body", "content")) -> DataFrame:
    """First usable text of every line, trimmed; blank, broken and textless lines are skipped.

    The first field that is not empty decides: if it is no string or only blanks, the line is dropped.
    """
    record = json_value(F.col("value"))

    def usable(name: str) -> Column:
        part_kind = kind(F.col("record"), name)
        part = field(F.col("record"), name)
        is_text = part_kind == "STRING"
        as_json = F.to_json(F.variant_get(F.col("record"), f"$.{name}", "variant"))
        empty = part_kind.isNull() | (part_kind == "VOID") | as_json.isin('""', "0", "0.0", "false", "[]", "{}")
        return F.when(~empty, F.when(is_text, part).otherwise(F.lit("")))

    parsed = lines.withColumn("record", record).filter(kind(F.col("record")) == "OBJECT")
    text = strip(F.coalesce(*[usable(name) for name in fields]))
    found = parsed.withColumn("text", text).filter(F.col("text") != "")
    given = F.nullif(field(F.col("record"), "checksum"), F.lit(""))
    return found.withColumn("checksum", F.coalesce(given, checksum(F.col("text")))).drop("value")


def write_jsonl(df: DataFrame, path: str, max_records: int | None = None, mode: str = "errorifexists") -> None:
    """One JSON object per line; null fields are kept so that every line has the same keys."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.json(path)
