"""Cleaning of raw records: text steps, measures, verdict, exact duplicates and the audit log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html, links, metadata, text
from ..functions.keys import stable_uuid
from ..session import staged
from .keyed import mark_first


@dataclass(frozen=True)
class CleanConfig:
    """``script`` is a regular-expression class body; ``scope`` bounds the exact deduplication (a file by default)."""

    min_chars: int = text.MIN_CHARS
    min_ratio: float = text.MIN_RATIO
    script: str = text.THAI
    script_language: str = "th"
    script_gate: float = text.THAI_GATE
    scope: tuple[str, ...] = ("file_path",)
    order: str = "line_no"


def source_or_stem(source: Column, stem: Column) -> Column:
    return F.coalesce(text.blank_to_null(source), stem)


def filename_or_derived(filename: Column, source_id: Column, source: Column, line_no: Column) -> Column:
    """The given name, else the source id (unless it says none), else source and line number."""
    usable_id = F.when((source_id != "") & (F.lower(source_id) != "none"), source_id)
    return F.coalesce(
        F.nullif(filename, F.lit("")), usable_id, F.format_string("%s_%07d.txt", source, line_no.cast("long"))
    )


def name_records(df: DataFrame, stem: Column) -> DataFrame:
    """Fill ``source`` and ``filename`` from their fallbacks and give every record a stable id."""
    df = df.withColumn("source", source_or_stem(F.col("source"), stem))
    return df.withColumn(
        "filename",
        filename_or_derived(F.col("filename"), F.col("source_id"), F.col("source"), F.col("line_no")),
    ).withColumn("id", stable_uuid(F.col("file_path"), F.col("line_no")))


def _step(name: str, detail: str) -> Column:
    return F.struct(F.lit(name).alias("step"), F.lit(detail).alias("detail"))


def clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Replace ``column`` by its clean form and add ``steps``, the ordered list of steps that ran.

    Each stage is its own projection, so a stage is computed once although the next stage and the log both read it.
    """
    staged = df.withColumn("_t0", F.coalesce(F.col(column), F.lit(""))).withColumn("_t1", text.unescape(F.col("_t0")))
    staged = (
        html.with_visible_text(staged, "_t1", "_t2", "_t3")
        .withColumn("_t4", F.replace(F.col("_t3"), F.lit(text.NBSP), F.lit(" ")))
        .withColumn("_t5", text.normalize_whitespace(F.col("_t4")))
    )
    steps = F.array_compact(
        F.array(
            F.when(F.col("_t1") != F.col("_t0"), _step("unescape_backslashes", "applied")),
            F.when(F.col("_t2") != F.col("_t1"), _step("normalize_unicode", "applied")),
            F.when(F.col("_t4") != F.col("_t3"), _step("post_soup_nbsp", "replaced_nbsp")),
            _step("remove_html", "applied"),
            F.when(F.col("_t5") != F.col("_t4"), _step("normalize_whitespace", "collapsed")).otherwise(
                _step("normalize_whitespace", "no_change")
            ),
        )
    )
    return (
        staged.withColumn("steps", steps)
        .withColumn("original_chars", F.length("_t0"))
        .withColumn(column, F.col("_t5"))
        .drop("_t0", "_t1", "_t2", "_t3", "_t4", "_t5")
    )


def measure(df: DataFrame, config: CleanConfig) -> DataFrame:
    """Checksum, counts, script ratio and the language where the ratio settles it."""
    ratio = F.col("script_ratio")
    return (
        df.withColumn("script_ratio", text.script_ratio(F.col("text"), config.script))
        .withColumn("char_count", text.char_count(F.col("text")))
        .withColumn("word_count", text.word_count(F.col("text")))
        .withColumn("checksum", text.checksum(F.col("text")))
        .withColumn("language", text.language_gate(ratio, config.script_language, config.script_gate))
    )


def verdict(df: DataFrame, config: CleanConfig) -> DataFrame:
    """``status`` and ``reason``: the first failing rule decides; failed rows stay in the output.

    Equal checksums mean equal texts, so the length and ratio rules agree inside a group of copies and the group's
    first row is also the first that passes them.
    """
    marked = mark_first(df, [*config.scope, "checksum"], list(config.scope), config.order)
    ratio = F.col("script_ratio")
    reason = (
        F.when(
            F.col("char_count") < config.min_chars,
            F.concat(F.lit("too_short:"), F.col("char_count").cast("string")),
        )
        .when(ratio < config.min_ratio, F.format_string("thai_ratio_low:%.2f", text.round_half_even(ratio, 2)))
        .when(~F.col("is_first"), "dup_exact")
        .otherwise("")
    )
    return (
        marked.withColumn("reason", reason)
        .withColumn("status", F.when(F.col("reason") == "", "cleaned").otherwise("failed"))
        .drop("is_first")
    )


def clean(
    df: DataFrame, config: CleanConfig = CleanConfig(), stage: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Clean, measure and judge all rows.

    Looking for duplicates reads the measured rows twice. ``stage`` is a folder where they are written once, so that no
    text is cleaned twice; ``keep`` are the measured columns to go on with, among them those that the verdict reads.
    """
    measured = measure(clean_text(df), config)
    if keep is not None:
        measured = measured.select(*keep)
    return verdict(staged(measured, stage, "measured"), config)


def collect_metadata(df: DataFrame, raw_text: str, links_key: str = "links_all") -> DataFrame:
    """``metadata`` from the record's own metadata text, its dates and the links of the raw text."""
    merged = links.merge_links(metadata.strings_of(F.col("metadata"), links_key), links.extract_urls(F.col(raw_text)))
    return (
        df.withColumn("metadata", metadata.parse_metadata(F.col("meta")))
        .withColumn("metadata", metadata.put(F.col("metadata"), "created_date", F.col("created_date")))
        .withColumn("metadata", metadata.put(F.col("metadata"), "updated_date", F.col("updated_date")))
        .withColumn("metadata", metadata.put_array(F.col("metadata"), links_key, merged))
        .withColumn("metadata", metadata.drop_reserved(F.col("metadata")))
        .drop("meta", "created_date", "updated_date")
    )


# Log columns, and the name each step writes under.
CLEANER, VALIDATOR, MAPPER = "cleaner", "validator", "mapper"
LOG_COLUMNS = ["log_id", "target_id", "step", "status", "details", "executed_by", "executed_at"]


def log_rows(df: DataFrame, entries: Column, by: str, at: Column, target: str = "id") -> DataFrame:
    """One log row per element of ``entries``, an array of ``struct<step, status, details>``."""
    exploded = df.select(F.col(target).cast("string").alias("target_id"), F.posexplode(entries).alias("_n", "_e"))
    return exploded.select(
        stable_uuid(F.lit(by), F.col("target_id"), F.col("_n"), F.col("_e.step")).alias("log_id"),
        "target_id",
        F.col("_e.step").alias("step"),
        F.col("_e.status").alias("status"),
        F.col("_e.details").alias("details"),
        F.lit(by).alias("executed_by"),
        at.alias("executed_at"),
    )


def _entry(step: Column, status: Column, details: Column) -> Column:
    return F.struct(step.alias("step"), status.alias("status"), details.alias("details"))


def clean_log(cleaned: DataFrame, at: Column, target: str = "id", by: str = CLEANER) -> DataFrame:
    """Audit rows of the cleaning step: input check, every text step, final verdict."""
    received = _entry(
        F.lit("validate_input"), F.lit("success"), F.to_json(F.struct(F.col("original_chars")))
    )
    steps = F.transform("steps", lambda s: _entry(s["step"], F.lit("success"), s["detail"]))
    final = _entry(
        F.lit("finalize_cleaned"),
        F.when(F.col("status") == "cleaned", "success").otherwise("failed"),
        F.to_json(F.struct("char_count", F.col("script_ratio").alias("thai_ratio"), "reason")),
    )
    return log_rows(cleaned, F.concat(F.array(received), steps, F.array(final)), by, at, target)


def quarantine_log(rejected: DataFrame, step: str, by: str, at: Column) -> DataFrame:
    """Log rows for lines that never became a record: they have no target."""
    return rejected.select(
        stable_uuid(F.lit(by), F.lit(step), F.col("file_path"), F.col("line_no")).alias("log_id"),
        F.lit(None).cast("string").alias("target_id"),
        F.lit(step).alias("step"),
        F.lit("failed").alias("status"),
        F.col("reason").alias("details"),
        F.lit(by).alias("executed_by"),
        at.alias("executed_at"),
    )

