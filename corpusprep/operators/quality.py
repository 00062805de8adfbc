"""Data-quality aggregates over documents and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


def blank(column: Column) -> Column:
    """Null or only U+0020, as SQL ``TRIM`` sees it."""
    return column.isNull() | (F.trim(column) == "")


def _name_of(counts: DataFrame, datasets: DataFrame) -> DataFrame:
    """Dataset names for rows already aggregated to one per dataset (and day): the join stays small and even."""
    return counts.join(datasets.withColumnRenamed("id", "dataset_id"), "dataset_id")


def day(ts: Column) -> Column:
    return F.date_format(F.date_trunc("day", ts), "yyyy-MM-dd")


def records_per_batch(documents: DataFrame, datasets: DataFrame) -> DataFrame:
    counts = (
        documents.filter("status = 'ingested'")
        .groupBy("dataset_id", day(F.col("created_at")).alias("batch_day"))
        .agg(F.count("*").alias("n"))
    )
    named = _name_of(counts, datasets).groupBy(F.col("name").alias("dataset_name"), "batch_day")
    return named.agg(F.sum("n").alias("records_cleaned")).orderBy("batch_day", "dataset_name")


def records_per_dataset(documents: DataFrame, datasets: DataFrame) -> DataFrame:
    counts = documents.filter("status = 'ingested'").groupBy("dataset_id").agg(F.count("*").alias("records_cleaned"))
    return _name_of(counts, datasets).orderBy("dataset_id").select("name", "records_cleaned")


def null_ratios(documents: DataFrame, datasets: DataFrame) -> DataFrame:
    """Share of null or blank values per dataset for seven columns."""
    absent = {
        "language_null_ratio": blank(F.col("language")),
        "content_null_ratio": blank(F.col("content")),
        "type_null_ratio": blank(F.col("type")),
        "word_count_null_ratio": F.col("word_count").isNull(),
        "char_count_null_ratio": F.col("char_count").isNull(),
        "thai_null_ratio": F.col("thai_ratio").isNull(),
        "source_null_ratio": blank(F.col("source")),
    }
    ratios = [(F.count_if(test) / F.count("*")).alias(name) for name, test in absent.items()]
    return _name_of(documents.groupBy("dataset_id").agg(*ratios), datasets).select("dataset_id", "name", *absent)


def clean_counters(cleaned: DataFrame, by: list[str]) -> DataFrame:
    """Rows in, cleaned and failed per run; in = cleaned + failed."""
    return cleaned.groupBy(*by).agg(
        F.count("*").alias("n_in"),
        F.count_if(F.col("status") == "cleaned").alias("n_cleaned"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )


def validate_counters(checked: DataFrame, by: list[str]) -> DataFrame:
    return checked.groupBy(*by).agg(
        F.count("*").alias("n_in"),
        F.count_if(F.col("reason").isNull()).alias("n_ok"),
        F.count_if(F.col("reason").isNotNull()).alias("n_bad"),
    )


def map_counters(mapped: DataFrame, by: list[str]) -> DataFrame:
    return mapped.groupBy(*by).agg(
        F.count("*").alias("n_in"),
        F.count("*").alias("n_out"),
        F.count_if(F.col("map_status") == "mapped").alias("n_mapped"),
        F.count_if(F.col("map_status") == "unmapped").alias("n_unmapped"),
    )


def reject_reasons(logs: DataFrame, details: Column | None = None) -> DataFrame:
    """How often each step rejected a record, by the reason's name before its first colon."""
    reason = F.substring_index(strip(details if details is not None else F.col("details")), ":", 1)
    return (
        logs.filter("status = 'failed'")
        .groupBy("step", "status", reason.alias("reason"))
        .agg(F.count("*").alias("n_records"))
    )


def daily_anomalies(daily: DataFrame, by: list[str], day_column: str, count: str, days: int = 7) -> DataFrame:
    """Deviation of each day's count from the ``days`` rows before it, in standard deviations.

    Works on daily counts: a series has one row per day, so its window is small however many records a day holds.
    Sums of whole numbers keep the result exact: z = (k*n - s1) / sqrt(k*s2 - s1^2). Null without spread or history.
    """
    frame = Window.partitionBy(*by).orderBy(day_column).rowsBetween(-days, -1)
    n = F.col(count).cast("double")
    k, s1, s2 = F.col("_k").cast("double"), F.col("_s1"), F.col("_s2")
    spread = k * s2 - s1 * s1
    return (
        daily.withColumn("_k", F.count("*").over(frame))
        .withColumn("_s1", F.sum(n).over(frame))
        .withColumn("_s2", F.sum(n * n).over(frame))
        .withColumn("z_score", F.when((k > 1) & (spread > 0), (k * n - s1) / F.sqrt(spread)))
        .drop("_k", "_s1", "_s2")
    )
