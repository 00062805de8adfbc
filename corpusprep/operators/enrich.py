"""URL side table, dataset lookup and metadata merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metadata
from ..functions.keys import basename, stable_uuid
from .clean import MAPPER
from .keyed import measured_lookup, salted_lookup


def last_url_per_name(url_map: DataFrame) -> DataFrame:
    """One row per filename: the url of its last line, and how many lines it had."""
    return url_map.groupBy("filename").agg(
        F.max_by("url", "line_no").alias("url"), F.count("*").alias("n_lines")
    )


def duplicate_names(url_map: DataFrame) -> DataFrame:
    return last_url_per_name(url_map).filter("n_lines > 1").select("filename", "n_lines")


def lookup_name(*candidates: Column) -> Column:
    """Basename of the first candidate that is not empty; '' when there is none."""
    return basename(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit("")))


def merge_url(old: Column, new: Column, prefer_csv: bool) -> Column:
    """The url to keep: the side table wins when preferred or when there was none."""
    if prefer_csv:
        return F.coalesce(new, old)
    return F.coalesce(F.when(~F.coalesce(old, F.lit("")).isin("", "{}"), old), new)


def map_urls(
    df: DataFrame, url_map: DataFrame, name: Column, old_url: Column, spread_by: list[str], prefer_csv: bool = False
) -> DataFrame:
    """Add ``map_key``, ``url``, ``map_status`` and ``url_written`` to every record.

    A record counts as mapped when its name is in the side table, also when its old url is kept; ``url_written``
    tells whether the side table's url was taken. A record without a name never matches. Many records may share one
    name, so the lookup is salted.
    """
    side = last_url_per_name(url_map).select(F.col("filename").alias("map_key"), F.col("url").alias("_csv_url"))
    keyed = df.withColumn("map_key", name).withColumn("_old_url", old_url)
    joined = salted_lookup(keyed, side, ["map_key"], spread_by)
    found = F.col("_csv_url").isNotNull()
    written = found & (F.lit(prefer_csv) | F.coalesce(F.col("_old_url"), F.lit("")).isin("", "{}"))
    return (
        joined.withColumn("url", merge_url(F.col("_old_url"), F.col("_csv_url"), prefer_csv))
        .withColumn("map_status", F.when(found, "mapped").otherwise("unmapped"))
        .withColumn("url_written", written)
        .drop("_csv_url", "_old_url")
    )


def map_metadata(df: DataFrame, url_map: DataFrame, spread_by: list[str], prefer_csv: bool = False) -> DataFrame:
    """:func:`map_urls` for records whose url lives in ``metadata``."""
    old = metadata.text_of(F.col("metadata"), "url")
    mapped = map_urls(df, url_map, lookup_name(F.col("filename")), old, spread_by, prefer_csv)
    put = metadata.put(F.col("metadata"), "url", F.col("url"))
    return mapped.withColumn("metadata", F.when(F.col("url_written"), put).otherwise(F.col("metadata"))).drop("url")


def mapping_log(mapped: DataFrame, at: Column, target: str = "id") -> DataFrame:
    """A log row per written url and per unmapped record; a kept old url leaves none."""
    target_id = F.col(target).cast("string")
    return mapped.filter("url_written OR map_status = 'unmapped'").select(
        stable_uuid(F.lit(MAPPER), target_id, F.lit("map")).alias("log_id"),
        target_id.alias("target_id"),
        F.lit("map").alias("step"),
        F.col("map_status").alias("status"),
        F.nullif(F.col("map_key"), F.lit("")).alias("details"),
        F.lit(MAPPER).alias("executed_by"),
        at.alias("executed_at"),
    )


def side_table_log(url_map: DataFrame, headers: list[str] | None, at: Column) -> DataFrame:
    """Warnings for names listed twice, or one failure when the headers are missing."""
    if headers is not None:
        details = "missing_headers:" + ",".join(headers)
        rows = url_map.sparkSession.range(1).select(F.lit(details).alias("details"), F.lit("failed").alias("status"))
    else:
        rows = duplicate_names(url_map).select(
            F.concat(F.lit("duplicate_in_csv:"), F.col("filename")).alias("details"), F.lit("warn").alias("status")
        )
    return rows.select(
        stable_uuid(F.lit(MAPPER), F.lit("load_csv"), F.col("details")).alias("log_id"),
        F.lit(None).cast("string").alias("target_id"),
        F.lit("load_csv").alias("step"),
        "status",
        "details",
        F.lit(MAPPER).alias("executed_by"),
        at.alias("executed_at"),
    )


def resolve_dataset(df: DataFrame, datasets: DataFrame, path: str, spread_by: list[str]) -> DataFrame:
    """Add ``dataset_id``: the dataset named by the deepest segment of the path before its first dot, else null.

    Each distinct path is resolved once; rows then look their path up.
    """
    names = datasets.groupBy("name").agg(F.min("id").alias("id")).select(F.col("name").alias("_segment"), "id")
    trimmed = F.btrim(F.col(path), F.lit("/"))
    segments = F.split(F.substring_index(trimmed, ".", 1), "/")
    paths = df.select(path).distinct().select(path, F.posexplode(segments).alias("_depth", "_segment"))
    matched = measured_lookup(paths, names, ["_segment"], [path], "inner")
    resolved = matched.groupBy(path).agg(F.max_by("id", "_depth").alias("dataset_id"))
    return salted_lookup(df, resolved, [path], spread_by)
