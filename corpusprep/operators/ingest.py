"""Loading into keyed tables: new rows only, and upserts with a rule per column.

Parquet has no merge, so every function returns the whole new table (or only the new rows) as a DataFrame; write it
to a new snapshot folder, or call it from ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import stable_uuid
from .keyed import mark_first


def new_keys(candidates: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    """Candidate keys not seen yet; one object may have millions of seen rows, so those are made distinct first."""
    return candidates.join(seen.select(*on).distinct(), on, "left_anti")


def with_defaults(df: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Fill what a record may leave out before it enters the documents table."""
    position = F.concat(F.coalesce("source", F.lit("unknown")), F.lit(":"), F.col(line_no).cast("string"))
    given_title = F.nullif(F.col("title"), F.lit("")) if "title" in df.columns else F.lit(None).cast("string")
    return (
        df.withColumn("id", F.coalesce(F.nullif("id", F.lit("")), stable_uuid(F.col("source"), F.col(line_no))))
        .withColumn("title", F.coalesce(F.nullif("filename", F.lit("")), given_title, position))
        .withColumn("language", F.coalesce(F.nullif("language", F.lit("")), F.lit("th")))
        .withColumn("source", F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown_source")))
        .withColumn("word_count", F.coalesce("word_count", F.lit(0).cast("long")))
        .withColumn("char_count", F.coalesce("char_count", F.lit(0).cast("long")))
        .withColumn("script_ratio", F.coalesce("script_ratio", F.lit(0.0)))
        .withColumn("status", F.lit("ingested"))
    )


def _spread(key: str, row_id: str) -> Column:
    """The key, or for a null key a text of its own: null keys match nothing but would all land in one task."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(row_id).cast("string")))


def absent_rows(
    batch: DataFrame, existing: DataFrame, key: str = "checksum", order: str = "line_no", row_id: str = "id"
) -> DataFrame:
    """Batch rows whose key is in neither the table nor an earlier batch row; rows without a key always pass.

    ``order`` must be unique in the batch.
    """
    first = mark_first(batch, [key], [], order).filter(f"is_first OR `{key}` IS NULL").drop("is_first")
    known = existing.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    keyed = first.withColumn("_key", _spread(key, row_id))
    return keyed.join(known, "_key", "left_anti").drop("_key")


def insert_absent(
    existing: DataFrame, batch: DataFrame, key: str = "checksum", order: str = "line_no", row_id: str = "id"
) -> DataFrame:
    added = absent_rows(batch, existing, key, order, row_id)
    return existing.unionByName(added.select(*existing.columns))


def upsert_rows(
    existing: DataFrame, batch: DataFrame, key: str = "checksum", order: str = "line_no", row_id: str = "id"
) -> DataFrame:
    """Replace rows by key, keeping the id of the row that came first.

    Only the keys of the batch meet the table: untouched rows pass an anti-join, their payload is not merged.
    """
    keyless = batch.filter(F.col(key).isNull())
    per_key = (
        batch.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(order).alias(order), F.min_by(row_id, order).alias("_first_id"))
    )
    latest = batch.join(per_key.select(order, "_first_id"), order)
    old_ids = existing.filter(F.col(key).isNotNull()).select(key, F.col(row_id).alias("_old_id"))
    updated = latest.join(old_ids, key, "left").withColumn(row_id, F.coalesce("_old_id", "_first_id"))
    touched = per_key.select(F.col(key).alias("_key"))
    untouched = existing.withColumn("_key", _spread(key, row_id)).join(touched, "_key", "left_anti")
    columns = existing.columns
    return untouched.select(*columns).unionByName(updated.select(*columns)).unionByName(keyless.select(*columns))


def upsert_columns(
    existing: DataFrame,
    batch: DataFrame,
    keys: list[str],
    newest: list[str],
    oldest: list[str] = (),
    greatest: list[str] = (),
    seq: str = "seq",
) -> DataFrame:
    """Keyed merge with a rule per column; ``seq`` orders the batch (greater is newer).

    Table rows count as oldest. One aggregation with map-side combine: repeated keys collapse before the shuffle.
    """
    rows = existing.withColumn(seq, F.lit(-1).cast("long")).unionByName(batch.withColumn(seq, F.col(seq).cast("long")))
    rules = [F.max_by(c, seq).alias(c) for c in newest]
    rules += [F.min_by(c, seq).alias(c) for c in oldest]
    rules += [F.max(c).alias(c) for c in greatest]
    return rows.groupBy(*keys).agg(*rules).select(*existing.columns)


def upsert_labels(existing: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Newest value and time, greatest confidence, first annotator.

    Value and confidence may therefore come from different rows; that is the table's rule.
    """
    return upsert_columns(
        existing, batch, ["target_id", "label_type"], ["label_value", "created_at"], ["annotator"], ["confidence"], seq
    )


def merge_labels(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """:func:`upsert_labels` for a table that keeps the order of its rows.

    ``seq`` is the newest row merged so far and ``first_seq`` the oldest, so partial merges in any order give the
    result of one merge over everything.
    """
    rows = existing.unionByName(batch)
    merged = rows.groupBy("target_id", "label_type").agg(
        F.max_by("label_value", "seq").alias("label_value"),
        F.max_by("created_at", "seq").alias("created_at"),
        F.min_by("annotator", "first_seq").alias("annotator"),
        F.max("confidence").alias("confidence"),
        F.max("seq").alias("seq"),
        F.min("first_seq").alias("first_seq"),
    )
    return merged.select(*existing.columns)


def upsert_logs(existing: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    return upsert_columns(
        existing,
        batch,
        ["id"],
        ["status", "details", "executed_at"],
        ["document_id", "step", "executed_by"],
        seq=seq,
    )


def union_logs(*logs: DataFrame | None) -> DataFrame:
    """Logs of all steps that ran; an absent one is skipped, missing columns become null."""
    present = [log for log in logs if log is not None]
    merged = present[0]
    for log in present[1:]:
        merged = merged.unionByName(log, allowMissingColumns=True)
    return merged


def log_table(logs: DataFrame) -> DataFrame:
    """Log rows under the column names of the log table."""
    return logs.withColumnsRenamed({"log_id": "id", "target_id": "document_id"})
