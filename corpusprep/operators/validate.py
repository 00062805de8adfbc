"""Ordered validation rules over cleaned records; the first failing rule is the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import checksum, strip
from ..sources import jsonl
from .clean import VALIDATOR, stable_uuid
from .keyed import mark_first

# Fields that must be present, in the order they are reported.
REQUIRED = ["filename", "source", "text", "checksum", "status", "processed_at"]

_WEEK = "W(?:0[1-9]|[1-4]\\d|5[0-3])"
_DATE = f"\\d{{4}}-(?:\\d{{2}}-\\d{{2}}|{_WEEK}(?:-[1-7])?)|\\d{{4}}(?:\\d{{4}}|{_WEEK}[1-7]?)"
_HOUR, _SIXTY = "(?:[01]\\d|2[0-3])", "[0-5]\\d"
_CLOCK = f"{_HOUR}(?::{_SIXTY}(?::{_SIXTY}(?:[.,]\\d+)?)?)?|{_HOUR}(?:{_SIXTY}(?:{_SIXTY}(?:[.,]\\d+)?)?)?"
_ZONE = f"Z|[+-]{_HOUR}(?::?{_SIXTY}(?::?{_SIXTY}(?:\\.\\d+)?)?)?"
ISO_SHAPE = f"^(?:{_DATE})(?:.(?:{_CLOCK})(?:{_ZONE})?)?$"


@dataclass(frozen=True)
class Field:
    """How one field shows up: present at all, of the wanted type, and its value."""

    present: Column
    typed: Column
    value: Column


def is_iso_timestamp(value: Column) -> Column:
    """ISO-8601 date or date and time whose calendar date exists (week dates are accepted by shape)."""
    value = strip(value)
    digits = F.replace(F.regexp_extract(value, "^(\\d{4}-?\\d{2}-?\\d{2})", 1), F.lit("-"), F.lit(""))
    real_date = F.when(digits == "", F.lit(True)).otherwise(F.try_to_date(digits, "yyyyMMdd").isNotNull())
    return F.coalesce(value.rlike(ISO_SHAPE) & real_date, F.lit(False))


def _rules(fields: dict[str, Field], allowed: list[str], min_chars: int) -> Column:
    name, source, text = fields["filename"], fields["source"], fields["text"]
    check, status, at = fields["checksum"], fields["status"], fields["processed_at"]
    words, chars = fields["word_count"], fields["char_count"]

    def bad(field: Field, condition: Column) -> Column:
        return ~field.typed | F.coalesce(condition, F.lit(False))

    def number(field: Field) -> Column:
        return field.present & (~field.typed | F.coalesce(field.value < 0, F.lit(False)))

    missing = F.coalesce(*[F.when(~fields[f].present, F.lit(f"missing_field:{f}")) for f in REQUIRED])
    size = F.length(text.value)
    return (
        F.when(missing.isNotNull(), missing)
        .when(bad(name, strip(name.value) == ""), "bad_filename")
        .when(bad(source, strip(source.value) == ""), "bad_source")
        .when(
            bad(text, size < min_chars),
            F.concat(F.lit("bad_text_len:"), F.when(text.typed, size.cast("string")).otherwise("NA")),
        )
        .when(bad(check, ~check.value.rlike("^[0-9a-f]{64}\\z")), "bad_checksum_format")
        .when(
            bad(status, ~status.value.isin(allowed)),
            F.concat(F.lit("bad_status:"), F.coalesce(status.value, F.lit("None"))),
        )
        .when(bad(at, ~is_iso_timestamp(at.value)), "bad_processed_at_format")
        .when(number(words), "bad_word_count")
        .when(number(chars), "bad_char_count")
        .when(
            chars.value.isNotNull() & (chars.value != size),
            F.concat(F.lit("char_count_mismatch:"), chars.value.cast("string"), F.lit("!="), size.cast("string")),
        )
        .when(checksum(text.value) != check.value, "checksum_mismatch")
    )


def allowed_statuses(comma_list: str = "cleaned") -> list[str]:
    return [s.strip() for s in comma_list.split(",") if s.strip()]


def _typed_fields() -> dict[str, Field]:
    def of(name: str, optional: bool = False) -> Field:
        value = F.col(name)
        return Field(value.isNotNull() if optional else F.lit(True), value.isNotNull(), value)

    fields = {name: of(name) for name in REQUIRED}
    return fields | {name: of(name, optional=True) for name in ("word_count", "char_count")}


def _variant_fields(record: Column) -> dict[str, Field]:
    def of(name: str, wanted: str) -> Field:
        part = jsonl.kind(record, name)
        value = jsonl.field(record, name)
        present = part.isNotNull()
        if wanted == "BIGINT":
            # A JSON null counts as "not given" for the optional numbers.
            present = present & (part != "VOID")
            value = F.when(part == "BIGINT", value.try_cast("long"))
        return Field(present, F.coalesce(part == wanted, F.lit(False)), value)

    fields = {name: of(name, "STRING") for name in REQUIRED}
    return fields | {name: of(name, "BIGINT") for name in ("word_count", "char_count")}


def _with_duplicates(df: DataFrame, scope: list[str], order: str) -> DataFrame:
    """The first accepted row of every checksum stays accepted, later ones are duplicates.

    Rejected rows neither win nor block: a copy behind a rejected first copy passes.
    """
    marked = mark_first(df, [*scope, "checksum"], scope, order, eligible=F.col("reason").isNull())
    duplicate = F.col("reason").isNull() & ~F.col("is_first")
    return marked.withColumn("reason", F.when(duplicate, "dup_checksum_in_file").otherwise(F.col("reason"))).drop(
        "is_first"
    )


def validate(
    df: DataFrame, scope: list[str], order: str, allowed: str = "cleaned", min_chars: int = 1
) -> DataFrame:
    """Typed records with their ``reason`` (null when accepted); accepted rows get status ``validated``."""
    checked = df.withColumn("reason", _rules(_typed_fields(), allowed_statuses(allowed), min_chars))
    checked = _with_duplicates(checked, scope, order)
    return checked.withColumn("status", F.when(F.col("reason").isNull(), "validated").otherwise(F.col("status")))


def validate_lines(lines: DataFrame, allowed: str = "cleaned", min_chars: int = 1) -> DataFrame:
    """Raw lines of a cleaned file to ``file_path, line_no, id, checksum, reason, record``.

    Field types are tested on the JSON itself: a number where a text belongs is a fault, not a text.
    """
    parsed = lines.withColumn("record", jsonl.json_value(F.col("value")))
    record = F.col("record")
    reason = (
        F.when(record.isNull(), "json_error")
        .when(jsonl.kind(record) != "OBJECT", "type:not_object")
        .otherwise(_rules(_variant_fields(record), allowed_statuses(allowed), min_chars))
    )
    fields = parsed.select(
        "file_path",
        "line_no",
        jsonl.field(record, "id").alias("id"),
        jsonl.field(record, "checksum").alias("checksum"),
        reason.alias("reason"),
        "record",
    )
    return _with_duplicates(fields, ["file_path"], "line_no")


def validation_log(checked: DataFrame, at: Column, target: str = "id") -> DataFrame:
    target_id = F.col(target).cast("string")
    return checked.select(
        stable_uuid(F.lit(VALIDATOR), target_id, F.lit("validate")).alias("log_id"),
        target_id.alias("target_id"),
        F.when(F.col("reason").startswith("json_error"), "read_json").otherwise("validate").alias("step"),
        F.when(F.col("reason").isNull(), "success").otherwise("failed").alias("status"),
        F.coalesce("reason", F.lit("")).alias("details"),
        F.lit(VALIDATOR).alias("executed_by"),
        at.alias("executed_at"),
    )
