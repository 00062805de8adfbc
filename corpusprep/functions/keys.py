"""Object keys, stage paths, stable identifiers and timestamps."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Stage prefixes and log folders of the object layout.
RAW, CLEANED, VALIDATED, MAPPING = "raw", "cleaned", "validated", "mapping"
CLEAN_LOGS, VALIDATION_LOGS, MAPPING_LOGS = (
    "meta/preprocessing_logs",
    "meta/validation_logs",
    "meta/mapping_logs",
)


def normalize_key(*parts: Column) -> Column:
    """Join key parts by one slash; no blank parts, back-slashes, doubled or leading slashes."""
    cleaned = []
    for part in parts:
        inner = F.replace(F.btrim(strip(part), F.lit("/")), F.lit("\\"), F.lit("/"))
        cleaned.append(F.when(F.btrim(part, F.lit("/")) != "", inner))
    joined = F.regexp_replace(F.concat_ws("/", *cleaned), "/{2,}", "/")
    return F.ltrim(joined, F.lit("/"))


def object_key(path: Column, root: str) -> Column:
    """Key of a scanned file below ``root``: the file's URI decoded, without scheme, host or bucket, and root.

    A path outside ``root`` keeps all its folders.
    """
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    # Decoding takes a plus sign for a blank; in a path it is a plus sign.
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), scheme, "")
    base = re.sub(scheme, "", root).strip("/") + "/"
    key = F.ltrim(plain, F.lit("/"))
    return F.when(key.startswith(base), F.substr(key, F.lit(len(base) + 1))).otherwise(key)


def basename(key: Column) -> Column:
    """Text after the last slash; a key ending in a slash is kept whole; null becomes ''."""
    key = strip(F.coalesce(key, F.lit("")))
    tail = F.substring_index(key, "/", -1)
    return F.when(tail != "", tail).otherwise(key)


def is_blank(value: Column) -> Column:
    return value.isNull() | F.lower(strip(value)).isin("", "none")


def below_prefix(key: Column, prefix: str = RAW) -> Column:
    return key.startswith(prefix.rstrip("/") + "/")


@dataclass(frozen=True)
class StagePaths:
    """Keys of every stage of one raw object, as Column expressions over its key."""

    stem: Column
    cleaned: Column
    clean_log: Column
    validated: Column
    validation_log: Column
    mapped: Column
    mapping_log: Column


def stage_paths(raw_key: Column, prefix: str = RAW) -> StagePaths:
    prefix = prefix.rstrip("/") + "/"
    base = F.when(raw_key.startswith(prefix), F.substr(raw_key, F.lit(len(prefix) + 1))).otherwise(raw_key)
    parent = F.regexp_extract(base, "^(.*)/[^/]*$", 1)
    stem = F.regexp_replace(F.substring_index(raw_key, "/", -1), "\\.jsonl$", "")
    # The mapped file lies beside the dataset folder: everything from "/jsonl" on is cut.
    dataset = F.regexp_replace(parent, "/jsonl.*$", "")

    def key(folder: str, middle: Column, suffix: str) -> Column:
        return normalize_key(F.lit(folder), middle, F.concat(stem, F.lit(suffix)))

    return StagePaths(
        stem=stem,
        cleaned=key(CLEANED, parent, ".cleaned.jsonl"),
        clean_log=key(CLEAN_LOGS, parent, ".cleaned.log.jsonl"),
        validated=key(VALIDATED, parent, ".validated.jsonl"),
        validation_log=key(VALIDATION_LOGS, parent, ".validated.log.jsonl"),
        mapped=key(MAPPING, dataset, ".mapped.jsonl"),
        mapping_log=key(MAPPING_LOGS, stem, ".map.log.jsonl"),
    )


def stable_uuid(*cols: Column) -> Column:
    """An identifier in UUID form derived from the row's own key, so that a rerun writes the same rows.

    Use ``F.uuid()`` instead where fresh identifiers are wanted.
    """
    text = F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    digest = F.sha2(text, 256)
    pieces = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in pieces])


def epoch_seconds(value: Column) -> Column:
    """Whole epoch seconds from a number that may be in milliseconds."""
    value = value.cast("long")
    return F.when(value >= 1_000_000_000_000, F.floor(value / 1000).cast("long")).otherwise(value)


def iso_from_epoch(value: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds(value)), "yyyy-MM-dd'T'HH:mm:ss")


def iso_plus7(ts: Column) -> Column:
    """ISO-8601 in the +07:00 zone, whole seconds, from a UTC timestamp (session zone UTC)."""
    return F.concat(F.date_format(ts + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
