"""Raw records to documents, logs and counters in one call."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import object_key, stage_paths
from ..operators import clean as cleaning
from ..operators import enrich, ingest, quality, validate
from ..operators.clean import CleanConfig
from ..operators.language import identify_joined, language_of, sendable
from ..session import materialize, remove, staged

# What prepare() reads; columns a source does not have may be null.
RECORD_COLUMNS = [
    "file_path",
    "line_no",
    "text",
    "source",
    "filename",
    "source_id",
    "meta",
    "created_date",
    "updated_date",
]


@dataclass(frozen=True)
class PrepareConfig:
    """``root`` is the folder or bucket that was scanned: file paths become object keys below it. None says that they
    are object keys already; scanned files have URIs, whose names and datasets would not be found."""

    root: str | None
    clean: CleanConfig = field(default_factory=CleanConfig)
    allowed_status: str = "cleaned"
    min_valid_chars: int = 1
    prefer_csv: bool = False


@dataclass
class Outputs:
    """``documents`` are the new rows for the documents table; logs and counters are planned when asked for."""

    cleaned: DataFrame
    checked: DataFrame
    mapped: DataFrame
    documents: DataFrame
    url_map: DataFrame
    headers: list[str] | None
    run_at: Column

    @cached_property
    def logs(self) -> DataFrame:
        return ingest.union_logs(
            cleaning.clean_log(self.cleaned, self.run_at),
            validate.validation_log(self.checked, self.run_at),
            enrich.mapping_log(self.mapped, self.run_at),
            enrich.side_table_log(self.url_map, self.headers, self.run_at),
        )

    @cached_property
    def counters(self) -> dict[str, DataFrame]:
        return {
            "clean": quality.clean_counters(self.cleaned, ["file_path"]),
            "validate": quality.validate_counters(self.checked, ["file_path"]),
            "map": quality.map_counters(self.mapped, ["file_path"]),
        }


def prepare(
    records: DataFrame,
    url_map: DataFrame,
    existing: DataFrame,
    datasets: DataFrame,
    run_at: Column,
    config: PrepareConfig,
    stage: str | None = None,
    profiles: DataFrame | None = None,
    headers: list[str] | None = None,
    keep_mapped: bool = False,
) -> Outputs:
    """Clean, validate, map and keep what is new.

    ``stage`` is a folder for the wide intermediate tables, of which those that a later one holds are deleted; ``keep_mapped`` also stores the mapped rows there, for
    callers that read several outputs. Duplicate checks read a step twice (once narrow for
    the keys, once whole), so at scale give a folder: the text is then cleaned once. ``profiles`` turns on language
    identification for texts the script ratio leaves open. ``headers`` comes from the side table's reader.
    """
    rules = config.clean
    if config.root is not None:
        records = records.withColumn("file_path", object_key(F.col("file_path"), config.root))
    named = cleaning.name_records(records, stage_paths(F.col("file_path")).stem)
    with_meta = cleaning.collect_metadata(named, "text").drop("source_id")
    measured = cleaning.measure(cleaning.clean_text(with_meta), rules)
    measured = staged(measured.withColumn("processed_at", run_at), stage, "measured")
    if profiles is not None:
        rows = sendable(profiles)
        if rows is not None:
            # Only texts that the ratio leaves open are looked at; no text leaves its row.
            detected = language_of(F.when(F.col("language").isNull(), F.col("text")), rows).getField("language")
            measured = measured.withColumn("language", F.coalesce("language", detected))
        else:
            open_texts = measured.filter("language IS NULL").select("id", "text")
            found = materialize(identify_joined(open_texts, "id", "text", profiles).select("id", "language"))
            found = found.withColumnRenamed("language", "_detected")
            measured = measured.join(found, "id", "left").withColumn("language", F.coalesce("language", "_detected"))
            measured = measured.drop("_detected")
        measured = staged(measured, stage, "languages")
    measured = measured.withColumn("language", F.coalesce("language", F.lit("und")))

    cleaned = cleaning.verdict(measured, rules)
    checked = validate.validate(
        cleaned.withColumnRenamed("reason", "clean_reason"),
        list(rules.scope),
        rules.order,
        config.allowed_status,
        config.min_valid_chars,
    )
    checked = staged(checked, stage, "checked")
    if stage is not None:
        # The checked rows hold all of the steps before.
        remove(records.sparkSession, *[f"{stage.rstrip('/')}/{name}" for name in ("measured", "languages")])
        # The cleaned rows are in the stored step: their duplicates are not looked for again by whoever reads them.
        passed = F.col("clean_reason") == ""
        cleaned = (
            checked.withColumn("reason", F.col("clean_reason"))
            .withColumn("status", F.when(passed, "cleaned").otherwise("failed"))
            .select(*cleaned.columns)
        )

    accepted = checked.filter("reason IS NULL")
    mapped = enrich.map_metadata(accepted, url_map, ["id"], config.prefer_csv)
    mapped = staged(mapped, stage if keep_mapped else None, "mapped")
    located = enrich.resolve_dataset(mapped, datasets, "file_path", ["id"])
    position = F.format_string("%s\u0001%012d", F.col("file_path"), F.col("line_no"))
    batch = ingest.with_defaults(located.withColumn("_position", position))
    documents = ingest.absent_rows(batch, existing, "checksum", "_position").drop("_position")

    return Outputs(cleaned, checked, mapped, documents, url_map, headers, run_at)
