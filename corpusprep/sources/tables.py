"""Side tables, database tables and optional inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from ..functions.keys import basename
from ..functions.text import strip
from .jsonl import scan_lines

URL_MAP = "filename string, url string, line_no long"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], **options: str) -> DataFrame:
    """Chosen columns of a database table; pass ``partitionColumn`` and its bounds to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)


def read_optional(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "json") -> DataFrame:
    """The table at ``path``, or an empty one with the same schema when it does not exist."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_url_map(spark: SparkSession, path: str) -> tuple[DataFrame, list[str] | None]:
    """``filename, url, line_no`` of a CSV side table, and its headers when the needed ones are missing.

    Headers match in any case and after a byte-order mark. Without both headers the map is empty.
    """
    table = spark.read.option("header", True).option("multiLine", False).csv(path)
    names = {c.lstrip(chr(0xFEFF)).strip('"').lower(): c for c in reversed(table.columns)}
    if "filename" not in names or "url" not in names:
        return spark.createDataFrame([], URL_MAP), list(table.columns)
    rows = table.select(
        basename(F.col(f"`{names['filename']}`")).alias("filename"),
        strip(F.col(f"`{names['url']}`")).alias("url"),
        F.monotonically_increasing_id().alias("line_no"),
    )
    return rows.filter("filename <> '' AND url <> ''"), None


def prefer_mapped(mapped: DataFrame, validated: DataFrame, on: str = "id") -> DataFrame:
    """Mapped records, and validated ones for every record that was not mapped."""
    rest = validated.join(mapped.select(on), on, "left_anti")
    return mapped.unionByName(rest, allowMissingColumns=True)


__all__ = ["read_table", "read_jdbc", "read_optional", "read_url_map", "prefer_mapped", "scan_lines"]
