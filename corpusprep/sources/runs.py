"""Tables that grow by runs: everything a run writes becomes visible at once, or not at all.

A run writes each of its tables to a folder nobody reads yet and then adds one line to the manifest that names them all.
Readers take their folders from the manifest, so they see whole runs only. A run that dies before that line leaves
folders that no one refers to; a run that is already in the manifest is not written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import put
from .tables import read_optional

#: Reads a table of the same run that is written already.
Written = Callable[[str], DataFrame]
_MANIFEST = "run string, tables string, replaces array<string>"


class RunTables:
    """The tables below ``root``. The manifest has one short line per run since the last :meth:`compact`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _lines(self) -> dict[str, tuple[dict[str, str], list[str]]]:
        """Folders and replaced runs of every run. If a run was published twice, both lines are whole; the smaller counts."""
        found = read_optional(self.spark, f"{self.root}/manifest", _MANIFEST)
        lines = found.groupBy("run").agg(F.min(F.struct("tables", "replaces")).alias("line")).orderBy("run").collect()
        return {r.run: (json.loads(r.line.tables), r.line.replaces or []) for r in lines}

    def runs(self) -> set[str]:
        return set(self._lines())

    def commit(self, run: str, tables: dict[str, DataFrame | Callable[[Written], DataFrame]], replaces: list[str] = ()) -> bool:
        """Write the tables and publish them as one run; False, and nothing written, if the run is published already.

        A table may be given as a function that is called when the tables before it are written: it gets a function that
        reads one of them by name, so that a wide table need not be stored a second time for those computed from it.
        ``replaces`` names runs whose folders of these tables are not read any more.
        """
        if run in self.runs():
            return False
        attempt = uuid.uuid4().hex
        paths, schemas = {}, {}

        def written(name: str) -> DataFrame:
            return self.spark.read.schema(schemas[name]).parquet(paths[name])

        for name, table in tables.items():
            df = table(written) if callable(table) else table
            paths[name], schemas[name] = f"{self.root}/data/{name}/{run}-{attempt}", df.schema
            put(df, paths[name])
        self._publish(run, paths, list(replaces))
        return True

    def _publish(self, run: str, paths: dict[str, str], replaces: list[str]) -> None:
        # One row is one file, and a file appears under its name only when it is complete.
        row = self.spark.createDataFrame([(run, json.dumps(paths, sort_keys=True), replaces)], _MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.root}/manifest")

    def _current(self, name: str) -> dict[str, str]:
        """Folder per run of one table, without the replaced ones."""
        lines = {run: line for run, line in self._lines().items() if name in line[0]}
        gone = {old for _, replaced in lines.values() for old in replaced}
        return {run: paths[name] for run, (paths, _) in lines.items() if run not in gone}

    def read(self, name: str, schema: StructType | str) -> DataFrame:
        """All rows of a table; without any run an empty table."""
        paths = sorted(self._current(name).values())
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def compact(self, name: str, schema: StructType | str) -> bool:
        """Write a table's runs together as one that replaces them; False if there is nothing to put together."""
        old = self._current(name)
        if len(old) < 2:
            return False
        return self.commit(f"compact-{uuid.uuid4().hex}", {name: self.read(name, schema)}, sorted(old))


