"""A keyed Parquet table in buckets: a merge reads and rewrites only buckets that may hold one of its keys.

Rows are dealt to buckets by the hash of their key. Every bucket has a Bloom filter, kept as a table of its bits. A
batch's keys are looked up there first: buckets in which none of them can be are not read, their new rows are added as
one more file; only buckets with a possible hit are read, merged and written anew. A version is published by one line of
the manifest, which lists the folders of all buckets, so readers see whole versions.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import materialize
from .tables import read_optional

_MANIFEST = "version long, name string, rows string, bits string"
_BITS = "word long, bits long"
_WORD = 63  # bits of a long that stay clear of its sign
Rule = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Merged:
    """Buckets that were read and written anew, and those that only got another file."""

    rewritten: tuple[int, ...]
    extended: tuple[int, ...]


class KeyedTable:
    """A table below ``root`` with the given schema and key columns; one writer at a time.

    ``buckets`` should make a bucket some hundred MB; it is fixed for the table's life, as are ``bits`` and ``hashes``
    of the Bloom filters (10 bits a key and 7 hashes err in 1 of 100 lookups; an error costs a rewrite, nothing else).
    ``spread_by`` is a column that deals rows with a null in their key; else all of them share a bucket.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int = 16,
        bits: int = 1 << 20, hashes: int = 7, spread_by: str | None = None,
    ):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.buckets, self.bits, self.hashes, self.spread_by = buckets, bits, hashes, spread_by

    def _lines(self) -> DataFrame:
        return read_optional(self.spark, f"{self.root}/manifest", _MANIFEST)

    def _newest(self, name: str = "") -> tuple[int, dict[str, list[str]], dict[str, list[str]], bool]:
        """Version, folders of rows and of filters per bucket, and whether a batch of that name was merged."""
        newest = F.max(F.struct("version", "rows", "bits")).alias("line")
        found = self._lines().agg(newest, F.count_if(F.col("name") == name).alias("n")).first()
        if found.line is None:
            return 0, {}, {}, False
        return found.line.version, json.loads(found.line.rows), json.loads(found.line.bits), found.n > 0

    @property
    def version(self) -> int:
        return self._newest()[0]

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """All rows of the newest version."""
        return self._rows(sorted(p for paths in self._newest()[1].values() for p in paths))

    def _bucket(self) -> Column:
        dealt = F.xxhash64(*self.keys)
        if self.spread_by:
            partly = reduce(or_, [F.col(k).isNull() for k in self.keys])
            dealt = F.when(partly, F.xxhash64(*self.keys, self.spread_by)).otherwise(dealt)
        return F.pmod(dealt, F.lit(self.buckets)).cast("int").alias("_bucket")

    def _positions(self, keyed: DataFrame) -> DataFrame:
        """A row per key and hash: ``word`` and the bit in it."""
        hashed = [F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(self.bits)) for i in range(1, self.hashes + 1)]
        placed = keyed.select("*", F.explode(F.array(*hashed)).alias("_at"))
        return placed.withColumns({"word": F.floor(F.col("_at") / _WORD), "_bit": (F.col("_at") % _WORD).cast("int")})

    def _touched(self, batch: DataFrame, bits: dict[str, list[str]]) -> tuple[list[int], list[int]]:
        """Buckets that may hold a key of the batch, and the other ones it has rows for."""
        asked = batch.select("_bucket", *self.keys).distinct()
        paths = sorted(p for of_bucket in bits.values() for p in of_bucket)
        if not paths:
            return [], sorted(r[0] for r in asked.select("_bucket").distinct().collect())  # at most ``buckets``
        reader = self.spark.read.option("basePath", f"{self.root}/bits").schema(_BITS + ", _bucket int")
        filters = reader.parquet(*paths).groupBy("_bucket", "word").agg(F.bit_or("bits").alias("bits"))
        looked_up = self._positions(asked).join(filters, ["_bucket", "word"], "left")
        is_set = F.coalesce(F.expr("shiftright(bits, _bit) & 1"), F.lit(0).cast("long"))
        per_key = looked_up.groupBy("_bucket", *self.keys).agg(F.min(is_set).alias("_set"))
        found = per_key.groupBy("_bucket").agg(F.max("_set").alias("hit")).collect()  # at most ``buckets``
        return sorted(r[0] for r in found if r.hit), sorted(r[0] for r in found if not r.hit)

    def merge(self, name: str, batch: DataFrame, rule: Rule) -> Merged | None:
        """``rule(existing, batch)`` gives a table's new rows; None if a batch of this name was merged before.

        ``rule`` may only match rows by the table's keys, and is called once with the rows of the buckets that may hold
        a key of the batch and once with no rows. The batch may have columns that only the rule needs.
        """
        version, rows, bits, merged_before = self._newest(name)
        if merged_before:
            return None
        batch = materialize(batch.withColumn("_bucket", self._bucket()))
        hit, fresh = self._touched(batch, bits)
        own = self._rows(sorted(p for b in hit for p in rows.get(str(b), [])))
        of = {True: batch.filter(F.col("_bucket").isin(hit)), False: batch.filter(F.col("_bucket").isin(fresh))}
        merged = rule(own, of[True].drop("_bucket")).select(*self.schema.names)
        if fresh:
            added = rule(self._rows([]), of[False].drop("_bucket")).select(*self.schema.names)
            merged = merged.unionByName(added)
        attempt = f"attempt={version + 1}-{uuid.uuid4().hex}"
        folder = f"{self.root}/rows/{attempt}"
        # One task per bucket: a bucket is one file, and as the rule leaves one row per key it is even.
        merged.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        dealt = StructType([*self.schema.fields, StructField("_bucket", IntegerType())])
        written = self.spark.read.schema(dealt).parquet(folder)
        set_bits = self._positions(written.select("_bucket", *self.keys)).groupBy("_bucket", "word")
        words = set_bits.agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))
        words.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/bits/{attempt}")
        for b in hit:
            rows.pop(str(b), None)
            bits.pop(str(b), None)
        for b in sorted({re.search(r"/_bucket=(\d+)/", f)[1] for f in written.inputFiles()}):
            rows[b] = [*rows.get(b, []), f"{folder}/_bucket={b}"]
            bits[b] = [*bits.get(b, []), f"{self.root}/bits/{attempt}/_bucket={b}"]
        line = (version + 1, name, json.dumps(rows, sort_keys=True), json.dumps(bits, sort_keys=True))
        # One row is one file, and a file appears under its name only when it is complete.
        self.spark.createDataFrame([line], _MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return Merged(tuple(hit), tuple(fresh))


def newest_wins(keys: list[str]) -> Rule:
    """Rule for batches with one row per key that replaces the table's."""

    def rule(existing: DataFrame, batch: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [existing[k].eqNullSafe(batch[k]) for k in keys])
        return existing.join(batch, same, "left_anti").unionByName(batch.select(*existing.columns))

    return rule
