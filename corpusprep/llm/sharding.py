"""Shards by a k-d tree: recursive splits at weighted medians along the widest metadata dimension.

A document is a point whose coordinates are the ranks of its metadata values and whose weight is its size. A node that is
to become k shards is cut where floor(k / 2) / k of its bytes lie below, along the dimension in which its points spread
widest. All nodes of a level are cut together: running totals over ranges of (node, coordinate) give every document the
bytes before it, so no task sees more than its range, however many documents share a value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import measured_lookup
from ..operators.timeline import running_total
from .common import stored

_NODE = ["first", "k"]
_GROUP = ["at", "text_md5"]


@dataclass(frozen=True)
class Sharding:
    """``shards``: how many; None for as many as ``target_bytes`` asks for. ``dimensions``: columns of the documents,
    besides ``size``. Documents with equal texts are cut apart only if together they have more than ``whole_percent``
    of a shard's bytes and the cut falls among them."""

    shards: int | None = None
    target_bytes: int = 256 << 20
    dimensions: tuple[str, ...] = ("source", "lang", "size")
    whole_percent: float = 1.0


def points(docs: DataFrame, how: Sharding = Sharding()) -> DataFrame:
    """``doc_id, size, text_crc32, text_md5`` and a rank ``r{i}`` from 0 for every dimension, one row per document.

    Size is the text's UTF-8 bytes plus 1. Equal texts have equal coordinates: those of the smallest values among them.
    Ranks count distinct values, null first; numbers rank as numbers, all else as text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    values = []
    for i, name in enumerate(how.dimensions):
        source = (F.octet_length(text) + 1).cast("long") if name == "size" else F.col(name)
        numeric = name == "size" or dict(docs.dtypes)[name] in ("tinyint", "smallint", "int", "bigint")
        # Numbers as text of equal length, offset so that negative ones come first.
        shown = F.lpad((source.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
        values.append((shown if numeric else source.cast("string")).alias(f"v{i}"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("text_md5"),
        *values,
    )
    rows = stored(rows, "shard-rows")
    names = [f"v{i}" for i in range(len(how.dimensions))]
    copies = rows.groupBy("text_md5").agg(F.count("*").alias("_n"), *[F.min(F.struct(v)).alias(f"_{v}") for v in names])
    copies = copies.filter("_n > 1").select("text_md5", *[f"_{v}" for v in names])
    rows = measured_lookup(rows, copies, ["text_md5"], ["doc_id"])
    alike = [F.when(F.col(f"_{v}").isNotNull(), F.col(f"_{v}.{v}")).otherwise(F.col(v)).alias(v) for v in names]
    rows = stored(rows.select("doc_id", "size", "text_crc32", "text_md5", *alike), "shard-values")

    def distinct(i: int) -> DataFrame:
        return rows.select(F.lit(i).alias("dim"), F.col(f"v{i}").alias("value")).distinct()

    every = reduce(DataFrame.unionByName, [distinct(i) for i in range(len(names))])
    ranged = every.repartitionByRange("dim", "value").withColumn("_bucket", F.spark_partition_id())
    cut = stored(ranged.withColumn("_one", F.lit(1).cast("long")), "shard-ranks")
    ranks = running_total(cut, ["dim"], ["value"], "_one", "rank")
    for i, v in enumerate(names):
        found = ranks.filter(F.col("dim") == i).select(
            F.coalesce("value", F.lit("")).alias(v), F.col("value").isNull().alias("_null"), (F.col("rank") - 1).alias(f"r{i}")
        )
        asked = rows.withColumns({"_null": F.col(v).isNull(), v: F.coalesce(v, F.lit(""))})
        rows = measured_lookup(asked, found, [v, "_null"], ["doc_id"]).drop(v, "_null")
    return stored(rows, "shard-points")


def _cut_level(rows: DataFrame, widest: DataFrame, how: Sharding, whole: float) -> DataFrame:
    """Rows of nodes with ``k > 1`` to rows of their halves."""
    dims = range(len(how.dimensions))
    seen = measured_lookup(rows, widest, _NODE, ["doc_id", "text_md5"], "inner")
    seen = seen.withColumn("at", F.coalesce(*[F.when(F.col("dim") == i, F.col(f"r{i}")) for i in dims]))
    order = [*_GROUP, "doc_id"]
    cut = stored(
        seen.repartitionByRange(*_NODE, *order).withColumn("_bucket", F.spark_partition_id()), "shard-ranges"
    )
    placed = stored(running_total(cut, _NODE, order, "size", "upto"), "shard-totals")
    # The document in which the wanted share of bytes ends, and the equal texts around it.
    hit = placed.filter("upto - size < wanted and upto >= wanted").select(
        *_NODE, *_GROUP, "wanted", "total", F.col("upto").alias("_upto"), (F.col("upto") - F.col("size")).alias("_from")
    )
    around = measured_lookup(
        placed.select(*_NODE, *_GROUP, "doc_id", "upto", "size"), hit, [*_NODE, *_GROUP], ["doc_id"], "inner"
    )
    around = around.groupBy(*_NODE, "wanted", "total", "_upto", "_from").agg(
        F.min(F.col("upto") - F.col("size")).alias("low"), F.max("upto").alias("high")
    )

    def nearer(low: str, high: str):
        return F.when(F.col("wanted") - F.col(low) <= F.col(high) - F.col("wanted"), F.col(low)).otherwise(F.col(high))

    apart = (F.col("high") - F.col("low") > whole) | ((F.col("low") == 0) & (F.col("high") == F.col("total")))
    limits = around.select(*_NODE, F.when(apart, nearer("_from", "_upto")).otherwise(nearer("low", "high")).alias("limit"))
    cut = measured_lookup(placed, limits, _NODE, ["doc_id", "text_md5"], "inner")
    below = F.col("upto") <= F.col("limit")
    half = F.floor(F.col("k") / 2).cast("int")
    return cut.select(
        "doc_id", "size", "text_crc32", "text_md5", *[f"r{i}" for i in dims],
        F.when(below, F.col("first")).otherwise(F.col("first") + half).alias("first"),
        F.when(below, half).otherwise(F.col("k") - half).alias("k"),
    )


def shard(docs: DataFrame, how: Sharding = Sharding()) -> DataFrame:
    """``doc_id, size, text_crc32, text_md5, shard, slot``: a row per row of ``docs``.

    Shards are numbered from 0 in the order of the tree's leaves, and ``slot`` counts a shard's documents from 0, equal
    texts side by side. Shards have about equal bytes: each cut misses its share by half a document or half a group of
    equal texts at most. Null texts are empty; null ids and null metadata are values of their own; a repeated row is a
    document of its own. A document larger than a shard's bytes fills one by itself, so that others may stay empty. An
    empty table gives no rows. Other columns are not read.
    """
    rows = points(docs, how)
    dims = range(len(how.dimensions))
    whole = rows.agg(F.sum("size").alias("total"), *[F.max(f"r{i}").alias(f"r{i}") for i in dims]).first()  # one row
    total = whole["total"] or 0
    k = how.shards or max(1, -(-total // how.target_bytes))
    rows = rows.withColumns({"first": F.lit(0), "k": F.lit(k)})
    done = []
    for _ in range((k - 1).bit_length()):
        stats = rows.filter("k > 1").groupBy(*_NODE).agg(
            F.sum("size").alias("total"),
            *[((F.max(f"r{i}") - F.min(f"r{i}")) / F.lit(float(whole[f"r{i}"] or 1))).alias(f"w{i}") for i in dims],
        )
        widths = [F.col(f"w{i}") for i in dims]
        most = F.greatest(*widths) if len(widths) > 1 else widths[0]
        widest = stats.select(
            *_NODE,
            "total",
            (F.col("total") * F.floor(F.col("k") / 2) / F.col("k")).alias("wanted"),
            F.coalesce(*[F.when(w == most, F.lit(i)) for i, w in enumerate(widths)]).alias("dim"),
        )
        done.append(rows.filter("k = 1"))
        rows = stored(_cut_level(rows.filter("k > 1"), widest, how, how.whole_percent / 100 * total / k), "shard-level")
    leaves = reduce(DataFrame.unionByName, [*done, rows]).withColumnRenamed("first", "shard")
    order = ["text_md5", "doc_id"]
    leaves = leaves.select("doc_id", "size", "text_crc32", "text_md5", "shard", F.lit(1).cast("long").alias("_one"))
    cut = leaves.repartitionByRange("shard", *order).withColumn("_bucket", F.spark_partition_id())
    numbered = running_total(stored(cut, "shard-slots"), ["shard"], order, "_one", "_upto")
    return numbered.select("doc_id", "size", "text_crc32", "text_md5", "shard", (F.col("_upto") - 1).alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents below ``path/shard=n``, all their columns kept; equal rows go to one shard."""
    where = placed.groupBy(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")).agg(F.min("shard").alias("_shard"))
    md5 = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = docs.join(where, docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (md5 == F.col("_md5")))
    found.select(*docs.columns, F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)
