"""Ordered computations per series that never sort a whole series in one task.

A plain window over a series puts the series, however long, into one task. Here :func:`cut` first splits all rows into
ranges of (series, order) of about equal size; the range number is the row's bucket. Each bucket of a series is one
window partition, and what it needs from earlier rows comes from a small table with one row per series and bucket. A
hot series, or a burst within one second, is spread over as many buckets as its rows fill.

All frames used are "everything before" or "the row before", which Spark updates row by row; sliding frames would be
summed anew for every row. ``order`` has to be unique inside a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

HOUR = 3600
DAY = 24 * HOUR
MICROS = 1_000_000


def cut(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``_bucket``, which never falls as the order rises inside a series.

    Range boundaries come from a sample and could differ when computed twice, so the result is stored.
    """
    ranged = df.repartitionByRange(*keys, *order)
    return materialize(ranged.withColumn("_bucket", F.spark_partition_id()))


def _inside(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "_bucket").orderBy(*order)


def _across(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_bucket")


def with_previous(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """Add for every ``new: column`` in ``values`` the column's value in the row before (null in the first row)."""
    now = rows.withColumn("_now", F.struct(*[F.col(column).alias(new) for new, column in values.items()]))
    last = now.groupBy(*keys, "_bucket").agg(F.max_by("_now", F.struct(*order)).alias("_last"))
    carried = last.select(*keys, "_bucket", F.lag("_last").over(_across(keys)).alias("_carried"))
    joined = now.join(carried, [*keys, "_bucket"])
    before = F.coalesce(F.lag("_now").over(_inside(keys, order)), F.col("_carried"))
    return joined.withColumn("_before", before).select(
        *rows.columns, *[F.col(f"_before.{new}").alias(new) for new in values]
    )


def running_total(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including the current one."""
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_sum"))
    earlier = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    upto = _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(offsets, [*keys, "_bucket"])
    return joined.withColumn(out, F.sum(value).over(upto) + F.col("_offset")).select(*rows.columns, out)


def carry_last(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add the newest ``value`` that is not null among all rows up to and including the current one."""
    present = F.when(F.col(value).isNotNull(), F.struct(*order))
    last = rows.groupBy(*keys, "_bucket").agg(F.max_by(value, present).alias("_last"))
    earlier = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    upto = _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    newest = F.coalesce(F.last(value, ignorenulls=True).over(upto), F.col("_carried"))
    return rows.join(carried, [*keys, "_bucket"]).withColumn(out, newest).select(*rows.columns, out)


def trailing_sum(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, out: str) -> DataFrame:
    """Add the sum of ``value`` over the samples with time in (t - seconds, t] for every sample.

    Time is cut into blocks as long as the window, so a window is the end of one block and the beginning of the next: the
    sum of its block up to t, and of the block before from behind t - seconds on. Both are running totals inside a block,
    one forwards and one backwards. Nothing is subtracted: a NaN or a huge value affects the windows it lies in and no
    other. Sums of a decimal column are exact. One sample per series and time is assumed; null values add nothing.
    """
    window = seconds * MICROS
    zero = F.lit(0).cast(df.schema[value].dataType)
    rows = df.withColumns({"_at": F.unix_micros(ts), "_add": F.coalesce(value, zero)})
    rows = rows.withColumn("_block", F.floor(F.col("_at") / window))
    forwards = [*keys, "_block"]
    upto = running_total(cut(rows, forwards, ["_at"]), forwards, ["_at"], "_add", "_upto").drop("_bucket")
    # Backwards, each sample also asks for the end of the block before; at equal times the question comes first, as the
    # sample at t - seconds is outside.
    roles = F.array(
        F.struct((-F.col("_at")).alias("back"), F.col("_block").alias("block"), F.lit(1).alias("adds"), F.col("_add").alias("add")),
        F.struct((window - F.col("_at")).alias("back"), (F.col("_block") - 1).alias("block"), F.lit(0).alias("adds"), zero.alias("add")),
    )
    both = upto.withColumn("_role", F.explode(roles)).select(
        *df.columns, "_upto", *[F.col(f"_role.{c}").alias(f"_{c}") for c in ("back", "block", "adds", "add")]
    )
    order = ["_back", "_adds"]
    behind = running_total(cut(both, forwards, order), forwards, order, "_add", "_behind").filter("_adds = 0")
    return behind.withColumn(out, F.col("_upto") + F.col("_behind")).select(*df.columns, out)


def islands(rows: DataFrame, keys: list[str], order: list[str], starts_new: Column, previous: dict[str, str]) -> DataFrame:
    """Add ``island``, the number of the run a row belongs to; ``starts_new`` may read the ``previous`` columns."""
    marked = with_previous(rows, keys, order, previous)
    marked = marked.withColumn("_starts", F.coalesce(starts_new, F.lit(True)).cast("long"))
    return running_total(marked, keys, order, "_starts", "island").drop("_starts")
