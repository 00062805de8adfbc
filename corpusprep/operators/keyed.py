"""Keyed building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 16
BROADCAST_ROWS = 200_000


def mark_first(
    df: DataFrame, keys: list[str], scope: list[str], order: str, flag: str = "is_first", eligible: Column | None = None
) -> DataFrame:
    """Flag the row with the smallest ``order`` of every key; ``scope + order`` identifies a row.

    A window over the key would sort all copies of a hot key in one task. Here the key is only aggregated (copies
    collapse before the shuffle), and the winners come back through the row's own identity, which is unique and
    therefore evenly spread. Keys that are null never win; rows outside ``eligible`` neither win nor block others.
    """
    # A condition inside the aggregate, not a filter before it: a filter on derived columns would be pushed below
    # their projections and evaluate long text expressions a second time.
    candidate = F.col(order) if eligible is None else F.when(eligible, F.col(order))
    winners = (
        df.groupBy(*scope, *[k for k in keys if k not in scope])
        .agg(F.min(candidate).alias(order))
        .select(*scope, order, F.lit(True).alias(flag))
    )
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return df.join(winners, [*scope, order], "left").withColumn(flag, F.coalesce(flag, F.lit(False)) & present)


def salted_lookup(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join to a side with one row per key, spreading every left key over ``salts`` tasks.

    ``spread_by`` are columns that differ between rows of one key. The right side is repeated ``salts`` times.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def measured_lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Lookup into a side whose size is counted first: broadcast below the bound, salted join above it.

    The right side is stored once, so that counting it does not compute it twice.
    """
    right = materialize(right)
    if right.count() <= max_rows:
        return left.join(F.broadcast(right), on, how)
    return salted_lookup(left, right, on, spread_by, how)


def outer_merge(tables: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of tables with one row per key, as one union and one aggregation.

    A chain of full outer joins would shuffle once per table; here all tables share a single shuffle.
    """
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    values = [c for c in merged.columns if c not in on]
    return merged.groupBy(*on).agg(*[F.max(c).alias(c) for c in values])
