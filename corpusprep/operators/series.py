"""Time-series queries over samples: label columns, a time and a value."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keyed import salted_lookup
from .timeline import MICROS, carry_last, cut, islands, trailing_sum, with_previous


def select_labels(df: DataFrame, equal: dict[str, str] | None = None, matching: dict[str, str] | None = None) -> DataFrame:
    """Rows whose labels equal the given texts and match the given patterns from end to end."""
    for label, value in (equal or {}).items():
        df = df.filter(F.col(label) == value)
    for label, pattern in (matching or {}).items():
        df = df.filter(F.col(label).rlike(f"^(?:{pattern})$"))
    return df


def newest_at(df: DataFrame, keys: list[str], ts: str, value: str, at: Column, lookback: int | None = None) -> DataFrame:
    """The newest sample of every series at a time, optionally not older than ``lookback`` seconds."""
    known = df.filter(F.col(ts) <= at)
    if lookback:
        known = known.filter(F.unix_micros(F.col(ts)) > F.unix_micros(at) - lookback * MICROS)
    return known.groupBy(*keys).agg(F.max(ts).alias(ts), F.max_by(value, ts).alias(value))


def in_range(df: DataFrame, keys: list[str], ts: str, start: Column, end: Column) -> DataFrame:
    return df.filter(F.col(ts).between(start, end)).orderBy(*keys, ts)


def counter_deltas(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Add ``delta``, the growth since the sample before; after a reset the new value is the growth."""
    rows = with_previous(cut(df, keys, [ts]), keys, [ts], {"_previous": value})
    grown = F.col(value) - F.col("_previous")
    delta = F.when(grown < 0, F.col(value)).otherwise(grown)
    none = F.lit(0).cast(df.schema[value].dataType)
    return rows.withColumn("delta", F.coalesce(delta, none)).drop("_previous", "_bucket")


def counter_rate(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int) -> DataFrame:
    """Add ``per_second``: growth over the trailing window divided by its length."""
    summed = trailing_sum(counter_deltas(df, keys, ts, value), keys, ts, "delta", seconds, "_growth")
    return summed.withColumn("per_second", F.col("_growth") / F.lit(seconds)).drop("_growth", "delta")


def trailing_increase(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, out: str = "increase") -> DataFrame:
    """Add the growth over the trailing window of every sample."""
    return trailing_sum(counter_deltas(df, keys, ts, value), keys, ts, "delta", seconds, out).drop("delta")


def rate_ratio(
    df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, by: list[str], part: Column, out: str = "ratio"
) -> DataFrame:
    """Summed windowed rate of some series over that of all, per time and the labels ``by``.

    Both sums belong to equal labels, so one aggregation gives them; null where nothing grew or no series is in part.
    """
    grown = trailing_increase(df, keys, ts, value, seconds, "_growth")
    sums = grown.groupBy(*by, ts).agg(F.sum(F.when(part, F.col("_growth"))).alias("_part"), F.sum("_growth").alias("_whole"))
    per_second = [F.col(c) / F.lit(seconds) for c in ("_part", "_whole")]
    return sums.select(*by, ts, ratio(*per_second).alias(out))


def counter_increase(df: DataFrame, keys: list[str], ts: str, value: str, unit: str = "day") -> DataFrame:
    """Growth per calendar unit and series."""
    deltas = counter_deltas(df, keys, ts, value)
    return deltas.groupBy(*keys, F.date_trunc(unit, F.col(ts)).alias(unit)).agg(F.sum("delta").alias("increase"))


def last_over_time(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, out: str = "last") -> DataFrame:
    """Add the newest value that is not null, if its sample lies in the trailing window."""
    stamped = F.when(F.col(value).isNotNull(), F.struct(F.unix_micros(ts).alias("at"), F.col(value).alias("value")))
    rows = cut(df.withColumn("_stamped", stamped), keys, [ts])
    carried = carry_last(rows, keys, [ts], "_stamped", "_newest")
    fresh = F.col("_newest.at") > F.unix_micros(ts) - seconds * MICROS
    return carried.withColumn(out, F.when(fresh, F.col("_newest.value"))).select(*df.columns, out)


def silences(
    df: DataFrame, keys: list[str], order: list[str], ts: str, seconds: int, until: Column | None = None
) -> DataFrame:
    """Gaps longer than ``seconds`` between neighbouring samples of a series.

    ``until`` also reports series that have been silent since their last sample.
    """
    narrow = df.select(*dict.fromkeys([*keys, *order, ts]))
    rows = with_previous(cut(narrow, keys, order), keys, order, {"gap_start": ts})
    gaps = rows.select(*keys, "gap_start", F.col(ts).alias("gap_end"))
    if until is not None:
        ends = df.groupBy(*keys).agg(F.max(ts).alias("gap_start")).withColumn("gap_end", until)
        gaps = gaps.unionByName(ends)
    length = (F.unix_micros("gap_end") - F.unix_micros("gap_start")).alias("gap_micros")
    return gaps.select("*", length).filter(F.col("gap_micros") > seconds * MICROS)


def state_spans(df: DataFrame, keys: list[str], order: list[str], ts: str, state: str) -> DataFrame:
    """Equal consecutive states merged into one span with its first and last time and number of samples."""
    narrow = df.select(*dict.fromkeys([*keys, *order, ts, state]))
    starts = ~F.col("_state").eqNullSafe(F.col(state)) | F.col("_ts").isNull()
    runs = islands(cut(narrow, keys, order), keys, order, starts, {"_state": state, "_ts": ts})
    return runs.groupBy(*keys, "island", state).agg(
        F.min(ts).alias("span_start"), F.max(ts).alias("span_end"), F.count("*").alias("n_samples")
    )


def quiet_batches(df: DataFrame, keys: list[str], order: list[str], ts: str, quiet_seconds: int) -> DataFrame:
    """Arrivals grouped into batches that end when nothing arrives for ``quiet_seconds``."""
    narrow = df.select(*dict.fromkeys([*keys, *order, ts]))
    gap = F.unix_micros(ts) - F.unix_micros("_ts")
    runs = islands(cut(narrow, keys, order), keys, order, gap >= quiet_seconds * MICROS, {"_ts": ts})
    return runs.groupBy(*keys, "island").agg(
        F.min(ts).alias("first_arrival"), F.max(ts).alias("last_arrival"), F.count("*").alias("n_objects")
    )


def reduce_series(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Last value that is not null, mean and sum of every series; sums run in decimals, so they do not drift."""
    exact = F.sum(F.col(value).cast("decimal(18,6)")).cast("double")
    return df.groupBy(*keys).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ts))).alias("last_not_null"),
        (exact / F.count(value)).alias("mean"),
        exact.alias("total"),
    )


def percent_change(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Change from the first to the last sample of a series in percent; null when the first is zero."""
    present = F.when(F.col(value).isNotNull(), F.col(ts))
    ends = df.groupBy(*keys).agg(
        F.min_by(value, present).alias("first_value"), F.max_by(value, present).alias("last_value")
    )
    grown = F.lit(100.0) * (F.col("last_value") - F.col("first_value"))
    return ends.withColumn("percent_change", F.when(F.col("first_value") != 0, grown / F.col("first_value")))


def distinct_series(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many series there are: a count of a count, so a hot series is one row before the final count."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.count("*").alias("n_series"), F.sum("_n").alias("n_samples")
    )


def label_values(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).select(label).distinct().orderBy(label)


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """Division of two sums, null where the whole is zero."""
    return F.when(whole != 0, F.lit(scale) * part / whole)


def wide_by_name(rows: DataFrame, name: str, metric: str, value: str, metrics: list[str]) -> DataFrame:
    """Metric tables joined by name into one row per name; metrics are fixed, so no pass is spent finding them."""
    return rows.groupBy(name).pivot(metric, metrics).agg(F.max(value))


def rename_by_regex(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    return df.toDF(*[re.sub(pattern, replacement, c) for c in df.columns])


def arrange(df: DataFrame, order: list[str], names: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Chosen columns first and in order, the rest after them, with new names and without the dropped ones."""
    names = names or {}
    rest = [c for c in df.columns if c not in order and c not in drop]
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in [*order, *rest]])


def map_values(value: Column, texts: dict[str, str], null_text: str) -> Column:
    """Display texts for values; values without a text stay as they are."""
    shown = F.when(value.isNull(), null_text)
    for key, shown_as in texts.items():
        shown = shown.when(value == key, shown_as)
    return shown.otherwise(value)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: list[float], accuracy: int = 10_000
) -> DataFrame:
    """``keys, quantile, value``: the smallest value with at least ``quantile`` of a series at or below it.

    A sketch of bounded size brackets every quantile first. Only values inside a bracket, a few ``1 / accuracy`` of
    the series, are counted one by one; everything below is a single number. So no series is sorted in one task.
    """
    step = 2.0 / accuracy
    probes = [p for q in quantiles for p in (max(q - step, 0.0), min(q + step, 1.0))]
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    bounds = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.percentile_approx(value, probes, accuracy).alias("_p"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.count("*").alias("_total"),
    )

    def bracket(i: int, q: float) -> Column:
        low = F.when(F.lit(q - step <= 0), F.col("_min")).otherwise(F.col("_p")[2 * i])
        high = F.when(F.lit(q + step >= 1), F.col("_max")).otherwise(F.col("_p")[2 * i + 1])
        rank = F.greatest(F.ceil(F.lit(q) * F.col("_total")), F.lit(1))
        return F.struct(
            F.lit(q).alias("quantile"), low.alias("low"), high.alias("high"), rank.cast("long").alias("rank")
        )

    brackets = bounds.select(*keys, F.array(*[bracket(i, q) for i, q in enumerate(quantiles)]).alias("_brackets"))
    placed = salted_lookup(counted, brackets, keys, [value], "inner")
    per_bracket = placed.select(*keys, F.col(value).alias("_v"), "_n", F.explode("_brackets").alias("_b"))
    near = F.when(F.col("_v") >= F.col("_b.low"), F.col("_v"))
    # Values below the bracket collapse into the null group before the shuffle.
    grouped = (
        per_bracket.filter(F.col("_v") <= F.col("_b.high"))
        .groupBy(*keys, F.col("_b.quantile").alias("quantile"), F.col("_b.rank").alias("_rank"), near.alias(value))
        .agg(F.sum("_n").alias("_n"))
    )
    upto = (
        Window.partitionBy(*keys, "quantile")
        .orderBy(F.col(value).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = grouped.withColumn("_upto", F.sum("_n").over(upto)).filter("_upto >= _rank")
    return reached.groupBy(*keys, "quantile").agg(F.min(value).alias(value))
