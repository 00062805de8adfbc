"""Time-series queries over samples derived from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import series
from ..operators.keyed import outer_merge
from ..operators.metric_rules import rewrite_names
from ..operators.timeline import DAY, HOUR
from ..streaming import windows
from .registry import Tables, query

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SQL_STAMP = "%Y-%m-%dT%H:%M:%S.%f"


def stamp(column: str):
    return F.date_format(column, STAMP)


def hourly(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total")
    )


def counters(t: Tables) -> DataFrame:
    """A counter per event type, one sample per hour; it starts again from zero every day."""
    day = Window.partitionBy("event_type", F.date_trunc("day", "ts")).orderBy("ts")
    total = F.sum("n").over(day.rowsBetween(Window.unboundedPreceding, 0))
    return hourly(t).select("event_type", "ts", total.cast("double").alias("value"))


SQL_COUNTERS = """
    hourly AS (
      SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n, sum(value::DECIMAL(12,2))::DOUBLE AS total
      FROM events GROUP BY ALL),
    counters AS (
      SELECT event_type, ts,
             (sum(n) OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts))::DOUBLE AS value
      FROM hourly),
    lagged AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS previous FROM counters),
    deltas AS (
      SELECT event_type, ts, value,
             CASE WHEN previous IS NULL THEN 0 WHEN value < previous THEN value ELSE value - previous END AS delta
      FROM lagged)"""


@query(
    "counter_rate",
    f"""
    WITH {SQL_COUNTERS}
    SELECT event_type, strftime(ts, '{SQL_STAMP}') AS ts, value,
           sum(delta) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL '10799999999 microseconds'
                            PRECEDING AND CURRENT ROW) / 10800 * 60 AS per_minute
    FROM deltas
    """,
)
def counter_rate(t: Tables) -> DataFrame:
    rates = series.counter_rate(counters(t), ["event_type"], "ts", "value", 3 * HOUR)
    return rates.select("event_type", stamp("ts").alias("ts"), "value", (F.col("per_second") * 60).alias("per_minute"))


@query(
    "increase_1d",
    f"""
    WITH {SQL_COUNTERS}
    SELECT event_type, strftime(ts, '{SQL_STAMP}') AS ts,
           (sum(delta) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL '86399999999 microseconds'
                             PRECEDING AND CURRENT ROW))::DOUBLE AS increase
    FROM deltas
    """,
)
def increase_1d(t: Tables) -> DataFrame:
    """Growth over the day before every sample."""
    grown = series.trailing_increase(counters(t), ["event_type"], "ts", "value", 24 * HOUR)
    return grown.select("event_type", stamp("ts").alias("ts"), "increase")


@query(
    "rate_ratio",
    f"""
    WITH {SQL_COUNTERS},
    grown AS (
      SELECT event_type, ts, sum(delta) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN
        INTERVAL '10799999999 microseconds' PRECEDING AND CURRENT ROW) AS growth FROM deltas),
    sums AS (
      SELECT ts, sum(growth) FILTER (event_type IN ('error', 'view')) / 10800::DOUBLE AS part, sum(growth) / 10800::DOUBLE AS whole
      FROM grown GROUP BY ts)
    SELECT strftime(ts, '{SQL_STAMP}') AS ts, CASE WHEN whole <> 0 THEN part / whole END AS ratio FROM sums
    """,
)
def rate_ratio(t: Tables) -> DataFrame:
    """Share of errors and views in the rate of all events over three hours."""
    part = F.col("event_type").isin("error", "view")
    ratios = series.rate_ratio(counters(t), ["event_type"], "ts", "value", 3 * HOUR, [], part)
    return ratios.select(stamp("ts").alias("ts"), "ratio")


@query(
    "counter_increase",
    f"""
    WITH {SQL_COUNTERS}
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, sum(delta)::DOUBLE AS increase FROM deltas GROUP BY ALL
    """,
)
def counter_increase(t: Tables) -> DataFrame:
    grown = series.counter_increase(counters(t), ["event_type"], "ts", "value")
    return grown.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "increase")


@query(
    "last_over_time",
    f"""
    SELECT event_type, strftime(ts, '{SQL_STAMP}') AS ts,
           last_value(kept IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN
             INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW) AS last_value
    FROM (SELECT event_type, ts, CASE WHEN value > 100 THEN value END AS kept FROM events)
    """,
)
def last_over_time(t: Tables) -> DataFrame:
    """Only values above 100 count as present, so many windows hold none."""
    kept = t.events.select("event_type", "ts", F.when(F.col("value") > 100, F.col("value")).alias("value"))
    last = series.last_over_time(kept, ["event_type"], "ts", "value", DAY, "last_value")
    return last.select("event_type", stamp("ts").alias("ts"), "last_value")


@query(
    "heartbeat_gaps",
    f"""
    SELECT event_type, strftime(previous, '{SQL_STAMP}') AS gap_start, strftime(ts, '{SQL_STAMP}') AS gap_end,
           epoch_us(ts) - epoch_us(previous) AS gap_micros
    FROM (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events
          UNION ALL SELECT event_type, TIMESTAMP '2024-01-31 12:00:00', max(ts) FROM events GROUP BY event_type)
    WHERE epoch_us(ts) - epoch_us(previous) > 3600000000
    """,
)
def heartbeat_gaps(t: Tables) -> DataFrame:
    until = F.lit("2024-01-31 12:00:00").cast("timestamp")
    gaps = series.silences(t.events, ["event_type"], ["ts", "event_id"], "ts", HOUR, until=until)
    return gaps.select("event_type", stamp("gap_start").alias("gap_start"), stamp("gap_end").alias("gap_end"), "gap_micros")


@query(
    "state_spans",
    f"""
    WITH marked AS (
      SELECT user_id, event_type, ts, event_id,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type AS starts
      FROM events),
    numbered AS (
      SELECT *, sum(starts::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                       ROWS UNBOUNDED PRECEDING)::BIGINT AS island
      FROM marked)
    SELECT user_id, island, event_type AS state, strftime(min(ts), '{SQL_STAMP}') AS span_start,
           strftime(max(ts), '{SQL_STAMP}') AS span_end, count(*) AS n_samples
    FROM numbered GROUP BY user_id, island, event_type
    """,
)
def state_spans(t: Tables) -> DataFrame:
    spans = series.state_spans(t.events, ["user_id"], ["ts", "event_id"], "ts", "event_type")
    return spans.select(
        "user_id",
        "island",
        F.col("event_type").alias("state"),
        stamp("span_start").alias("span_start"),
        stamp("span_end").alias("span_end"),
        "n_samples",
    )


@query(
    "stable_batches",
    f"""
    WITH marked AS (
      SELECT event_type, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 900000000, TRUE) AS starts
      FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    numbered AS (
      SELECT *, sum(starts::INT) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
      FROM marked)
    SELECT event_type, strftime(min(ts), '{SQL_STAMP}') AS first_arrival, strftime(max(ts), '{SQL_STAMP}') AS last_arrival,
           count(*) AS n_objects
    FROM numbered GROUP BY event_type, island
    """,
)
def stable_batches(t: Tables) -> DataFrame:
    """Arrivals of one kind form a batch until nothing comes for a quarter of an hour."""
    batches = series.quiet_batches(t.events, ["event_type"], ["ts", "event_id"], "ts", 900)
    return batches.select(
        "event_type",
        stamp("first_arrival").alias("first_arrival"),
        stamp("last_arrival").alias("last_arrival"),
        "n_objects",
    )


@query(
    "instant_select",
    f"""
    SELECT user_id, strftime(max(ts), '{SQL_STAMP}') AS ts, arg_max(value, ts) AS value
    FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY user_id
    """,
)
def instant_select(t: Tables) -> DataFrame:
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    newest = series.newest_at(t.events, ["user_id"], "ts", "value", at)
    return newest.select("user_id", stamp("ts").alias("ts"), "value")


@query(
    "range_select",
    f"""
    SELECT event_type, strftime(ts, '{SQL_STAMP}') AS ts, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'
    """,
)
def range_select(t: Tables) -> DataFrame:
    start, end = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp") for d in (10, 12))
    return series.in_range(t.events, ["event_type"], "ts", start, end).select(
        "event_type", stamp("ts").alias("ts"), "value"
    )


STATUS = {"click": "success", "error": "failed", "view": "running", "signup": "queued"}
# Display texts of run states.
STATUS_TEXTS = {"failed": "Failed", "queued": "Queued", "running": "Running", "success": "Success"}
NO_STATUS = "No Status"


def run_states(t: Tables) -> DataFrame:
    """Event types as run states (a purchase has none), the user as the workflow."""
    status = F.lit(None).cast("string")
    for event, state in STATUS.items():
        status = F.when(F.col("event_type") == event, state).otherwise(status)
    return t.events.select(F.col("user_id").cast("string").alias("dag_id"), status.alias("status"), "ts", "value")


@query(
    "latest_status",
    """
    SELECT dag_id, coalesce(status, 'No Status') AS status FROM (
      SELECT user_id::VARCHAR AS dag_id, CASE event_type WHEN 'click' THEN 'Success' WHEN 'error' THEN 'Failed'
             WHEN 'view' THEN 'Running' WHEN 'signup' THEN 'Queued' END AS status, max((value > 60)::INT) AS flag
      FROM events WHERE regexp_full_match(user_id::VARCHAR, '1[0-9]*|2.') GROUP BY ALL)
    WHERE flag = 1
    """,
)
def latest_status(t: Tables) -> DataFrame:
    """max by (dag_id, status) of a 0/1 gauge, kept where it is 1, shown as text."""
    rows = series.select_labels(run_states(t), matching={"dag_id": "1[0-9]*|2."})
    flag = F.max(F.when(F.col("value") > 60, 1).otherwise(0))
    on = rows.groupBy("dag_id", "status").agg(flag.alias("flag")).filter("flag = 1")
    return on.select("dag_id", series.map_values(F.col("status"), STATUS_TEXTS, NO_STATUS).alias("status"))


@query(
    "run_summary",
    """
    SELECT user_id::VARCHAR AS dag_id, max(value) AS top_value, count(*) FILTER (event_type = 'click') AS total_success,
           count(*) FILTER (event_type = 'error') AS total_failed,
           arg_max(value, ts) FILTER (ts > TIMESTAMP '2024-01-30 00:00:00') AS last_duration
    FROM events GROUP BY user_id
    """,
)
def run_summary(t: Tables) -> DataFrame:
    """Four result tables merged on the workflow, renamed and put in order."""
    rows = run_states(t)
    at = F.lit("2024-01-31 00:00:00").cast("timestamp")
    listed = rows.groupBy("dag_id").agg(F.max("value").alias("Value #LIST"))
    good = rows.groupBy("dag_id").agg(F.count_if(F.col("status") == "success").alias("Value #TOTAL_SUCCESS"))
    bad = rows.groupBy("dag_id").agg(F.count_if(F.col("status") == "failed").alias("Value #TOTAL_FAILED"))
    last = series.newest_at(rows, ["dag_id"], "ts", "value", at, lookback=DAY)
    tables = [listed, good, bad, last.select("dag_id", F.col("value").alias("Value #Duration"))]
    tables = [series.rename_by_regex(table, r"^Value #([A-Z_]+)$", r"\1") for table in tables]
    merged = outer_merge(tables, ["dag_id"])
    names = {
        "LIST": "top_value",
        "TOTAL_SUCCESS": "total_success",
        "TOTAL_FAILED": "total_failed",
        "Value #Duration": "last_duration",
    }
    filled = merged.fillna(0, ["TOTAL_SUCCESS", "TOTAL_FAILED"])
    return series.arrange(filled, ["dag_id", "LIST", "TOTAL_SUCCESS", "TOTAL_FAILED"], names)


@query(
    "latency_avg",
    f"""
    WITH {SQL_COUNTERS}
    SELECT event_type, strftime(ts, '%Y-%m-%dT%H') AS hour, total / n AS seconds FROM hourly
    """,
)
def latency_avg(t: Tables) -> DataFrame:
    """Growth of the sum over growth of the count, per label and hour: both from one aggregation."""
    seconds = series.ratio(F.col("total"), F.col("n"))
    return hourly(t).select("event_type", F.date_format("ts", "yyyy-MM-dd'T'HH").alias("hour"), seconds.alias("seconds"))


@query(
    "success_rate",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'click') AS n_success,
           CASE WHEN count(*) FILTER (event_type IN ('click', 'error')) > 0 THEN
             100.0::DOUBLE * count(*) FILTER (event_type = 'click') / count(*) FILTER (event_type IN ('click', 'error')) END
           AS success_percent
    FROM events GROUP BY ALL
    """,
)
def success_rate(t: Tables) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    counts = run_states(t).groupBy(day).agg(
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status").isin("success", "failed")).alias("_ended"),
    )
    percent = series.ratio(F.col("n_success"), F.col("_ended"), 100.0)
    return counts.select("day", "n_success", percent.alias("success_percent"))


@query(
    "series_count",
    "SELECT count(*) AS n_series, sum(n)::BIGINT AS n_samples FROM (SELECT user_id, count(*) AS n FROM events GROUP BY ALL)",
)
def series_count(t: Tables) -> DataFrame:
    return series.distinct_series(t.events, ["user_id"])


@query(
    "series_reduce",
    """
    SELECT user_id, arg_max(v, ts) FILTER (v IS NOT NULL) AS last_not_null, sum(v::DECIMAL(18,6))::DOUBLE / count(v) AS mean,
           sum(v::DECIMAL(18,6))::DOUBLE AS total
    FROM (SELECT user_id, ts, CASE WHEN event_type <> 'view' THEN value END AS v FROM events) GROUP BY user_id
    """,
)
def series_reduce(t: Tables) -> DataFrame:
    shown = F.when(F.col("event_type") != "view", F.col("value"))
    return series.reduce_series(t.events.select("user_id", "ts", shown.alias("value")), ["user_id"], "ts", "value")


@query("label_values", "SELECT DISTINCT props->>'k' AS k FROM events WHERE props->>'k' IS NOT NULL")
def label_values(t: Tables) -> DataFrame:
    return series.label_values(t.events.select(F.get_json_object("props", "$.k").alias("k")), "k")


@query(
    "percent_change",
    """
    SELECT user_id, arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value,
           CASE WHEN arg_min(value, ts) <> 0 THEN
             100.0::DOUBLE * (arg_max(value, ts) - arg_min(value, ts)) / arg_min(value, ts) END AS percent_change
    FROM events GROUP BY user_id
    """,
)
def percent_change(t: Tables) -> DataFrame:
    return series.percent_change(t.events, ["user_id"], "ts", "value")


@query(
    "timer_quantiles",
    """
    WITH ranked AS (
      SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn,
             count(*) OVER (PARTITION BY event_type) AS n FROM events),
    wanted AS (SELECT unnest([0.5::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS quantile)
    SELECT event_type, quantile, value FROM ranked, wanted WHERE rn = greatest(ceil(quantile * n), 1)
    """,
)
def timer_quantiles(t: Tables) -> DataFrame:
    return series.exact_quantiles(t.events, ["event_type"], "value", [0.5, 0.9, 0.99])


METRICS = ["n_events", "n_users", "top_value", "low_value", "n_small", "n_large", "n_errors"]


@query(
    "metric_wide",
    """
    SELECT 'user ' || user_id AS name, count(*)::DOUBLE AS n_events, count(DISTINCT event_type)::DOUBLE AS n_users,
           max(value) AS top_value, min(value) AS low_value, nullif(count(*) FILTER (value < 5), 0)::DOUBLE AS n_small,
           nullif(count(*) FILTER (value > 50), 0)::DOUBLE AS n_large,
           nullif(count(*) FILTER (event_type = 'error'), 0)::DOUBLE AS n_errors
    FROM events GROUP BY user_id
    """,
)
def metric_wide(t: Tables) -> DataFrame:
    """Seven metric tables in long form, joined by name; a metric without samples stays empty for that name."""
    name = F.concat(F.lit("user "), F.col("user_id").cast("string"))

    kinds = t.events.groupBy(name.alias("name"), "event_type").agg(
        F.count("*").alias("n"),
        F.max("value").alias("top"),
        F.min("value").alias("low"),
        F.count_if(F.col("value") < 5).alias("small"),
        F.count_if(F.col("value") > 50).alias("large"),
    )
    values = kinds.groupBy("name").agg(
        F.sum("n").cast("double").alias("n_events"),
        F.count("*").cast("double").alias("n_users"),
        F.max("top").alias("top_value"),
        F.min("low").alias("low_value"),
        F.nullif(F.sum("small"), F.lit(0)).cast("double").alias("n_small"),
        F.nullif(F.sum("large"), F.lit(0)).cast("double").alias("n_large"),
        F.nullif(F.sum(F.when(F.col("event_type") == "error", F.col("n")).otherwise(0)), F.lit(0))
        .cast("double")
        .alias("n_errors"),
    )
    long = values.unpivot(["name"], METRICS, "metric", "value").filter("value IS NOT NULL")
    return series.wide_by_name(long, "name", "metric", "value", METRICS)


@query(
    "metric_rules",
    """
    WITH names AS (
      SELECT CASE event_type
               WHEN 'click' THEN 'af.ti.finish.dag' || user_id || '.load.success'
               WHEN 'view' THEN 'af.pool.open_slots.pool' || user_id
               WHEN 'purchase' THEN 'af.dag.dag' || user_id || '.extract.duration'
               WHEN 'signup' THEN 'af.eu.operator_successes_Op' || user_id
               ELSE 'af.unknown.user' || user_id END AS name,
             CASE WHEN event_type = 'view' THEN 'gauge' WHEN event_type = 'purchase' THEN 'observer' ELSE 'counter' END
               AS kind, event_type, user_id
      FROM events)
    SELECT name, kind, count(*) AS n_samples,
           CASE event_type WHEN 'click' THEN 18 WHEN 'view' THEN 30 WHEN 'purchase' THEN 40 WHEN 'signup' THEN 4 END
             AS rule_no,
           CASE event_type WHEN 'click' THEN 'af_agg_ti_finish' WHEN 'view' THEN 'af_agg_pool_open_slots'
             WHEN 'purchase' THEN 'af_agg_dag_task_duration' WHEN 'signup' THEN 'af_agg_operator_successes' END AS metric,
           CASE event_type WHEN 'signup' THEN 'af.eu' WHEN 'error' THEN NULL ELSE 'af' END AS airflow_id,
           CASE WHEN event_type IN ('click', 'purchase') THEN 'dag' || user_id END AS dag_id
    FROM names GROUP BY ALL
    """,
)
def metric_rules(t: Tables) -> DataFrame:
    """Metric names built from events, rewritten once per distinct name."""
    user = F.col("user_id").cast("string")
    name = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("af.ti.finish.dag"), user, F.lit(".load.success")))
        .when(F.col("event_type") == "view", F.concat(F.lit("af.pool.open_slots.pool"), user))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("af.dag.dag"), user, F.lit(".extract.duration")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("af.eu.operator_successes_Op"), user))
        .otherwise(F.concat(F.lit("af.unknown.user"), user))
    )
    kind = F.when(F.col("event_type") == "view", "gauge").when(F.col("event_type") == "purchase", "observer")
    names = t.events.groupBy(name.alias("name"), kind.otherwise("counter").alias("kind")).agg(
        F.count("*").alias("n_samples")
    )
    labels = F.col("labels")
    return rewrite_names(names).select(
        "name", "kind", "n_samples", "rule_no", "metric", labels["airflow_id"].alias("airflow_id"), labels["dag_id"].alias("dag_id")
    )


@query(
    "daily_counts",
    """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_events FROM events GROUP BY ALL
    """,
)
def daily_counts(t: Tables) -> DataFrame:
    counts = windows.daily_counts(t.events, "ts", ["event_type"], "n_events")
    return counts.select("event_type", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_events")


@query(
    "sliding_rate",
    f"""
    SELECT event_type, strftime(make_timestamp((s - k * 15) * 1000000), '{SQL_STAMP}') AS window_start,
           count(*) AS n_events, count(*) / 60::DOUBLE AS per_second
    FROM (SELECT event_type, (floor(epoch(ts) / 15) * 15)::BIGINT AS s FROM events), (SELECT unnest([0, 1, 2, 3]) AS k)
    GROUP BY ALL
    """,
)
def sliding_rate(t: Tables) -> DataFrame:
    rates = windows.sliding_rate(t.events, "ts", ["event_type"], 60, 15)
    return rates.select("event_type", stamp("window_start").alias("window_start"), "n_events", "per_second")
