"""Time-series operators against brute force in plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import series, timeline


@pytest.fixture(scope="module", autouse=True)
def many_buckets(spark):
    """Small data would be coalesced into one bucket; here every range keeps its own."""
    names = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "7")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def frame(spark, rows, schema="k string, ts timestamp, value double"):
    return spark.createDataFrame([(k, at(s), v) for k, s, v in rows], schema)


@pytest.fixture(scope="module")
def hot(spark):
    """One series with most samples, a burst within two seconds, gaps and nulls; a few small ones."""
    rng = random.Random(7)
    rows, seconds = [], 0.0
    for i in range(1500):
        seconds += 0.001 if 500 < i < 900 else rng.choice([1, 5, 40, 400])
        rows.append(("hot", round(seconds, 3), rng.choice([None, float(rng.randint(0, 50))])))
    rows += [(k, s * 100.0, float(s)) for k in "abc" for s in range(20)] + [("one", 5.0, 3.0)]
    return rows


def grouped(rows):
    found = {}
    for k, s, v in sorted(rows, key=lambda r: (r[0], r[1])):
        found.setdefault(k, []).append((s, v))
    return found


def test_cut_spreads_a_hot_series(spark, hot):
    rows = timeline.cut(frame(spark, hot), ["k"], ["ts"])
    per_bucket = [r["count"] for r in rows.filter("k = 'hot'").groupBy("_bucket").count().collect()]
    assert len(per_bucket) >= 5 and max(per_bucket) < 500


def test_previous_total_and_carry(spark, hot):
    rows = timeline.cut(frame(spark, hot), ["k"], ["ts"])
    previous = timeline.with_previous(rows, ["k"], ["ts"], {"before": "value", "when": "ts"})
    totals = timeline.running_total(rows.fillna(0.0, ["value"]), ["k"], ["ts"], "value", "total")
    carried = timeline.carry_last(rows, ["k"], ["ts"], "value", "last")

    def collected(df, column):
        return {(r.k, r.ts): r[column] for r in df.collect()}

    before, when = collected(previous, "before"), collected(previous, "when")
    total, last = collected(totals, "total"), collected(carried, "last")
    for k, samples in grouped(hot).items():
        running, newest = 0.0, None
        for i, (s, v) in enumerate(samples):
            running, newest = running + (v or 0.0), v if v is not None else newest
            key = (k, at(s))
            assert before[key] == (samples[i - 1][1] if i else None)
            assert when[key] == (at(samples[i - 1][0]) if i else None)
            assert (total[key], last[key]) == (running, newest)


@pytest.mark.parametrize("seconds", [2, 60, 1000])
def test_trailing_sum_and_last(spark, hot, seconds):
    df = frame(spark, hot)
    sums = timeline.trailing_sum(df.fillna(0.0, ["value"]), ["k"], "ts", "value", seconds, "total").collect()
    lasts = series.last_over_time(df, ["k"], "ts", "value", seconds).collect()
    total, last = ({(r.k, r.ts): r[c] for r in rows} for rows, c in ((sums, "total"), (lasts, "last")))
    for k, samples in grouped(hot).items():
        for s, _ in samples:
            window = [v for u, v in samples if s - seconds < u <= s]
            present = [v for v in window if v is not None]
            assert total[(k, at(s))] == pytest.approx(sum(present))
            assert last[(k, at(s))] == (present[-1] if present else None)


def test_counter_reset_and_rate(spark):
    df = frame(spark, [("c", 0, 5.0), ("c", 60, 8.0), ("c", 120, 2.0), ("c", 600, 4.0), ("x", 0, 1.0)])
    deltas = {(r.k, r.ts): r.delta for r in series.counter_deltas(df, ["k"], "ts", "value").collect()}
    assert [deltas[("c", at(s))] for s in (0, 60, 120, 600)] == [0.0, 3.0, 2.0, 2.0]
    rates = {(r.k, r.ts): r.per_second for r in series.counter_rate(df, ["k"], "ts", "value", 120).collect()}
    assert rates[("c", at(120))] == pytest.approx(5 / 120)
    assert rates[("c", at(600))] == pytest.approx(2 / 120)
    assert rates[("x", at(0))] == 0.0
    (increase,) = [r.increase for r in series.counter_increase(df, ["k"], "ts", "value").collect() if r.k == "c"]
    assert increase == 7.0


def test_silences(spark):
    df = frame(spark, [("c", 0, 1.0), ("c", 60, 1.0), ("c", 400, 1.0), ("one", 10, 1.0)])
    until = F.lit("2024-01-01 00:08:00").cast("timestamp")
    gaps = series.silences(df, ["k"], ["ts"], "ts", 120, until)
    assert sorted((r.k, r.gap_start, r.gap_end) for r in gaps.collect()) == [
        ("c", at(60), at(400)), ("one", at(10), at(480)),
    ]


def test_state_spans(spark):
    rows = [("s", i, state) for i, state in enumerate(["a", "a", "b", "b", "a", None, None])]
    df = frame(spark, rows, "k string, ts timestamp, state string")
    spans = series.state_spans(df, ["k"], ["ts"], "ts", "state").orderBy("island").collect()
    assert [(r.state, r.n_samples, r.span_start, r.span_end) for r in spans] == [
        ("a", 2, at(0), at(1)), ("b", 2, at(2), at(3)), ("a", 1, at(4), at(4)), (None, 2, at(5), at(6)),
    ]


def test_quiet_batches_close_at_the_quiet_time(spark):
    df = frame(spark, [("p", 0, 1.0), ("p", 14, 1.0), ("p", 29, 1.0), ("p", 30, 1.0)])
    batches = series.quiet_batches(df, ["k"], ["ts"], "ts", 15).orderBy("first_arrival").collect()
    assert [(r.first_arrival, r.last_arrival, r.n_objects) for r in batches] == [(at(0), at(14), 2), (at(29), at(30), 2)]


def test_selectors_and_reducers(spark):
    df = frame(spark, [("a", 0, 2.0), ("a", 10, 4.0), ("a", 20, None), ("b", 0, 0.0), ("b", 5, 3.0)])
    noon = F.lit(at(10)).cast("timestamp")
    newest = {r.k: r.value for r in series.newest_at(df, ["k"], "ts", "value", noon).collect()}
    assert newest == {"a": 4.0, "b": 3.0}
    recent = series.newest_at(df, ["k"], "ts", "value", noon, lookback=5).collect()
    assert [r.k for r in recent] == ["a"]
    reduced = {r.k: (r.last_not_null, r.mean, r.total) for r in series.reduce_series(df, ["k"], "ts", "value").collect()}
    assert reduced == {"a": (4.0, 3.0, 6.0), "b": (3.0, 1.5, 3.0)}
    change = {r.k: r.percent_change for r in series.percent_change(df, ["k"], "ts", "value").collect()}
    assert change == {"a": 100.0, "b": None}
    assert series.select_labels(df, matching={"k": "a|x"}).count() == 3
    assert series.select_labels(df, equal={"k": "b"}).count() == 2
    assert tuple(series.distinct_series(df, ["k"]).first()) == (2, 5)


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_are_exact_at_any_sketch_size(spark, accuracy):
    rng = random.Random(3)
    values = {"wide": [rng.random() for _ in range(3000)], "ties": [float(rng.randint(0, 3)) for _ in range(1000)], "one": [5.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, value double")
    wanted = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = {(r.k, r["quantile"]): r.value for r in series.exact_quantiles(df, ["k"], "value", wanted, accuracy).collect()}
    for k, vs in values.items():
        ordered = sorted(vs)
        for q in wanted:
            rank = max(-(-int(q * 10_000) * len(ordered) // 10_000), 1)
            assert got[(k, q)] == ordered[rank - 1], (k, q)


def test_reshaping(spark):
    df = spark.createDataFrame([("n", "m1", 1.0), ("n", "m2", 2.0), ("o", "m1", 3.0)], "name string, metric string, value double")
    wide = series.wide_by_name(df, "name", "metric", "value", ["m1", "m2"])
    assert sorted(map(tuple, wide.collect())) == [("n", 1.0, 2.0), ("o", 3.0, None)]
    assert series.arrange(wide, ["m2"], {"m2": "second"}, ("m1",)).columns == ["second", "name"]
    assert series.rename_by_regex(wide, "^m([0-9])$", r"x\1").columns == ["name", "x1", "x2"]
    shown = wide.select(series.map_values(F.col("name"), {"n": "N"}, "none").alias("t"))
    assert sorted(r.t for r in shown.collect()) == ["N", "o"]


@pytest.mark.parametrize("seconds", [60, 100, 3600])
def test_trailing_sums_of_nan_huge_values_and_fractions(spark, seconds):
    """What is outside a window does not touch it; decimals are exact."""
    import math
    import random

    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    at = sorted(rng.sample(range(-5000, 5000), 400))
    special = {10: float("nan"), 50: 1e17, 51: -1e17, 120: float("inf"), 200: 1e17}
    values = [special.get(i, rng.randrange(1000) / 8) for i in range(400)]
    df = spark.createDataFrame(
        [("k", start + timedelta(seconds=s), v) for s, v in zip(at, values)] + [("other", start, 1.5)], "k string, ts timestamp, v double"
    )
    got = {(r.k, r.ts): r.total for r in timeline.trailing_sum(df, ["k"], "ts", "v", seconds, "total").collect()}
    assert got.pop(("other", start)) == 1.5 and len(got) == 400
    for s in at:
        inside = [v for a, v in zip(at, values) if s - seconds < a <= s]
        total, want = got[("k", start + timedelta(seconds=s))], math.fsum(v for v in inside if math.isfinite(v))
        if any(map(math.isnan, inside)):
            assert math.isnan(total)
        elif any(map(math.isinf, inside)):
            assert math.isinf(total)
        elif not any(abs(v) > 1e9 for v in inside):
            assert total == want  # eighths add up without rounding
        else:
            assert abs(total - want) <= 64
    cents = df.filter("k = 'k' and not isnan(v) and abs(v) < 1e9").withColumn("v", F.expr("cast(v as decimal(20, 3)) + 0.007"))
    exact = timeline.trailing_sum(cents, ["k"], "ts", "v", seconds, "total").collect()
    rows = {r.ts: r.v for r in cents.collect()}
    for r in exact:
        assert r.total == sum(v for ts, v in rows.items() if r.ts - timedelta(seconds=seconds) < ts <= r.ts)


def test_a_ratio_of_rates_without_growth_is_null(spark):
    start = datetime(2024, 1, 1)
    rows = [(k, start + timedelta(seconds=s), v) for k, vs in {"a": [1, 3, 3, 3], "b": [5, 6, 6, 6]}.items() for s, v in zip((0, 60, 120, 180), vs)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long").withColumn("v", F.col("v").cast("double"))
    got = series.rate_ratio(df, ["k"], "ts", "v", 100, [], F.col("k") == "a").orderBy("ts").collect()
    assert [r.ratio for r in got] == [None, pytest.approx(2 / 3), pytest.approx(2 / 3), None]
