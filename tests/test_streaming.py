import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import ingest, series
from corpusprep.sources.keyed_table import KeyedTable, newest_wins
from corpusprep.streaming import files, windows

SCHEMA = "k string, ts timestamp, n long"


def rows(spark, *seconds):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([("k", start + timedelta(seconds=s), i) for i, s in enumerate(seconds)], SCHEMA)


def test_rewrite_keeps_fields_and_fails_on_a_broken_line(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"text": "straße ก", "n": [1, null]}\n\n{"other": 1}\n', encoding="utf-8")
    files.rewrite_jsonl(spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [{"n": [1, None], "text": "STRASSE ก"}, {"other": 1}]))

    (source / "b.jsonl").write_text('{"text": "fine"}\n{broken\n', encoding="utf-8")
    with pytest.raises(Exception, match="not a JSON object"):
        files.rewrite_jsonl(spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_only_new_files_are_picked_up(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = rows(spark, 0).schema
    for seconds in ((0, 1), (2, 3, 4)):
        rows(spark, *seconds).write.mode("append").parquet(folder)
        files.append_new_files(files.stream_table(spark, folder, schema), target, checkpoint)
    assert spark.read.parquet(target).count() == 5


def test_stream_and_batch_windows_agree(spark, tmp_path):
    df = rows(spark, 0, 3600, 90_000, 200_000, 400_000)
    df.write.parquet(str(tmp_path / "in"))
    stream = files.stream_table(spark, str(tmp_path / "in"), df.schema)
    counted = windows.daily_counts(stream, "ts", ["k"], "n_rows", late="1 hour")
    files.append_new_files(counted, str(tmp_path / "out"), str(tmp_path / "cp"))
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {tuple(r) for r in windows.daily_counts(df, "ts", ["k"], "n_rows").collect()}
    assert closed < batch and len(batch - closed) == 1


LABELS = "target_id string, label_type string, label_value string, confidence double, annotator string, created_at long, seq long, first_seq long"


def test_stream_merges_batches_and_can_repeat_one(spark, tmp_path):
    batches = [[("d", "s", "a", 50.0, "m1", 1, 1, 1)], [("d", "s", "b", 40.0, "m2", 2, 2, 2), ("e", "s", "c", 1.0, "m3", 2, 3, 3)]]
    folder = tmp_path / "in"
    base = spark.createDataFrame([], LABELS)
    keys = ["target_id", "label_type"]
    table = KeyedTable(spark, str(tmp_path / "table"), base.schema, keys)
    for batch in batches:
        spark.createDataFrame(batch, LABELS).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = files.stream_table(spark, str(folder), base.schema, files_per_batch=1)
        files.merge_stream(stream, table, ingest.merge_labels, str(tmp_path / "cp"), "labels")

    run()
    got = {r.target_id: (r.label_value, r.confidence, r.annotator) for r in table.read().collect()}
    assert got == {"d": ("b", 50.0, "m1"), "e": ("c", 1.0, "m3")} and table.version == 2
    assert table.merge("labels-1", spark.createDataFrame(batches[0], LABELS), ingest.merge_labels) is None
    # A restart goes on from the newest version and only merges what is new.
    late = [("d", "s", "z", 99.0, "m0", 0, 0, 0)]
    spark.createDataFrame(late, LABELS).coalesce(1).write.mode("append").parquet(str(folder))
    table = KeyedTable(spark, str(tmp_path / "table"), base.schema, keys)
    run()
    batches.append(late)
    whole = ingest.merge_labels(base, spark.createDataFrame(sum(batches, []), LABELS))
    assert sorted(map(str, whole.collect())) == sorted(map(str, table.read().collect()))


def test_only_buckets_that_may_hold_a_key_are_rewritten(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v long").schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=64, bits=1 << 14)
    rule = newest_wins(["k"])
    loaded = table.merge("load", spark.range(20_000).selectExpr("id AS k", "id AS v"), rule)
    assert loaded.rewritten == () and len(loaded.extended) == 64
    folders = set(table._newest()[1])
    before = {b: paths for b, paths in table._newest()[1].items()}
    done = table.merge("ten", spark.range(10).selectExpr("id * 1999 AS k", "-1L AS v"), rule)
    assert 1 <= len(done.rewritten) <= 10 and done.extended == ()
    after = table._newest()[1]
    assert {b for b in folders if after[b] != before[b]} == {str(b) for b in done.rewritten}
    # Keys the filters rule out: their buckets get a file and are not read.
    new = table.merge("new", spark.range(10).selectExpr("id + 1000000 AS k", "-2L AS v"), rule)
    assert len(new.extended) >= 8 and len(new.rewritten) + len(new.extended) <= 10
    assert table.merge("new", spark.range(10).selectExpr("id AS k", "id AS v"), rule) is None
    again = table.merge("again", spark.createDataFrame([(1_000_000, 7), (None, 8)], schema), rule)
    assert len(again.rewritten) >= 1
    rows = {r.k: r.v for r in table.read().collect()}
    assert len(rows) == table.read().count() == 20_011 and rows[1999] == -1 and rows[5] == 5
    assert (rows[1_000_000], rows[1_000_001], rows[None]) == (7, -2, 8)


def test_a_merge_that_dies_changes_nothing(spark, tmp_path):
    schema = "k string, v long"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, ["k"], buckets=2)
    table.merge("a", spark.createDataFrame([("x", 1)], schema), newest_wins(["k"]))

    def broken(existing, batch):
        return batch.withColumn("v", F.raise_error(F.lit("lost")).cast("long"))

    with pytest.raises(Exception, match="lost"):
        table.merge("b", spark.createDataFrame([("x", 2), ("y", 3)], schema), broken)
    assert [tuple(r) for r in table.read().collect()] == [("x", 1)] and table.version == 1
    table.merge("b", spark.createDataFrame([("x", 2), ("y", 3)], schema), newest_wins(["k"]))
    assert sorted(map(tuple, table.read().collect())) == [("x", 2), ("y", 3)]
    assert table.merge("none", spark.createDataFrame([], schema), newest_wins(["k"])).rewritten == ()
    assert table.read().count() == 2


def test_open_windows_a_late_row_and_a_restart(spark, tmp_path):
    """Counts in update mode are those of a batch, but for a row later than the watermark."""
    folder, keys = str(tmp_path / "in"), ["k", "window_start"]
    parts = [(0, 3600, 90_000), (89_000, 200_000), (400_000, 401_000)]
    table = None
    for part in parts:
        rows(spark, *part).coalesce(1).write.mode("append").parquet(folder)
        stream = files.stream_table(spark, folder, rows(spark, 0).schema, files_per_batch=1)
        counts = windows.daily_counts(stream, "ts", ["k"], "n_rows", late="1 hour")
        table = KeyedTable(spark, str(tmp_path / "t"), counts.schema, keys, buckets=2)
        files.merge_stream(counts, table, newest_wins(keys), str(tmp_path / "cp"), "daily", "update")
    batch = windows.daily_counts(rows(spark, *sum(parts, ())), "ts", ["k"], "n_rows")
    assert sorted(map(str, table.read().collect())) == sorted(map(str, batch.collect()))
    rows(spark, 10).write.mode("append").parquet(folder)
    stream = files.stream_table(spark, folder, rows(spark, 0).schema)
    counts = windows.daily_counts(stream, "ts", ["k"], "n_rows", late="1 hour")
    files.merge_stream(counts, table, newest_wins(keys), str(tmp_path / "cp"), "daily", "update")
    assert sorted(map(str, table.read().collect())) == sorted(map(str, batch.collect()))


def test_first_seen_in_a_stream(spark, tmp_path):
    df = rows(spark, 0, 1, 2).withColumn("checksum", F.when(F.col("n") < 2, "same").otherwise("other"))
    df.write.parquet(str(tmp_path / "in"))
    stream = files.stream_table(spark, str(tmp_path / "in"), df.schema)
    files.append_new_files(windows.first_seen(stream, "ts", ["checksum"], "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.checksum for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["other", "same"]


def test_quiet_batches_close_by_timer_join_and_keep_little_state(spark, tmp_path):
    folder, keys = str(tmp_path / "in"), ["k", "first_arrival"]
    table, query = None, None

    def run(*seconds):
        nonlocal table, query
        rows(spark, *seconds).coalesce(1).write.mode("append").parquet(folder)
        stream = files.stream_table(spark, folder, rows(spark, 0).schema, files_per_batch=1)
        found = windows.quiet_batches_with_open(stream, "ts", "k", 45, "n", "1 minute")
        table = table or KeyedTable(spark, str(tmp_path / "t"), found.schema, keys, buckets=2)
        with files.rocksdb_state(spark):
            query = files.merge_stream(found, table, newest_wins(keys), str(tmp_path / "cp"), "quiet", "update")
        start = datetime(2024, 1, 1)
        live = table.read().filter("n > 0").collect()
        return sorted(((r.first_arrival - start).seconds, (r.last_arrival - start).seconds, r.n, r.closed) for r in live)

    assert run(0, 10, 100) == [(0, 10, 2, False), (100, 100, 1, False)]
    # Exactly the quiet time apart starts a new batch.
    assert run(55, 145) == [(0, 10, 2, True), (55, 55, 1, False), (100, 100, 1, False), (145, 145, 1, False)]
    # A row in between joins two batches; one later than the watermark is dropped.
    assert run(99, 54) == [(0, 10, 2, True), (55, 100, 3, False), (145, 145, 1, False)]
    done = run(5000)  # the watermark passes all others: no later row of theirs closes them
    assert [b[3] for b in done] == [True] * (len(done) - 1) + [False] and done[-1][:3] == (5000, 5000, 1)
    assert sum(b[2] for b in done) == 7
    total = sum(o.numRowsTotal for p in query.recentProgress[-1:] for o in p.stateOperators)
    assert total <= 6  # one open batch, its timer and their counts, however many rows there were
    batch = series.quiet_batches(rows(spark, 0, 10, 100, 55, 145, 99, 5000), ["k"], ["ts", "n"], "ts", 45).collect()
    start = datetime(2024, 1, 1)
    want = sorted(((r.first_arrival - start).seconds, (r.last_arrival - start).seconds, r.n_objects) for r in batch)
    assert [b[:3] for b in done] == want
