"""Copies of texts that a run no longer reads are gone; tables of a run may be computed from one another."""

import json

from corpusprep import session
from corpusprep.operators.clean import CleanConfig
from corpusprep.plans import files_run
from corpusprep.plans.files_run import COUNTERS, DOCUMENTS, FilesRun, ingest_files
from corpusprep.sources.runs import RunTables
from pyspark.sql import functions as F


def one_run(spark, tmp_path, monkeypatch, **more):
    folder = tmp_path / "bucket" / "raw" / "site"
    folder.mkdir(parents=True)
    texts = [f"a text of some length, number {i} of this file" for i in range(20)]
    (folder / "a.jsonl").write_text("\n".join([json.dumps({"text": t}) for t in texts] + ["{broken"]), encoding="utf-8")
    work = tmp_path / "work"
    work.mkdir()
    monkeypatch.setattr(files_run, "work_path", lambda spark, name: str(work / name))
    seen = []
    put = session.put

    def watched(df, path, *mode):
        put(df, path, *mode)
        seen.append({p.name for p in work.rglob("*") if p.is_dir()} & {"lines", "parsed", "measured", "checked", "mapped", "documents"})

    monkeypatch.setattr(session, "put", watched)
    monkeypatch.setattr("corpusprep.sources.runs.put", watched)
    rules = CleanConfig(min_chars=1, min_ratio=0.0, script="A-Za-z", script_language="latin")
    how = FilesRun(root=str(tmp_path / "bucket"), tables=str(tmp_path / "tables"), rules=rules, **more)
    side = spark.createDataFrame([], "filename string, url string, line_no long")
    sets = spark.createDataFrame([], "id string, name string")
    assert ingest_files(spark, [str(folder / "a.jsonl")], how, side, sets, F.lit("2024-02-01T07:00:00+07:00"))
    return RunTables(spark, how.tables), work, seen


def test_a_run_deletes_copies_of_its_texts(spark, tmp_path, monkeypatch):
    tables, work, seen = one_run(spark, tmp_path, monkeypatch)
    assert list(work.iterdir()) == []
    assert all(len(there) <= 3 for there in seen) and seen[-1] == {"checked", "mapped"}
    assert tables.read("documents", DOCUMENTS).count() == 20
    counted = tables.read("counters", COUNTERS).first()
    assert (counted.n_in, counted.n_broken, counted.n_inserted) == (21, 1, 20)


def test_documents_without_their_texts_count_too(spark, tmp_path, monkeypatch):
    tables, work, _ = one_run(spark, tmp_path, monkeypatch, content=False)
    assert list(work.iterdir()) == []
    assert tables.read("documents", DOCUMENTS).filter("content is null").count() == 20
    assert tables.read("counters", COUNTERS).first().n_inserted == 20


def test_a_table_of_a_run_is_computed_from_one_before_it(spark, tmp_path):
    tables = RunTables(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([("x", 1), ("x", 2)], "k string, n long")
    assert tables.commit("1", {"a": rows, "b": lambda read: read("a").groupBy("k").agg(F.sum("n").alias("n"))})
    assert [tuple(r) for r in tables.read("b", "k string, n long").collect()] == [("x", 3)]


def test_rows_of_many_bytes_are_few_in_a_row_group(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(40, numPartitions=1).select("id", F.transform(F.sequence(F.lit(1), F.lit(400_000)), lambda i: F.xxhash64("id", i)).alias("xs"))
    session.put(rows, str(tmp_path / "wide"), options=session.WIDE_ROWS)
    (file,) = (tmp_path / "wide").glob("*.parquet")
    kept = pq.ParquetFile(file).metadata
    # 3.2 MB a row: a hundred of them would be in one group if sizes were looked at every hundred rows.
    assert max(kept.row_group(i).num_rows for i in range(kept.num_row_groups)) <= 8
    assert spark.read.parquet(str(tmp_path / "wide")).agg(F.sum(F.size("xs"))).first()[0] == 40 * 400_000
