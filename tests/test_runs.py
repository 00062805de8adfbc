"""The run from files to tables: published as a whole, repeated without effect, nothing lost."""

import json

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import labels
from corpusprep.operators.clean import CleanConfig
from corpusprep.plans import files_run
from corpusprep.plans.files_run import COUNTERS, DOCUMENTS, LABELS, LOGS, QUARANTINE, STAGES, FilesRun, ingest_files, run_files
from corpusprep.sources.runs import RunTables

ROWS = "k string, n long"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def test_a_run_shows_as_a_whole_and_once(spark, tmp_path, monkeypatch):
    tables = RunTables(spark, str(tmp_path / "t"))
    assert tables.runs() == set() and tables.read("a", ROWS).count() == 0
    assert tables.commit("1", {"a": rows(spark, ("x", 1)), "b": rows(spark, ("y", 2))})
    assert not tables.commit("1", {"a": rows(spark, ("x", 1))})

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(RunTables, "_publish", dies)
        with pytest.raises(RuntimeError):
            tables.commit("2", {"a": rows(spark, ("z", 3)), "b": rows(spark, ("z", 3))})
    assert tables.runs() == {"1"} and tables.read("a", ROWS).count() == 1
    assert tables.commit("2", {"a": rows(spark, ("z", 3))})
    assert sorted(map(tuple, tables.read("a", ROWS).collect())) == [("x", 1), ("z", 3)]
    assert tables.read("b", ROWS).count() == 1
    assert tables.compact("a", ROWS) and not tables.compact("a", ROWS)
    assert len(tables._current("a")) == 1 and sorted(r.k for r in tables.read("a", ROWS).collect()) == ["x", "z"]
    assert tables.commit("3", {"a": rows(spark, ("w", 4))}) and tables.read("a", ROWS).count() == 3


def test_a_run_published_twice_counts_once(spark, tmp_path):
    tables = RunTables(spark, str(tmp_path / "t"))
    tables.commit("1", {"a": rows(spark, ("x", 1))})
    path = tables._current("a")["1"]
    rows(spark, ("x", 1)).write.parquet(path + "-again")
    tables._publish("1", {"a": path + "-again"}, [])
    assert tables.read("a", ROWS).count() == 1


THAI = "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e0a\u0e32\u0e27\u0e42\u0e25\u0e01\u0e17\u0e38\u0e01\u0e04\u0e19"


def lines(*texts):
    """Texts as records; what is no record stays as it is."""
    plain = ("{broken", "", "[1]")
    return "\n".join(t if t in plain else json.dumps({"text": t}, ensure_ascii=False) for t in texts)


@pytest.fixture
def objects(tmp_path):
    folder = tmp_path / "my bucket" / "raw" / "org [1]" / "site.v1" / "jsonl"
    folder.mkdir(parents=True)
    (folder / "a+b 100%.jsonl").write_text(lines(THAI, "{broken", "x", THAI, "", THAI + "\u0e01"), encoding="utf-8")
    other = tmp_path / "my bucket" / "raw" / "\u0e02\u0e49\u0e2d\u0e21\u0e39\u0e25"
    other.mkdir()
    (other / "c.jsonl").write_text(lines(THAI, THAI + "\u0e02", "[1]"), encoding="utf-8")
    return tmp_path / "my bucket"


def parts(spark, root, name, **more):
    how = FilesRun(root=str(root), tables=str(root.parent / name), bucket="b", files_per_batch=1, **more)
    side = spark.createDataFrame([("a+b 100%_0000006.txt", "http://six", 1)], "filename string, url string, line_no long")
    sets = spark.createDataFrame([("1", "org [1]"), ("2", "\u0e02\u0e49\u0e2d\u0e21\u0e39\u0e25")], "id string, name string")
    return how, (how, side, sets, F.lit("2024-02-01T07:00:00+07:00"))


def shown(tables):
    docs = tables.read("documents", DOCUMENTS).select(
        "content_ptr.object_path", "content_ptr.line_no", "dataset_id", "title", "content", F.to_json("metadata"), "id"
    )
    kinds = {"counters": COUNTERS, "quarantine": QUARANTINE, "logs": LOGS, "stages": STAGES}
    found = {name: sorted(map(str, tables.read(name, schema).collect())) for name, schema in kinds.items()}
    return found | {"documents": sorted(map(str, docs.collect()))}


def test_objects_become_documents_logs_and_counters(spark, objects):
    how, args = parts(spark, objects, "tables")
    tables = run_files(spark, *args, str(objects.parent / "cp"))
    docs = {(r.content_ptr.object_path, r.content_ptr.line_no): r for r in tables.read("documents", DOCUMENTS).collect()}
    first, second = "raw/org [1]/site.v1/jsonl/a+b 100%.jsonl", "raw/\u0e02\u0e49\u0e2d\u0e21\u0e39\u0e25/c.jsonl"
    # The common text is loaded from the object that came first, whichever that was.
    assert set(docs) in ({(first, 1), (first, 6), (second, 2)}, {(first, 6), (second, 1), (second, 2)})
    assert docs[(first, 6)].dataset_id == "1" and docs[(second, 2)].dataset_id == "2"
    counts = {r.object_path: r for r in tables.read("counters", COUNTERS).collect()}
    c = counts[first]
    assert (c.n_in, c.n_broken, c.n_cleaned, c.n_failed, c.n_ok, c.n_mapped, c.n_unmapped) == (6, 2, 2, 4, 2, 1, 1)
    assert all(r.n_in == r.n_cleaned + r.n_failed for r in counts.values())
    assert sum(r.n_inserted for r in counts.values()) == len(docs) == 3
    bad = {(r.object_path, r.line_no): (r.reason, r.value) for r in tables.read("quarantine", QUARANTINE).collect()}
    assert bad == {(first, 2): ("json_error", "{broken"), (first, 5): ("json_error", ""), (second, 3): ("type:not_object", "[1]")}
    broken = tables.read("logs", LOGS).filter("document_id is null and status = 'failed'").count()
    assert broken == 3
    stages = {r.stage_path for r in tables.read("stages", STAGES).collect()}
    assert "cleaned/org [1]/site.v1/jsonl/a+b 100%.cleaned.jsonl" in stages
    record = json.loads(tables.read("stages", STAGES).filter("stage = 'mapped' and content_ptr.line_no = 6").first().value)
    assert record["metadata"]["url"] == "http://six" and record["content_ptr"]["line_no"] == 6
    # Nothing new, then a new object beside the known ones.
    before = shown(tables)
    run_files(spark, *args, str(objects.parent / "cp"))
    assert shown(tables) == before
    (objects / "raw" / "new.jsonl").write_text(lines(THAI + "\u0e03"), encoding="utf-8")
    run_files(spark, *args, str(objects.parent / "cp"))
    assert tables.read("documents", DOCUMENTS).count() == 4


def test_a_run_killed_between_two_writes_starts_over(spark, objects, monkeypatch):
    _, whole = parts(spark, objects, "whole")
    want = shown(run_files(spark, *whole, str(objects.parent / "cp-whole")))
    how, args = parts(spark, objects, "killed")
    commit, calls = RunTables.commit, []

    def dying(self, run, tables, replaces=()):
        calls.append(run)
        if len(calls) == 2:  # the second batch writes its documents, then the process is lost
            tables["documents"].write.parquet(f"{self.root}/data/documents/{run}-lost")
            raise RuntimeError("lost")
        return commit(self, run, tables, replaces)

    with monkeypatch.context() as patch:
        patch.setattr(RunTables, "commit", dying)
        with pytest.raises(Exception, match="lost"):
            run_files(spark, *args, str(objects.parent / "cp-killed"))
    assert len(RunTables(spark, how.tables).runs()) == 1
    assert shown(run_files(spark, *args, str(objects.parent / "cp-killed"))) == want
    # A checkpoint that was lost delivers all files again: they are known.
    assert shown(run_files(spark, *args, str(objects.parent / "cp-new"))) == want


def test_strays_limit_labels_and_no_content(spark, objects):
    lexicon = labels.Lexicon(positive=(THAI,), negative=("x",))
    how, args = parts(
        spark, objects, "tables", limit=2, content=False, dataset_id="9",
        rules=CleanConfig(), scorer=labels.lexicon_scores(lexicon), annotator="lexicon@1",
    )
    (objects / "elsewhere.jsonl").write_text(lines(THAI), encoding="utf-8")
    first = str(objects / "raw" / "org [1]" / "site.v1" / "jsonl" / "a+b 100%.jsonl")
    assert ingest_files(spark, [first, str(objects / "elsewhere.jsonl")], *args)
    assert not ingest_files(spark, [first, str(objects / "elsewhere.jsonl")], *args)
    assert not ingest_files(spark, [str(objects / "elsewhere.jsonl")], *args)
    tables = RunTables(spark, how.tables)
    doc = tables.read("documents", DOCUMENTS).collect()
    assert [(d.content, d.dataset_id, d.content_ptr.line_no) for d in doc] == [(None, "9", 1)]
    label = tables.read("labels", LABELS).collect()
    assert [(r.target_id, r.label_value, r.annotator) for r in label] == [(doc[0].id, "positive", "lexicon@1")]
    stray = tables.read("quarantine", QUARANTINE).filter("line_no is null").collect()
    assert [(r.object_path, r.reason) for r in stray] == [("elsewhere.jsonl", "outside_prefix:raw")]
    with pytest.raises(FileNotFoundError):
        run_files(spark, FilesRun(root=str(objects), tables="t", glob="*.csv"), *args[1:], str(objects.parent / "cp"))


def test_names_of_runs_and_keys():
    assert files_run.run_name(["b", "a"]) == files_run.run_name(["a", "b"]) != files_run.run_name(["a"])
    assert files_run.plain_key("s3a://bucket/raw/a%20b.jsonl", "s3a://bucket") == "raw/a%20b.jsonl"
    assert files_run.plain_key("file:/x/other/a.jsonl", "/x/root") == "x/other/a.jsonl"
