
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import chat, ingest, labels, language, metric_rules, quality
from corpusprep.sources.tables import prefer_mapped

DOCS = "id string, checksum string, line_no long, title string"


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCS)


def test_absent_rows_skip_known_and_repeated_but_keep_keyless(spark):
    existing = docs(spark, ("o1", "a", 0, "old"), ("o2", None, 0, "old"))
    batch = docs(spark, ("n1", "a", 1, "x"), ("n2", "b", 2, "x"), ("n3", "b", 3, "x"), ("n4", None, 4, "x"), ("n5", None, 5, "x"))
    assert sorted(r.id for r in ingest.absent_rows(batch, existing).collect()) == ["n2", "n4", "n5"]
    assert ingest.insert_absent(existing, batch).count() == 5


def test_upsert_rows_keep_the_first_id(spark):
    existing = docs(spark, ("o1", "a", 0, "old"), ("o2", "c", 0, "old"), ("o3", None, 0, "old"))
    batch = docs(spark, ("n1", "a", 1, "t1"), ("n2", "a", 2, "t2"), ("n3", "b", 3, "t3"), ("n4", "b", 4, "t4"), ("n5", None, 5, "t5"))
    got = sorted((r.id, r.checksum or "", r.title) for r in ingest.upsert_rows(existing, batch).collect())
    assert got == [("n3", "b", "t4"), ("n5", "", "t5"), ("o1", "a", "t2"), ("o2", "c", "old"), ("o3", "", "old")]


def test_upsert_labels_mixes_newest_greatest_and_oldest(spark):
    schema = "target_id string, label_type string, label_value string, confidence double, annotator string, created_at long"
    existing = spark.createDataFrame([("d", "s", "pos", 90.0, "first", 1)], schema)
    batch = spark.createDataFrame(
        [("d", "s", "neg", 60.0, "second", 2, 0), ("e", "s", "pos", 10.0, "x", 3, 1), ("e", "s", "neu", 5.0, "y", 4, 2)],
        schema + ", seq long",
    )
    got = {r.target_id: tuple(r) for r in ingest.upsert_labels(existing, batch).collect()}
    assert got["d"] == ("d", "s", "neg", 90.0, "first", 2)
    assert got["e"] == ("e", "s", "neu", 10.0, "x", 4)


def test_upsert_logs(spark):
    schema = "id string, document_id string, step string, status string, details string, executed_by string, executed_at string"
    old = spark.createDataFrame([("1", "d1", "clean", "failed", "x", "me", "t1")], schema)
    new = spark.createDataFrame([("1", "d2", "map", "success", "y", "you", "t2", 0)], schema + ", seq long")
    assert tuple(ingest.upsert_logs(old, new).first()) == ("1", "d1", "clean", "success", "y", "me", "t2")


def test_defaults(spark):
    row = spark.createDataFrame(
        [(None, None, None, None, None, None, None, 7)],
        "id string, filename string, language string, source string, word_count long, char_count long, script_ratio double, line_no long",
    )
    got = ingest.with_defaults(row).first()
    assert (got.title, got.language, got.source, got.word_count, got.script_ratio, got.status) == (
        "unknown:7", "th", "unknown_source", 0, 0.0, "ingested",
    )
    assert len(got.id) == 36


def test_new_keys_and_prefer_mapped(spark):
    keys = spark.createDataFrame([("b", "x"), ("b", "y"), ("c", "x")], "bucket string, object_path string")
    seen = spark.createDataFrame([("b", "x"), ("b", "x")], "bucket string, object_path string")
    left = ingest.new_keys(keys, seen, ["bucket", "object_path"])
    assert sorted(tuple(r) for r in left.collect()) == [("b", "y"), ("c", "x")]
    mapped = spark.createDataFrame([("1", "u")], "id string, url string")
    validated = spark.createDataFrame([("1",), ("2",)], "id string")
    assert sorted(map(tuple, prefer_mapped(mapped, validated).collect())) == [("1", "u"), ("2", None)]


def test_union_logs_skips_an_absent_log(spark):
    a = spark.createDataFrame([("1", "s")], "log_id string, step string")
    b = spark.createDataFrame([("2",)], "log_id string")
    assert sorted(map(tuple, ingest.union_logs(a, None, b).collect())) == [("1", "s"), ("2", None)]
    assert ingest.log_table(a).columns == ["id", "step"]


def test_daily_anomaly_sees_a_jump(spark):
    rows = [("s", f"2024-01-{d:02d}", 10 + d % 2) for d in range(1, 11)] + [("s", "2024-01-11", 100)]
    scored = quality.daily_anomalies(spark.createDataFrame(rows, "k string, day string, n long"), ["k"], "day", "n")
    z = {r.day: r.z_score for r in scored.collect()}
    assert z["2024-01-11"] > 50
    assert abs(z["2024-01-10"]) < 3
    assert z["2024-01-01"] is None


def test_blank_is_sql_trim(values):
    assert values([None, "", "  ", "\t", "x"], quality.blank) == [True, True, True, False, False]


def test_chat_export(spark, tmp_path):
    chats = spark.createDataFrame(
        [
            ("c1", "t", '{"messages": [{"role": "user", "content": "hi", "x": 1}, {"role": "assistant", "content": "yo"},'
             ' {"role": "assistant", "content": "m", "modelName": "big"}]}', 1_700_000_000_500, 1_700_000_000),
            ("c2", "t", '{"title": "none"}', 1_700_000_000, 1_700_000_060),
        ],
        "id string, title string, chat string, created_at long, updated_at long",
    )
    exported = {r.chat_id: r for r in chat.export_chats(chats).collect()}
    assert [tuple(m) for m in exported["c1"].messages] == [("user", "hi", None), ("assistant", "yo", "assistant"), ("assistant", "m", "big")]
    assert exported["c1"].created_at == exported["c1"].updated_at == "2023-11-14T22:13:20"
    assert exported["c2"].messages == []
    path = chat.write_export(chat.export_chats(chats), str(tmp_path), "2024-02-01")
    assert path.endswith("/2024-02-01")
    lines = spark.read.text(path).filter(F.col("value").contains('"c1"')).first().value
    assert '{"role":"user","content":"hi"}' in lines


def test_both_scorers_agree_and_ties_take_the_first_class(spark):
    from corpusprep.plans.label_queries import LEXICON, make_lexicon_scorer

    texts = ["The cat and the dog", "of the", "nothing", "que que of\nto", "the " * 600, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    native = labels.label_texts(df, labels.lexicon_scores(LEXICON)).orderBy("i").collect()
    model = labels.label_texts(df, labels.model_scores(make_lexicon_scorer, batch=2)).orderBy("i").collect()
    assert native == model
    assert [r.label for r in native] == ["positive", "positive", "positive", "negative", "positive", "positive"]
    assert native[0].confidence == pytest.approx(66.67)


def test_lookup_counts_misses(spark):
    labelled = spark.createDataFrame([("a", "pos", 1.0), ("a", "pos", 1.0), ("b", "neg", 2.0)], "checksum string, label string, confidence double")
    known = spark.createDataFrame([("a", "doc")], "checksum string, id string")
    rows, misses = labels.lookup_labels(labelled, known, "me@v1")
    assert [tuple(r) for r in rows.collect()] == [("doc", "sentiment", "pos", 1.0, "me@v1", 2)]
    assert [tuple(r) for r in misses.collect()] == [("b", 1)]


def test_all_grams_count_in_the_row_and_joined(spark, monkeypatch):
    train = [("en", "the cat and the hat"), ("de", "der hund und das haus"), ("fr", "le chat et la maison \U0001d4d0\U0001d4d1")]
    profiles = language.language_profiles(spark.createDataFrame(train, "lang string, text string"), "lang", "text", 20)
    # The ending decides: whoever looks at the beginning only takes the other language.
    texts = ["the cat " * 3 + "und das haus " * 300, "und " * 3 + "the hat " * 40_000, "", None, "x", "1 2 3", "e", "et \U0001d4d0\U0001d4d1 la"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = {}
    ranks = {}
    for r in profiles.collect():
        ranks.setdefault(r.gram, {})[r.lang] = 21 - r.lang_rank
    for i, t in enumerate(texts):
        words = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        padded = " " + " ".join(words) + " " if words else " "
        grams = [padded[k : k + 3] for k in range(len(padded) - 2)]
        sums = {}
        for g in grams:
            for lang, gain in ranks.get(g, {}).items():
                sums[lang] = sums.get(lang, 0) + gain
        best = max(sums, key=lambda x: (sums[x], x), default=None)
        want[i] = (best or "und", 20 * len(grams) - sums[best] if best else None)
    assert (want[0][0], want[1][0]) == ("de", "en")
    for chunk in (language.CHUNK, 997):
        monkeypatch.setattr(language, "CHUNK", chunk)
        got = language.identify(df, "i", "text", profiles, 20)
        assert {r.i: (r.language, r.distance) for r in got.collect()} == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    joined = language.identify_joined(df, "i", "text", profiles, 20)
    assert {r.i: (r.language, r.distance) for r in joined.collect()} == want
    monkeypatch.setattr(language, "SENT_BYTES", 10)
    assert language.sendable(profiles, 20) is None
    again = language.identify(df, "i", "text", profiles, 20)
    assert {r.i: (r.language, r.distance) for r in again.collect()} == want


def test_language_of_short_texts(spark):
    train = spark.createDataFrame(
        [("en", "the cat sat on the mat and the dog ran with the ball"), ("de", "der hund und die katze sind auf der matte und ich")],
        "lang string, text string",
    )
    texts = ["the dog and the mat", "die katze und der hund", "1234", None]
    found = language.identify(
        spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "i", "text", language.language_profiles(train, "lang", "text")
    )
    assert {r.i: r.language for r in found.collect()} == {0: "en", 1: "de", 2: "und", 3: "und"}


def test_metric_rules(spark):
    names = [
        ("af.ti.finish.d.t.success", "counter"),
        ("af.x.job_start", "counter"),
        ("af.operator_failures_Bash", "counter"),
        ("af.ti_failures", "counter"),
        ("af.ti_failures", "gauge"),
        ("af.pool.open_slots.default", "gauge"),
        ("a.b.pool.open_slots.default", "gauge"),
        ("af.dag.d.t.duration", "observer"),
        ("af.ti.start.job_start.t_end", "counter"),
        ("nothing", "counter"),
    ]
    df = spark.createDataFrame(names, "name string, kind string")
    got = {(r.name, r.kind): (r.metric, r.labels) for r in metric_rules.rewrite_names(df).collect()}
    assert got[names[0]] == ("af_agg_ti_finish", {"airflow_id": "af", "dag_id": "d", "task_id": "t", "state": "success"})
    assert got[names[1]] == ("af_agg_job_start", {"airflow_id": "af.x", "job_name": "job"})
    assert got[names[2]] == ("af_agg_operator_failures", {"airflow_id": "af", "operator_name": "Bash"})
    assert got[names[3]] == ("af_agg_ti_failures", {"airflow_id": "af"})
    assert got[names[4]] == got[names[6]] == got[names[9]] == (None, None)
    assert got[names[5]] == ("af_agg_pool_open_slots", {"airflow_id": "af", "pool_name": "default"})
    assert got[names[7]][0] == "af_agg_dag_task_duration"
    # A whole-name pattern wins over an expression that would also match.
    assert got[names[8]][0] == "af_agg_ti_start"
    assert len(metric_rules.parse_rules()) == 46


