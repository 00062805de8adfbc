"""Edges: object keys of scanned files, batches that end at the quiet time, null fields of exported chats."""

import json
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from corpusprep.functions import text
from corpusprep.functions.keys import object_key, stage_paths
from corpusprep.operators import chat, enrich, language
from corpusprep.plans import registry
from corpusprep.sources import jsonl
from corpusprep.streaming import windows


def test_object_keys_of_files_in_odd_folders(spark, tmp_path):
    root = tmp_path / "my v1.2"
    folder = root / "raw" / "corpus"
    folder.mkdir(parents=True)
    (folder / "\u0e02\u0e48\u0e32\u0e27 a+b%.jsonl").write_text('{"text": "x"}\n')
    lines = jsonl.read_lines(spark, str(root))
    keyed = lines.select(object_key(F.col("file_path"), str(root)).alias("key"), "line_no")
    sets = spark.createDataFrame([(7, "corpus")], "id int, name string")
    row = enrich.resolve_dataset(keyed, sets, "key", ["line_no"]).first()
    assert (row.key, row.dataset_id) == ("raw/corpus/\u0e02\u0e48\u0e32\u0e27 a+b%.jsonl", 7)
    paths = stage_paths(F.col("key"))
    stem, cleaned = keyed.select(paths.stem, paths.cleaned).first()
    assert stem == "\u0e02\u0e48\u0e32\u0e27 a+b%"
    assert cleaned == "cleaned/corpus/\u0e02\u0e48\u0e32\u0e27 a+b%.cleaned.jsonl"


def test_object_keys_drop_bucket_and_root(spark):
    df = spark.createDataFrame([("s3a://a.b/raw/x/c.jsonl",), ("s3a://a.b/other/c.jsonl",), (None,)], "p string")
    got = [r[0] for r in df.select(object_key(F.col("p"), "s3a://a.b")).collect()]
    assert got == ["raw/x/c.jsonl", "other/c.jsonl", None]
    below = [r[0] for r in df.select(object_key(F.col("p"), "s3a://a.b/raw/")).collect()]
    assert below == ["x/c.jsonl", "other/c.jsonl", None]


def test_a_gap_of_the_quiet_time_ends_a_session(spark):
    times = [datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 15), datetime(2024, 1, 1, 0, 29, 59)]
    df = spark.createDataFrame([("a", t) for t in times], "k string, ts timestamp")
    rows = windows.quiet_sessions(df, "ts", ["k"], "15 minutes", "n", "1 hour").orderBy("window_start").collect()
    assert [(r.n, r.window_end) for r in rows] == [
        (1, datetime(2024, 1, 1, 0, 15)),
        (2, datetime(2024, 1, 1, 0, 44, 59)),
    ]


def test_export_keeps_null_fields(spark, tmp_path):
    messages = [{"role": "user", "content": None}, {"role": "assistant", "content": "b", "modelName": "m"}]
    chats = spark.createDataFrame(
        [("1", None, json.dumps({"messages": messages}), 0, 0)],
        "id string, title string, chat string, created_at long, updated_at long",
    )
    path = chat.write_export(chat.export_chats(chats), str(tmp_path), "d")
    line = json.loads(spark.read.text(path).first()[0])
    assert line["title"] is None and "title" in line
    assert line["messages"] == [{"role": "user", "content": None}, {"role": "assistant", "content": "b", "model": "m"}]


MANY = " ".join(a + b + c for a in "bcdfghjk" for b in "aeiou" for c in "lmnprs")
# The grams that tell the second text's language are its rarest: they come after hundreds of others.
TEXTS = ["the cat and the hat", MANY + " " + MANY + " und das haus", "", None, "x", "1 2 3", "e", "et \U0001d4d0\U0001d4d1 la", "und die and the"]


def _ranked_by_hand(profiles, top):
    ranks = {}
    for r in profiles.collect():
        ranks.setdefault(r.lang, {})[r.gram] = r.lang_rank
    want = {}
    for i, t in enumerate(TEXTS):
        words = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        padded = " " + " ".join(words) + " " if words else " "
        counts = Counter(padded[k : k + 3] for k in range(len(padded) - 2))
        order = sorted(counts, key=lambda g: (-counts[g], g))
        missing = max(len(order), top)
        gains = {}
        for lang, known in ranks.items():
            shared = [missing - abs(rank - known[g]) for rank, g in enumerate(order, 1) if g in known]
            if shared:
                gains[lang] = sum(shared)
        best = max(gains, key=lambda x: (gains[x], x is not None, x or ""), default="")
        want[i] = (best or "und", missing * len(order) - gains[best] if gains else None)
    return want


def test_all_grams_of_a_text_are_ranked(spark, monkeypatch):
    train = [("en", "the cat and the hat"), ("de", "der hund und das haus"), ("fr", "le chat et la maison \U0001d4d0\U0001d4d1")]
    train.append((None, "xyz " + train[0][1]))
    profiles = language.language_profiles(spark.createDataFrame(train, "lang string, text string"), "lang", "text", 20)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    want = _ranked_by_hand(profiles, 20)
    assert want[1][0] == "de"
    for chunk in (language.CHUNK, 50):
        monkeypatch.setattr(language, "CHUNK", chunk)
        got = language.identify_ranked(df, "i", "text", profiles, 20)
        assert {r.i: (r.language, r.distance) for r in got.collect()} == want
    monkeypatch.setattr(language, "SENT_BYTES", 10)
    joined = language.identify_ranked(df, "i", "text", profiles, 20)
    assert {r.i: (r.language, r.distance) for r in joined.collect()} == want


def test_lang_id_ranks_a_texts_own_grams(spark, tmp_path):
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3]) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.queries()["lang_id"](spark, str(tmp_path))
    want = _ranked_by_hand(language.language_profiles(docs, "lang", "text"), language.TOP)
    assert {r.doc_id: (r.language, r.distance) for r in got.collect()} == want


def test_logs_clean_every_text_once_and_without_python(spark, tmp_path):
    rows = [(1, "some words of a text", "en", "a"), (2, "some words of a text", "en", "b"), (3, None, None, None), (None, "x" * 20, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    log = registry.queries()["clean_audit_log"](spark, str(tmp_path))
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "documents.parquet" not in plan
    final = {r.target_id: r.details for r in log.filter("step = 'finalize_cleaned'").collect()}
    assert final["1"].endswith("|") and final["2"].endswith("|dup_exact") and "too_short" in final["3"]


def test_ideographic_blanks_need_no_composition(values):
    texts = ["　 a、b。", "が", "é", "กู่", "กู่", None]
    assert values(texts, text.maybe_not_nfc) == [False, True, True, False, True, None]


def test_lines_are_parsed_once(spark, tmp_path):
    rows = [("a", 1, '{"text": "x"}'), ("a", 2, '{"text": 1}'), ("a", 3, "no"), ("a", 4, '{"text": "y"} 2'), ("a", 5, None), ("a", 6, "[1]")]
    lines = spark.createDataFrame(rows, "file_path string, line_no long, value string")
    for stage in (None, str(tmp_path / "stage")):
        good, bad = jsonl.split_parsed(lines, stage)
        raw = jsonl.raw_records(good)
        assert [(r.line_no, r.text) for r in raw.collect()] == [(1, "x")]
        want = {2: ("text:not_string", rows[1][2]), 3: ("json_error", "no"), 4: ("json_error", rows[3][2]), 5: ("json_error", None), 6: ("type:not_object", "[1]")}
        assert {r.line_no: (r.reason, r.value) for r in bad.collect()} == want
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (raw, bad)]
        # Unstored: in the filter and in the projection above it.
        assert max(p.count("parse_json") + p.count("parseJson") for p in plans) <= (0 if stage else 2)
