import hashlib
import json
from datetime import datetime

from pyspark.sql import functions as F

from corpusprep.operators import clean, enrich, validate
from corpusprep.operators.clean import CleanConfig
from corpusprep.operators.keyed import mark_first, outer_merge, salted_lookup
from corpusprep.plans.prepare import PrepareConfig, prepare

AT = "2024-02-01T07:00:00+07:00"


def test_clean_verdicts_first_rule_wins(spark):
    thai = "สวัสดีชาวโลกทุกคน"
    rows = [("f", 1, thai), ("f", 2, "ab"), ("f", 3, "latin letters only"), ("f", 4, f" {thai} "), ("g", 1, thai), ("f", 5, None)]
    cleaned = clean.clean(spark.createDataFrame(rows, "file_path string, line_no long, text string"))
    got = {(r.file_path, r.line_no): (r.status, r.reason) for r in cleaned.collect()}
    assert got == {
        ("f", 1): ("cleaned", ""),
        ("f", 2): ("failed", "too_short:2"),
        ("f", 3): ("failed", "thai_ratio_low:0.00"),
        ("f", 4): ("failed", "dup_exact"),
        ("g", 1): ("cleaned", ""),
        ("f", 5): ("failed", "too_short:0"),
    }


def test_clean_log_lists_the_steps_that_changed_text(spark):
    rows = [(1, "f", "a\\tb" + chr(0xA0) + "<i>c</i>&nbsp;d  e"), (2, "f", "plain text here")]
    config = CleanConfig(min_ratio=0.0)
    cleaned = clean.clean(spark.createDataFrame(rows, "line_no long, file_path string, text string"), config)
    log = clean.clean_log(cleaned, F.lit(AT), "line_no").collect()
    steps = {}
    for r in log:
        steps.setdefault(r.target_id, {})[r.step] = (r.status, r.details)
    assert list(steps["2"]) == ["validate_input", "remove_html", "normalize_whitespace", "finalize_cleaned"]
    assert steps["2"]["normalize_whitespace"] == ("success", "no_change")
    assert set(steps["1"]) >= {"unescape_backslashes", "normalize_unicode", "post_soup_nbsp"}
    assert json.loads(steps["2"]["finalize_cleaned"][1])["reason"] == ""
    assert len({r.log_id for r in log}) == len(log)


def record(**changes):
    body = changes.get("text", "some text")
    digest = hashlib.sha256(str(body).encode()).hexdigest()
    base = dict(id="x", filename="f", source="s", text=body, checksum=digest, status="cleaned", processed_at=AT,
                word_count=2, char_count=len(str(body)))
    base.update(changes)
    return {k: v for k, v in base.items() if v != "ABSENT"}


def test_every_validation_rule(spark):
    cases = [
        (record(), None),
        (record(), "dup_checksum_in_file"),
        (record(source="ABSENT", filename="ABSENT"), "missing_field:filename"),
        (record(filename=" "), "bad_filename"),
        (record(filename=None), "bad_filename"),
        (record(filename=7), "bad_filename"),
        (record(source=""), "bad_source"),
        (record(text=""), "bad_text_len:0"),
        (record(text=5), "bad_text_len:NA"),
        (record(checksum="A" * 64), "bad_checksum_format"),
        (record(checksum="a" * 64 + "\n"), "bad_checksum_format"),
        (record(status="failed"), "bad_status:failed"),
        (record(processed_at="yesterday"), "bad_processed_at_format"),
        (record(processed_at="2024-02-01T00:00:00Z", text="zulu"), None),
        (record(word_count=-1), "bad_word_count"),
        (record(word_count=1.5), "bad_word_count"),
        (record(word_count=None, text="no count"), None),
        (record(char_count=-1), "bad_char_count"),
        (record(char_count="9"), "bad_char_count"),
        (record(char_count=3), "char_count_mismatch:3!=9"),
        (record(checksum="a" * 64), "checksum_mismatch"),
        # The first copy is rejected, so the second passes.
        (record(text="copy", filename=" "), "bad_filename"),
        (record(text="copy"), None),
        (record(text="copy"), "dup_checksum_in_file"),
    ]
    lines = [("f", i, json.dumps(r)) for i, (r, _) in enumerate(cases)] + [("f", 900, "{no"), ("f", 901, "[1]")]
    checked = validate.validate_lines(spark.createDataFrame(lines, "file_path string, line_no long, value string"))
    got = {r.line_no: r.reason for r in checked.select("line_no", "reason").collect()}
    assert got == {**{i: reason for i, (_, reason) in enumerate(cases)}, 900: "json_error", 901: "type:not_object"}


def test_iso_timestamps_as_python_reads_them(values):
    given_texts = [
        AT, "2024-02-01", "2024-02-01T10:00:00Z", "20240201T100000", "2024-02-30T10:00:00", "2024-02-01T25:00:00",
        "2024-02-01 10:00", "2024-02-01T10", "yesterday", "", "2024-W05-1", "2024-02-01T10:61", "2024-13-01",
        "2024-02-01T10:00:00.123456", "2024-02-01T10:00:00+0700", "2024-02-01T10:00:00+07:00Z", " 2024-02-01T07:00:00 ",
    ]

    def python(value):
        value = value.strip()
        try:
            datetime.fromisoformat(value[:-1] + "+00:00" if value.endswith("Z") else value)
            return True
        except ValueError:
            return False

    assert values(given_texts, validate.is_iso_timestamp) == [python(v) for v in given_texts]


def test_map_urls_policies(spark):
    side = spark.createDataFrame([("a.txt", "http://new", 1)], "filename string, url string, line_no long")
    rows = spark.createDataFrame(
        [(1, "x/a.txt", None), (2, "a.txt", "http://old"), (3, "a.txt", ""), (4, "b.txt", "http://old"), (5, "", None), (6, "a.txt", "{}")],
        "id int, name string, old string",
    )

    def run(prefer):
        mapped = enrich.map_urls(rows, side, enrich.lookup_name(F.col("name")), F.col("old"), ["id"], prefer)
        return {r.id: (r.url, r.map_status, r.url_written) for r in mapped.collect()}

    kept = run(False)
    assert kept[1] == ("http://new", "mapped", True)
    assert kept[2] == ("http://old", "mapped", False)
    assert kept[3] == kept[6] == ("http://new", "mapped", True)
    assert kept[4] == ("http://old", "unmapped", False)
    assert kept[5] == (None, "unmapped", False)
    assert run(True)[2] == ("http://new", "mapped", True)


def test_resolve_dataset_takes_the_deepest_name(spark):
    sets = spark.createDataFrame([("1", "org"), ("2", "site"), ("3", "file")], "id string, name string")
    paths = ["/raw/org/site/file.v1.jsonl", "raw/org/other/x.jsonl", "none/at/all", "org.site/file"]
    rows = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    got = {r.i: r.dataset_id for r in enrich.resolve_dataset(rows, sets, "path", ["i"]).collect()}
    assert got == {0: "3", 1: "1", 2: None, 3: "1"}


def test_mark_first_with_one_hot_key(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    marked = mark_first(rows, ["k"], [], "n")
    assert marked.filter("is_first").count() == 10_001
    assert marked.filter("k = 'hot' AND is_first").first().n == 1
    assert "Window" not in marked._jdf.queryExecution().executedPlan().toString()


def test_salted_lookup_equals_a_plain_join(spark):
    left = spark.range(5_000).select("id", (F.col("id") % 7).alias("k"))
    right = spark.createDataFrame([(0, "a"), (3, "b")], "k long, v string")
    for how in ("left", "inner"):
        plain = sorted(tuple(r) for r in left.join(right, "k", how).select("id", "k", "v").collect())
        salted = salted_lookup(left, right, ["k"], ["id"], how).select("id", "k", "v").collect()
        assert sorted(tuple(r) for r in salted) == plain


def test_outer_merge_equals_full_joins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, b int")
    joined = a.join(b, "k", "full")
    assert sorted(map(str, outer_merge([a, b], ["k"]).collect())) == sorted(map(str, joined.select("k", "a", "b").collect()))


def test_prepare_end_to_end(spark, tmp_path):
    thai = "สวัสดีชาวโลกทุกคน"
    rows = [
        ("raw/org/site/jsonl/site.jsonl", 1, thai, " ", "d/a.txt", None, '{"url": "http://old"}', "2024-01-01", None),
        ("raw/org/site/jsonl/site.jsonl", 2, thai, "web", None, None, None, None, None),
        ("raw/org/site/jsonl/site.jsonl", 3, thai + " http://Link.example/x.", "web", None, "b.txt", None, None, None),
        ("raw/org/site/jsonl/site.jsonl", 4, "x", "web", None, None, None, None, None),
        ("raw/org/other.jsonl", 1, thai + "ใหม่", "web", None, None, "junk", None, None),
    ]
    schema = "file_path string, line_no long, text string, source string, filename string, source_id string, meta string, created_date string, updated_date string"
    side = spark.createDataFrame([("b.txt", "http://b", 1), ("a.txt", "http://a", 2)], "filename string, url string, line_no long")
    sets = spark.createDataFrame([("1", "org"), ("2", "site")], "id string, name string")
    known = spark.createDataFrame([(hashlib.sha256((thai + "ใหม่").encode()).hexdigest(),)], "checksum string")
    results = []
    for stage in (None, str(tmp_path / "stage")):
        out = prepare(spark.createDataFrame(rows, schema), side, known, sets, F.lit(AT), PrepareConfig(root=None), stage)
        docs = out.documents.withColumn("m", F.to_json("metadata")).drop("metadata").orderBy("line_no").collect()
        results.append([(r.title, r.source, r.dataset_id, r.status, r.language, json.loads(r.m)) for r in docs])
        counts = {name: {r.file_path: r.asDict() for r in c.collect()} for name, c in out.counters.items()}
        site = "raw/org/site/jsonl/site.jsonl"
        assert (counts["clean"][site]["n_in"], counts["clean"][site]["n_cleaned"], counts["clean"][site]["n_failed"]) == (4, 2, 2)
        assert (counts["validate"][site]["n_ok"], counts["map"][site]["n_mapped"]) == (2, 2)
        logs = out.logs.groupBy("step", "status").count().collect()
        assert {(r.step, r.status): r["count"] for r in logs}[("map", "unmapped")] == 1
    assert results[0] == results[1] == [
        ("d/a.txt", "site", "2", "ingested", "th", {"url": "http://old", "created_date": "2024-01-01"}),
        ("b.txt", "web", "2", "ingested", "und", {"links_all": ["http://link.example/x"], "url": "http://b"}),
    ]


def test_prepare_with_language_profiles(spark, tmp_path):
    from corpusprep.operators.language import language_profiles

    train = spark.createDataFrame(
        [("en", "the cat sat on the mat and the dog ran with the ball"), ("de", "der hund und die katze sind auf der matte und ich")],
        "lang string, text string",
    )
    texts = ["the dog and the mat with the cat", "die katze und der hund auf der matte", "สวัสดีชาวโลกทุกคน", "12345678901234"]
    rows = [("raw/x.jsonl", i, t) + (None,) * 6 for i, t in enumerate(texts, 1)]
    schema = "file_path string, line_no long, text string, source string, filename string, source_id string, meta string, created_date string, updated_date string"
    empty = spark.createDataFrame([], "filename string, url string, line_no long")
    out = prepare(
        spark.createDataFrame(rows, schema),
        empty,
        spark.createDataFrame([], "checksum string"),
        spark.createDataFrame([], "id string, name string"),
        F.lit(AT),
        PrepareConfig(root=None, clean=CleanConfig(min_ratio=0.0)),
        str(tmp_path / "stage"),
        language_profiles(train, "lang", "text"),
    )
    got = {r.line_no: (r.language, r.dataset_id) for r in out.documents.select("line_no", "language", "dataset_id").collect()}
    assert got == {1: ("en", None), 2: ("de", None), 3: ("th", None), 4: ("und", None)}
