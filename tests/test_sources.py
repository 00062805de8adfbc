import json

from pyspark.sql import functions as F

from corpusprep.functions import metadata
from corpusprep.operators import clean, enrich
from corpusprep.sources import jsonl, tables

LINES = [
    '{"text": "good", "source": " web ", "source_id": "None", "meta": {"a": 1}}',
    "{broken",
    "",
    "[1, 2]",
    '{"text": "x"} trailing',
    '{"text": 5}',
    '{"source": "s", "source_id": 12}',
    '{"text": "", "filename": "f.txt", "meta": "{\\"k\\": [1, 2]}"}',
    '{"text": "m", "meta": "{\'k\': None, \'t\': True}"}',
    '{"text": "m", "meta": "free text", "created_date": "2024-01-01"}',
    '{"text": "m", "meta": "NaN"}',
    '{"text": "a"} {"text": "b"}',
]


def write_lines(folder, lines, name="part.jsonl"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_line_numbers_count_broken_and_blank_lines(spark, tmp_path):
    lines = jsonl.read_lines(spark, write_lines(tmp_path / "a", LINES))
    assert [r.value for r in lines.orderBy("line_no").collect()] == LINES
    assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(1, len(LINES) + 1))


def test_a_line_cannot_close_the_list_it_is_read_in(spark, tmp_path):
    broken = ['{"text":"x"}]', '{"text":"x"}] junk', '{"text":"x"}, 1', '{"text":"x"}, "y"]']
    good, bad = jsonl.split_parsed(jsonl.read_lines(spark, write_lines(tmp_path / "z", [*broken, '{"text":"x"}'])))
    assert [r.line_no for r in good.collect()] == [5] and bad.count() == 4


def test_numbers_do_not_depend_on_later_split_settings(spark, tmp_path):
    content = [f"{n:06d} " + "x" * (n % 40) for n in range(12_000)]
    folder = write_lines(tmp_path / "s", content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        lines = jsonl.read_lines(spark, folder)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "70000")
        rows = lines.orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in rows] == content and [r.line_no for r in rows] == list(range(1, len(content) + 1))


def test_line_numbers_over_many_splits_and_files(spark, tmp_path):
    texts = {f"f{i}.jsonl": [f"{i}-{n:05d} " + "x" * (n % 50) for n in range(4000)] for i in range(3)}
    for name, content in texts.items():
        write_lines(tmp_path / "b", content, name)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = jsonl.read_lines(spark, str(tmp_path / "b"))
        rows = lines.select(F.substring_index("file_path", "/", -1).alias("f"), "line_no", "value").collect()
        limited = jsonl.read_lines(spark, str(tmp_path / "b"), limit=5).groupBy("file_path").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 12000
    assert all(texts[r.f][r.line_no - 1] == r.value for r in rows)
    assert [r["count"] for r in limited] == [5, 5, 5]


def test_quarantine(spark, tmp_path):
    good, bad = jsonl.split_parsed(jsonl.read_lines(spark, write_lines(tmp_path / "c", LINES)))
    reasons = {r.line_no: r.reason for r in bad.collect()}
    assert reasons == {2: "json_error", 3: "json_error", 4: "type:not_object", 5: "json_error", 6: "text:not_string", 12: "json_error"}
    assert sorted(r.line_no for r in good.collect()) == [1, 7, 8, 9, 10, 11]


def test_raw_records_and_metadata(spark, tmp_path):
    good, _ = jsonl.split_parsed(jsonl.read_lines(spark, write_lines(tmp_path / "d", LINES)))
    named = clean.name_records(jsonl.raw_records(good), F.lit("part"))
    full = clean.collect_metadata(named, "text")
    rows = {r.line_no: r for r in full.withColumn("m", F.to_json("metadata")).drop("metadata").collect()}
    assert (rows[1].source, rows[1].filename) == ("web", "web_0000001.txt")
    assert (rows[7].source, rows[7].filename) == ("s", "12")
    assert (rows[8].source, rows[8].filename) == ("part", "f.txt")
    assert json.loads(rows[1].m) == {"a": 1}
    assert json.loads(rows[8].m) == {"k": [1, 2]}
    assert json.loads(rows[9].m) == {"k": None, "t": True}
    assert json.loads(rows[10].m) == {"raw_meta": "free text", "created_date": "2024-01-01"}
    assert json.loads(rows[11].m) == {}
    assert rows[7].text == ""


def test_reserved_keys_leave_the_metadata(spark):
    meta = spark.createDataFrame([('{"bucket": "b", "line_no": 3, "keep": 1}',)], "m string")
    row = meta.select(F.to_json(metadata.drop_reserved(metadata.parse_metadata(F.col("m")))).alias("r")).first()
    assert json.loads(row.r) == {"keep": 1}


def test_links_join_metadata(spark):
    rows = spark.createDataFrame(
        [('{"links_all": ["http://old.example"]}', "http://new.example http://old.example", None, None)],
        "meta string, text string, created_date string, updated_date string",
    )
    merged = clean.collect_metadata(rows, "text")
    row = merged.select(metadata.strings_of(F.col("metadata"), "links_all").alias("l")).first()
    assert row.l == ["http://old.example", "http://new.example"]


def test_tolerant_scan(spark, tmp_path):
    lines = [
        '{"text": "", "body": " b "}',
        '{"text": 0, "content": "c"}',
        '{"text": 5, "body": "never"}',
        '{"text": [], "body": "after empty list"}',
        "{bad",
        "",
        '{"text": "t", "checksum": "given"}',
        '{"text": "  "}',
    ]
    found = jsonl.tolerant_texts(jsonl.scan_lines(spark, write_lines(tmp_path / "e", lines)))
    rows = {r.text: r.checksum for r in found.collect()}
    assert set(rows) == {"b", "c", "after empty list", "t"}
    assert rows["t"] == "given"
    assert len(rows["b"]) == 64


def test_listing(spark, tmp_path):
    write_lines(tmp_path / "f" / "x", ["{}"], "b.jsonl")
    write_lines(tmp_path / "f", ["{}"], "a.jsonl")
    write_lines(tmp_path / "f", ["{}"], "c.txt")
    keys = jsonl.list_keys(spark, str(tmp_path / "f"))
    assert keys.count() == 2
    assert jsonl.first_key(keys).first().file_path.endswith("a.jsonl")
    assert jsonl.first_key(keys, "forced").first().file_path == "forced"


def test_json_sink_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("กำ", None)], "a string, b string").coalesce(1)
    jsonl.write_jsonl(df, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text(encoding="utf-8").strip() == '{"a":"กำ","b":null}'


def url_map(spark, tmp_path, content):
    (tmp_path / "map.csv").write_text(content, encoding="utf-8")
    return tables.read_url_map(spark, str(tmp_path / "map.csv"))


def test_url_map_headers(spark, tmp_path):
    rows, headers = url_map(spark, tmp_path, chr(0xFEFF) + "FileName,note,URL\nd/a.txt,n,http://1\na.txt,n,http://2\nb.txt,n,\n,n,http://3\n")
    assert headers is None
    assert [(r.filename, r.url) for r in enrich.last_url_per_name(rows).collect()] == [("a.txt", "http://2")]
    assert [r.filename for r in enrich.duplicate_names(rows).collect()] == ["a.txt"]


def test_url_map_without_headers_is_empty(spark, tmp_path):
    rows, headers = url_map(spark, tmp_path, "name,link\na,b\n")
    assert (rows.count(), headers) == (0, ["name", "link"])
    log = enrich.side_table_log(rows, headers, F.lit("now")).collect()
    assert [(r.status, r.details) for r in log] == [("failed", "missing_headers:name,link")]


def test_optional_input(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "absent"), "a string").count() == 0
