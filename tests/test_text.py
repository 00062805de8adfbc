import hashlib
import unicodedata
from html import unescape as python_unescape

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.functions import html, keys, links, text

NBSP, ZW = chr(0xA0), chr(0x200B)


def test_unescape_in_order_and_case_sensitive(values):
    given_texts = ["a\\r\\nb", "a\\nb\\tc", "x\\u00A0y", "x\\u00a0y", "\\r", None, "plain"]
    got = values(given_texts, text.unescape)
    assert got == ["a\nb", "a\nb\tc", f"x{NBSP}y", "x\\u00a0y", "\\r", None, "plain"]


def test_normalize_unicode(values):
    decomposed = "e" + chr(0x301)
    # Thai tone mark before a below vowel: canonical order puts the vowel first.
    disordered = chr(0x0E01) + chr(0x0E48) + chr(0x0E38)
    got = values([decomposed, f"a{NBSP}b{ZW}c", "a\r\nb\rc", None, disordered], text.normalize_unicode)
    assert got == ["é", "a bc", "a\nb\nc", "", unicodedata.normalize("NFC", disordered)]


def test_normalize_whitespace(values):
    ideographic = chr(0x3000)
    got = values(
        ["a \t b", "a\t\nb", "a\n\n\n\nb", f" {ideographic}\n x {ideographic}", "a b", "\t"], text.normalize_whitespace
    )
    assert got == ["a b", "a \nb", "a\n\nb", "x", "a b", ""]


def test_script_ratio_and_gate(values):
    thai, mixed, emoji = "สวัสดี", "กabcdefghi", "🙂a"
    assert values([thai, mixed, "abc", "", emoji], text.script_ratio) == [1.0, 0.1, 0.0, 0.0, 0.0]
    gate = values([thai, mixed], lambda c: text.language_gate(text.script_ratio(c)))
    assert gate == ["th", None]


def test_counts_and_checksum(values):
    sample = "กำ🙂a b2-c"
    assert values([sample], text.char_count) == [len(sample)]
    assert values([sample, "", "  "], text.word_count) == [4, 0, 0]
    assert values([sample], text.checksum) == [hashlib.sha256(sample.encode()).hexdigest()]


def test_rounding_is_half_even(spark):
    row = spark.range(1).select(text.round_half_even(F.lit(0.0625), 3).alias("r")).first()
    assert row.r == 0.062


def test_token_budget(values):
    assert [text.token_budget(n) for n in (514, 512, 100, 1)] == [510, 510, 98, 2]
    assert values(["a b  c", "a b", "  a\nb\tc  d "], lambda c: text.cut_to_budget(c, 2)) == ["a b", "a b", "a b"]


def html_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r.t for r in html.with_text(df, "v", "t").orderBy("i").collect()]


def test_html_to_text(spark):
    page = "<SCRIPT a='1'>var x='</p>'\n</Script ><style>p{}</style><!-- no\n --><p>a &amp;lt; b&nbsp;c</p>1 < 2"
    assert html_of(spark, [page, "none", None]) == [f"a &lt; b{NBSP}c1 < 2", "none", None]


def test_uncommon_entities_go_through_python(spark):
    texts = ["&eacute; &#3585; &amp;", "&copy", "&amp;eacute;", "AT&T"]
    assert html_of(spark, texts) == [python_unescape(t) for t in texts]


def test_rare_rows_equal_native_rows(spark):
    """The Python path and the built-in path give the same result on texts both can do."""
    texts = [f"a{NBSP}<b>x</b>\r\n&amp; {ZW}y", "<script>q</script>plain", "tail &quot;"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    native = html.with_visible_text(df, "v", "n", "t").orderBy("i").collect()
    batch = df.withColumn("r", html._rare_batch(F.col("v"))).orderBy("i").collect()
    assert [(r.n, r.t) for r in native] == [(r.r.visible, r.r.text) for r in batch]


def test_links(values):
    body = (
        f"see http://A.example/x?y=1#top. and http://a.example/x?y=1, (HTTPS://B.Example/p)”"
        f" http://c.example{NBSP}end http://[bad/p]"
    )
    got = values([body, None, "none"], links.extract_urls)
    assert got[0] == ["http://a.example/x?y=1", "https://b.example/p", "http://c.example", "http://[bad/p"]
    assert got[1:] == [[], []]


def test_normalize_url(values):
    got = values(
        ["HTTP://H.example:80/A?q=B#f", " http://h.example?a=1 ", "http://h.example/?", "notaurl#x", None, "http://[::1]/p"],
        links.normalize_url,
    )
    assert got == ["http://h.example:80/A?q=B", "http://h.example?a=1", "http://h.example/", "notaurl", "", "http://[::1]/p"]


def test_merge_links(spark):
    rows = spark.createDataFrame([(["b", "a", None, ""], ["a", "c"]), (None, None)], "p array<string>, l array<string>")
    got = [r.m for r in rows.select(links.merge_links(F.col("p"), F.col("l")).alias("m")).collect()]
    assert got == [["b", "a", "c"], []]


def test_normalize_key(values):
    got = values(["/a//b\\c/", " x ", "", "//"], lambda c: keys.normalize_key(F.lit("/raw/"), c, F.lit("f.jsonl")))
    assert got == ["raw/a/b/c/f.jsonl", "raw/x/f.jsonl", "raw/f.jsonl", "raw/f.jsonl"]


def test_basename_and_blank(values):
    assert values(["a/b.txt", "b.txt", " a/ ", None], keys.basename) == ["b.txt", "b.txt", "a/", ""]
    assert values([None, " ", "None", "x"], keys.is_blank) == [True, True, True, False]


def test_stage_paths(values):
    def path(name):
        return lambda c: getattr(keys.stage_paths(c), name)

    raw = ["raw/org/site/jsonl/site.jsonl", "raw/top.jsonl", "raw/raw/x.jsonl"]
    assert values(raw, path("cleaned")) == [
        "cleaned/org/site/jsonl/site.cleaned.jsonl",
        "cleaned/top.cleaned.jsonl",
        "cleaned/raw/x.cleaned.jsonl",
    ]
    assert values(raw, path("mapped"))[0] == "mapping/org/site/site.mapped.jsonl"
    assert values(raw, path("mapping_log"))[0] == "meta/mapping_logs/site/site.map.log.jsonl"
    assert values(raw, path("validation_log"))[0] == "meta/validation_logs/org/site/jsonl/site.validated.log.jsonl"
    assert values(["raw/a", "cleaned/a", "rawer/a"], keys.below_prefix) == [True, False, False]


def test_timestamps_and_ids(spark):
    row = spark.range(1).select(
        keys.iso_from_epoch(F.lit(1_700_000_000)).alias("s"),
        keys.iso_from_epoch(F.lit(1_700_000_000_999)).alias("ms"),
        keys.iso_plus7(F.lit("2024-01-01 20:00:00").cast("timestamp")).alias("th"),
        keys.stable_uuid(F.lit("a"), F.lit(1)).alias("u"),
        keys.stable_uuid(F.lit("a"), F.lit(1)).alias("again"),
        keys.stable_uuid(F.lit("a1"), F.lit(None)).alias("other"),
    ).first()
    assert row.s == row.ms == "2023-11-14T22:13:20"
    assert row.th == "2024-01-02T03:00:00+07:00"
    assert row.u == row.again != row.other
    assert len(row.u) == 36


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \t\n\r.<>é" + NBSP + ZW), max_size=30), min_size=1, max_size=20))
def test_whitespace_is_idempotent_and_matches_python(texts):
    import re

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        from corpusprep.session import local_session

        spark = local_session("4", 4)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    once = text.normalize_whitespace(text.normalize_unicode(F.col("v")))
    twice = text.normalize_whitespace(F.col("once"))
    rows = df.select("i", once.alias("once")).select("i", "once", twice.alias("twice")).orderBy("i").collect()
    for source, row in zip(texts, rows):
        plain = unicodedata.normalize("NFC", source).replace(NBSP, " ").replace(ZW, "")
        plain = plain.replace("\r\n", "\n").replace("\r", "\n")
        plain = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", plain)).strip()
        assert row.once == row.twice == plain
