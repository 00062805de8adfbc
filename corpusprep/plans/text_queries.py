"""Queries over text expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, keys, links, text
from .registry import Tables, query

LATIN = "A-Za-z"

# SQL list of the characters strip() removes, and the zero-width ones, built by code point.
SQL_BLANKS = " || ".join(f"chr({ord(c)})" for c in text.BLANKS)


def sql_whitespace(expr: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace({expr}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), "
        f"{SQL_BLANKS})"
    )


def sql_unicode(expr: str) -> str:
    expr = f"replace(nfc_normalize({expr}), chr(160), ' ')"
    for code in (0x200B, 0x200C, 0x200D):
        expr = f"replace({expr}, chr({code}), '')"
    return f"replace(replace({expr}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def sql_unescape(expr: str) -> str:
    for escape, char in text.ESCAPES:
        expr = f"replace({expr}, '{escape}', chr({ord(char)}))"
    return expr


def sql_html(expr: str) -> str:
    for pattern in (
        "(?is)<script\\b[^>]*>.*?</script\\s*>",
        "(?is)<style\\b[^>]*>.*?</style\\s*>",
        "(?s)<!--.*?-->",
        "</?[A-Za-z][^>]*>|<[!?][^>]*>",
    ):
        expr = f"regexp_replace({expr}, '{pattern}', '', 'g')"
    for name, char in html.ENTITIES:
        expr = f"replace({expr}, '&{name};', chr({ord(char)}))"
    return expr


def sql_script_chars(expr: str, script: str) -> str:
    return f"(length({expr}) - length(regexp_replace({expr}, '[{script}]+', '', 'g')))"


def sql_ratio(expr: str, script: str) -> str:
    return f"CASE WHEN length({expr}) > 0 THEN {sql_script_chars(expr, script)}::DOUBLE / length({expr}) ELSE 0 END"


def sql_word_count(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+'))"


DIRTY_HEAD = "chr(12288) || ' '"
DIRTY_TAIL = (
    "'\\r\\n\\n\\t tail\\u00A0\\u200B  end ' || chr(13) || chr(10) || chr(13) || chr(160) || chr(8203) "
    "|| chr(9) || chr(9) || chr(10) || chr(10) || chr(10) || chr(10) || '  x' || chr(10) || chr(9)"
)


def dirty_documents(t: Tables) -> DataFrame:
    """Documents wrapped in escapes, tabs, blank lines and invisible characters: the given texts are clean."""
    tail = (
        "\\r\\n\\n\\t tail\\u00A0\\u200B  end \r\n\r" + chr(160) + chr(8203) + "\t\t\n\n\n\n  x\n\t"
    )
    dirty = F.concat(F.lit(chr(12288) + " "), F.col("text"), F.lit(tail))
    return t.spread("documents", "doc_id").select("doc_id", dirty.alias("text"))


@query(
    "text_clean",
    f"""
    SELECT doc_id, sha256(clean) AS checksum, length(clean)::BIGINT AS n_chars
    FROM (SELECT doc_id, {sql_whitespace(sql_unicode(sql_unescape(f"{DIRTY_HEAD} || text || {DIRTY_TAIL}")))} AS clean
          FROM documents)
    """,
)
def text_clean(t: Tables) -> DataFrame:
    dirty = dirty_documents(t)
    clean = dirty.withColumn("text", text.unescape(F.col("text")))
    clean = clean.withColumn("text", text.normalize_unicode(F.col("text")))
    clean = clean.withColumn("text", text.normalize_whitespace(F.col("text")))
    return clean.select(
        "doc_id", text.checksum(F.col("text")).alias("checksum"), text.char_count(F.col("text")).alias("n_chars")
    )


@query(
    "nfc_text",
    """
    SELECT doc_id, sha256(nfc_normalize(raw)) AS checksum, length(raw)::BIGINT AS raw_chars,
           length(nfc_normalize(raw))::BIGINT AS nfc_chars
    FROM (SELECT doc_id, replace(replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776)), 'ñ',
                                 'n' || chr(771)) AS raw
          FROM documents)
    """,
)
def nfc_text(t: Tables) -> DataFrame:
    raw = F.col("text")
    for char, base, mark in (("é", "e", 769), ("ü", "u", 776), ("ñ", "n", 771)):
        raw = F.replace(raw, F.lit(char), F.lit(base + chr(mark)))
    rows = t.spread("documents", "doc_id").select("doc_id", raw.alias("raw")).withColumn("nfc", text.nfc(F.col("raw")))
    return rows.select(
        "doc_id",
        text.checksum(F.col("nfc")).alias("checksum"),
        text.char_count(F.col("raw")).alias("raw_chars"),
        text.char_count(F.col("nfc")).alias("nfc_chars"),
    )


@query(
    "html_text",
    f"""
    SELECT page_id, sha256(body) AS checksum, length(body)::BIGINT AS n_chars
    FROM (SELECT page_id, {sql_whitespace("replace(raw, chr(160), ' ')")} AS body
          FROM (SELECT page_id, {sql_html("html")} AS raw FROM pages))
    """,
)
def html_text(t: Tables) -> DataFrame:
    rows = html.with_text(t.spread("pages", "page_id").select("page_id", "html"), "html", "body")
    body = F.replace(F.col("body"), F.lit(text.NBSP), F.lit(" "))
    rows = rows.withColumn("body", text.normalize_whitespace(body))
    return rows.select(
        "page_id", text.checksum(F.col("body")).alias("checksum"), text.char_count(F.col("body")).alias("n_chars")
    )


@query(
    "script_ratio",
    f"""
    SELECT doc_id, {sql_script_chars("text", LATIN)}::BIGINT AS latin_chars, {sql_ratio("text", LATIN)} AS latin_ratio,
           {sql_ratio("text", "\\x{0E00}-\\x{0E7F}")} AS thai_ratio
    FROM documents
    """,
)
def script_ratio(t: Tables) -> DataFrame:
    body = F.col("text")
    return t.spread("documents", "doc_id").select(
        "doc_id",
        text.script_chars(body, LATIN).cast("long").alias("latin_chars"),
        text.script_ratio(body, LATIN).alias("latin_ratio"),
        text.script_ratio(body).alias("thai_ratio"),
    )


@query(
    "lang_gate",
    f"""
    SELECT doc_id, CASE WHEN trim(text, {SQL_BLANKS}) = '' THEN 'und' WHEN {sql_ratio("text", "a-z ")} >= 0.9 THEN 'la'
                   ELSE lang END AS language
    FROM documents
    """,
)
def lang_gate(t: Tables) -> DataFrame:
    """The gate decides where it can; elsewhere the detector's answer stands (here: the given code)."""
    gated = text.language_gate(text.script_ratio(F.col("text"), "a-z "), "la")
    language = F.when(text.strip(F.col("text")) == "", "und").otherwise(F.coalesce(gated, F.col("lang")))
    return t.documents.select("doc_id", language.alias("language"))


@query("checksum", "SELECT doc_id, sha256(text) AS checksum FROM documents")
def checksum(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.checksum(F.col("text")).alias("checksum"))


@query(
    "text_stats",
    f"SELECT doc_id, {sql_word_count('text')}::BIGINT AS word_count, length(text)::BIGINT AS char_count FROM documents",
)
def text_stats(t: Tables) -> DataFrame:
    body = F.col("text")
    return t.spread("documents", "doc_id").select(
        "doc_id", text.word_count(body).alias("word_count"), text.char_count(body).alias("char_count")
    )


@query(
    "extract_urls",
    """
    WITH found AS (
      SELECT doc_id,
             list_transform(
               regexp_extract_all(
                 text || ' see (HTTP://Example.ORG/' || source || '/' || doc_id || '?l=' || lang || '#top). Also <http://'
                      || source || '.Example.net/a' || chr(160) || 'b, http://example.org/' || source || '/' || doc_id
                      || '?l=' || lang || '.”', '(?i)https?://[^\\s\\x{A0})>\\]"}]+'),
               lambda u: rtrim(u, '.,);]}>"''!?、。’”')) AS raw
      FROM documents),
    clean AS (
      SELECT doc_id, list_transform(raw, lambda u:
               lower(regexp_extract(u, '^([A-Za-z]+://[^/?#]*)', 1)) ||
               regexp_extract(u, '^[A-Za-z]+://[^/?#]*([^#]*)', 1)) AS urls
      FROM found)
    SELECT doc_id, len(kept)::BIGINT AS n_links, array_to_string(kept, ' ') AS links
    FROM (SELECT doc_id, list_filter(urls, lambda u, i: list_position(urls, u) = i) AS kept FROM clean)
    """,
)
def extract_urls(t: Tables) -> DataFrame:
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("?l="), F.col("lang"))
    linked = F.concat(
        F.col("text"),
        F.lit(" see (HTTP://Example.ORG/"),
        path,
        F.lit("#top). Also <http://"),
        F.col("source"),
        F.lit(".Example.net/a" + text.NBSP + "b, http://example.org/"),
        path,
        F.lit(".”"),
    )
    rows = t.spread("documents", "doc_id").select("doc_id", links.extract_urls(linked).alias("urls"))
    return rows.select(
        "doc_id", F.size("urls").cast("long").alias("n_links"), F.array_join("urls", " ").alias("links")
    )


@query(
    "normalize_url",
    """
    SELECT page_id, url || '.)' AS raw_url, regexp_replace(url, '#.*$', '') AS url FROM pages
    """,
)
def normalize_url(t: Tables) -> DataFrame:
    """Page addresses with scheme and host in upper case and a trailing mark must come back as they were."""
    scheme_host = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    rest = F.substr(F.col("url"), F.length(scheme_host) + 1)
    raw = F.concat(F.upper(scheme_host), rest, F.lit(".)"))
    return t.pages.select(
        "page_id", F.concat("url", F.lit(".)")).alias("raw_url"), links.normalize_url(raw).alias("url")
    )


@query(
    "normalize_key",
    """
    SELECT page_id, 'raw/' || regexp_replace(replace(replace(url, '://', '/'), chr(92), '/'), '/+$', '')
           || '/' || page_id || '.jsonl' AS key
    FROM pages
    """,
)
def normalize_key(t: Tables) -> DataFrame:
    back = F.replace(F.replace(F.col("url"), F.lit("://"), F.lit("\\\\")), F.lit("/"), F.lit("//"))
    name = F.concat(F.lit("//"), F.col("page_id").cast("string"), F.lit(".jsonl "))
    key = keys.normalize_key(F.lit(" /raw/ "), back, F.lit("//"), name)
    return t.pages.select("page_id", key.alias("key"))


@query(
    "upper_text",
    "SELECT doc_id, sha256(upper(replace(text, 'ß', 'SS'))) AS checksum FROM documents",
)
def upper_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.checksum(F.upper("text")).alias("checksum"))


@query(
    "truncate_tokens",
    f"""
    SELECT doc_id, len(tokens)::BIGINT AS n_tokens,
           sha256(CASE WHEN len(tokens) > 510 THEN array_to_string(tokens[1:510], ' ') ELSE text END) AS checksum
    FROM (SELECT doc_id, text, string_split_regex(trim(text, {SQL_BLANKS}), '[\\s\\x{{A0}}]+') AS tokens
          FROM documents)
    """,
)
def truncate_tokens(t: Tables) -> DataFrame:
    body = F.col("text")
    tokens = F.size(F.split(text.strip(body), f"[{text.BLANK_CLASS}]+"))
    cut = text.cut_to_budget(body, text.token_budget())
    return t.spread("documents", "doc_id").select("doc_id", tokens.cast("long").alias("n_tokens"), text.checksum(cut).alias("checksum"))


@query(
    "epoch_norm",
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS created_at FROM events
    """,
)
def epoch_norm(t: Tables) -> DataFrame:
    """Clicks carry milliseconds, other events seconds; both must give the same text."""
    stamp = F.when(F.col("event_type") == "click", F.unix_millis("ts")).otherwise(F.unix_seconds("ts"))
    return t.events.select("event_id", keys.iso_from_epoch(stamp).alias("created_at"))
