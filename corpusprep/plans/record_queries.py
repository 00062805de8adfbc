"""Queries over whole records: naming, cleaning, validation, logs, counters, chats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import metadata, text
from ..operators import chat, clean, enrich, ingest, quality, validate
from ..operators.clean import CleanConfig
from ..operators.keyed import mark_first
from ..session import work_path
from .prepare import PrepareConfig, prepare
from .registry import Tables, query
from .text_queries import (
    DIRTY_HEAD,
    DIRTY_TAIL,
    LATIN,
    dirty_documents,
    sql_html,
    sql_ratio,
    sql_script_chars,
    sql_unescape,
    sql_unicode,
    sql_whitespace,
    sql_word_count,
)

# The given documents are European, so the script rule looks at Latin letters; the corpus is one scope.
CORPUS = CleanConfig(
    min_chars=10, min_ratio=0.5, script=LATIN, script_language="latin", scope=(), order="doc_id"
)
RUN_AT = "2024-02-01T07:00:00+07:00"
JUDGED = ["doc_id", "char_count", "script_ratio", "checksum"]
LOGGED = [*JUDGED, "steps", "original_chars"]


def cleaned(t: Tables, rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows of the corpus cleaned once: only narrow measured columns are stored and looked through for duplicates."""
    return clean.clean(rows, CORPUS, work_path(t.spark, "clean"), keep)


def sql_clean(raw: str = "text", extra: str = "source, lang", table: str = "documents") -> str:
    """CTEs t0..t5 (every text step), ``measured`` and ``cleaned`` of the given text."""
    return f"""
    t0 AS (SELECT doc_id, {extra}, {raw} AS x0 FROM {table}),
    t1 AS (SELECT *, {sql_unescape("x0")} AS x1 FROM t0),
    t2 AS (SELECT *, {sql_unicode("x1")} AS x2 FROM t1),
    t3 AS (SELECT *, {sql_html("x2")} AS x3 FROM t2),
    t4 AS (SELECT *, replace(x3, chr(160), ' ') AS x4 FROM t3),
    t5 AS (SELECT *, {sql_whitespace("x4")} AS x5 FROM t4),
    measured AS (
      SELECT *, x5 AS body, length(x5)::BIGINT AS char_count, {sql_ratio("x5", LATIN)} AS ratio,
             {sql_script_chars("x5", LATIN)} AS latin, sha256(x5) AS checksum FROM t5),
    cleaned AS (
      SELECT *, CASE WHEN reason = '' THEN 'cleaned' ELSE 'failed' END AS status FROM (
        SELECT *, CASE WHEN char_count < 10 THEN 'too_short:' || char_count
                       WHEN ratio < 0.5 THEN 'thai_ratio_low:' || printf('%.2f', round_even(ratio, 2))
                       WHEN row_number() OVER (PARTITION BY checksum ORDER BY doc_id) > 1 THEN 'dup_exact'
                       ELSE '' END AS reason
        FROM measured))"""


@query(
    "derive_filename",
    """
    SELECT doc_id, CASE lang WHEN 'fr' THEN 'fr/' || doc_id || '.txt' WHEN 'de' THEN doc_id::VARCHAR
                   ELSE source || '_' || lpad(doc_id::VARCHAR, 7, '0') || '.txt' END AS filename
    FROM documents
    """,
)
def derive_filename(t: Tables) -> DataFrame:
    """French rows bring a name, German ones an id, Spanish ones the text None, the rest nothing."""
    doc_id = F.col("doc_id").cast("string")
    given = F.when(F.col("lang") == "fr", F.concat(F.lit("fr/"), doc_id, F.lit(".txt"))).when(F.col("lang") == "es", "")
    source_id = F.when(F.col("lang") == "de", doc_id).when(F.col("lang") == "es", "None")
    stem = F.when(F.col("lang") == "de", F.lit("  ")).otherwise(F.col("source"))
    source = clean.source_or_stem(stem, F.col("source"))
    name = clean.filename_or_derived(given, source_id, source, F.col("doc_id"))
    return t.documents.select("doc_id", name.alias("filename"))


@query("clean_status", f"WITH {sql_clean()} SELECT doc_id, status, reason, checksum, char_count FROM cleaned")
def clean_status(t: Tables) -> DataFrame:
    rows = cleaned(t, t.spread("documents", "doc_id"), JUDGED)
    return rows.select("doc_id", "status", "reason", "checksum", "char_count")


@query(
    "exact_dedup",
    """
    SELECT doc_id, source, row_number() OVER (PARTITION BY source, sha256(text) ORDER BY doc_id) = 1 AS is_first
    FROM documents
    """,
)
def exact_dedup(t: Tables) -> DataFrame:
    """First copy of every text inside its source."""
    rows = t.documents.select("doc_id", "source", text.checksum(F.col("text")).alias("checksum"))
    return mark_first(rows, ["source", "checksum"], ["source"], "doc_id").select("doc_id", "source", "is_first")


@query(
    "clean_audit_log",
    f"""
    WITH {sql_clean(f"{DIRTY_HEAD} || text || {DIRTY_TAIL}")}
    SELECT doc_id::VARCHAR AS target_id, 'validate_input' AS step, 'success' AS status,
           '{{"original_chars":' || length(x0) || '}}' AS details FROM cleaned
    UNION ALL SELECT doc_id::VARCHAR, 'unescape_backslashes', 'success', 'applied' FROM cleaned WHERE x1 <> x0
    UNION ALL SELECT doc_id::VARCHAR, 'normalize_unicode', 'success', 'applied' FROM cleaned WHERE x2 <> x1
    UNION ALL SELECT doc_id::VARCHAR, 'post_soup_nbsp', 'success', 'replaced_nbsp' FROM cleaned WHERE x4 <> x3
    UNION ALL SELECT doc_id::VARCHAR, 'remove_html', 'success', 'applied' FROM cleaned
    UNION ALL SELECT doc_id::VARCHAR, 'normalize_whitespace', 'success',
                     CASE WHEN x5 <> x4 THEN 'collapsed' ELSE 'no_change' END FROM cleaned
    UNION ALL SELECT doc_id::VARCHAR, 'finalize_cleaned', CASE WHEN reason = '' THEN 'success' ELSE 'failed' END,
                     char_count || '|' || reason FROM cleaned
    """,
)
def clean_audit_log(t: Tables) -> DataFrame:
    """The ratio inside the final details is left out here: engines print doubles differently."""
    dirty = dirty_documents(t)
    log = clean.clean_log(cleaned(t, dirty, LOGGED), F.lit(RUN_AT), "doc_id")
    final = F.concat(
        F.get_json_object("details", "$.char_count"), F.lit("|"), F.get_json_object("details", "$.reason")
    )
    details = F.when(F.col("step") == "finalize_cleaned", final).otherwise(F.col("details"))
    return log.select("target_id", "step", "status", details.alias("details"))


def faulty_records(t: Tables) -> DataFrame:
    """Cleaned-looking records with one fault each, chosen by the first letter, source or length of the text.

    Copies from source ``src3`` have a blank name: where such a copy comes first, the next one must pass.
    """
    first = F.substring("text", 1, 1)
    size = F.length("text").cast("long")
    digest = F.sha2("text", 256)
    return t.spread("documents", "doc_id").select(
        "doc_id",
        F.when(F.col("source") == "src3", " ").otherwise(F.col("source")).alias("filename"),
        F.when(first == "A", "").otherwise(F.col("source")).alias("source"),
        F.col("text"),
        F.when(first == "B", F.upper(digest))
        .when(first == "G", F.sha2(F.concat("text", F.lit("x")), 256))
        .otherwise(digest)
        .alias("checksum"),
        F.when(first == "H", "failed").otherwise("cleaned").alias("status"),
        F.when(first == "C", "yesterday")
        .when(first == "I", "2024-02-30T10:00:00Z")
        .when(first == "L", "2024-02-01T10:00:00Z")
        .otherwise(RUN_AT)
        .alias("processed_at"),
        F.when(first == "D", F.lit(-1)).otherwise(F.lit(7)).cast("long").alias("word_count"),
        F.when(first == "E", F.lit(-1).cast("long"))
        .when(first == "F", size + 1)
        .when(first == "R", F.lit(None).cast("long"))
        .otherwise(size)
        .alias("char_count"),
    )


SQL_VALIDATED = f"""
    given AS (SELECT *, substr(text, 1, 1) AS f, length(text)::BIGINT AS n FROM documents),
    ruled AS (
      SELECT doc_id, sha256(text) AS checksum,
        CASE WHEN source = 'src3' THEN 'bad_filename' WHEN f = 'A' THEN 'bad_source'
             WHEN n < 12 THEN 'bad_text_len:' || n WHEN f = 'B' THEN 'bad_checksum_format'
             WHEN f = 'H' THEN 'bad_status:failed' WHEN f IN ('C', 'I') THEN 'bad_processed_at_format'
             WHEN f = 'D' THEN 'bad_word_count' WHEN f = 'E' THEN 'bad_char_count'
             WHEN f = 'F' THEN 'char_count_mismatch:' || (n + 1) || '!=' || n WHEN f = 'G' THEN 'checksum_mismatch'
        END AS rule
      FROM given),
    checked AS (
      SELECT doc_id, CASE WHEN rule IS NULL AND row_number() OVER (PARTITION BY checksum, rule IS NULL ORDER BY doc_id) > 1
                          THEN 'dup_checksum_in_file' ELSE rule END AS reason
      FROM ruled)"""


@query(
    "validate_records",
    f"""
    WITH {SQL_VALIDATED}
    SELECT doc_id, reason, CASE WHEN reason IS NULL THEN 'validated'
                                WHEN reason = 'bad_status:failed' OR (reason IS NOT NULL AND f = 'H') THEN 'failed'
                                ELSE 'cleaned' END AS status
    FROM checked JOIN (SELECT doc_id, substr(text, 1, 1) AS f FROM documents) USING (doc_id)
    """,
)
def validate_records(t: Tables) -> DataFrame:
    checked = validate.validate(faulty_records(t), [], "doc_id", min_chars=12)
    return checked.select("doc_id", "reason", "status")


@query(
    "run_counters",
    f"""
    WITH {sql_clean()}
    SELECT source, count(*) AS n_in, count(*) FILTER (status = 'cleaned') AS n_cleaned,
           count(*) FILTER (status = 'failed') AS n_failed
    FROM cleaned GROUP BY source
    """,
)
def run_counters(t: Tables) -> DataFrame:
    return quality.clean_counters(cleaned(t, t.spread("documents", "doc_id"), [*JUDGED, "source"]), ["source"])


@query(
    "reject_reasons",
    f"""
    WITH {sql_clean()}, {SQL_VALIDATED}
    SELECT step, 'failed' AS status, split_part(reason, ':', 1) AS reason, count(*) AS n_records
    FROM (SELECT 'finalize_cleaned' AS step, reason FROM cleaned WHERE reason <> ''
          UNION ALL SELECT 'validate', reason FROM checked WHERE reason IS NOT NULL)
    GROUP BY ALL
    """,
)
def reject_reasons(t: Tables) -> DataFrame:
    at = F.lit(RUN_AT)
    logs = ingest.union_logs(
        clean.clean_log(cleaned(t, t.spread("documents", "doc_id"), LOGGED), at, "doc_id"),
        validate.validation_log(validate.validate(faulty_records(t), [], "doc_id", min_chars=12), at, "doc_id"),
    )
    cleaned_reason = F.get_json_object("details", "$.reason")
    details = F.when(F.col("step") == "finalize_cleaned", cleaned_reason).otherwise(F.col("details"))
    return quality.reject_reasons(logs, details)


@query(
    "merge_links",
    """
    SELECT page_id, 'https://first.example/|' || url || CASE WHEN contains(url, '#')
           THEN '|' || regexp_replace(url, '#.*$', '') ELSE '' END AS links
    FROM pages
    """,
)
def merge_links(t: Tables) -> DataFrame:
    """Links already in the metadata come first; the page's own address is in both lists."""
    known = F.to_json(F.struct(F.array(F.lit("https://first.example/"), F.col("url")).alias("links_all")))
    body = F.concat(F.lit("<"), F.col("url"), F.lit("> and <https://FIRST.example/#a>"))
    rows = t.pages.select(
        "page_id",
        known.alias("meta"),
        F.lit(None).cast("string").alias("created_date"),
        F.lit(None).cast("string").alias("updated_date"),
        body.alias("text"),
    )
    merged = clean.collect_metadata(rows, "text")
    links = metadata.strings_of(F.col("metadata"), "links_all")
    return merged.select("page_id", F.array_join(links, "|").alias("links"))


def corpus_records(t: Tables) -> DataFrame:
    """The documents as raw records: source objects by language, the document number as line number."""
    nothing = F.lit(None).cast("string")
    path = F.concat(F.lit("raw/corpus/"), F.col("lang"), F.lit("/jsonl/"), F.col("source"), F.lit(".jsonl"))
    return t.spread("documents", "doc_id").select(
        path.alias("file_path"),
        F.col("doc_id").alias("line_no"),
        "text",
        F.when(F.col("lang") == "fr", " ").otherwise(F.col("source")).alias("source"),
        nothing.alias("filename"),
        nothing.alias("source_id"),
        F.to_json(F.struct("lang")).alias("meta"),
        nothing.alias("created_date"),
        nothing.alias("updated_date"),
    )


def page_url_map(t: Tables) -> DataFrame:
    """A side table naming documents by page number; addresses with a fragment are listed again without it."""
    names = t.documents.select("doc_id", "source").withColumnRenamed("doc_id", "page_id")
    name = F.concat(F.lit("files/"), F.format_string("%s_%07d.txt", F.col("source"), F.col("page_id")))
    listed = t.pages.select("page_id", "url").join(names, "page_id")
    versions = F.array_compact(
        F.array(F.col("url"), F.when(F.col("url").contains("#"), F.substring_index("url", "#", 1)))
    )
    rows = listed.select("page_id", name.alias("name"), F.posexplode(versions).alias("version", "url"))
    return rows.select(
        F.substring_index("name", "/", -1).alias("filename"),
        "url",
        (F.col("version") * 1_000_000_000_000 + F.col("page_id")).cast("long").alias("line_no"),
    )


def labelled_documents(t: Tables) -> DataFrame:
    """A documents table that already exists: the texts labelled as low quality."""
    low = t.labels.filter("quality = 0").select("doc_id")
    digest = text.checksum(F.col("text"))
    return t.documents.join(low, "doc_id").select(F.col("doc_id").cast("string").alias("id"), digest.alias("checksum"))


def language_datasets(t: Tables) -> DataFrame:
    """Datasets named by language and, for sources with a very long text, by source."""
    languages = t.documents.select(F.col("lang").alias("name")).distinct()
    sources = t.documents.filter("n_chars > 10000").select(F.col("source").alias("name")).distinct()
    names = languages.union(sources)
    return names.select(F.concat(F.lit("ds-"), F.col("name")).alias("id"), "name")


SQL_URL_MAP = """
    url_rows AS (
      SELECT d.source || '_' || lpad(d.doc_id::VARCHAR, 7, '0') || '.txt' AS filename, p.url, p.page_id AS line_no
      FROM pages p JOIN documents d ON d.doc_id = p.page_id
      UNION ALL
      SELECT d.source || '_' || lpad(d.doc_id::VARCHAR, 7, '0') || '.txt', regexp_replace(p.url, '#.*$', ''),
             p.page_id + 1000000000000
      FROM pages p JOIN documents d ON d.doc_id = p.page_id WHERE contains(p.url, '#')),
    url_map AS (SELECT filename, arg_max(url, line_no) AS url, count(*) AS n_lines FROM url_rows GROUP BY filename)"""

SQL_DATASETS = """
    datasets AS (
      SELECT 'ds-' || name AS id, name FROM (
        SELECT DISTINCT lang AS name FROM documents
        UNION SELECT DISTINCT source FROM documents WHERE n_chars > 10000))"""

SQL_EXISTING = """
    existing AS (
      SELECT d.doc_id::VARCHAR AS id, sha256(d.text) AS checksum
      FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 0)"""


@query(
    "prepare_docs",
    f"""
    WITH {sql_clean()}, {SQL_URL_MAP}, {SQL_DATASETS}, {SQL_EXISTING},
    valid AS (SELECT *, source || '_' || lpad(doc_id::VARCHAR, 7, '0') || '.txt' AS title FROM cleaned
              WHERE status = 'cleaned')
    SELECT v.doc_id, v.title, coalesce(s.id, l.id) AS dataset_id, u.url, v.checksum, v.char_count,
           {sql_word_count("v.body")}::BIGINT AS word_count, round_even(v.ratio, 3) AS ratio,
           CASE WHEN v.ratio >= 0.9 THEN 'latin' ELSE 'und' END AS language, 'ingested' AS status
    FROM valid v
    LEFT JOIN url_map u ON u.filename = v.title
    LEFT JOIN datasets s ON s.name = v.source
    LEFT JOIN datasets l ON l.name = v.lang
    WHERE v.checksum NOT IN (SELECT checksum FROM existing)
    """,
)
def prepare_docs(t: Tables) -> DataFrame:
    """Raw records to new documents: clean, measure, deduplicate, validate, map, resolve, keep what is new."""
    rules = CleanConfig(
        min_chars=10, min_ratio=0.5, script=LATIN, script_language="latin", scope=(), order="line_no"
    )
    outputs = prepare(
        corpus_records(t),
        page_url_map(t),
        labelled_documents(t),
        language_datasets(t),
        F.lit(RUN_AT),
        PrepareConfig(root=None, clean=rules),
        stage=work_path(t.spark, "prepare"),
    )
    return outputs.documents.select(
        F.col("line_no").alias("doc_id"),
        "title",
        "dataset_id",
        metadata.text_of(F.col("metadata"), "url").alias("url"),
        "checksum",
        "char_count",
        "word_count",
        text.round_half_even(F.col("script_ratio"), 3).alias("ratio"),
        "language",
        "status",
    )


@query(
    "map_urls",
    f"""
    WITH {SQL_URL_MAP},
    records AS (
      SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE source || '_' || lpad(doc_id::VARCHAR, 7, '0') || '.txt' END
                     AS name,
             CASE lang WHEN 'fr' THEN 'https://kept.example/' || doc_id WHEN 'de' THEN '' END AS old_url
      FROM documents)
    SELECT r.doc_id, r.name AS map_key, CASE WHEN nullif(r.old_url, '') IS NOT NULL THEN r.old_url ELSE coalesce(u.url, NULL) END
           AS url, CASE WHEN u.url IS NULL THEN 'unmapped' ELSE 'mapped' END AS map_status,
           u.url IS NOT NULL AND nullif(r.old_url, '') IS NULL AS url_written
    FROM records r LEFT JOIN url_map u ON u.filename = r.name
    """,
)
def map_urls(t: Tables) -> DataFrame:
    """French records already have an address, German ones a blank one, Spanish ones no name."""
    derived = F.concat(F.lit("in/"), F.format_string("%s_%07d.txt", F.col("source"), F.col("doc_id")))
    name = enrich.lookup_name(F.when(F.col("lang") == "es", "").otherwise(derived))
    old = F.when(F.col("lang") == "fr", F.concat(F.lit("https://kept.example/"), F.col("doc_id").cast("string"))).when(
        F.col("lang") == "de", ""
    )
    rows = t.documents.select("doc_id", "lang", "source")
    mapped = enrich.map_urls(rows, page_url_map(t), name, old, ["doc_id"])
    return mapped.select("doc_id", "map_key", "url", "map_status", "url_written")


@query("dup_keys", f"WITH {SQL_URL_MAP} SELECT filename, n_lines FROM url_map WHERE n_lines > 1")
def dup_keys(t: Tables) -> DataFrame:
    return enrich.duplicate_names(page_url_map(t)).orderBy("filename")


@query(
    "resolve_dataset",
    f"""
    WITH {SQL_DATASETS}
    SELECT d.doc_id, d.lang || '/jsonl/' || d.source AS place, coalesce(s.id, l.id) AS dataset_id
    FROM documents d LEFT JOIN datasets s ON s.name = d.source LEFT JOIN datasets l ON l.name = d.lang
    """,
)
def resolve_dataset(t: Tables) -> DataFrame:
    rows = t.documents.select(
        "doc_id",
        F.concat("lang", F.lit("/jsonl/"), "source").alias("place"),
        F.concat(F.lit("/raw/corpus/"), "lang", F.lit("/jsonl/"), "source", F.lit(".v1.jsonl")).alias("path"),
    )
    resolved = enrich.resolve_dataset(rows, language_datasets(t), "path", ["doc_id"])
    return resolved.select("doc_id", "place", "dataset_id")


@query(
    "chat_messages",
    """
    SELECT conv_id || '-' || turn AS chat_id, role, text AS content,
           CASE WHEN role = 'assistant' THEN CASE WHEN length(text) > 300 THEN 'long-form' ELSE 'assistant' END END AS model
    FROM conversations
    """,
)
def chat_messages(t: Tables) -> DataFrame:
    return (
        chat.export_chats(chat_rows(t))
        .select("chat_id", F.explode("messages").alias("m"))
        .select("chat_id", "m.role", "m.content", "m.model")
    )


def chat_rows(t: Tables) -> DataFrame:
    """Chat table rows, one per turn: a conversation of any length stays spread over many rows."""
    model: Column = F.when((F.col("role") == "assistant") & (F.length("text") > 300), "long-form")
    message = F.struct("role", F.col("text").alias("content"), model.alias("modelName"))
    stamp = F.lit(1_700_000_000) + F.col("conv_id") * 60 + F.col("turn")
    return t.conversations.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("Chat "), F.col("conv_id").cast("string")).alias("title"),
        F.to_json(F.struct(F.array(message).alias("messages"))).alias("chat"),
        F.when(F.col("role") == "user", stamp * 1000 + 250).otherwise(stamp).alias("created_at"),
        stamp.alias("updated_at"),
    )

