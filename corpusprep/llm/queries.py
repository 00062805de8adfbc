"""Registered queries of this package: ``opN_<name>`` for each operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .chat_format import format_chats, read_back
from .common import LOWER, UPPER, stored, table
from .decontam import decontaminate
from .license_scan import license_scan
from .line_dedup import line_dedup
from .lm_score import lm_score
from .mixing import Mixing, mix, text_form
from .ngram_join import NgramJoin, ngram_join
from .prefix_trie import PrefixTrie, prefix_trie, turn_digests, with_conversation
from .quality_rules import RULES, SYMBOLS, QualityRules, quality_rules
from .sharding import Sharding, shard
from .spelling import RUN, Spelling, runs, spelling_variants, vocabulary
from .token_counts import bpe_counts, commit, deletes, inserts, revisions, totals, word_counts
from .url_filter import UrlFilter, url_filter

Query = Callable[[SparkSession, str], DataFrame]

#: Words of the contracts, in DuckDB.
_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(table(spark, folder, "documents"), NgramJoin(words=3, percent=90)).drop("n_verified_links")


OP7_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWERED)} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2]))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
links AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles,
  least(s.doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = s.doc_id), s.doc_id)) AS component_id
FROM sets s
"""

#: Rank file of a public byte-level vocabulary.
BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches: all documents come in; toxic ones are deleted; bad ones are revised, their marks taken out.

    The second batch is committed twice, as after a failure.
    """
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    ranks = Path(BPE_RANKS).read_bytes()

    def counted(df: DataFrame, name: str) -> DataFrame:
        both = bpe_counts(df, ranks, "byte_bpe_50k").unionByName(word_counts(df))
        return stored(both, f"token-counts-{name}")

    # Only texts with marks are counted again without them, whether bad or not: which ones are bad is decided on the
    # counts, so that no text is shuffled.
    cleared = F.translate("text", SYMBOLS, "")
    has_marks = F.coalesce(F.col("text") != cleared, F.lit(False))
    marked = counted(docs.filter(has_marks), "marked")
    counts = marked.unionByName(counted(docs.filter(~has_marks), "unmarked"))
    after = counted(docs.filter(has_marks).withColumn("text", cleared), "cleared")
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()
    bad = labels.filter("quality = 0").join(toxic, "doc_id", "left_anti").select("doc_id").distinct()
    removed = deletes(counts.join(toxic, "doc_id", "left_semi"))
    revised = revisions(marked.join(bad, "doc_id", "left_semi"), after.join(bad, "doc_id", "left_semi"))
    path = work_path(spark, "token-rollup")
    commit(path, "0001-load", [inserts(counts)])
    commit(path, "0002-toxic", [removed])
    commit(path, "0003-marks", [revised])
    commit(path, "0002-toxic", [removed])
    return totals(spark, path)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(turns.unionByName(extra))).drop("errors")


#: The contract's rules.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter(table(spark, folder, "pages"), UrlFilter(rules=URL_RULES))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


#: Exponent that tempers the shares of sources, languages and topics.
TEMPER = 0.5


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("topic", text_form(F.col("text")))
    return mix(docs, TEMPER).select("doc_id", "n_tokens", F.round("probability", 9).alias("probability"), "kept")


def _op5_sql(how: Mixing = Mixing()) -> str:
    """The same rounds, one common table expression per step."""
    names = ", ".join(how.dimensions)
    count = lambda chars: f"(length(t) - length(translate(t, '{chars}', '')))"
    steps = [
        f"""c0 AS (SELECT {names}, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS weight
  FROM d GROUP BY {names})"""
    ]
    targets = ", ".join(
        f"(SELECT sum(tokens) FROM c0 x WHERE x.{d} = c0.{d}) ** {TEMPER} / (SELECT sum(s ** {TEMPER}) FROM "
        f"(SELECT sum(tokens) AS s FROM c0 GROUP BY {d} HAVING s > 0)) AS t_{d}"
        for d in how.dimensions
    )
    steps.append(f"r0 AS MATERIALIZED (SELECT *, {targets} FROM c0)")
    k = 0
    for _ in range(how.rounds):
        for d in how.dimensions:
            steps.append(
                f"r{k + 1} AS (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {d}) > 0 THEN weight * t_{d} / "
                f"sum(weight) OVER (PARTITION BY {d}) ELSE 0 END AS weight) FROM r{k})"
            )
            k += 1
    steps.append(f"p0 AS (SELECT *, sum(tokens) OVER () * {how.share} AS budget, 0.0::DOUBLE AS p FROM r{k})")
    for i in range(how.capping):
        left = "(budget - sum(CASE WHEN p >= 1 THEN tokens ELSE 0 END) OVER ())"
        rest = "sum(CASE WHEN p >= 1 THEN 0 ELSE weight END) OVER ()"
        given = f"CASE WHEN {rest} > 0 THEN weight * {left} / {rest} ELSE 0 END"
        steps.append(
            f"p{i + 1} AS (SELECT * REPLACE (CASE WHEN p >= 1 THEN 1.0 WHEN tokens > 0 THEN "
            f"least(1.0, greatest(0.0, {given} / tokens)) ELSE 0.0 END AS p) FROM p{i})"
        )
    dims = ", ".join(f"coalesce({d}, '') AS {d}" for d in how.dimensions)
    return f"""
WITH raw AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
formed AS (SELECT doc_id, source, lang, CAST(len({_WORDS.format(text="t")}) AS BIGINT) AS n_tokens,
  CASE WHEN {count("#*$%&|<>")} * 20 > greatest(length(t), 1) THEN 'marks'
    WHEN {count("0123456789")} * 20 > greatest(length(t), 1) THEN 'numbers'
    WHEN length(t) < 1000 THEN 'short' ELSE 'prose' END AS topic FROM raw),
d AS (SELECT doc_id, n_tokens, {dims} FROM formed),
{", ".join(steps)}
SELECT doc_id, n_tokens, round(p, 9) AS probability,
  CAST(('0x' || substr(md5('{how.seed}:' || doc_id), 1, 13)) AS BIGINT) / (16.0::DOUBLE ** 13) < p AS kept
FROM d JOIN p{how.capping} USING ({names})
"""


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_ALNUM = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_ALNUM}, []) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(ws), 13) AS size,
    array_to_string(list_slice(ws, i, i + least(len(ws), 13) - 1), ' ') AS w
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
places AS (
  SELECT doc_id, i, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, greatest(len(ws) - size + 2, 1))) AS i FROM d, sizes)),
found AS (SELECT doc_id, i, win.size, item FROM places JOIN win USING (size, w)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(t.s, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN items t USING (doc_id)
"""

def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm_score(table(spark, folder, "documents"), held_out)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("version")


def _op9_sql(how: QualityRules = QualityRules()) -> str:
    """The same tests in DuckDB, with the binomial terms from ``lgamma``."""
    rate, rules = how.risk / len(RULES), len(RULES)
    counts, tests, chosen, verdicts = [], [], [], []
    for name, (measure, steps) in RULES.items():
        for i, c in enumerate(steps):
            counts.append(f"count(*) FILTER (good = 1 AND {measure} > {c}) AS {name}_{i}")
            counts.append(f"count(*) FILTER (good = 0 AND {measure} > {c}) AS {name}_c{i}")
            p = (
                f"(SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({rate}) + (n - j) * "
                f"ln(1 - {rate}))) FROM range(0, {name}_{i} + 1) AS r(j))"
            )
            tests.append(f"{p} <= {how.error} / ((SELECT count(*) FROM strata) * {rules}) AS {name}_t{i}")
        holds = [" AND ".join(f"{name}_t{j}" for j in range(i + 1)) for i in range(len(steps))]
        most = "greatest(" + ", ".join(f"CASE WHEN {h} THEN {name}_c{i} ELSE 0 END" for i, h in enumerate(holds)) + ")"
        cases = " ".join(
            f"WHEN {h} AND {name}_c{i} > 0 AND {name}_c{i} = {most} THEN {steps[i]}" for i, h in enumerate(holds)
        )
        chosen.append(f"CASE {cases} END AS {name}")
        verdicts.append(f"WHEN {measure} > {name} THEN '{name}'")
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS.format(text="text")} AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS v
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM w)),
twice AS (SELECT doc_id, v FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, v)) GROUP BY 1),
m AS (SELECT w.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals,
  length(text) - length(translate(text, '!', '')) AS n_exclamations
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < {how.min_words} OR 100 * n_repeat_words > {how.max_repeat_percent} * n_words AS base_failed FROM m),
l AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY 1),
strata AS (SELECT stratum, count(*) FILTER (good = 1) AS n, {", ".join(counts)}
  FROM f JOIN l USING (doc_id) WHERE NOT base_failed GROUP BY 1),
tests AS (SELECT *, {", ".join(tests)} FROM strata),
chosen AS (SELECT stratum, {", ".join(chosen)} FROM tests),
judged AS (SELECT f.*, CASE WHEN base_failed THEN 'base' {" ".join(verdicts)} END AS reason
  FROM f LEFT JOIN chosen USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason IS NULL AS kept, reason
FROM judged
"""


#: Lengths of the template's marks: header without role, end; each control string in a text gets two more characters.
OP3_SQL = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, len(regexp_extract_all(text, '<[|](?:turn|text|end|im_start|im_end|endoftext)[|]>|</?s>|\\[/?INST\\]')) AS n,
  length(text) - length(replace(text, chr(27), '')) AS e,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
  lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after FROM c),
f AS (SELECT *, CASE coalesce(before, 'start') WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
  WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END
  AND (after IS NOT NULL OR role = 'assistant') AS fine FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(23 + length(role) + length(text) + 2 * n + e) AS BIGINT) AS formatted_chars, bool_and(fine) AS valid
FROM f GROUP BY conv_id
"""


def rebuilt(turns: DataFrame, how: PrefixTrie = PrefixTrie()) -> tuple[DataFrame, DataFrame]:
    """Conversations of the contract, on turn digests: the first h turns of conversation c - c % 5, then c's own after
    its first h. Returns their turns and the ids of all of them, as some have no turn left."""
    convs = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n_turns"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 9)
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("_n", F.lit(0).cast("long"))))
    convs = stored(convs.drop("_n"), "trie-conversations")
    first = turns.filter("pos < 8").withColumnRenamed("conv_id", "base")  # h is 8 at most
    borrowed = first.join(convs.filter("taken > 0").select("conv_id", "base", "taken"), "base").filter("pos < taken")
    own = with_conversation(turns, convs.select("conv_id", "n_turns", "h", "taken"), how.segment * how.block)
    own = own.filter("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "digest", "n_bytes"]
    return borrowed.select(*columns).unionByName(own.select(*columns)), convs.select("conv_id")


def op11_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(*rebuilt(turn_digests(table(spark, folder, "conversations"))))


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes in DuckDB; needs ``_CRC_TABLE`` as ``crc(steps)`` in FROM."""
    digit = "(strpos('0123456789ABCDEF', x[{}]) - 1)"
    byte = f"{digit.format(1)} * 16 + {digit.format(2)}"
    codes = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: CAST({byte} AS BIGINT))"
    step = "xor(c >> 8, steps[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295::BIGINT)"


_CRC_TABLE = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(
  list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, b: xor(c >> 1, 3988292384::BIGINT * (c & 1)))) AS steps)"""

OP11_SQL = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h, conv_id - conv_id % 5 AS base, n FROM
  (SELECT conv_id, count(*) AS n FROM t GROUP BY 1), crc),
k AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN (SELECT conv_id AS base, n FROM c) b USING (base)),
r AS (SELECT k.conv_id, p, role, text FROM k JOIN t ON t.conv_id = base AND p < taken
  UNION ALL SELECT conv_id, p - h + taken, role, text FROM k JOIN t USING (conv_id) WHERE p >= h),
m AS (SELECT conv_id, p + 1 AS d, strlen(text) AS bytes, string_agg(md5(role || chr(10) || md5(text)), '') OVER w AS key
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY p ROWS UNBOUNDED PRECEDING) UNION ALL SELECT conv_id, 0, 0, '' FROM k),
l AS (SELECT conv_id, max(d) AS len FROM m GROUP BY 1),
v AS (SELECT d, key, min(conv_id) AS owner, count(*) AS n, any_value(bytes) AS bytes, count(*) FILTER (d = len) AS n_ends,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = len), '')) AS ends
  FROM m JOIN l USING (conv_id) GROUP BY d, key),
below AS (SELECT a.d, a.key, sum((v.n - 1) * v.bytes) AS saved, count(*) FILTER (v.n = v.n_ends) AS leaves,
  count(*) FILTER (v.d = a.d + 1) AS children FROM v JOIN m a ON a.conv_id = v.owner AND a.d <= v.d GROUP BY ALL)
SELECT v.owner AS conv_id, CAST(v.d AS BIGINT) AS depth, u.owner AS parent_conv_id, v.n AS n_convs, children AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN below USING (d, key) LEFT JOIN m q ON q.conv_id = v.owner AND q.d = v.d - 1
LEFT JOIN v u ON u.d = v.d - 1 AND u.key = q.key
"""


SHARDING = Sharding(shards=16)


def op13_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(table(spark, folder, "documents"), SHARDING).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _op13_sql(how: Sharding = SHARDING) -> str:
    """The same cuts, one common table expression per level."""
    dims = range(len(how.dimensions))
    shown = [f"coalesce(CAST({d} AS VARCHAR), '')" if d != "size" else "size" for d in how.dimensions]
    levels = []
    for i in range((how.shards - 1).bit_length()):
        node = "PARTITION BY first, k"
        widths = [f"(max(r{d}) OVER ({node}) - min(r{d}) OVER ({node})) / greatest((SELECT max(r{d}) FROM l0), 1)" for d in dims]
        most = "greatest(" + ", ".join(f"w{d}" for d in dims) + ")"
        levels.append(f"""
a{i} AS (SELECT *, {", ".join(f"{w} AS w{d}" for d, w in zip(dims, widths))}, sum(size) OVER ({node}) AS total FROM l{i}),
b{i} AS (SELECT *, total * (k // 2) / k AS wanted, CASE {" ".join(f"WHEN w{d} = {most} THEN r{d}" for d in dims)} END AS c FROM a{i}),
c{i} AS (SELECT *, sum(size) OVER ({node} ORDER BY c, md5, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM b{i}),
d{i} AS (SELECT *, min(upto - size) OVER (PARTITION BY first, k, c, md5) AS lo, max(upto) OVER (PARTITION BY first, k, c, md5) AS hi FROM c{i}),
e{i} AS (SELECT *, CASE WHEN upto - size < wanted AND upto >= wanted THEN
  CASE WHEN hi - lo > (SELECT sum(size) FROM l0) * {how.whole_percent / 100 / how.shards} OR (lo = 0 AND hi = total)
    THEN CASE WHEN wanted - (upto - size) <= upto - wanted THEN upto - size ELSE upto END
    ELSE CASE WHEN wanted - lo <= hi - wanted THEN lo ELSE hi END END END AS cut FROM d{i}),
f{i} AS (SELECT *, k = 1 OR upto <= max(cut) OVER ({node}) AS below FROM e{i}),
l{i + 1} AS (SELECT doc_id, size, crc, md5, {", ".join(f"r{d}" for d in dims)},
  CASE WHEN below THEN first ELSE first + k // 2 END AS first,
  CASE WHEN k = 1 THEN 1 WHEN below THEN k // 2 ELSE k - k // 2 END AS k FROM f{i})""")
    last = (how.shards - 1).bit_length()
    return f"""
WITH {_CRC_TABLE},
t AS (SELECT doc_id, source, lang, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size FROM documents),
v AS (SELECT doc_id, size, {_crc32("text")} AS crc, md5(text) AS md5,
  {", ".join(f"min({s}) OVER (PARTITION BY md5(text)) AS v{d}" for d, s in zip(dims, shown))} FROM t, crc),
l0 AS MATERIALIZED (SELECT doc_id, size, crc, md5, {", ".join(f"dense_rank() OVER (ORDER BY v{d}) - 1 AS r{d}" for d in dims)},
  0 AS first, {how.shards} AS k FROM v),{",".join(levels)}
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(first AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY first ORDER BY md5, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM l{last}
"""



def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Some runs lose a letter first, by hash of document and run."""
    words = runs(table(spark, folder, "documents"))
    h = F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("word")))
    at = (h % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    changed = words.select(F.when(h % 97 == 0, shorter).otherwise(F.col("word")).alias("word"))
    return spelling_variants(vocabulary(changed))


def _op12_sql(how: Spelling = Spelling()) -> str:
    run = RUN.replace("\\u00C0", "\u00C0").replace("\\u00FF", "\u00FF")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '{run}')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM g, crc),
x AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(word) >= {how.min_letters} GROUP BY word HAVING sum(n) >= {how.min_count}),
d AS MATERIALIZED (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS p FROM v)),
longer AS (SELECT DISTINCT d.word AS a, d.n AS an, v.word AS b, v.n AS bn FROM d JOIN v ON v.word = d.rest),
near AS (SELECT a.word AS a, b.word AS b, b.n AS n FROM d a JOIN d b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT a, b, bn FROM longer UNION ALL SELECT b, a, an FROM longer),
best AS (SELECT a, count(*) AS n_near, max(n) AS form_n, arg_min(b, (-n, b)) AS form FROM near GROUP BY a),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {how.ratio} * n THEN form END AS form,
  CASE WHEN form_n >= {how.ratio} * n THEN form_n END AS form_n FROM v LEFT JOIN best ON a = word),
w AS (SELECT word, form AS t, 1 AS k FROM f WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form, k + 1 FROM w JOIN f ON f.word = w.t WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(t, k) AS root FROM w GROUP BY word)
SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM f LEFT JOIN roots USING (word)
"""


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op3_chat_formatting": op3_chat_formatting,
    "op6_url_filter": op6_url_filter,
    "op5_source_mixing": op5_source_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_scoring": op10_lm_scoring,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_kd_sharding": op13_kd_sharding,
}
SQL: dict[str, str] = {
    "op3_chat_formatting": OP3_SQL,
    "op5_source_mixing": _op5_sql(),
    "op9_quality_rules": _op9_sql(),
    "op8_benchmark_decontamination": OP8_SQL,
    "op7_ngram_jaccard_join": OP7_SQL,
    "op11_conversation_prefix_trie": OP11_SQL,
    "op12_spelling_variants": _op12_sql(),
    "op13_kd_sharding": _op13_sql(),
}
