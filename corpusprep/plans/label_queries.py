"""Queries over labels and languages."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import labels
from ..operators.language import TOP, identify_ranked, language_profiles
from .registry import Tables, query
from .table_queries import loaded_documents

# The given texts are made of invented words, so the lexicon takes frequent ones of each kind.
LEXICON = labels.Lexicon(positive=("the", "la", "der", "and"), negative=("of", "que", "und", "to"))
ANNOTATOR = "lexicon@v1"

SQL_LABELLED = f"""
    cut AS (SELECT doc_id, sha256(text) AS checksum, lower(text) AS body FROM documents),
    hits AS (
      SELECT doc_id, checksum,
             1 + len(list_filter(words, lambda w: w IN ('the', 'la', 'der', 'and'))) AS p,
             1 + len(list_filter(words, lambda w: w IN ('of', 'que', 'und', 'to'))) AS n
      FROM (SELECT doc_id, checksum, string_split_regex(body, '[^\\p{{L}}\\p{{M}}]+') AS words FROM cut)),
    labelled AS (
      SELECT doc_id, checksum,
             CASE WHEN p >= 1 AND p >= n THEN 'positive' WHEN n <= 1 THEN 'neutral' ELSE 'negative' END AS label,
             round_even(greatest(p, 1, n)::DOUBLE / (p + n + 1) * 100, 2) AS confidence
      FROM hits)"""


@query("lexicon_label", f"WITH {SQL_LABELLED} SELECT doc_id, label, confidence FROM labelled")
def lexicon_label(t: Tables) -> DataFrame:
    scored = labels.label_texts(t.spread("documents", "doc_id"), labels.lexicon_scores(LEXICON))
    return scored.select("doc_id", "label", "confidence")


def make_lexicon_scorer() -> labels.Scorer:
    """The lexicon as an external model would be plugged in: a function from texts to class scores."""
    import regex

    split = regex.compile(r"[^\p{L}\p{M}]+")

    def score(texts: list[str]) -> list[dict[str, float]]:
        results = []
        for one in texts:
            words = Counter(split.split(one.lower()))
            positive = 1 + sum(words[w] for w in LEXICON.positive)
            negative = 1 + sum(words[w] for w in LEXICON.negative)
            total = positive + negative + 1
            results.append(dict(zip(LEXICON.labels, (positive / total, 1 / total, negative / total))))
        return results

    return score


@query("model_label", f"WITH {SQL_LABELLED} SELECT doc_id, label, confidence FROM labelled")
def model_label(t: Tables) -> DataFrame:
    """The same labels through the batched Python scorer."""
    scored = labels.label_texts(t.spread("documents", "doc_id"), labels.model_scores(make_lexicon_scorer))
    return scored.select("doc_id", "label", "confidence")


@query(
    "label_lookup",
    f"""
    WITH {SQL_LABELLED},
    known AS (SELECT sha256(text) AS checksum, 'old-' || min(doc_id) AS id FROM documents JOIN labels USING (doc_id)
              GROUP BY sha256(text)),
    per_text AS (SELECT checksum, label, confidence, count(*) AS n_records FROM labelled GROUP BY ALL)
    SELECT p.checksum, k.id AS target_id, p.label AS label_value, p.confidence, p.n_records,
           CASE WHEN k.id IS NULL THEN 'miss' ELSE 'sentiment' END AS label_type
    FROM per_text p LEFT JOIN known k USING (checksum)
    """,
)
def label_lookup(t: Tables) -> DataFrame:
    """Labels of all texts against the loaded documents: rows for known texts, and the misses."""
    docs = t.spread("documents", "doc_id").select("doc_id", "text", text.checksum(F.col("text")).alias("checksum"))
    scored = labels.label_texts(docs, labels.lexicon_scores(LEXICON))
    return labels.join_labels(scored, loaded_documents(t)).select(
        "checksum",
        "target_id",
        F.col("label").alias("label_value"),
        "confidence",
        "n_records",
        F.when(F.col("target_id").isNull(), "miss").otherwise("sentiment").alias("label_type"),
    )


@query(
    "label_rows",
    f"""
    WITH {SQL_LABELLED},
    known AS (SELECT sha256(text) AS checksum, 'old-' || min(doc_id) AS id FROM documents JOIN labels USING (doc_id)
              GROUP BY sha256(text))
    SELECT k.id AS target_id, 'sentiment' AS label_type, label AS label_value, confidence, '{ANNOTATOR}' AS annotator,
           count(*) AS n_records
    FROM labelled JOIN known k USING (checksum) GROUP BY ALL
    """,
)
def label_rows(t: Tables) -> DataFrame:
    docs = t.spread("documents", "doc_id").select("doc_id", "text", text.checksum(F.col("text")).alias("checksum"))
    scored = labels.label_texts(docs, labels.lexicon_scores(LEXICON))
    rows, _ = labels.lookup_labels(scored, loaded_documents(t), ANNOTATOR)
    return rows


@query(
    "best_label",
    """
    WITH scores AS (SELECT user_id, event_type, sum(value::DECIMAL(12,2))::DOUBLE AS score FROM events GROUP BY ALL),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS rn,
             (sum(score::DECIMAL(18,2)) OVER (PARTITION BY user_id))::DOUBLE AS whole FROM scores)
    SELECT user_id, event_type AS label, round_even(score / whole * 100, 2) AS confidence FROM ranked WHERE rn = 1
    """,
)
def best_label(t: Tables) -> DataFrame:
    """Event types as classes of a user, their summed values as scores."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    exact = F.col("value").cast("decimal(12,2)")
    sums = t.events.groupBy("user_id").agg(
        *[F.sum(F.when(F.col("event_type") == k, exact)).cast("double").alias(k) for k in kinds],
        F.sum(exact).cast("double").alias("whole"),
    )
    scores = F.array_compact(
        F.array(
            *[
                F.when(F.col(k).isNotNull(), F.struct(F.lit(k).alias("label"), (F.col(k) / F.col("whole")).alias("score")))
                for k in kinds
            ]
        )
    )
    return sums.select("user_id", labels.best_of(scores).alias("b")).select("user_id", "b.label", "b.confidence")


@query(
    "lang_id",
    f"""
    WITH padded AS (
      SELECT doc_id, lang, regexp_replace(' ' || regexp_replace(lower(text), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g') || ' ',
                                          ' +', ' ', 'g') AS p
      FROM documents),
    grams AS (
      SELECT doc_id, lang, gram FROM (
        SELECT doc_id, lang, unnest(list_transform(range(1, greatest(length(p) - 2, 1) + 1),
                                                   lambda i: substr(p, i, 3))) AS gram FROM padded)
      WHERE length(gram) = 3),
    lang_ranks AS (
      SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS lang_rank
      FROM (SELECT lang, gram, count(*) AS n FROM grams GROUP BY ALL)),
    doc_ranks AS (
      SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, gram) AS rank
      FROM (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL)),
    sizes AS (SELECT doc_id, count(*) AS n, greatest(count(*), {TOP}) AS missing FROM doc_ranks GROUP BY doc_id),
    scores AS (
      SELECT d.doc_id, l.lang, sum(s.missing - abs(d.rank - l.lang_rank))::BIGINT AS gain
      FROM doc_ranks d JOIN sizes s USING (doc_id) JOIN lang_ranks l ON l.gram = d.gram AND l.lang_rank <= {TOP} GROUP BY ALL),
    best AS (
      SELECT doc_id, lang, gain FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY gain DESC, lang DESC) = 1)
    SELECT o.doc_id, coalesce(b.lang, 'und') AS language, (s.missing * s.n - b.gain)::BIGINT AS distance
    FROM documents o LEFT JOIN best b USING (doc_id) LEFT JOIN sizes s USING (doc_id)
    """,
)
def lang_id(t: Tables) -> DataFrame:
    """Profiles learned from the given languages, all grams of every text ranked against each of them."""
    docs = t.spread("documents", "doc_id")
    return identify_ranked(docs, "doc_id", "text", language_profiles(docs, "lang", "text"))
