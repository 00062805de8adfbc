"""Text classification with a pluggable scorer, and label rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_to_budget, round_half_even, token_budget

Scorer = Callable[[list[str]], list[dict[str, float]]]
# Adds a column of class scores: frame, text column, new column.
Scores = Callable[[DataFrame, str, str], DataFrame]
MARKER = "\u0001"
SCORES = "array<struct<label: string, score: double>>"


@dataclass(frozen=True)
class Lexicon:
    """Words that speak for or against; a stand-in for a model. Matching is by whole lower-case words."""

    positive: tuple[str, ...] = ("good", "great", "love", "excellent", "happy")
    negative: tuple[str, ...] = ("bad", "poor", "hate", "terrible", "slow")
    labels: tuple[str, str, str] = field(default=("positive", "neutral", "negative"))


def lexicon_scores(lexicon: Lexicon) -> Scores:
    """Class scores from word counts, built-in expressions only.

    A hit becomes one marker character, so counting is a difference of lengths: no word list is built per row.
    """

    def hits(text: Column, chosen: tuple[str, ...]) -> Column:
        words = "|".join(re.escape(w) for w in chosen)
        marked = F.regexp_replace(text, f"(?<![\\p{{L}}\\p{{M}}])(?:{words})(?![\\p{{L}}\\p{{M}}])", MARKER)
        return F.length(F.regexp_replace(marked, f"[^{MARKER}]+", ""))

    def add(df: DataFrame, text: str, out: str) -> DataFrame:
        counted = (
            df.withColumn("_plain", F.lower(F.replace(F.col(text), F.lit(MARKER), F.lit(" "))))
            .withColumn("_for", hits(F.col("_plain"), lexicon.positive) + 1)
            .withColumn("_against", hits(F.col("_plain"), lexicon.negative) + 1)
        )
        total = F.col("_for") + F.col("_against") + 1
        parts = zip(lexicon.labels, (F.col("_for"), F.lit(1), F.col("_against")))
        scores = [F.struct(F.lit(n).alias("label"), (s / total).alias("score")) for n, s in parts]
        return counted.withColumn(out, F.array(*scores)).drop("_plain", "_for", "_against")

    return add


def model_scores(make_scorer: Callable[[], Scorer], batch: int = 16) -> Scores:
    """Scores from a Python scorer through Arrow. ``make_scorer`` runs once per task: so is a model loaded."""

    @F.pandas_udf(SCORES)
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for series in texts:
            out: list[list[dict]] = []
            values = series.tolist()
            for start in range(0, len(values), batch):
                for classes in scorer(values[start : start + batch]):
                    out.append([{"label": k, "score": float(v)} for k, v in classes.items()])
            yield pd.Series(out)

    return lambda df, text, out: df.withColumn(out, score(F.col(text)))


def best_of(scores: Column) -> Column:
    """Class with the highest score (the first of equals) and its score in percent, two digits."""
    ranked = F.transform(
        scores, lambda s, i: F.struct(s["score"].alias("score"), (-i).alias("rank"), s["label"].alias("label"))
    )
    top = F.array_max(ranked)
    return F.struct(top["label"].alias("label"), round_half_even(top["score"] * 100, 2).alias("confidence"))


def label_texts(df: DataFrame, add_scores: Scores, max_positions: int | None = None) -> DataFrame:
    """Add ``label`` and ``confidence``. The scorer judges the whole text; only for one that can't take more than
    ``max_positions`` tokens is it cut to that budget. The checksum stays that of the whole text."""
    text = F.col("text") if max_positions is None else cut_to_budget(F.col("text"), token_budget(max_positions))
    scored = add_scores(df.withColumn("_cut", text), "_cut", "_scores").withColumn("_best", best_of(F.col("_scores")))
    return scored.select(*df.columns, "_best.label", "_best.confidence")


def join_labels(labelled: DataFrame, documents: DataFrame) -> DataFrame:
    """Labels per checksum with the number of their records and the document's id, null for a miss.

    Copies of one text carry one label, so they are counted per checksum before the join.
    """
    per_text = labelled.groupBy("checksum", "label", "confidence").agg(F.count("*").alias("n_records"))
    return per_text.join(documents.select("checksum", F.col("id").alias("target_id")), "checksum", "left")


def lookup_labels(
    labelled: DataFrame, documents: DataFrame, annotator: str, label_type: str = "sentiment"
) -> tuple[DataFrame, DataFrame]:
    """Label rows for known checksums, and per unknown checksum the number of records that found no document."""
    joined = join_labels(labelled, documents)
    rows = joined.filter("target_id IS NOT NULL").select(
        "target_id",
        F.lit(label_type).alias("label_type"),
        F.col("label").alias("label_value"),
        "confidence",
        F.lit(annotator).alias("annotator"),
        "n_records",
    )
    return rows, joined.filter("target_id IS NULL").select("checksum", "n_records")
