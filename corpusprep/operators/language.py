"""Language identification by ranked character n-grams (profiles as of Cavnar and Trenkle, 1994)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .keyed import salted_lookup

SIZE = 3
#: Grams a language's profile keeps: the model's size. Texts are never cut.
TOP = 300
#: Profiles up to this size are sent to every task.
SENT_BYTES = 16 << 20
#: Positions of a batch that are looked up at a time; texts that are ranked stay whole.
CHUNK = 1 << 20


def gram_counts(df: DataFrame, by: str, text: str) -> DataFrame:
    """``by, gram, n``: letters only, lower case, words padded by one blank.

    Grams of a row are counted inside its task first, so the shuffle carries distinct grams, not characters.
    """
    padded = _padded(F.col(text))
    # A look-ahead matches at every position, so one pass over the text lists all overlapping grams; none starts in the
    # middle of a code point.
    grams = F.regexp_extract_all(padded, F.lit("(?!\\p{Cs})(?=(" + "." * SIZE + "))"), F.lit(1))
    exploded = df.select(by, F.explode(grams).alias("gram"))
    return exploded.groupBy(by, "gram").agg(F.count("*").alias("n"))


def ranked(counts: DataFrame, by: str, top: int = TOP) -> DataFrame:
    """Ranks 1..top of each key's grams; equal counts are ordered by the gram."""
    order = Window.partitionBy(by).orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).drop("n")


def language_profiles(df: DataFrame, language: str, text: str, top: int = TOP) -> DataFrame:
    """``lang, gram, rank`` learned from texts whose language is known: at most ``top`` rows per language."""
    profiles = ranked(gram_counts(df, language, text), language, top)
    return profiles.select(F.col(language).alias("lang"), "gram", F.col("rank").alias("lang_rank"))


def _gain(top: int) -> Column:
    """What one occurrence of a gram is worth: ``top`` for a language's most frequent gram, 1 for its last ranked one."""
    return (F.lit(top + 1) - F.col("lang_rank")).cast("long")


def identify_joined(df: DataFrame, row_id: str, text: str, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """:func:`identify` for profiles too large to send to every task: grams are counted per text and joined."""
    counts = gram_counts(df, row_id, text)
    shared = salted_lookup(counts, _by_gram(profiles, top), ["gram"], [row_id])
    size = counts.groupBy(row_id).agg((F.lit(top) * F.sum("n")).alias("_most"))
    return _best(df, row_id, shared, F.col("n") * F.col("_l.gain"), size)


def identify_ranked_joined(df: DataFrame, row_id: str, text: str, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """:func:`identify_ranked` for profiles too large to send to every task: a text's grams are ranked and joined."""
    counts = gram_counts(df, row_id, text)
    one = Window.partitionBy(row_id)
    rank = F.row_number().over(one.orderBy(F.desc("n"), "gram"))
    placed = counts.select(row_id, "gram", rank.alias("rank"), F.count("*").over(one).alias("_size"))
    placed = placed.withColumn("_missing", F.greatest("_size", F.lit(top).cast("long")))
    shared = salted_lookup(placed, _by_gram(profiles, top), ["gram"], [row_id])
    size = placed.groupBy(row_id).agg((F.max("_missing") * F.max("_size")).alias("_most"))
    out_of_place = F.abs(F.col("rank") - (F.lit(top + 1) - F.col("_l.gain")))
    return _best(df, row_id, shared, F.col("_missing") - out_of_place, size)


def _best(df: DataFrame, row_id: str, shared: DataFrame, gain: Column, size: DataFrame) -> DataFrame:
    """``row_id, language, distance`` from grams with their ``langs`` and the greatest distance ``_most`` of every text."""
    one = shared.withColumn("_l", F.explode_outer("langs"))
    sums = one.groupBy(row_id, F.col("_l.lang").alias("lang")).agg(F.sum(gain).alias("gain"))
    known = F.when(F.col("gain").isNotNull(), F.struct("gain", "lang"))
    best = sums.groupBy(row_id).agg(F.max(known).alias("_top"))
    distance = F.col("_most") - F.col("_top.gain")
    return df.select(row_id).join(best.join(size, row_id), row_id, "left").select(
        row_id, F.coalesce("_top.lang", F.lit("und")).alias("language"), distance.cast("long").alias("distance")
    )


def _by_gram(profiles: DataFrame, top: int) -> DataFrame:
    return profiles.groupBy("gram").agg(F.collect_list(F.struct("lang", _gain(top).alias("gain"))).alias("langs"))


def _padded(text: Column) -> Column:
    letters = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^\\p{L}\\p{M}]+", " "), F.lit(" "))
    return F.regexp_replace(letters, " +", " ")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and where each text starts."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), starts


def _gram_ids(codes: np.ndarray) -> np.ndarray:
    """A number per position, one for each gram that starts there: three code points of 21 bits."""
    wide = codes.astype(np.int64)
    return wide[:-2] << 42 | wide[1:-1] << 21 | wide[2:]


def _languages(rows: list[tuple[str, str, int]]) -> list[str | None]:
    """Languages of the profiles, of which the first with the greatest sum is taken: greater names first, null last."""
    return sorted({r[0] for r in rows}, key=lambda lang: (lang is not None, lang or ""), reverse=True)


def _scorer(rows: list[tuple[str, str, int]], top: int):
    """``struct<language, distance>`` of padded texts, null for a null text. ``rows`` are the profiles (lang, gram, gain).

    The weights of all languages are one table by gram; a batch is looked up some 2^20 positions at a time.
    """
    langs = _languages(rows)
    ids = _gram_ids(_codes([r[1] for r in rows])[0])[::SIZE] if rows else np.zeros(0, np.int64)
    grams, at = np.unique(ids, return_inverse=True)
    weights = np.zeros((len(grams) + 1, max(len(langs), 1)), np.int64)  # the last row: a gram no profile has
    for k, (lang, _, gain) in zip(at, rows):
        weights[k, langs.index(lang)] = gain

    def score(texts: pd.Series) -> pd.DataFrame:
        given = [t or "" for t in texts]
        codes, starts = _codes(given)
        sums = np.zeros((len(given), weights.shape[1]), np.int64)
        for low in range(0, max(len(codes) - SIZE + 1, 0), CHUNK):
            found = _gram_ids(codes[low : low + CHUNK + SIZE - 1])
            positions = np.arange(low, low + len(found))
            row = np.searchsorted(starts, positions, side="right") - 1
            inside = positions + SIZE <= starts[row + 1]
            found, row = found[inside], row[inside]
            if not len(grams) or not len(found):
                continue
            k = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
            k = np.where(grams[k] == found, k, len(grams))
            edges = np.flatnonzero(np.diff(row, prepend=-1))
            sums[row[edges]] += np.add.reduceat(weights[k], edges, axis=0)
        names = ["und" if lang is None else lang for lang in langs]
        sizes = np.maximum(np.diff(starts) - SIZE + 1, 0)
        best = sums.argmax(axis=1)
        most = sums[np.arange(len(given)), best]
        return pd.DataFrame(
            {
                "language": [None if t is None else names[b] if m else "und" for t, b, m in zip(texts, best, most)],
                "distance": pd.array([int(top * n - m) if m else None for n, m in zip(sizes, most)], "Int64"),
            }
        )

    return F.pandas_udf(score, "language string, distance long")


def _ranker(rows: list[tuple[str, str, int]], top: int):
    """``struct<language, distance>`` of padded texts by the ranks of their grams. ``rows`` are as in :func:`_scorer`."""
    langs = _languages(rows)
    ids = _gram_ids(_codes([r[1] for r in rows])[0])[::SIZE] if rows else np.zeros(0, np.int64)
    grams, at = np.unique(ids, return_inverse=True)
    ranks = np.zeros((len(grams) + 1, max(len(langs), 1)), np.int64)  # 0: the language's profile has no such gram
    for k, (lang, _, gain) in zip(at, rows):
        ranks[k, langs.index(lang)] = top + 1 - gain

    def judged(given: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language of each text, its gain, and the greatest distance."""
        codes, starts = _codes(given)
        found = _gram_ids(codes)
        positions = np.arange(len(found))
        row = np.searchsorted(starts, positions, side="right") - 1
        inside = positions + SIZE <= starts[row + 1]
        found, row = found[inside], row[inside]
        order = np.lexsort((found, row))
        found, row = found[order], row[order]
        first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(found, prepend=-1) != 0))
        n = np.diff(first, append=len(found))
        found, row = found[first], row[first]
        # Ids of grams rise as the grams do: equal counts are ordered by the gram.
        order = np.lexsort((found, -n, row))
        found = found[order]
        size = np.bincount(row, minlength=len(given))
        rank = np.arange(len(found)) - np.repeat(np.cumsum(size) - size, size) + 1
        missing = np.maximum(size, top)
        sums = np.zeros((len(given), ranks.shape[1]), np.int64)
        if len(grams) and len(found):
            k = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
            hit = grams[k] == found
            k, rank, row = k[hit], rank[hit], row[hit]
            gain = np.where(ranks[k] > 0, missing[row][:, None] - np.abs(rank[:, None] - ranks[k]), 0)
            edges = np.flatnonzero(np.diff(row, prepend=-1))
            if len(edges):
                sums[row[edges]] += np.add.reduceat(gain, edges, axis=0)
        best = sums.argmax(axis=1)
        return best, sums[np.arange(len(given)), best], missing * size

    def rank_texts(texts: pd.Series) -> pd.DataFrame:
        given = [t or "" for t in texts]
        ends = np.cumsum(np.fromiter(map(len, given), np.int64, len(given)))
        parts, start = [], 0
        while start < len(given):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
            parts.append(judged(given[start:end]))
            start = end
        names = ["und" if lang is None else lang for lang in langs]
        best, gain, most = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        return pd.DataFrame(
            {
                "language": [None if t is None else names[b] if g else "und" for t, b, g in zip(texts, best, gain)],
                "distance": pd.array([int(m - g) if g else None for g, m in zip(gain, most)], "Int64"),
            }
        )

    return F.pandas_udf(rank_texts, "language string, distance long")


def language_of(text: Column, profiles: list[tuple[str, str, int]], top: int = TOP) -> Column:
    """``struct<language, distance>`` of a text, found inside the row: no gram is shuffled. Null for a null text.

    ``profiles`` are (lang, gram, gain) as :func:`sendable` returns them.
    """
    return _scorer(profiles, top)(F.when(text.isNotNull(), _padded(text)))


def sendable(profiles: DataFrame, top: int = TOP) -> list[tuple[str, str, int]] | None:
    """The profiles as rows for :func:`language_of`, or None if they have more than ``SENT_BYTES``."""
    rows = materialize(profiles.select("lang", "gram", _gain(top).alias("gain")))
    size = rows.agg(F.sum(F.octet_length("lang") + F.octet_length("gram") + 8)).first()[0] or 0
    return [tuple(r) for r in rows.collect()] if size <= SENT_BYTES else None


def identify(df: DataFrame, row_id: str, text: str, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """``row_id, language, distance``: the language whose profile gives the text's grams the most weight.

    Every gram of the whole text counts, as often as it occurs: ``top`` for a language's most frequent gram, 1 less for
    each further rank, nothing for a gram its profile does not have. The distance is ``top`` times the number of grams
    less that sum. Of equal languages the greater name is taken; texts without any known gram get ``und``.
    """
    rows = sendable(profiles, top)
    if rows is None:
        return identify_joined(df, row_id, text, profiles, top)
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(row_id, language_of(body, rows, top).alias("_l")).select(row_id, "_l.language", "_l.distance")


def identify_ranked(df: DataFrame, row_id: str, text: str, profiles: DataFrame, top: int = TOP) -> DataFrame:
    """``row_id, language, distance``: the profile with the smallest out-of-place distance to the text's own ranking.

    All distinct grams of the whole text are ranked by how often they occur, equal counts by the gram. A gram costs the
    difference of its rank and the profile's; one that the profile does not have costs the greatest difference there can
    be: the number of the text's grams, or ``top`` if that is more. The distance is the sum. Of equal languages the greater
    name is taken; texts without any known gram get ``und``.
    """
    rows = sendable(profiles, top)
    if rows is None:
        return identify_ranked_joined(df, row_id, text, profiles, top)
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(row_id, _ranker(rows, top)(_padded(body)).alias("_l")).select(row_id, "_l.language", "_l.distance")
