"""Spelling variants: words one edit apart, found with bitsets per (position, letter).

Two words one edit apart share either the first half of the shorter one or its remainder, so the vocabulary is dealt into
buckets of words that agree in one of them. Inside a bucket a bitset per (position, letter) says which words have that
letter there. All queries of a bucket run at once: for every letter of a query the sets of words that agree so far with no
error and with one error (a replaced letter; a letter more; a letter less, with the position shifted by one) are updated
by whole machine words. What is left at the end are the words one edit away; no pair is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import measured_lookup
from .common import LOWER, UPPER, stored

#: Runs of letters, as a Java regular expression.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"


@dataclass(frozen=True)
class Spelling:
    """Words of at least ``min_letters`` code points and ``min_count`` occurrences take part; a form has at least ``ratio``
    times its variant's count. Buckets above ``block`` words are compared block by block, by many tasks; smaller ones
    share an index of about ``pack`` words. ``cells``: 64-bit words that one state of the search may hold."""

    min_letters: int = 5
    min_count: int = 3
    ratio: int = 2
    block: int = 4096
    pack: int = 1024
    cells: int = 1 << 18


def runs(docs: DataFrame) -> DataFrame:
    """``doc_id, word`` for every maximal run of letters of whole texts, A-Z lower-cased. Null texts have none."""
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), 0)).alias("word")
    )


def vocabulary(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """``word, n``: distinct words that are long and frequent enough, with their counts over all rows of ``words``."""
    long = words.filter(F.length("word") >= how.min_letters)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= how.min_count)


def _bucketed(vocab: DataFrame, how: Spelling) -> DataFrame:
    """A row per word and bucket: ``size`` is the shorter word's length, ``side`` the half that agrees (0: first).

    A word of length l is in the buckets of size l, and as the longer one in those of size l - 1.
    """
    length = F.length("word")

    def half(size, side: int):
        keep = F.floor(size / 2).cast("int")
        piece = F.substring("word", F.lit(1), keep) if side == 0 else F.substring("word", length - size + keep + 1, size - keep)
        return F.struct(size.cast("int").alias("size"), F.lit(side).alias("side"), F.xxhash64(piece).alias("piece"))

    # Any hash will do: words that share a bucket by chance alone are told apart by the search.
    keys = F.array(*[half(size, side) for size in (length, length - 1) for side in (0, 1)])
    rows = vocab.select("word", "n", F.explode(keys).alias("_k")).filter(F.col("_k.size") >= how.min_letters)
    return rows.select("word", "n", "_k.*")


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in one array, and where each word starts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64), starts


class _Index:
    """Bitsets over a list of words: per (position, letter), per bucket, and of words longer than a position."""

    def __init__(self, words: list[str], buckets: np.ndarray, n_buckets: int):
        self.width = (len(words) + 63) // 64
        codes, starts = _codes(words)
        lengths = np.diff(starts)
        rows = np.repeat(np.arange(len(words)), lengths)
        positions = np.arange(len(codes)) - starts[rows]
        self.keys, at = np.unique(positions << 21 | codes, return_inverse=True)
        self.letters = self._bits(at, rows, len(self.keys) + 1)  # the last row: no word has that letter there
        self.buckets = self._bits(buckets, np.arange(len(words)), n_buckets)
        self.lengths = lengths

    def _bits(self, rows: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        bits = np.zeros((n, self.width), np.uint64)
        np.bitwise_or.at(bits, (rows, words >> 6), np.uint64(1) << (words & 63).astype(np.uint64))
        return bits

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """A bitset per letter: the words with that letter at ``position``."""
        if position < 0:
            return self.letters[np.full(len(letters), len(self.keys))]
        wanted = position << 21 | letters
        found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.letters[np.where(self.keys[found] == wanted, found, len(self.keys))]

    def of_length(self, length: int) -> np.ndarray:
        words = np.flatnonzero(self.lengths == length)
        return self._bits(np.zeros(len(words), np.int64), words, 1)[0]


def _near(index: _Index, letters: np.ndarray, size: int, side: int, start: np.ndarray) -> np.ndarray:
    """Bitsets of words one edit from the queries, whose letters are the rows of ``letters``, all of one length.

    The shorter word of a pair has length ``size``. A pair that agrees in its first half is found in the bucket of that
    half (``side`` 0) and not again in the other. ``start`` holds the words that each query may meet.
    """
    length = letters.shape[1]
    same, half = start.copy(), size // 2
    agree = start if half == 0 else None
    replaced, more, less = (np.zeros_like(start) for _ in range(3))
    shorter = length == size  # the query is the shorter one, or of equal length
    for i in range(length):
        here = index.at(i, letters[:, i])
        if shorter:
            # Replaced at i: agreed so far, another letter here. Words that have ended before go out by their length.
            replaced = (replaced & here) | (same & ~here)
            # A letter more: words that agree up to i skip one of theirs, then go on one position later.
            more = (more | same) & index.at(i + 1, letters[:, i])
        else:
            less = (less & index.at(i - 1, letters[:, i])) | same
        same = same & here
        if i + 1 == half:
            agree = same
    if shorter:
        found = (replaced & index.of_length(length)) | ((more | same) & index.of_length(length + 1))
    else:
        found = less & index.of_length(length - 1)
    return found & agree if side == 0 else found & ~agree


def _search(words: list[str], counts: np.ndarray, buckets: list[tuple], asks: np.ndarray, indexed: np.ndarray, how: Spelling):
    """Per asking word with near words: its position in ``words``, their number, the best one's position."""
    ids = {b: i for i, b in enumerate(dict.fromkeys(buckets))}
    bucket = np.fromiter((ids[b] for b in buckets), np.int64, len(buckets))
    # Bits stand in order of preference: count falling, then word rising; the lowest bit set is the best word.
    keep = np.flatnonzero(indexed)
    keep = np.array(sorted(keep.tolist(), key=lambda i: (-counts[i], words[i])), np.int64)
    index = _Index([words[i] for i in keep], bucket[keep], len(ids))
    groups: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(asks).tolist():
        groups.setdefault((buckets[i][0], buckets[i][1], len(words[i])), []).append(i)
    step = max(1, how.cells // index.width)
    for (size, side, length), members in groups.items():
        for low in range(0, len(members), step):
            some = np.array(members[low : low + step], np.int64)
            letters = np.frombuffer("".join(words[i] for i in some).encode("utf-32-le"), np.uint32)
            letters = letters.astype(np.int64).reshape(len(some), length)
            found = _near(index, letters, size, side, index.buckets[bucket[some]])
            number = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
            hit = np.flatnonzero(number)
            if not len(hit):
                continue
            first = np.argmax(found[hit] != 0, axis=1)
            word = found[hit, first]
            lowest = np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            yield some[hit], number[hit], keep[first * 64 + lowest]


_FOUND = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]
)
_BUCKET = ["size", "side", "piece", "i", "j"]


def _searcher(how: Spelling):
    """Rows sorted by bucket to near words. Small buckets share an index; a bucket has at most some ``block`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        letters = 0

        def flush(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            words, counts = [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)
            asks, indexed = (np.array([r[k] for r in rows], bool) for k in (3, 4))
            for who, number, best in _search(words, counts, [r[0] for r in rows], asks, indexed, how):
                columns = [[words[i] for i in who], number, [words[i] for i in best], counts[best]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in _BUCKET]
            rest = [batch[c].to_pylist() for c in ("word", "n", "asks", "indexed")]
            for key, *row in zip(zip(*columns), *rest):
                if held and key != held[-1][0] and (len(held) >= how.pack or letters >= 16 * how.pack):
                    yield from flush(held)
                    held, letters = [], 0
                held.append((key, *row))
                letters += len(row[0])
        yield from flush(held)

    return run


def near_words(vocab: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """``word, n_near, form, form_n`` for every word of ``vocab`` (distinct ``word``, ``n``) that has near words.

    Near: exactly one inserted, deleted or replaced code point. The form is the near word of largest count, ties to the
    smallest in code-point order; whether it is frequent enough is not judged here.
    """
    keyed = stored(_bucketed(vocab, how), "spelling-buckets")
    bucket = ["size", "side", "piece"]
    sizes = keyed.groupBy(*bucket).agg(F.count("*").alias("_words")).filter("_words > 1")
    sizes = stored(sizes, "spelling-sizes")
    # Most buckets hold a few words. Large ones are cut into blocks by hash; each pair of blocks is one bucket more.
    small = keyed.join(sizes.filter(F.col("_words") <= how.block), bucket)
    zero, yes = F.lit(0), F.lit(True)
    small = small.select("word", "n", *bucket, zero.alias("i"), zero.alias("j"), yes.alias("asks"), yes.alias("indexed"))
    large = measured_lookup(keyed, sizes.filter(F.col("_words") > how.block), bucket, ["word"], "inner")
    blocks = F.ceil(F.col("_words") / how.block).cast("int")
    large = large.withColumns({"_blocks": blocks, "_own": F.pmod(F.xxhash64("word"), blocks).cast("int")})
    other = F.explode(F.sequence(zero, F.col("_blocks") - 1))
    large = large.withColumn("_other", other)
    same = F.col("_own") == F.col("_other")
    # Block i is looked up in the index of block j: as asking (own, other), as indexed (other, own).
    asking = large.select("word", "n", *bucket, F.col("_own").alias("i"), F.col("_other").alias("j"), yes.alias("asks"), same.alias("indexed"))
    listed = large.filter(~same).select(
        "word", "n", *bucket, F.col("_other").alias("i"), F.col("_own").alias("j"), F.lit(False).alias("asks"), yes.alias("indexed")
    )
    dealt = small.unionByName(asking).unionByName(listed).repartition(*_BUCKET).sortWithinPartitions(*_BUCKET)
    found = dealt.mapInArrow(_searcher(how), "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return merged.select("word", "n_near", F.col("_best.form").alias("form"), (-F.col("_best.order")).alias("form_n"))


def spelling_variants(vocab: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of ``vocab`` (:func:`vocabulary`).

    A word's form is its most frequent near word if that has at least ``ratio`` times its count, else null; its root is
    the last word reached from form to form, the word itself if it has no form. Counts rise along the way, so there is
    no circle, and links are followed by doubling: as many rounds as the longest way's length has binary digits. An
    empty vocabulary gives no rows.
    """
    vocab = stored(vocab, "spelling-vocabulary")
    linked = vocab.join(near_words(vocab, how), "word", "left")
    enough = F.col("form_n") >= F.col("n") * how.ratio
    linked = linked.select(
        "word", "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("form")).alias("form"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )
    linked = stored(linked, "spelling-forms")
    # Each word points at another one. One that points at a word without form has arrived; its pointer still serves others.
    way = links = linked.filter("form is not null").select("word", F.col("form").alias("to"))
    arrived = linked.limit(0).select("word", F.col("form").alias("to"))
    while not way.isEmpty():
        jump = links.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        step = stored(way.join(jump, "to", "left").select("word", "to", "_next"), "spelling-steps")
        arrived = stored(arrived.unionByName(step.filter("_next is null").select("word", "to")), "spelling-roots")
        way = step.filter("_next is not null").select("word", F.col("_next").alias("to"))
        links = arrived.unionByName(way)
    roots = arrived.withColumnRenamed("to", "root")
    return linked.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
