"""Benchmark decontamination: an FM-index per shard of the corpus is searched for windows of benchmark words.

A shard is a few MB of documents inside one task. Its index holds the stretches that can contain a window at all: runs of
benchmark words, at least as long as the shortest window; all other words are one separator. Windows are found by
backward search through wavelet ranks, located by sampled suffix positions, and merged to spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored
from .fm_index import FMIndex

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Bytes that are no part of a word become a blank, A-Z become lower case.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Decontamination:
    """``window`` words in a row make a match; ``block`` bounds the (window, item) pairs that are broadcast at once;
    a document is contaminated when its hit words times ``share`` reach its words."""

    window: int = 13
    share: int = 20
    block: int = 500_000
    shard_bytes: int = 8 << 20
    sample: int = 16

    def __post_init__(self):
        if min(self.window, self.share, self.block, self.shard_bytes, self.sample) < 1:
            raise ValueError("all parameters are 1 at least")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``item, window``: every ``size`` words in a row of an item, all its words if it has fewer."""

    def run(batches):
        for piece in pieces(batches, "text"):
            names, found = [], []
            for name, text in zip(piece["item"].to_pylist(), piece["text"].to_pylist(), strict=True):
                words = words_of(text)
                for start in range(max(len(words) - size, 0) + 1 if words else 0):
                    names.append(name)
                    found.append(b" ".join(words[start : start + size]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["item", "window"])

    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    return items.mapInArrow(run, "item string, window string").distinct()


class Phrases:
    """A block of windows as sequences of word numbers, and the items that each belongs to."""

    def __init__(self, rows: list[tuple[str, str]]):
        found: dict[str, list[str]] = {}
        for item, window in rows:
            found.setdefault(window, []).append(item)
        split = [w.encode().split() for w in found]
        # 0 ends the sequence and 1 separates stretches, so words count from 2.
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for words in split for w in words}), 2)}
        self.items = list(found.values())
        self.lengths = np.array([len(words) for words in split], np.int64)
        self.patterns = np.zeros((len(split), int(self.lengths.max(initial=1))), np.int64)
        for row, words in enumerate(split):
            self.patterns[row, : len(words)] = [self.vocabulary[w] for w in words]
        self.shortest = int(self.lengths.min(initial=1))


def find(texts: list[str | None], phrases: Phrases, sample: int) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Words that a window covers: one flag per word of the shard, offsets of its texts, items found in each text."""
    get, codes, offsets = phrases.vocabulary.get, [], np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words = words_of(text)
        codes.append(np.fromiter(map(get, words, repeat(1)), np.int64, len(words)))
        offsets[i + 1] = offsets[i] + len(words)
    flat = np.concatenate([*codes, np.zeros(0, np.int64)])
    hit, items = np.zeros(len(flat), bool), [set() for _ in texts]
    # Runs of benchmark words end at every other word and at the end of a text.
    known = flat > 1
    first = known.copy()
    first[1:] &= ~known[:-1]
    starts_text = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts_text] = known[starts_text]
    starts = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    sizes = np.bincount(run[known], minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    kept = known & (sizes[np.maximum(run, 0)] >= phrases.shortest) if len(starts) else known & False
    places = np.flatnonzero(kept)
    if not len(places) or not len(phrases.items):
        return hit, offsets, items
    # One separator before each run; ``origin`` leads from the sequence back to words.
    begins = first[places]
    at = np.arange(len(places)) + np.cumsum(begins)
    sequence = np.ones(len(places) + int(begins.sum()), np.int64)
    sequence[at] = flat[places]
    origin = np.full(len(sequence), -1, np.int64)
    origin[at] = places
    index = FMIndex(sequence, sample)
    low, high = index.search(phrases.patterns, phrases.lengths)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    position = origin[index.locate(rows)]
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, position, 1)
    np.add.at(change, position + phrases.lengths[which], -1)
    hit = np.cumsum(change[:-1]) > 0
    owner = np.searchsorted(offsets, position, side="right") - 1
    pairs = np.unique(owner * len(counts) + which)
    for pair in pairs:
        items[pair // len(counts)].update(phrases.items[pair % len(counts)])
    return hit, offsets, items


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def in_characters(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of characters."""
    data = text.encode()
    # Letter case does not matter for where words are: upper-case letters are made lower first.
    where = [m.span() for m in _WORD.finditer(data.translate(_PLAIN))]
    return [(len(data[: where[a][0]].decode()), len(data[: where[b - 1][1]].decode())) for a, b in spans]


_SPANS = "array<struct<start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans_array(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in spans] for spans in rows], _SPAN_TYPE)


def _search(block, how: Decontamination, last: bool):
    """One block of windows over all shards; hits of earlier blocks come in as ``spans`` and ``items``."""

    def run(batches):
        phrases = block.value
        for piece in pieces(batches, "text", how.shard_bytes):
            texts = piece["text"].to_pylist()
            before, names = piece["spans"].to_pylist(), piece["items"].to_pylist()
            hit, offsets, items = find(texts, phrases, how.sample)
            counts, spans, characters, n_hit = [], [], [], []
            for i, text in enumerate(texts):
                flags = hit[offsets[i] : offsets[i + 1]]
                for span in before[i] or []:
                    flags[span["start"] : span["end"]] = True
                items[i].update(names[i] or [])
                counts.append(len(flags))
                n_hit.append(int(flags.sum()))
                spans.append(spans_of(flags) if n_hit[-1] else [])
                characters.append(in_characters(text, spans[-1]) if last and spans[-1] else [])
            found = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc_id"],
                        pa.array(counts, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        _spans_array(characters),
                        found,
                    ],
                    names=["doc_id", "n_words", "n_hit", "spans", "items"],
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], piece["text"], _spans_array(spans), found],
                    names=["doc_id", "text", "spans", "items"],
                )

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: Decontamination = Decontamination()) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, contaminated`` for every row of ``docs`` (``doc_id`` long, ``text``).

    ``spans`` are the merged hits as ``[start, end)`` in characters of the text, ``items`` the sorted ids (as strings) of
    benchmark items with a window in the text. Null and wordless texts have no words and are clean, so are all texts
    when the benchmark is empty. Items without words have no window; an item without id goes by the empty string; items
    that repeat count once. Repeated rows come back as often as they came, other columns are ignored.
    """
    spark = docs.sparkSession
    listed = stored(windows(benchmark, how.window), "benchmark-windows")
    blocks = max(1, -(-listed.count() // how.block))
    number = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for i in range(blocks):
        # About ``how.block`` pairs, whatever the benchmark's size.
        rows = [(r["item"], r["window"]) for r in listed.filter(number == i).collect()]
        phrases, last = spark.sparkContext.broadcast(Phrases(rows)), i == blocks - 1
        if last:
            schema = f"doc_id long, n_words long, n_hit long, spans {_SPANS}, items array<string>"
            found = found.mapInArrow(_search(phrases, how, True), schema)
        else:
            schema = f"doc_id long, text string, spans {_SPANS}, items array<string>"
            found = stored(found.mapInArrow(_search(phrases, how, False), schema), "contaminated")
    contaminated = (F.col("n_hit") > 0) & (F.lit(how.share) * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("contaminated", contaminated)


def without_spans(text: Column, spans: Column) -> Column:
    """The text with its spans cut out."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda s, x: F.struct(
            F.concat(s["kept"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).alias("kept"), x["end"].alias("at")
        ),
    )
    return F.concat(cut["kept"], F.substring(text, cut["at"] + 1, F.length(text)))
