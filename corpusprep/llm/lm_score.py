"""Language-model scoring: a hashed maximum-entropy model with n-gram and skip features and a class-factored softmax.

``P(word | history) = P(group | history) * P(class | group, history) * P(word | class)``. A word's class follows from
its ending, so it needs no table; two softmaxes of ``WAYS`` each choose group and class by weights in one hashed table.
Features of the history: class of the last word, last word (bigram), class of the word before (skip), both words
(trigram). Inside its class a word has its add-one frequency; words not seen in training share one place per class.

1. Each task encodes its documents in chunks of a few MB, counts their words, and takes gradient steps (AdaGrad on small
   batches) on the training documents. Chunks are stored.
2. The tasks' weights are averaged by how often each row of the table was used: the table's size is a parameter.
3. Word counts of all chunks meet by word, once per chunk and word, so a frequent word is no hot key; counts go back to
   their chunk, where the documents are scored in numpy batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import WIDE_ROWS
from .common import encoded_words, in_slices, pieces, stored, summed_slices

WAYS = 16
START = WAYS * WAYS
_FEATURES = 4
_SLICES = 64
#: Squared gradients a weight starts with: the first steps of a rare feature stay small.
_PRIOR = 16.0
#: No weight grows beyond this, so that sums of ``_FEATURES`` weights have float32 exponentials.
_LIMIT = 20.0
_MARKS = b".,;:!?|%$&*#\"')("


@dataclass(frozen=True)
class LanguageModel:
    """``rows_bits``: log2 of the rows of the weight table (64 bytes each); ``rounds``: passes of gradient steps over all
    training documents, each starting from the average of the one before."""

    rows_bits: int = 15
    batch: int = 16_384
    rate: float = 0.2
    rounds: int = 1
    chunk_bytes: int = 8 << 20

    def __post_init__(self):
        if not 6 <= self.rows_bits <= 24 or min(self.batch, self.rounds, self.chunk_bytes) < 1 or self.rate <= 0:
            raise ValueError("rows_bits from 6 to 24, the others above 0")


def class_of(word: bytes) -> int:
    core = word.rstrip(_MARKS)
    return xxhash.xxh32_intdigest(core[-3:] + b"." * (len(core) < len(word))) % START


def _spread(x: np.ndarray) -> np.ndarray:
    """A 32-bit hash of 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def features(codes: np.ndarray, ends: np.ndarray, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """``_FEATURES`` hashed features of the history of every token; a history does not cross its document's start."""
    n = len(codes)
    word, kind = hashes[codes], classes[codes].astype(np.uint32)
    last, before = np.full(n, START, np.uint32), np.full(n, START, np.uint32)
    last_kind, before_kind = last.copy(), before.copy()
    last[1:], last_kind[1:] = word[:-1], kind[:-1]
    starts = np.concatenate([[0], ends[:-1]])
    last[starts] = last_kind[starts] = START
    before[1:], before_kind[1:] = last[:-1], last_kind[:-1]
    before[starts] = before_kind[starts] = START
    found = np.empty((_FEATURES, n), np.uint32)
    found[0] = _spread(last_kind + np.uint32(0x10000))
    found[1] = _spread(last + np.uint32(0x20000))
    found[2] = _spread(before_kind + np.uint32(0x30000))
    found[3] = _spread(last ^ _spread(before + np.uint32(0x40000)))
    return found


class Weights:
    """The table: a row of ``WAYS`` weights for each hashed feature, and for each feature together with a group."""

    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.mask = np.uint32((1 << bits) - 1)
        shape = (1 << bits, WAYS)
        self.table = np.zeros(shape, np.float32) if table is None else table.reshape(shape).astype(np.float32)
        self.squares = np.full(shape, _PRIOR, np.float32)
        self.used = np.zeros(shape[0], np.float32)

    def rows(self, found: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all features for the group, and of all features for the class inside the group."""
        inner = _spread(found + (groups.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B9))
        return (found & self.mask).astype(np.int64), (inner & self.mask).astype(np.int64)

    def exponents(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of weights, and their exponentials; weights are kept so small that none overflows."""
        logits = self.table[rows[0]]
        for row in rows[1:]:
            logits += self.table[row]
        return logits, np.exp(logits)

    def log_probability(self, found: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """log P(class of the token | history), in batches."""
        result = np.zeros(len(kinds), np.float64)
        for start in range(0, len(kinds), 1 << 15):
            part = slice(start, start + (1 << 15))
            groups, members = kinds[part] // WAYS, kinds[part] % WAYS
            here = np.arange(len(groups))
            for rows, truth in zip(self.rows(found[:, part], groups), (groups, members), strict=True):
                logits, weight = self.exponents(rows)
                result[part] += logits[here, truth] - np.log(weight @ np.ones(WAYS, np.float32))
        return result

    def learn(self, found: np.ndarray, kinds: np.ndarray, how: LanguageModel) -> None:
        """Gradient steps over tokens in order, one per batch."""
        size = self.table.size
        ways = np.arange(WAYS)
        for start in range(0, len(kinds), how.batch):
            part = slice(start, start + how.batch)
            groups, members = kinds[part] // WAYS, kinds[part] % WAYS
            here = np.arange(len(groups))
            step = np.zeros(size)
            for rows, truth in zip(self.rows(found[:, part], groups), (groups, members), strict=True):
                _, wrong = self.exponents(rows)
                wrong /= (wrong @ np.ones(WAYS, np.float32))[:, None]
                wrong[here, truth] -= 1
                weights = wrong.astype(np.float64).reshape(-1)
                for row in rows:
                    step += np.bincount((row[:, None] * WAYS + ways).reshape(-1), weights=weights, minlength=size)
                self.used += np.bincount(rows.reshape(-1), minlength=len(self.used))
            step = step.astype(np.float32).reshape(self.table.shape)
            self.squares += step * step
            self.table -= how.rate * step / np.sqrt(self.squares)
            np.clip(self.table, -_LIMIT, _LIMIT, out=self.table)

    def blocks(self) -> tuple[pa.Array, pa.Array]:
        """Weights times use, and use, for the average over tasks."""
        flat = np.concatenate([self.table * self.used[:, None], self.used[:, None]], axis=1)
        return in_slices(flat.ravel(), _SLICES)


_CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, ends array<long>, codes array<int>, hashes array<int>, "
    "classes array<int>, words array<string>, trained array<long>, slice int, block binary"
)
_NAMES = [field.split()[0] for field in _CHUNK.split(", ")]


def _list(values, kind) -> pa.Array:
    values = pa.array(values, kind) if not isinstance(values, pa.Array) else values.cast(kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _encode(how: LanguageModel):
    """Documents to stored chunks and, at the end of a task, its weights in blocks."""

    def run(batches):
        weights = Weights(how.rows_bits)
        first = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(pieces(batches, "text", how.chunk_bytes)):
            words, plain, offsets = encoded_words(piece["text"])
            # One end follows each text: the empty word.
            rows = np.arange(piece.num_rows)
            codes = np.full(len(plain) + len(rows), len(words), np.int64)
            codes[np.arange(len(plain)) + np.repeat(rows, np.diff(offsets))] = plain
            ends = offsets[1:] + rows + 1
            words.append(b"")
            hashes = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.uint32, len(words))
            classes = np.fromiter(map(class_of, words), np.int64, len(words))
            held = piece["held_out"].to_numpy(zero_copy_only=False).astype(bool)
            learning = ~np.repeat(held, np.diff(ends, prepend=0))
            found = features(codes, ends, hashes, classes)
            weights.learn(found[:, learning], classes[codes[learning]], how)
            trained = np.bincount(codes[learning], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number], pa.int64()),
                    _list(piece["doc_id"], pa.int64()),
                    _list(held, pa.bool_()),
                    _list(ends, pa.int64()),
                    _list(codes.astype(np.int32), pa.int32()),
                    _list(hashes.view(np.int32), pa.int32()),
                    _list(classes.astype(np.int32), pa.int32()),
                    _list(pa.array(words, pa.binary()).cast(pa.string()), pa.string()),
                    _list(trained, pa.int64()),
                    pa.nulls(1, pa.int32()),
                    pa.nulls(1, pa.binary()),
                ],
                names=_NAMES,
            )
        if weights.used.any():
            yield _model_rows(weights)

    return run


def _model_rows(weights: Weights) -> pa.RecordBatch:
    numbers, blocks = weights.blocks()
    kinds = [pa.int64(), *[pa.list_(t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())]]
    return pa.RecordBatch.from_arrays([*[pa.nulls(len(blocks), k) for k in kinds], numbers, blocks], names=_NAMES)


def _relearn(how: LanguageModel, table):
    """A further round of gradient steps over stored chunks, starting from the average of the round before."""

    def run(batches):
        weights = Weights(how.rows_bits, table.value)
        for batch in batches:
            for row in range(batch.num_rows):
                ends, codes, hashes, classes, held = (
                    batch[c][row].values.to_numpy(zero_copy_only=False)
                    for c in ("ends", "codes", "hashes", "classes", "held")
                )
                classes = classes.astype(np.int64)
                learning = ~np.repeat(held.astype(bool), np.diff(ends, prepend=0))
                found = features(codes, ends, hashes.view(np.uint32), classes)
                weights.learn(found[:, learning], classes[codes[learning]], how)
        if weights.used.any():
            numbers, blocks = weights.blocks()
            yield pa.RecordBatch.from_arrays([numbers, blocks], names=["slice", "block"])

    return run


def _average(blocks: DataFrame, how: LanguageModel) -> np.ndarray:
    rows = 1 << how.rows_bits
    total = summed_slices(blocks, _SLICES, rows * (WAYS + 1), "float32").reshape(rows, WAYS + 1)
    return (total[:, :WAYS] / np.maximum(total[:, WAYS:], 1.0)).astype(np.float32)


def lm_score(docs: DataFrame, held_out, how: LanguageModel = LanguageModel()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``docs`` has ``doc_id`` (long) and ``text``; ``held_out`` is a boolean Column of it, rows where it is null count as
    training documents. ``base_score`` is the text's log10 probability by add-one word frequencies, ``score`` that of the
    model. A null text is empty: its only token is the end. Without training documents all words are unknown and the
    classes equally likely. Repeated rows count and come back as often as they came, a null doc_id stays null, other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    asked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    encoded = stored(asked.mapInArrow(_encode(how), _CHUNK), "lm-chunks", WIDE_ROWS)
    chunks = encoded.filter("chunk is not null")
    table = _average(encoded.filter("slice is not null").select("slice", "block"), how)
    for _ in range(how.rounds - 1):
        start = spark.sparkContext.broadcast(table)
        more = chunks.select("ends", "codes", "hashes", "classes", "held")
        table = _average(stored(more.mapInArrow(_relearn(how, start), "slice int, block binary"), "lm-round"), how)

    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "trained", "classes"))).select(
        "chunk", F.col("pos").alias("place"), "col.words", "col.trained", F.col("col.classes").alias("class")
    )
    # A word is in a chunk's list once, so even the most frequent word has no more rows than there are chunks.
    word = Window.partitionBy("words")
    counted = stored(
        listed.select(
            "chunk",
            "place",
            "class",
            F.sum("trained").over(word).alias("count"),
            (F.col("chunk") == F.min("chunk").over(word)).alias("first"),
            "trained",
        ),
        "lm-counts",
    )
    tokens, known = np.zeros(START), np.zeros(START)
    sums = counted.groupBy("class").agg(
        F.sum("trained").alias("tokens"), F.count_if(F.col("first") & (F.col("count") > 0)).alias("words")
    )
    for row in sums.collect():  # one row per class
        tokens[row["class"]], known[row["class"]] = row["tokens"], row["words"]
    model = spark.sparkContext.broadcast((table, tokens, known))
    by_chunk = chunks.select("chunk", "doc_ids", "held", "ends", "codes", "hashes", "classes").groupBy("chunk")
    counts = counted.select("chunk", "place", "count").groupBy("chunk")
    return by_chunk.cogroup(counts).applyInArrow(
        _score(how, model),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _score(how: LanguageModel, model):
    """Score the documents of one chunk; its words' counts come as rows of their own."""

    def run(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        table, tokens, known = model.value
        weights = Weights(how.rows_bits, table)
        total, vocabulary = tokens.sum(), known.sum()
        ends, codes, hashes, classes = (
            chunk[c].combine_chunks().values.to_numpy(zero_copy_only=False) for c in ("ends", "codes", "hashes", "classes")
        )
        classes = classes.astype(np.int64)
        seen = np.zeros(len(classes))
        seen[counts["place"].to_numpy()] = counts["count"].to_numpy()
        base = np.log10((seen + 1) / (total + vocabulary + 1))
        inside = np.log10((seen + 1) / (tokens[classes] + known[classes] + 1))
        kinds = weights.log_probability(features(codes, ends, hashes.view(np.uint32), classes), classes[codes])
        starts = np.concatenate([[0], ends[:-1]])

        def per_document(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, starts)

        size = len(ends)
        return pa.table(
            {
                "doc_id": chunk["doc_ids"].combine_chunks().values,
                "held_out": chunk["held"].combine_chunks().values,
                "n_tokens": np.diff(ends, prepend=0).astype(np.int64),
                "n_known": per_document((seen > 0).astype(np.int64)[codes]),
                "train_tokens": np.full(size, int(total), np.int64),
                "base_score": per_document(base[codes]),
                "score": per_document(inside[codes] + kinds / np.log(10)),
            }
        )

    return run
