"""Token counts as rollups that are kept up to date by deltas.

Counts of documents become signed rows: an insert adds, a delete takes away what the document had, a revision does both.
A batch is summed by source, language and tokenizer version before it is written, and replaces itself when it is written
again: committing a batch twice, or again after a failure, changes nothing. Totals are the sum over committed batches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, pieces

#: Pattern of the public byte-level vocabularies. (Fixed value.)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ["source", "lang", "version"]
_BATCH = "source string, lang string, version string, n_docs long, n_tokens long, batch string"


def bpe_counts(docs: DataFrame, ranks: bytes, version: str) -> DataFrame:
    """``doc_id, source, lang, version, n_tokens`` by a byte-level BPE whose rank file is given as bytes (about 1 MB).

    One row per row of ``docs``; a null text has no tokens.
    """
    file = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.value.splitlines())}
        encoder = tiktoken.Encoding(version, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        for piece in pieces(batches, "text"):
            # Without special tokens every string is ordinary text.
            counts = [len(encoder.encode_ordinary(t)) if t else 0 for t in piece["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], piece["source"], piece["lang"], pa.array(counts, pa.int64())],
                names=["doc_id", "source", "lang", "n_tokens"],
            )

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")])
    counted = asked.mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(version).alias("version"), "n_tokens")


def word_counts(docs: DataFrame, version: str = "words") -> DataFrame:
    """The same table by white space between words."""
    words = F.coalesce(F.size(F.array_remove(F.split(F.col("text").cast("string"), SPACE), "")), F.lit(0))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("version"),
        words.cast("long").alias("n_tokens"),
    )


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    """``counts`` as they were when the documents came in."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    return deletes(before).unionByName(inserts(after))


def commit(path: str, batch: str, changes: list[DataFrame]) -> None:
    """Write one batch of signed rows, summed per key, below ``path``; it replaces an earlier copy of itself.

    Null keys are values of their own. Sums of zero stay out; a batch without rows still counts as committed.
    """
    rows = reduce(DataFrame.unionByName, changes)
    summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    summed = summed.filter("n_docs <> 0 or n_tokens <> 0")
    summed.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``source, lang, version, n_docs, n_tokens`` over all committed batches; keys that cancelled out are gone."""
    rows = spark.read.schema(_BATCH).option("basePath", path).parquet(path)
    summed = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return summed.filter("n_docs <> 0 or n_tokens <> 0")
