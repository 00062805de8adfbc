"""Helpers shared by the operators: stored intermediates, bounded pieces of Arrow batches, ASCII words, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..session import put, remove, work_path

#: Bytes of text that one Python step works on at a time.
PIECE_BYTES = 4 << 20

#: White space between words, as a class of Java regular expressions: [\x20\x09-\x0D].
SPACE = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _written(df: DataFrame, name: str, options: dict | None = None) -> str:
    path = work_path(df.sparkSession, name)
    put(df, path, options=options)
    return path


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: its lineage ends at those files. ``options`` are
    the writer's, as ``WIDE_ROWS``."""
    return df.sparkSession.read.schema(df.schema).parquet(_written(df, name, options))


def stored_slices(slices: Iterable[DataFrame], name: str) -> DataFrame:
    """The slices of an intermediate result, written one after another: only one slice's shuffles are there at a time."""
    slices = list(slices)
    return slices[0].sparkSession.read.schema(slices[0].schema).parquet(*[_written(df, name) for df in slices])


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` results that nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, *{file.rpartition("/")[0] for file in df.inputFiles()})


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes of text each; one longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def encoded_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts, A-Z lower-cased: distinct words, one code per word, row offsets.

    Null texts have no words.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    # Splitting leaves an empty string where a text begins or ends with white space.
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    rows = np.repeat(np.arange(len(lengths)), lengths)
    if not filled.all():
        flat, rows = flat.filter(pa.array(filled)), rows[filled]
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(np.bincount(rows, minlength=len(lengths)), out=offsets[1:])
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    return words, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def in_slices(values: np.ndarray, count: int) -> tuple[pa.Array, pa.Array]:
    """A flat array as ``count`` numbered blocks of bytes, so that arrays of many tasks are summed in parallel."""
    return (
        pa.array(range(count), pa.int32()),
        pa.array([b.tobytes() for b in np.split(values, count)], pa.binary()),
    )


def summed_slices(rows: DataFrame, count: int, length: int, dtype: str) -> np.ndarray:
    """Sum of the arrays that tasks left as blocks (columns ``slice``, ``block``): ``length`` numbers at the driver.

    A group streams through its task batch by batch, so memory does not grow with the number of tasks.
    """
    wide = "float64" if np.dtype(dtype).kind == "f" else "int64"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch["slice"][row].as_py()
                block = np.frombuffer(batch["block"][row].as_py(), dtype).astype(wide)
                total = block if total is None else total + block
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "block"]
            )

    result = np.zeros(length, wide)
    width = length // count
    for row in rows.groupBy("slice").applyInArrow(add, "slice int, block binary").collect():  # ``count`` rows
        result[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["block"], wide)
    return result
