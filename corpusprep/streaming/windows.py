"""Event-time windows for batch and streaming DataFrames.

On a stream, give ``late`` (a delay such as "1 hour"): it bounds the state and decides how late a row may come. Rows
later than that are dropped by the stream, so a stream and a batch run agree only as long as no row is that late.
``ts`` must be TIMESTAMP; a TIMESTAMP_NTZ column has to be cast first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor


def _watermarked(df: DataFrame, ts: str, late: str | None) -> DataFrame:
    return df.withWatermark(ts, late) if late else df


def _counted(df: DataFrame, window: Column, by: list[str], out: str) -> DataFrame:
    counts = df.groupBy(window.alias("_window"), *by).agg(F.count("*").alias(out))
    return counts.select(*by, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), out)


def daily_counts(df: DataFrame, ts: str, by: list[str], out: str, late: str | None = None) -> DataFrame:
    """Rows per calendar day."""
    return _counted(_watermarked(df, ts, late), F.window(ts, "1 day"), by, out)


def sliding_rate(
    df: DataFrame, ts: str, by: list[str], seconds: int, every: int, late: str | None = None
) -> DataFrame:
    """Rows and rows per second in windows of ``seconds`` that start every ``every`` seconds.

    A row falls into seconds / every windows; they are counted inside the task before the shuffle.
    """
    window = F.window(ts, f"{seconds} seconds", f"{every} seconds")
    counts = _counted(_watermarked(df, ts, late), window, by, "n_events")
    return counts.withColumn("per_second", F.col("n_events") / F.lit(seconds).cast("double"))


def quiet_sessions(df: DataFrame, ts: str, by: list[str], quiet: str, out: str, late: str) -> DataFrame:
    """Batches on a stream that close when a key has been quiet; emitted once the watermark has passed them.

    A gap of exactly ``quiet`` ends a batch. Session windows would still merge there, so theirs is one microsecond
    shorter; ``window_end`` is the last arrival plus ``quiet``.
    """
    counts = _counted(_watermarked(df, ts, late), F.session_window(ts, f"{quiet} -1 microseconds"), by, out)
    return counts.withColumn("window_end", F.col("window_end") + F.expr("INTERVAL 1 MICROSECOND"))


def first_seen(df: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """The first row of every key within the watermark's reach: a seen-set of bounded size.

    A copy that comes later than the watermark is kept again, unlike in a batch run over everything.
    """
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


class QuietBatches(StatefulProcessor):
    """Batches per key with state of its own: a batch ends when nothing arrives for ``quiet`` microseconds.

    The state is a short list of open batches (first and last arrival, count); rows that come in between two of them join
    them. A batch is closed by a timer when the watermark passes its end, so no later row of its key is needed. Rows out:
    every batch that changed, with ``closed``; a batch that became part of another one comes out with no objects.
    """

    def __init__(self, key: str, out: str, quiet: int):
        self.key, self.out, self.quiet = key, out, quiet

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "first long, last long, n long")

    def _rows(self, key, batches: list[tuple], closed: bool):
        return pd.DataFrame(
            {
                self.key: pd.Series([key] * len(batches), dtype=object),
                "first_arrival": pd.Series([b[0] for b in batches], dtype="int64"),
                "last_arrival": pd.Series([b[1] for b in batches], dtype="int64"),
                self.out: pd.Series([b[2] for b in batches], dtype="int64"),
                "closed": pd.Series([closed] * len(batches), dtype=bool),
            }
        )

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - names given by Spark
        before = [tuple(b) for b in self.open.get()]
        pieces = list(before)
        for frame in rows:
            at = np.sort(frame["at"].to_numpy(np.int64))
            starts = np.flatnonzero(np.diff(at, prepend=at[:1] - self.quiet) >= self.quiet)
            ends = np.append(starts[1:], len(at))
            pieces += [(int(at[s]), int(at[e - 1]), int(e - s)) for s, e in zip(starts, ends)]
            pieces = self._joined(pieces)
        known = set(before)
        changed = [b for b in pieces if b not in known]
        gone = {b[0] for b in before} - {b[0] for b in pieces}
        self.open.put(pieces)
        self._wake(pieces)
        yield self._rows(key[0], changed + [(first, first, 0) for first in sorted(gone)], False)

    def _ends(self, batch: tuple) -> int:
        return (batch[1] + self.quiet) // 1000

    def _wake(self, batches: list[tuple]) -> None:
        """One timer, for the batch that ends first; it closes all that have ended and sets the next."""
        if batches:
            self.handle.registerTimer(min(map(self._ends, batches)))

    def _joined(self, pieces: list[tuple]) -> list[tuple]:
        merged: list[tuple] = []
        for first, last, n in sorted(pieces):
            if merged and first - merged[-1][1] < self.quiet:
                merged[-1] = (merged[-1][0], max(merged[-1][1], last), merged[-1][2] + n)
            else:
                merged.append((first, last, n))
        return merged

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803 - names given by Spark
        batches = [tuple(b) for b in self.open.get()]
        done = [b for b in batches if self._ends(b) <= timerValues.getCurrentWatermarkInMs()]
        left = [b for b in batches if b not in set(done)]
        if left:
            self.open.put(left)
            self._wake(left)
        else:
            self.open.clear()
        yield self._rows(key[0], done, True)

    def close(self) -> None:
        pass


def quiet_batches_with_open(df: DataFrame, ts: str, key: str, quiet_seconds: int, out: str, late: str) -> DataFrame:
    """A stream's batches as they change: ``key, first_arrival, last_arrival, out, closed`` in update mode.

    Merge the rows by (key, first_arrival) and drop those without objects: that table holds closed and open batches, as
    a batch run over the same rows gives them. State holds what the watermark has not closed. Rows later than ``late``
    are dropped. Only the key and the time reach Python; a key's rows of one micro-batch pass through one task.
    """
    asked = df.withWatermark(ts, late).select(ts, F.col(key).cast("string").alias(key), F.unix_micros(ts).alias("at"))
    found = asked.groupBy(key).transformWithStateInPandas(
        QuietBatches(key, out, quiet_seconds * 1_000_000),
        f"{key} string, first_arrival long, last_arrival long, {out} long, closed boolean",
        "Update",
        "EventTime",
    )
    times = {c: F.timestamp_micros(c) for c in ("first_arrival", "last_arrival")}
    return found.withColumns(times)
