"""Count windows of a stream of lines, on Spark's own keyed state.

Each source keeps its next position and the lines of windows still open (fewer than ``size``) in the state store,
under the stream's checkpoint: a restarted or repeated micro-batch finds the state it started from. With event
time a source that stays silent is taken out of the state by a timer, and reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

EVENT_TIME = "ts"
MEMBER = ("pos", "normalized", "level", "component")
MEMBERS = "array<struct<pos: bigint, normalized: string, level: string, component: string>>"
#: What ``keyed_windows`` yields: full windows, and sources that left the state. ``lines`` is the number of a
#: source's lines so far, ``open`` of those that no window will take.
OUTPUT = f"kind string, source string, win bigint, members {MEMBERS}, ts timestamp, lines bigint, open bigint"
WINDOW, EXPIRED = "window", "expired"
#: The columns that the windows need of a line, and how many lines are at hand as Python objects at once.
LINE = ["seq", "normalized", "level", "component", "us"]
SLICE = 4096
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def full_windows(n: int, size: int, stride: int) -> int:
    """How many windows ``n`` lines give."""
    return max(0, (n - size) // stride + 1)


class WindowProcessor(StatefulProcessor):
    """Numbers a source's lines and cuts its windows."""

    def __init__(self, size: int, stride: int, idle_ms: int | None) -> None:
        self.size, self.stride, self.idle_ms = size, stride, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", "next bigint, seen bigint")
        self.open = handle.getListState("open", "pos bigint, normalized string, level string, component string, us bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        # a micro-batch brings a source's lines in any order; ``seq`` orders them
        new = pd.concat([x[LINE] for x in rows], ignore_index=True).sort_values("seq", kind="stable", ignore_index=True)
        start, seen = self.place.get() if self.place.exists() else (0, None)
        held = list(self.open.get()) if start else []
        end = start + len(new)
        open_ = max(0, end - full_windows(end, self.size, self.stride) * self.stride)
        # windows go out slice by slice: as Python objects, lines take several times the room of the frame
        for at in range(0, len(new), SLICE):
            part = new.iloc[at : at + SLICE]
            low, high = start + at, start + at + len(part)
            held += zip(range(low, high), part["normalized"], part["level"], part["component"], part["us"], strict=True)
            base = held[0][0]  # positions in ``held`` have no gap
            out = []
            for win in range(full_windows(low, self.size, self.stride), full_windows(high, self.size, self.stride)):
                first = win * self.stride - base
                lines = held[first : first + self.size]
                times = [x[4] for x in lines if not pd.isna(x[4])]
                out.append((win, [dict(zip(MEMBER, x, strict=False)) for x in lines], max(times, default=None)))
            # the first window that is not full yet begins here
            still = full_windows(high, self.size, self.stride) * self.stride
            held = [x for x in held if x[0] >= still]
            if out:
                yield self.rows(WINDOW, key, *zip(*out, strict=True), end, open_)
        left = [(int(p), a, b, c, None if pd.isna(t) else int(t)) for p, a, b, c, t in held]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        latest = new["us"].max()
        latest = seen if pd.isna(latest) else max(int(latest), seen if seen is not None else int(latest))
        self.place.update((end, latest))
        if self.idle_ms is not None and latest is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(latest // 1000 + self.idle_ms)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        end, latest = self.place.get()
        left = len(list(self.open.get())) if self.open.exists() else 0
        self.place.clear()
        self.open.clear()
        yield self.rows(EXPIRED, key, [None], [None], [latest], end, left)

    def rows(self, kind: str, key: tuple, wins: list, members: list, times: list, lines: int, open_: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "kind": kind, "source": key[0], "win": pd.array(wins, dtype="Int64"), "members": list(members),
                "ts": pd.to_datetime(pd.Series(times, dtype="Int64"), unit="us"), "lines": lines, "open": open_,
            }
        )

    def close(self) -> None:
        pass


def stream_windows(cleaned: DataFrame, size: int = 8, stride: int = 4, idle: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """A stream of cleaned lines (source, seq, normalized, level, component, and ``ts`` where there is one) as a
    stream of ``OUTPUT`` rows.

    Lines of one micro-batch are ordered by ``seq``; a line of a later one comes later, whatever its ``seq``.
    With ``idle`` (an interval) a source whose latest ``ts`` lies that far behind the watermark leaves the state and gives
    one row of kind ``expired``; it starts at position 0 if it ever comes back. Lines behind the watermark, which trails the
    latest ``ts`` by ``delay``, are then dropped and counted in the query's progress. Without ``idle``
    nothing is dropped and sources stay.

    A null source is a source of its own. A micro-batch brings all its lines of a source to one task, so bound it by
    the trigger (``maxFilesPerTrigger``, ``maxBytesPerTrigger``). Streams that start from now on in this session
    keep their state in RocksDB, as this one asks.
    """
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be at least 1")
    timed = EVENT_TIME in cleaned.columns
    if idle is not None and not timed:
        raise ValueError("idle sources need an event time")
    idle_ms = None
    if timed:
        cleaned = cleaned.withColumn(EVENT_TIME, F.col(EVENT_TIME).cast("timestamp"))
    if idle is not None:
        cleaned = cleaned.withWatermark(EVENT_TIME, delay)
        idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    carried = [EVENT_TIME] if idle is not None else []
    micros = F.unix_micros(EVENT_TIME) if timed else F.lit(None).cast("bigint")
    lines = cleaned.select("source", "seq", "normalized", "level", "component", micros.alias("us"), *carried)
    cleaned.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return lines.groupBy("source").transformWithStateInPandas(
        statefulProcessor=WindowProcessor(size, stride, idle_ms),
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="none" if idle is None else "eventTime",
    )


def to_files(stream: DataFrame, path: str) -> DataStreamWriter:
    """Append a stream to a folder; its log of finished micro-batches keeps a repeated one from counting twice."""
    return stream.writeStream.format("parquet").option("path", path)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """The full windows that ``stream_windows`` wrote to ``out``."""
    found = spark.read.schema(OUTPUT).parquet(out).where(F.col("kind") == WINDOW)
    return found.select("source", "win", "members", EVENT_TIME)


def windows_stream(spark: SparkSession, out: str) -> DataFrame:
    """The same as a stream of its own."""
    found = spark.readStream.schema(OUTPUT).parquet(out).where(F.col("kind") == WINDOW)
    return found.select("source", "win", "members", EVENT_TIME)


def expired_sources(spark: SparkSession, out: str) -> DataFrame:
    """Sources that left the state: their number of lines, how many of them no window took, the latest event time."""
    found = spark.read.schema(OUTPUT).parquet(out).where(F.col("kind") == EXPIRED)
    return found.select("source", "lines", "open", EVENT_TIME)
