"""Log lines as a stream: cleaning, dedup and triage, and running streams to the end of their input.

The column code is the batch code. Cleaning and triage are stateless; windows (``streaming.windows``) and dedup
keep their state in Spark's state store.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from emberlog.operators.incidents import build_incidents
from emberlog.operators.labelling import label_columns
from emberlog.operators.lines import informative_lines
from emberlog.operators.repair import triage

LINE_FIELDS = ["normalized", "level", "component"]


def stream_clean(lines: DataFrame) -> DataFrame:
    """Informative, normalised lines of a stream; stateless."""
    carried = [c for c in ("ts",) if c in lines.columns]
    return informative_lines(lines).select("source", "seq", *carried, *LINE_FIELDS)


def stream_incidents(windows: DataFrame) -> DataFrame:
    """Incidents of a stream of windows; stateless, repeats included."""
    return build_incidents(windows, dedup=False)


def stream_dedup(incidents: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Drop repeats of an id within the watermark.

    An id is forgotten once the watermark, which trails the latest event time by ``delay``, reaches the event time
    that it was first seen with, plus ``delay``; then it may come back. That bounds the state, unlike in the batch
    dedup. Rows at or behind the watermark are lost, so ``delay`` must cover the slowest source;
    ``state_changes`` tells how many were, and how many ids were forgotten.
    """
    return incidents.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["incident_id"])


def stream_triage(incidents: DataFrame) -> DataFrame:
    """Labels for a stream of incidents; a ``raw_output`` column is repaired and overridden, and
    without one the rules give the answer. Stateless."""
    if "raw_output" in incidents.columns:
        return triage(incidents)
    return label_columns(incidents)


def run_available(writer: DataStreamWriter, checkpoint: str) -> list[dict]:
    """Process everything that is there now, then stop; what the query reported of its micro-batches."""
    started = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started.recentProgress


CHANGES = "batch bigint, rows bigint, late bigint, forgotten bigint, held bigint, watermark timestamp"


def state_changes(spark: SparkSession, progress: Iterable[dict]) -> DataFrame:
    """(``CHANGES``) per reported micro-batch, summed over its stateful operators: rows read, rows dropped behind the
    watermark, state rows removed by it, state rows held afterwards."""
    rows = []
    for report in progress:
        state = report["stateOperators"]
        watermark = (report.get("eventTime") or {}).get("watermark")
        rows.append(
            (
                report["batchId"], report["numInputRows"], sum(s["numRowsDroppedByWatermark"] for s in state),
                sum(s["numRowsRemoved"] for s in state), sum(s["numRowsTotal"] for s in state), watermark,
            )
        )
    found = spark.createDataFrame(rows, CHANGES.replace("watermark timestamp", "watermark string"))
    return found.withColumn("watermark", found["watermark"].cast("timestamp"))
