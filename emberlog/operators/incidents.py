"""Windows to incidents, and the counts along the way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import incidents as I
from emberlog.functions.lines import is_informative
from emberlog.operators.lines import stripped
from emberlog.operators.windows import expected_windows

ORDER = ("source", "win")


def identify_windows(windows: DataFrame) -> DataFrame:
    """Add ``service`` and ``incident_id``, keeping the members as they are."""
    return windows.withColumn("service", I.window_service(F.col("members"))).withColumn(
        "incident_id",
        I.incident_id(I.incident_text(F.col("service"), F.col("members.normalized"))),
    )


def render_incidents(identified: DataFrame) -> DataFrame:
    """Fill in texts and statistics of identified windows."""
    members = F.col("members")
    return identified.withColumn("lines", members["normalized"]).select(
        *[c for c in identified.columns if c not in ("service", "incident_id", "members")],
        "incident_id",
        "service",
        "lines",
        I.incident_text(F.col("service"), F.col("lines")).alias("incident_text"),
        F.struct(
            I.levels_count(members).alias("levels_count"),
            I.top_components(members).alias("top_components"),
        ).alias("stats"),
    )


def dedup_incidents(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Keep the first row per ``incident_id``.

    ``min_by`` combines on the map side: an id that fills a third of the table reaches the
    shuffle as one row per task.
    """
    kept = df.groupBy("incident_id").agg(F.min_by(F.struct("*"), F.struct(*order)).alias("r"))
    return kept.select(*[F.col(f"r.{c}").alias(c) for c in df.columns])


def build_incidents(windows: DataFrame, dedup: bool = True) -> DataFrame:
    """Windows to incidents. Texts are built after the dedup, so the shuffle carries each line once."""
    identified = identify_windows(windows)
    return render_incidents(dedup_incidents(identified) if dedup else identified)


def ingest_funnel(
    lines: DataFrame,
    windows: DataFrame,
    size: int = 8,
    stride: int = 4,
    cap: int | None = None,
) -> DataFrame:
    """``(metric, value)``: lines in, lines kept, windows expected and built, ids, duplicates."""
    per_source = (
        stripped(lines)
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(is_informative(F.col("line"))).alias("kept"),
        )
    )
    read = per_source.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("informative_lines"),
        F.coalesce(F.sum(expected_windows(F.col("kept"), size, stride, cap)), F.lit(0)).alias(
            "expected_windows"
        ),
    )
    built = (
        identify_windows(windows)
        .groupBy("incident_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("windows"),
            F.count(F.lit(1)).alias("unique_ids"),
        )
        .withColumn("duplicates_removed", F.col("windows") - F.col("unique_ids"))
    )
    parts = [part.unpivot([], part.columns, "metric", "value") for part in (read, built)]
    return parts[0].union(parts[1])
