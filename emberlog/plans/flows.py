"""The composed jobs: lines to incidents, incidents to labelled splits, outputs to a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberlog.operators import evaluation, labelling, repair, splits
from emberlog.operators.incidents import build_incidents
from emberlog.operators.lines import informative_lines, keep_informative, normalize_lines
from emberlog.operators.ordinal import line_ordinal
from emberlog.operators.windows import sliding_windows
from emberlog.session import pin
from emberlog.sources.files import read_log_lines


def positioned_lines(lines: DataFrame) -> DataFrame:
    """Informative lines with their dense position per source.

    Lines are ranked before they are normalised: the counting pass then only filters, and the masks
    run behind the shuffle, spread over its partitions even when the input came in few pieces.
    """
    kept = keep_informative(lines)
    columns = [c for c in ("source", "block", "seq", "line") if c in kept.columns]
    return normalize_lines(line_ordinal(kept.select(*columns)))


def lines_to_windows(
    lines: DataFrame, size: int = 8, stride: int = 4, cap: int | None = None
) -> DataFrame:
    return sliding_windows(positioned_lines(lines), size, stride, cap)


def lines_to_incidents(
    lines: DataFrame, size: int = 8, stride: int = 4, cap: int | None = None, dedup: bool = True
) -> DataFrame:
    return build_incidents(lines_to_windows(lines, size, stride, cap), dedup)


def files_to_incidents(
    spark: SparkSession,
    path: str | list[str],
    size: int = 8,
    stride: int = 4,
    cap: int | None = None,
    by: str = "file",
) -> tuple[DataFrame, Observation]:
    """Text files to incidents, with the line counts observed while reading.

    The files are read once: what survives the filter is pinned as a columnar table, which both
    ranking passes then scan and which fixes the order keys of the text scan.
    """
    counts = Observation("lines")
    lines = read_log_lines(spark, path, by).observe(
        counts, F.count(F.lit(1)).alias("total_lines"), F.count_if(F.col("line") == "").alias("blank_lines")
    )
    kept = pin(
        informative_lines(lines).select(
            "source", "block", "seq", "level", "component", "normalized"
        ),
        "informative",
    )
    return build_incidents(sliding_windows(line_ordinal(kept), size, stride, cap)), counts


def incidents_to_splits(incidents: DataFrame, pinned: bool = True, **ratios) -> DataFrame:
    """Label, validate and split. Labelled incidents are pinned: four passes follow."""
    labelled = labelling.label_incidents(incidents)
    if pinned:
        labelled = pin(labelled, "labelled")
    bad = labelling.validate_pairs(labelled).first()
    if sum(bad[c] for c in bad.asDict() if c != "pairs"):
        raise ValueError(f"invalid prompt/response pairs: {bad.asDict()}")
    return splits.stratified_split(labelled, **ratios)


def outputs_to_scores(outputs: DataFrame, policy: str = "blank") -> DataFrame:
    """Raw outputs with their truth to one row of answers and flags per example."""
    return evaluation.score_rows(evaluation.truth_columns(repair.predict(outputs, policy)))


def triage_by_host(lines: DataFrame) -> DataFrame:
    """Which incidents happened per host, how severe they are, and what to do."""
    found = labelling.label_columns(lines_to_incidents(lines))
    return found.groupBy("source", "service", "severity", "likely_cause", "recommended_action").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.min("win").alias("first_window"),
        F.max("win").alias("last_window"),
    )
