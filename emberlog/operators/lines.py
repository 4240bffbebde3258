"""Line tables: parse, keep the informative lines, normalise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import lines as L


def stripped(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", L.strip(F.col("line")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``level``, ``component`` and ``message`` to the stripped ``line``."""
    line = F.col("line")
    return stripped(lines).withColumns(
        {
            "level": L.parse_level(line),
            "component": L.parse_component(line),
            "message": L.parse_message(line),
        }
    )


def keep_informative(lines: DataFrame) -> DataFrame:
    """Only lines worth keeping, unparsed. Blank lines match no keyword and fall out here."""
    return stripped(lines).where(L.is_informative(F.col("line")))


def normalize_lines(kept: DataFrame) -> DataFrame:
    """Replace ``line`` by ``level``, ``component`` and ``normalized``."""
    line = F.col("line")
    return kept.withColumns(
        {
            "level": L.parse_level(line),
            "component": L.parse_component(line),
            "normalized": L.normalize_text(line),
        }
    ).drop("line")


def informative_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines worth keeping, with their normalised text; only kept lines pay for the masks."""
    return normalize_lines(keep_informative(lines))


def dry_run_sample(lines: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` informative lines in file order; a top-k, not a full sort."""
    order = [c for c in ("source", "block", "seq") if c in lines.columns]
    return (
        informative_lines(lines)
        .orderBy(*order)
        .limit(n)
        .select("source", "seq", "level", "component", "normalized")
    )
