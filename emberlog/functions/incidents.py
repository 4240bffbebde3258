"""Column expressions over one window: an array of line structs in file order.

The arrays hold at most one window's lines, so histogram, mode and top-k stay inside the row
and need no shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog.functions.lines import infer_service


def tally(values: Column) -> Column:
    """``array<struct<rank_n, first, value>>``, most frequent first, ties by first appearance."""
    counted = F.transform(
        F.array_distinct(values),
        lambda v: F.struct(
            (-F.size(F.filter(values, lambda x: x == v))).alias("rank_n"),
            F.array_position(values, v).alias("first"),
            v.alias("value"),
        ),
    )
    return F.array_sort(counted)


def tally_map(ranked: Column) -> Column:
    """A tally as ``map<string,bigint>``."""
    return F.map_from_entries(
        F.transform(ranked, lambda e: F.struct(e["value"], (-e["rank_n"]).cast("bigint")))
    )


def majority_component(members: Column) -> Column:
    return F.get(tally(members["component"]), F.lit(0))["value"]


def levels_count(members: Column) -> Column:
    return tally_map(tally(members["level"]))


def top_components(members: Column, k: int = 3) -> Column:
    return tally_map(F.slice(tally(members["component"]), 1, k))


def window_service(members: Column) -> Column:
    return infer_service(majority_component(members))


def incident_text(service: Column, lines: Column) -> Column:
    return F.concat(F.lit("service: "), service, F.lit("\n"), F.array_join(lines, "\n"))


def incident_id(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 12)
