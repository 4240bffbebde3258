"""Overlapping count windows over positioned lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES_PER_CHUNK = 256
MEMBER_FIELDS = ("pos", "normalized", "level", "component")


def _floor_div(value: Column, by: int) -> Column:
    return ((value - F.pmod(value, F.lit(by))) / by).cast("bigint")


def cover(pos: Column, size: int, stride: int) -> Column:
    """Numbers of all windows (``size`` long, one every ``stride``) that cover ``pos``."""
    last = _floor_div(pos, stride)
    first = F.greatest(_floor_div(pos - size, stride) + 1, F.lit(0))
    return F.sequence(first, last)


def sliding_windows(
    lines: DataFrame,
    size: int = 8,
    stride: int = 4,
    cap: int | None = None,
    keys: Sequence[str] = ("source",),
    fields: Sequence[str] = MEMBER_FIELDS,
) -> DataFrame:
    """Full windows as ``(keys, win, members)``; ``members`` is in position order.

    Positions of a key form one gap-free run, which may start anywhere.

    Lines are not copied once per window. They are collected into chunks of many windows that
    overlap by ``size - stride`` lines, so the shuffle carries a few percent more than the lines
    themselves, and the windows are cut out of each chunk inside the row. Chunks are keyed by
    ``(keys, chunk)`` with a bounded number of lines, so a hot source spreads over all tasks.
    """
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be at least 1")
    if stride > size:
        # lines in the gaps belong to no window; renumber the rest without gaps
        lines = lines.where(F.pmod("pos", F.lit(stride)) < size).withColumn(
            "pos", _floor_div(F.col("pos"), stride) * size + F.pmod("pos", F.lit(stride))
        )
        stride = size
    if cap:
        lines = lines.where(F.col("pos") < (cap - 1) * stride + size)

    per_chunk = max(1, LINES_PER_CHUNK // stride)
    span = (per_chunk - 1) * stride + size
    chunks = (
        lines.select(
            *keys,
            F.explode(cover(F.col("pos"), span, per_chunk * stride)).alias("chunk"),
            F.struct(*fields).alias("member"),
        )
        .groupBy(*keys, "chunk")
        .agg(F.array_sort(F.collect_list("member")).alias("members"))
        .where(F.size("members") >= size)
    )
    start = F.get("members", F.lit(0))["pos"]
    end = start + F.size("members")
    first = F.greatest(F.col("chunk") * per_chunk, -_floor_div(-start, stride))
    last = F.least((F.col("chunk") + 1) * per_chunk - 1, _floor_div(end - size, stride))
    runs = chunks.select(
        *keys, "members", start.alias("start"), first.alias("first"), last.alias("last")
    ).where("first <= last")
    return runs.select(
        *keys,
        F.explode(
            F.transform(
                F.sequence("first", "last"),
                lambda win: F.struct(
                    win.alias("win"),
                    F.slice(
                        F.col("members"), (win * stride - F.col("start") + 1).cast("int"), size
                    ).alias("members"),
                ),
            )
        ).alias("w"),
    ).select(*keys, "w.win", "w.members")


def expected_windows(n: Column, size: int = 8, stride: int = 4, cap: int | None = None) -> Column:
    """How many windows ``n`` lines give; never below zero."""
    count = F.greatest(_floor_div(n - size, stride) + 1, F.lit(0))
    return F.least(count, F.lit(cap)) if cap else count
