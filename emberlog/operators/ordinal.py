"""Dense positions without one huge sort.

``row_number`` keyed by source alone would send a source that holds a third of all rows to one
task. Here rows are ranked inside ``(keys, block)``, where a block is a slice of the order column
with a bounded number of rows, and each block's offset comes from a small table of block counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_SPAN = 1_000_000


def int_block(seq: Column, span: int = BLOCK_SPAN) -> Column:
    """Slice of an integer order column: at most ``span`` rows when it is unique per key."""
    return F.floor((seq - F.pmod(seq, F.lit(span))) / span)


def hash_block(digest: Column, digits: int = 4) -> Column:
    """Slice of a hexadecimal digest: ``16**digits`` even slices."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def dense_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    name: str = "pos",
    starts: DataFrame | None = None,
    read_once: bool = False,
) -> DataFrame:
    """Add the 0-based rank of each row within ``keys`` by ``order``.

    ``block`` must not decrease along ``order`` and must depend on the row alone, so that both
    sides agree. A null key is a key of its own; a null in ``order`` or ``block`` has no place and
    raises an error. The rows are shuffled once, on ``(keys, block)``, which serves the ranks and
    the join with the offsets. ``starts`` (``keys``, ``start``) counts on from earlier rows; it
    meets the offsets, not the rows, so a hot key stays spread.

    Counting the blocks normally scans the keys a second time, cheap on a stored table. With
    ``read_once`` the counts come from the shuffled rows instead, for inputs behind a costly filter.
    """
    # one struct, so that null keys meet in plain equality joins too
    slot = ["_key", "_block"]
    placeless = reduce(or_, [F.col(c).isNull() for c in order], block.isNull())
    failure = F.raise_error(F.lit(f"null in the order columns {', '.join(order)}"))
    placed = df.withColumns(
        {"_key": F.struct(*keys), "_block": F.when(placeless, failure).otherwise(block)}
    )
    # never false; both sides of the join below then carry the same test and can share one exchange
    placed = placed.where(F.col("_block").isNotNull())
    before = (
        Window.partitionBy("_key")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    n = F.count(F.lit(1)).alias("_n")
    if read_once:
        # the checksum makes the counting side need the same columns, so that both sides share one
        # exchange and the input is filtered once
        placed = placed.repartition(*slot)
        counted = placed.groupBy(*slot).agg(n, F.bit_xor(F.xxhash64(*df.columns)).alias("_sum"))
        offsets = counted.where(F.col("_sum").isNotNull()).select(*slot, offset)
    else:
        offsets = placed.groupBy(*slot).agg(n).select(*slot, offset)
    if starts is not None:
        offsets = offsets.join(
            starts.select(F.struct(*keys).alias("_key"), "start"), "_key", "left"
        ).select(*slot, (F.col("_offset") + F.coalesce("start", F.lit(0))).alias("_offset"))
    ranked = placed.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*slot).orderBy(*order))
    )
    return (
        ranked.join(offsets, slot)
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("bigint"))
        .drop("_key", "_block", "_offset", "_rank")
    )


def line_ordinal(
    lines: DataFrame,
    keys: Sequence[str] = ("source",),
    order: str = "seq",
    span: int = BLOCK_SPAN,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Position of each line within its source, in file order.

    A table read from text files carries a ``block`` column (the file block); other tables are
    sliced by the integer ``order`` column, which must be unique per source.
    """
    blocks = "block" in lines.columns
    return dense_position(
        lines,
        keys,
        ["block", order] if blocks else [order],
        F.col("block") if blocks else int_block(F.col(order), span),
        starts=starts,
        read_once=True,
    )


def global_ordinal(lines: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """Position of each line in one sequence over all sources, in order of their names, then in file order.

    No task sees more than a block of lines: positions within a source come from ``line_ordinal``, and the sources'
    offsets from a table of one row per source. ``lines`` is scanned twice, so let it be a stored table. A null
    source comes first.
    """
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
    starts = counted.select(F.struct("source").alias("_source"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = line_ordinal(lines, span=span).withColumn("_source", F.struct("source"))
    return placed.join(starts, "_source").withColumn("pos", F.col("_start") + F.col("pos")).drop("_source", "_start")
