"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. Every document has a size in words and a place in its source's shuffled order (the order of a keyed
   digest of its id), so the words of a source lie on a line. The line, repeated, is cut into blocks of ``BLOCK`` words.
2. Targets: the total is shared by weight; no source goes beyond ``cap`` times its size and what it
   leaves is shared again by weight until none is above.
3. Slot ``i`` of the schedule takes the point ``frac(i * golden ratio)``; the source in whose piece of
   the cumulative targets it falls fills the slot. Any run of the schedule therefore holds every source
   in nearly its share.
4. Slots are ranked per source, slice by slice with offsets; rank ``r`` takes block ``r`` of the source's repeated
   line. A slot that would go beyond the source's target stays empty.
5. What a source's slots leave open to its target, less than a block or the few blocks by which the points miss a share,
   follows in slots behind the schedule, the last block cut to the word.
6. Documents are cut at the borders of blocks and meet the blocks by (source, rank): what is taken of a document are
   its words in blocks that fill a slot, and the slots order the documents of the mix.

Places in the shuffled order come from prefix sums over ``BUCKETS``
slices of the digest: a source that holds a third of all rows is ranked in that many pieces. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import n_words, own, pin, table

#: Slices of the shuffled order of each source (a power of 16).
BUCKETS = 4096
#: Words of a block.
BLOCK = 512
#: The golden ratio as a quotient of neighbouring Fibonacci numbers: whole numbers, exact at any slot.
GOLDEN = (1_134_903_170, 1_836_311_903)
#: Slots that are ranked together.
SLICE = 1 << 16
#: Cells in which points and pieces of the cumulative targets meet.
CELLS = 4096


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """(source, source_size) -> one row per source with ``sid`` (1 up, by code point, null last),
    ``weight`` and ``target``.

    Capped sources come first in the order of size / weight. The level of the others follows from the
    fewest capped ones that leave none above; capping more would only lower it, so it is the largest that
    fits. One row per source goes through one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    n = len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("sid") - 1, F.lit(n)))
    by_ratio = Window.orderBy("_ratio", "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.col("source_size")
    levels = (
        sizes.withColumn("sid", rank)
        .withColumn("weight", weight)
        .withColumn("_ratio", size * cap / F.col("weight"))
        .withColumn("_all", F.lit(total) * F.sum(size).over(everything))
        .withColumn("_full", F.coalesce(F.sum(size).over(before), F.lit(0)) * cap)
        .withColumn("_level", (F.col("_all") - F.col("_full")) / F.sum("weight").over(after))
    )
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))
    level = F.max(fits).over(everything)
    target = F.least(size * cap, F.col("weight") * F.coalesce(level, F.col("_ratio")))
    return levels.withColumn("target", target).select("source", "source_size", "sid", "weight", "target")


def shuffled_places(sized: DataFrame, seed: str) -> DataFrame:
    """Add ``start``: words of the same source that come before the document in shuffled order.

    ``sized`` has sid, doc_id, size. Rows equal in all three are interchangeable.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = sized.withColumn("_key", F.md5(F.concat(F.lit(seed), name)))
    keyed = keyed.withColumn("_bucket", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int"))
    sums = keyed.groupBy("sid", "_bucket").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("sid").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "sid", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    within = (
        Window.partitionBy("sid", "_bucket").orderBy("_key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = keyed.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = ranked.join(offsets, ["sid", "_bucket"])
    return placed.withColumn("start", F.col("_offset") + F.col("_before")).drop(
        "_key", "_bucket", "_before", "_offset"
    )


def slot_sources(targets: DataFrame, n_slots: int) -> DataFrame:
    """(sid, target) -> rows (slot, sid): the source in whose piece each slot's point falls; without targets none."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running, whole = F.sum("target").over(Window.orderBy("sid")), F.sum("target").over(everything)
    pieces = (
        targets.withColumn("_high", running / F.nullif(whole, F.lit(0.0)))
        .withColumn("_low", F.coalesce(F.lag("_high").over(Window.orderBy("sid")), F.lit(0.0)))
        .where(F.col("_low") < F.col("_high"))
    )
    last = F.max("sid").over(everything)
    pieces = pieces.withColumn("_high", F.when(F.col("sid") == last, F.lit(1.0)).otherwise(F.col("_high")))
    cell = lambda x: F.floor(x * CELLS).cast("int")
    pieces = pieces.select("sid", "_low", "_high", F.explode(F.sequence(cell(F.col("_low")), cell(F.col("_high")))).alias("_cell"))
    step, period = (F.lit(x).cast("bigint") for x in GOLDEN)
    point = ((F.col("id") + 1) % period * step % period).cast("double") / period.cast("double")
    slots = targets.sparkSession.range(n_slots).select(F.col("id").alias("slot"), point.alias("_point"))
    met = slots.withColumn("_cell", cell(F.col("_point"))).join(pieces, "_cell")
    return met.where((F.col("_low") <= F.col("_point")) & (F.col("_point") < F.col("_high"))).select("slot", "sid")


def schedule(targets: DataFrame, block: int, n_slots: int) -> DataFrame:
    """(sid, source_size, target) -> rows (slot, sid, rank, first): the slots that are filled, in the order of the mix.

    ``first`` is the word of the source's line at which the block begins; a block that reaches the end of the line
    goes on at its beginning. Ranks come from a slice of slots and the counts of the slices before it.
    """
    met = slot_sources(targets, n_slots).withColumn("_slice", F.floor(F.col("slot") / SLICE))
    counts = met.groupBy("sid", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("sid").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("sid", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("sid", "_slice").orderBy("slot")) - 1
    ranked = met.withColumn("_within", within).join(offsets, ["sid", "_slice"])
    ranked = ranked.join(targets.select("sid", "source_size", "target"), "sid")
    rank = (F.col("_offset") + F.col("_within")).cast("bigint")
    filled = ranked.withColumn("rank", rank).where((F.col("rank") + 1) * block <= F.col("target"))
    return filled.select("slot", "sid", "rank", F.pmod(F.col("rank") * block, F.col("source_size")).alias("first"))


def filled(targets: DataFrame, block: int, n_slots: int) -> DataFrame:
    """(sid, source_size, target) -> rows (slot, sid, rank, words): all blocks of the mix, each in its slot.

    First the slots of the schedule. A source that these leave below its target goes on, block after block, in slots
    behind them, the sources in turn; its last block has as many words as are missing, so it may be a short one.
    """
    done = pin(schedule(targets, block, n_slots).select("slot", "sid", "rank", F.lit(block).cast("bigint").alias("words")), "slots")
    counts = done.groupBy("sid").agg(F.max("rank").alias("_last"))
    next_ = (F.coalesce(F.col("_last"), F.lit(-1)) + 1).alias("_next")
    whole = F.round("target").cast("bigint")
    short = targets.crossJoin(targets.agg(F.count(F.lit(1)).alias("_n"))).join(counts, "sid", "left")
    short = short.select("sid", "_n", next_, whole.alias("_whole")).where(F.col("_whole") > F.col("_next") * block)
    last = F.floor((F.col("_whole") - 1) / block)
    closing = short.withColumn("rank", F.explode(F.sequence("_next", last))).select(
        (F.lit(n_slots) + (F.col("rank") - F.col("_next")) * F.col("_n") + F.col("sid") - 1).alias("slot"), "sid", "rank",
        F.least(F.lit(block), F.col("_whole") - F.col("rank") * block).cast("bigint").alias("words"),
    )
    return done.unionByName(closing)


def mix_pieces(
    docs: DataFrame, weights: Sequence[float], total: float, cap: float, block: int, seed: str
) -> tuple[DataFrame, DataFrame]:
    """Documents with what the mix takes of them, and how many slots of the schedule each source fills.

    Every document lies on its source's line once per round; each of these places is cut at the borders of the
    blocks and every part meets the block of its rank. Rows (doc_id, source, size, source_size, target, sid, start,
    round, at, slot, words, middle): ``words`` of the document in the block of ``slot``, from word ``at`` of the
    repeated line on; ``middle`` marks the part that holds the document's middle. Documents of which nothing is
    taken have one row with nulls behind ``start``.
    """
    sized = pin(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = pin(source_targets(sums, weights, total, cap).drop("weight"), "targets")
    wanted = targets.agg(F.sum("target")).first()[0] or 0.0
    n_slots = -int(-wanted // block)
    blocks = pin(filled(targets, block, n_slots), "blocks")
    by_schedule = blocks.where(F.col("slot") < n_slots).groupBy("sid").agg(F.count(F.lit(1)).alias("slots"))
    slots = targets.join(by_schedule, "sid", "left").select("sid", F.coalesce("slots", F.lit(0)).alias("slots"))
    keyed = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = shuffled_places(keyed.where("size > 0"), seed)
    rounds = F.floor((F.round("target").cast("bigint") - 1 - F.col("start")) / F.col("source_size"))
    placed = placed.withColumn("round", F.explode_outer(F.when(rounds >= 0, F.sequence(F.lit(0).cast("bigint"), rounds))))
    placed = placed.withColumn("_at", F.col("start") + F.col("round") * F.col("source_size"))
    ranks = F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block))
    cut = placed.withColumn("rank", F.explode_outer(ranks))
    met = cut.join(blocks, ["sid", "rank"], "left")
    low = F.greatest("_at", F.col("rank") * block)
    high = F.least(F.col("_at") + F.col("size"), F.col("rank") * block + F.col("words"))
    middle = F.floor(F.col("_at") + F.col("size") / 2)
    filling = F.col("slot").isNotNull() & (high > low)  # greatest and least pass over nulls
    taken = met.select(
        "doc_id", "source", "size", "source_size", "target", "sid", "start", "round", low.alias("at"), "slot",
        F.when(filling, high - low).alias("words"), (filling & (low <= middle) & (middle < high)).alias("middle"),
    )
    empty = keyed.where("size = 0")
    missing = [F.lit(None).cast(t.dataType).alias(t.name) for t in taken.schema if t.name not in empty.columns]
    return taken.unionByName(empty.select("*", *missing)), slots


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    cap: int = 2,
    block: int = BLOCK,
    seed: str = "mix-1:",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, passes, slots.

    ``taken``: words of the document in the blocks that fill the slots, repeats counted; the document in which a
    source's last block ends is cut. All sources meet their targets to the word, and as no target is
    above ``cap`` times its source, ``taken`` never exceeds ``cap`` times the size. ``passes``: how often the middle
    of the document is taken, i.e. the copies to write where documents stay whole. ``slots``: of its source, those of the
    schedule.

    Null texts and texts without words have size 0 and nothing taken. A null source is a source of its
    own, the last; a null doc_id is an id like any other. Repeated rows are documents of their own. An
    empty table, or one without words, gives its rows with target 0. The result does not depend on
    partitions, order or reruns: the order comes from the ids.
    """
    pieces, slots = mix_pieces(docs, weights, total, cap, block, seed)
    some = pieces.where("size > 0").groupBy("sid", "start").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")],
        F.coalesce(F.sum("words"), F.lit(0)).alias("taken"), F.count_if("middle").alias("passes"),
    )
    none = pieces.where("size = 0").withColumns({c: F.lit(0).cast("bigint") for c in ("taken", "passes")})
    mixed = some.unionByName(none.select(*some.columns)).join(slots, "sid")
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "passes", "slots")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total: float = 1.5,
    cap: int = 2,
    block: int = BLOCK,
    seed: str = "mix-1:",
) -> DataFrame:
    """The documents of the mix in the order of its slots, each whole and as often as it is passed; columns as given.

    A copy stands where the document's middle stands. Decisions join back by (doc_id, source, size); of rows equal in
    these three, all get those of the one with most copies. Documents without words are not in the mix. Written as it is,
    the table's files, by name, hold the mix in its order: ``with_places`` reads it.
    """
    keys = ["doc_id", "source", "size"]
    theirs, words, spot = {k: own(k) for k in keys}, own("words"), own("spot")
    pieces, _ = mix_pieces(docs, weights, total, cap, block, seed)
    plan = pieces.where("middle").groupBy(*keys, "round").agg(F.min(F.struct("slot", "at")).alias(spot))
    plan = plan.select(*[F.col(k).alias(name) for k, name in theirs.items()], spot)
    sized = docs.withColumn(words, n_words(F.col("text")))
    same = (
        F.col("doc_id").eqNullSafe(F.col(theirs["doc_id"]))
        & F.col("source").eqNullSafe(F.col(theirs["source"]))
        & (F.col(words) == F.col(theirs["size"]))
    )
    return sized.join(plan, same).orderBy(spot, "text").select(*docs.columns)


def with_places(mixed: DataFrame, name: str = "place") -> DataFrame:
    """Add the 0-based place in the mix to a table of ``mixed_documents``, read back from the Parquet files it was written to.

    Files follow one another by name, rows as they lie in the file, however the scan is cut and packed. The files make a
    table of one row each.
    """
    file, row, n = own("file"), own("row"), own("n")
    rows = mixed.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy(file).agg(F.count(F.lit(1)).alias(n))
    starts = files.select(file, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n))
    kept = [c for c in mixed.columns if c != name]
    return rows.join(F.broadcast(starts), file).select(*kept, (F.col(n) + F.col(row)).alias(name))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size, target and slots, and the words taken from it."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes", "slots", "source")


OP10_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY encode(source) NULLS LAST) AS sid FROM sized GROUP BY source),
rated AS (
  SELECT *, CAST([3, 1, 2][(sid - 1) % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size / weight AS ratio,
    sum(source_size) OVER () * 1.5::DOUBLE AS whole FROM sums),
levels AS (
  SELECT *, (whole - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY ratio, sid
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY ratio, sid
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM rated),
targets AS (
  SELECT source, source_size, sid, least(2.0::DOUBLE * source_size,
    weight * coalesce((SELECT max(level) FROM levels WHERE level <= ratio), ratio)) AS target FROM levels),
cut AS (SELECT CAST(ceil(sum(target) / {BLOCK}) AS BIGINT) AS n_slots, sum(target) AS whole FROM targets),
bounds AS (
  SELECT sid, sum(target) OVER (ORDER BY sid) / whole AS high FROM targets, cut WHERE whole > 0),
pieces AS (
  SELECT sid, CASE WHEN sid = max(sid) OVER () THEN 1.0::DOUBLE ELSE high END AS upto,
    coalesce(lag(high) OVER (ORDER BY sid), 0) AS low FROM bounds),
points AS (
  SELECT i, CAST((i + 1) % {GOLDEN[1]} * {GOLDEN[0]} % {GOLDEN[1]} AS DOUBLE) / {GOLDEN[1]}::DOUBLE AS point
  FROM range((SELECT n_slots FROM cut)) r(i)),
ranked AS (
  SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY i) - 1 AS r
  FROM points JOIN pieces ON low <= point AND point < upto),
filled AS (
  SELECT t.sid, count(r) AS slots FROM targets t LEFT JOIN ranked k ON t.sid = k.sid AND (r + 1) * {BLOCK} <= target GROUP BY t.sid),
taking AS (
  SELECT t.*, slots, slots * {BLOCK} + (CAST(round(target) AS BIGINT) - slots * {BLOCK}) AS words
  FROM targets t JOIN filled f ON t.sid = f.sid),
places AS (
  SELECT doc_id, sized.source AS source, size, source_size, target, slots, words, coalesce(sum(size) OVER (PARTITION BY sid
    ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized JOIN taking ON sized.source IS NOT DISTINCT FROM taking.source),
rests AS (SELECT *, words // source_size AS rounds, words % source_size AS rest FROM places WHERE size > 0)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(rounds * size + greatest(least(start + size, rest) - start, 0) AS BIGINT) AS taken,
  CAST(rounds + CASE WHEN start + size // 2 < rest THEN 1 ELSE 0 END AS BIGINT) AS passes, slots, source
FROM rests
UNION ALL SELECT doc_id, 0, source_size, target, 0, 0, slots, source FROM places WHERE size = 0
"""
