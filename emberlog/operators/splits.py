"""Stratified splits and preparation of prompt/response pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions.lines import SPACE, strip
from emberlog.operators.ordinal import dense_position, hash_block

SPLITS = ("train", "val", "test")
ROW_ID = ("source", "win", "incident_id")


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 0.01:
        raise ValueError(f"split ratios must sum to 1, got {train + val + test}")


def seeded_hash(seed: int, columns: Sequence[str]) -> Column:
    """A random-looking order that every engine with SHA-1 reproduces."""
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def stratified_split(
    labelled: DataFrame,
    train: float = 0.7,
    val: float = 0.15,
    test: float = 0.15,
    seed: int = 42,
    stratum: str = "severity",
    strata: Sequence[str] | None = vocab.SEVERITIES,
    row_id: Sequence[str] = ROW_ID,
) -> DataFrame:
    """Add ``split``: per stratum the first ``floor(n*train)`` rows in seeded order, then
    ``floor(n*val)``, the rest is test.

    Rows are never sorted as a whole and never shuffled. Counts per hash slice tell which slices
    hold the two cuts; only those few slices are ranked, which yields the digest at each cut, and
    every row is then compared with the two digests of its stratum.

    ``row_id`` must identify a row. ``strata`` lists the possible strata, which bounds the table of
    cuts; rows of any other stratum raise an error rather than vanish. With ``strata=None`` the
    strata are unbounded and Spark picks the join.
    """
    check_ratios(train, val, test)
    keyed = labelled.withColumn("_h", seeded_hash(seed, row_id))
    if strata is not None:
        known = F.col(stratum).isin(list(strata))
        keyed = keyed.withColumn(
            stratum,
            F.when(known, F.col(stratum)).otherwise(
                F.raise_error(F.concat(F.lit("unknown stratum: "), F.col(stratum)))
            ),
        )
    narrow = keyed.select(stratum, "_h", hash_block("_h").alias("_block"))

    upto = Window.partitionBy(stratum).orderBy("_block")
    whole = Window.partitionBy(stratum)
    slices = (
        narrow.groupBy(stratum, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_cut1", F.floor(F.col("_total") * F.lit(float(train))))
        .withColumn("_cut2", F.col("_cut1") + F.floor(F.col("_total") * F.lit(float(val))))
    )
    # slices in which a cut falls: at most two per stratum
    start = F.col("_end") - F.col("_n")
    cut_slices = slices.where(
        ((F.col("_cut1") >= start) & (F.col("_cut1") < F.col("_end")))
        | ((F.col("_cut2") >= start) & (F.col("_cut2") < F.col("_end")))
    ).select(stratum, "_block", "_cut1", "_cut2", start.alias("_start"))
    bounded = F.broadcast if strata is not None else lambda df: df
    rank = F.row_number().over(Window.partitionBy(stratum, "_block").orderBy("_h")) - 1
    cuts = (
        narrow.join(bounded(cut_slices), [stratum, "_block"])
        .withColumn("_pos", F.col("_start") + rank)
        .where((F.col("_pos") == F.col("_cut1")) | (F.col("_pos") == F.col("_cut2")))
        .groupBy(stratum)
        .agg(
            F.min(F.when(F.col("_pos") == F.col("_cut1"), F.col("_h"))).alias("_h1"),
            F.min(F.when(F.col("_pos") == F.col("_cut2"), F.col("_h"))).alias("_h2"),
        )
    )
    # a missing cut means it lies behind the last row
    split = (
        F.when(F.col("_h1").isNull() | (F.col("_h") < F.col("_h1")), "train")
        .when(F.col("_h2").isNull() | (F.col("_h") < F.col("_h2")), "val")
        .otherwise("test")
    )
    joined = keyed.join(bounded(cuts), stratum, "left")
    return joined.withColumn("split", split).select(*labelled.columns, "split")


def split_stats(splits: DataFrame) -> DataFrame:
    """``(split, severity, n)`` with subtotals: null severity = whole split, null split = all."""
    return splits.rollup("split", "severity").agg(F.count(F.lit(1)).alias("n"))


def split_leakage(splits: DataFrame, text: str = "prompt") -> DataFrame:
    """Texts that sit in more than one split, and the rows that carry them.

    Aggregated per digest of the text, so repeated texts combine on the map side.
    """
    per_text = splits.groupBy(F.sha1(text).alias("_t")).agg(
        F.count(F.lit(1)).alias("n"), F.min("split").alias("lo"), F.max("split").alias("hi")
    )
    leaked = F.col("lo") != F.col("hi")
    return per_text.agg(
        F.count(F.lit(1)).alias("distinct_texts"),
        F.count_if(leaked).alias("leaked_texts"),
        F.coalesce(F.sum(F.when(leaked, F.col("n"))), F.lit(0)).alias("leaked_rows"),
    )


def shuffle_rows(splits: DataFrame, seed: int = 42, row_id: Sequence[str] = ROW_ID) -> DataFrame:
    """Add ``shuffle_pos``: a seeded random order inside each split."""
    hashed = splits.withColumn("_h", seeded_hash(seed + 1, row_id))
    return dense_position(hashed, ["split"], ["_h"], hash_block("_h"), "shuffle_pos").drop("_h")


def append_target_newline(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("response", F.concat("response", F.lit("\n")))


def tokens(text: Column) -> Column:
    """White-space tokens; none for a blank text."""
    stripped = strip(text)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"(?U){SPACE}+")
    )


def truncate_to_budget(df: DataFrame, text: str, budget: int) -> DataFrame:
    """Add the token count, an over-budget flag and the text cut to ``budget`` tokens."""
    return (
        df.withColumn("_tokens", tokens(F.col(text)))
        .withColumns(
            {
                "n_tokens": F.size("_tokens").cast("bigint"),
                "truncated": F.array_join(F.slice("_tokens", 1, budget), " "),
            }
        )
        .withColumn("over_budget", F.col("n_tokens") > budget)
        .drop("_tokens")
    )


def token_lengths(splits: DataFrame, prompt_budget: int, response_budget: int, *by: str) -> DataFrame:
    """``(by, field, n_tokens, budget)`` of both text fields."""
    field = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("field"),
                    F.size(tokens(F.col(name))).cast("bigint").alias("n_tokens"),
                    F.lit(budget).alias("budget"),
                )
                for name, budget in (("prompt", prompt_budget), ("response", response_budget))
            ]
        )
    )
    return splits.select(*by, field.alias("f")).select(*by, "f.*")


def length_audit(
    splits: DataFrame, prompt_budget: int = 512, response_budget: int = 256, by: str = "split"
) -> DataFrame:
    """Token-length percentiles and over-budget counts per group and text field.

    Texts are measured before the shuffle; exact percentiles aggregate a count per distinct length.
    """
    return (
        token_lengths(splits, prompt_budget, response_budget, by)
        .groupBy(by, "field")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("n_tokens").alias("max_tokens"),
            F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n_tokens)").alias("p50"),
            F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY n_tokens)").alias("p95"),
            F.count_if(F.col("n_tokens") > F.col("budget")).alias("over_budget"),
        )
    )


#: Size of a length sketch, and how far a percentile's rank may be off with it (99 % of the time, merged or not).
SKETCH_SIZE = 400
RANK_ERROR = 0.01


def length_sketches(
    splits: DataFrame, prompt_budget: int = 512, response_budget: int = 256, by: Sequence[str] = ("split",), size: int = SKETCH_SIZE
) -> DataFrame:
    """``(by, field, n, max_tokens, over_budget, sketch)``: audits that can be stored and merged.

    A sketch is a quantile sketch (KLL) of the token lengths, a few kilobytes whatever the number of rows, built
    on the map side. An audit of yesterday's and one of today's rows merge into that of both, where exact
    percentiles need all rows again.
    """
    return (
        token_lengths(splits, prompt_budget, response_budget, *by)
        .groupBy(*by, "field")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("n_tokens").alias("max_tokens"),
            F.count_if(F.col("n_tokens") > F.col("budget")).alias("over_budget"),
            F.kll_sketch_agg_bigint("n_tokens", F.lit(size)).alias("sketch"),
        )
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Audits of parts to audits of the whole, per ``by`` and field."""
    return sketches.groupBy(*by, "field").agg(
        F.sum("n").alias("n"),
        F.max("max_tokens").alias("max_tokens"),
        F.sum("over_budget").alias("over_budget"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def sketched_percentiles(sketches: DataFrame) -> DataFrame:
    """Audits with ``p50`` and ``p95`` in place of the sketch; ranks are within ``RANK_ERROR`` for the usual size."""
    part = {f"p{share}": F.kll_sketch_get_quantile_bigint("sketch", F.lit(share / 100)) for share in (50, 95)}
    return sketches.withColumns(part).drop("sketch")
