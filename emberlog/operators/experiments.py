"""Tables of tuning runs: ``ord, config_name, ..., train_loss, val_loss, runtime_seconds``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog import vocab


def leaderboard(runs: DataFrame) -> DataFrame:
    """Losses and minutes per run, in listing order."""
    return runs.select(
        "ord",
        "config_name",
        "train_loss",
        "val_loss",
        (F.col("runtime_seconds") / 60).alias("runtime_minutes"),
    ).orderBy("ord")


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the lowest validation loss; the first listed wins a tie, runs without a
    validation loss never win."""
    best = runs.where(F.col("val_loss").isNotNull()).agg(
        F.min_by(F.struct("*"), F.struct("val_loss", "ord")).alias("r")
    )
    return best.where("r is not null").select("r.*")


def improvement_pct(runs: DataFrame, baseline: str = vocab.BASELINE_CONFIG) -> DataFrame:
    """Validation-loss reduction against the first listed baseline run, in percent; null without one or
    where its loss is zero. One pass over a table of one row per run."""
    first = F.min_by("val_loss", F.when(F.col("config_name") == baseline, F.col("ord")))
    reference = first.over(Window.partitionBy(F.lit(0)))
    gain = F.try_divide(F.col("base_loss") - F.col("val_loss"), F.col("base_loss")) * 100
    return runs.select("ord", "config_name", "val_loss", reference.alias("base_loss")).select(
        "ord", "config_name", "val_loss", gain.alias("improvement_pct")
    )


def only_best(runs: DataFrame, name: str = vocab.BEST_CONFIG) -> DataFrame:
    return runs.where(F.col("config_name") == name)
