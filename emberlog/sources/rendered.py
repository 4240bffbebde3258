"""Inputs rendered from the given tables: log lines, model outputs, tuning runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import labels as B


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def render_line(event_id: Column, user_id: Column, event_type: Column, value: Column) -> Column:
    """One HDFS-style line per event; the error texts rotate with the event number."""
    phase = F.pmod(F.floor(event_id / 200), F.lit(4))
    is_error = event_type == "error"
    head = F.concat_ws(
        " ",
        (F.lit(100000) + event_id % 900000).cast("string"),
        F.lit("203615"),
        user_id.cast("string"),
    )
    body = (
        F.when(is_error & (phase == 1), "WARN dfs.DataNode$DataXceiver: 10.250.")
        .when(is_error & (phase == 2), "WARN dfs.FSNamesystem: slow response from 10.250.")
        .when(is_error & (phase == 3) & (value > 60), "ERROR dfs.NameNode: timeout reaching 10.250.")
        .when(
            event_type == "purchase",
            "INFO dfs.FSNamesystem: BLOCK* NameSystem.addStoredBlock: blockMap updated: 10.251.",
        )
        .when(
            event_type == "click",
            "DEBUG dfs.DataBlockScanner: Verification succeeded for 10.251.",
        )
        .otherwise(
            "INFO dfs.DataNode$PacketResponder: PacketResponder 1 for block terminating 10.251."
        )
    )
    joint = F.when(
        is_error & (phase == 1), ":Got exception while serving blk_-"
    ).otherwise(" blk_")
    return F.concat(
        head, F.lit(" "), body,
        (user_id % 250).cast("string"), F.lit("."), (event_id % 250).cast("string"),
        F.lit(":50010"), joint, (event_id * 7919).cast("string"),
        F.lit(" size "), (event_id % 1000).cast("string"),
    )


def lines_of_events(events: DataFrame, *carried: str) -> DataFrame:
    """``(source, seq, line)`` and ``carried`` columns; works on a table and on a stream.

    The partition test is always true. It keeps the rendering from being copied into every
    condition of a filter on ``line``, which a stored line would not have to pay either.
    """
    line = render_line(*[F.col(c) for c in ("event_id", "user_id", "event_type", "value")])
    return events.select(
        *carried,
        (F.col("user_id") % 8).cast("string").alias("source"),
        F.col("event_id").alias("seq"),
        F.when(F.spark_partition_id() >= 0, line).alias("line"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of_events(table(spark, sf_dir, "events"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, seq, line)`` of all document texts: the line number is the order."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("source"),
        F.posexplode(F.split("text", "\n")).alias("seq", "line"),
    )


def corrupted(kind: Column, severity: Column, cause: Column, action: Column, win: Column) -> Column:
    """Raw text a model might have given instead of the clean response."""
    clean = B.response_json(severity, cause, action)
    wrong = F.when(severity == "SEV-1", "SEV-3").otherwise("SEV-1")
    return (
        F.when(kind == 0, clean)
        .when(kind == 1, F.translate(clean, '"', "`"))
        .when(
            kind == 2,
            F.regexp_replace(clean, r'"([^"]*)"', "“$1”"),
        )
        .when(
            kind == 3,
            F.concat(F.substring_index(clean, '"recommended_action":', 1), F.lit('"recommended_action":')),
        )
        .when(
            kind == 4,
            F.concat(
                F.lit('{"severity": "'), severity,
                F.lit('", "likely_cause": ('), cause,
                F.lit('), "recommended_action": ("'), action, F.lit('")}'),
            ),
        )
        .when(kind == 5, F.lit("The incident shows unusual activity on several nodes."))
        .when(kind == 6, F.concat(F.lit("Answer: "), clean, F.lit(" done")))
        .when(F.pmod(F.floor(win / 8), F.lit(2)) == 0, B.response_json(wrong, cause, action))
        .otherwise(F.concat(F.lit('{"note": "n/a", '), clean.substr(F.lit(2), F.length(clean))))
    )


def model_outputs(labelled: DataFrame) -> DataFrame:
    """``(example_id, run, win, incident_text, raw_output, response)`` for two runs.

    The candidate runs through eight kinds of corruption, the baseline answers with narrative text
    on most rows.
    """
    kind = F.pmod("win", F.lit(8))
    fields = [F.col(f) for f in vocab.FIELDS]
    rows = labelled.select(
        F.concat_ws("-", "source", F.col("win").cast("string")).alias("example_id"),
        "win",
        "incident_text",
        "response",
        F.explode(
            F.array(
                F.struct(
                    F.lit("candidate").alias("run"),
                    corrupted(kind, *fields, F.col("win")).alias("raw_output"),
                ),
                F.struct(
                    F.lit("baseline").alias("run"),
                    corrupted(
                        F.when(kind == 0, 0).otherwise(5), *fields, F.col("win")
                    ).alias("raw_output"),
                ),
            )
        ).alias("o"),
    )
    return rows.select(
        "example_id", "o.run", "win", "incident_text", "o.raw_output", "response"
    )


# fixed values: how each configuration scores SEV-1 from the WARN count, in percent
SCORE_RULES = {"A": (20, 10), "B": (35, 5), "C": (5, 30)}


def tuning_runs(splits: DataFrame) -> DataFrame:
    """One row per configuration: squared-error losses of a WARN-count score on the real splits.

    Sums stay whole numbers until one final division; steps stand in for the runtime.
    """
    warn = F.coalesce(F.try_element_at("stats.levels_count", F.lit("WARN")), F.lit(0))
    truth = F.when(F.col("severity") == "SEV-1", 100).otherwise(0)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).cast("bigint").alias("ord"),
                    F.lit(name).alias("config_name"),
                    F.lit(lr).alias("learning_rate"),
                    F.lit(batch).cast("bigint").alias("batch_size"),
                    F.lit(epochs).cast("bigint").alias("epochs"),
                    F.least(F.lit(base) + F.lit(weight) * warn, F.lit(95)).alias("score"),
                )
                for i, ((name, lr, batch, epochs), (base, weight)) in enumerate(
                    zip(vocab.CONFIGS, SCORE_RULES.values())
                )
            ]
        )
    )
    scored = splits.select("split", truth.alias("truth"), rows.alias("c")).select(
        "split", "c.*", ((F.col("c.score") - F.col("truth")) ** 2).cast("bigint").alias("sq")
    )

    def loss(split: str) -> Column:
        part = F.col("split") == split
        return F.sum(F.when(part, F.col("sq"))) / F.count_if(part) / 10000

    keys = ["ord", "config_name", "learning_rate", "batch_size", "epochs"]
    return (
        scored.groupBy(*keys)
        .agg(
            loss("train").alias("train_loss"),
            loss("val").alias("val_loss"),
            F.count_if(F.col("split") == "train").alias("_n"),
        )
        .withColumn("runtime_seconds", F.col("_n") * F.col("epochs") / F.col("batch_size"))
        .drop("_n")
    )
