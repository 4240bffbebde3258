"""Rule labels, prompt/response pairs, their validation and distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import labels as B
from emberlog.functions.repair import bound, object_entry, parse_object


def action_dimension(df: DataFrame) -> DataFrame:
    """The fixed cause/action rows as a table."""
    return df.sparkSession.createDataFrame(
        list(vocab.ACTIONS.items()), "likely_cause string, recommended_action string"
    )


def assign_recommended_action(df: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Look the action up. The built-in dimension has five rows and is broadcast; a caller's own
    table has no known bound, so Spark picks that join from its size."""
    side = F.broadcast(action_dimension(df)) if dimension is None else dimension
    return df.join(side, "likely_cause", "left").withColumn(
        "recommended_action", F.coalesce("recommended_action", F.lit(vocab.DEFAULT_ACTION))
    )


def label_columns(incidents: DataFrame) -> DataFrame:
    """Add ``severity``, ``likely_cause`` and ``recommended_action``."""
    text = F.col("incident_text")
    return incidents.withColumns(
        {
            "severity": B.severity(text, F.col("stats.levels_count")),
            "likely_cause": B.likely_cause(text),
        }
    ).withColumn("recommended_action", B.recommended_action(F.col("likely_cause")))


def label_incidents(incidents: DataFrame) -> DataFrame:
    """Labels plus ``prompt`` and ``response``; one narrow stage."""
    return label_columns(incidents).withColumns(
        {
            "prompt": B.format_prompt(F.col("incident_text")),
            "response": B.response_json(*[F.col(f) for f in vocab.FIELDS]),
        }
    )


def parse_response(response: str = "response") -> Column:
    """The entries of a JSON response column, each key once with its last value as text; null when it is
    no JSON object."""

    def last(obj: Column) -> Column:
        keys = F.array_distinct(F.map_keys(obj))
        entry = lambda k: F.struct(k.alias("key"), object_entry(obj, k)["value"].cast("string").alias("value"))
        return F.map_from_entries(F.transform(keys, entry))

    return bound(parse_object(F.col(response)), last)


def validate_pairs(pairs: DataFrame, template: bool = True) -> DataFrame:
    """Violation counts over all rows, in one aggregate. Zero everywhere means valid."""
    checked = pairs.select("prompt", parse_response().alias("p"))
    keys = F.coalesce(F.map_keys("p"), F.array().cast("array<string>"))
    parsed = F.size(keys) > 0
    complete = F.size(F.array_intersect(keys, F.array(*map(F.lit, vocab.FIELDS)))) == 3
    severity = F.coalesce(F.try_element_at("p", F.lit("severity")), F.lit(""))
    has_slot = F.col("prompt").contains(vocab.EMPTY_SEVERITY_SLOT) | F.lit(not template)
    return checked.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(~parsed).alias("bad_json"),
        F.count_if(parsed & ~complete).alias("missing_keys"),
        F.count_if(parsed & complete & ~severity.startswith("SEV-")).alias("bad_severity"),
        F.count_if(~has_slot).alias("missing_template"),
    )


def validation_sample(pairs: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """``n`` pairs picked by a seeded hash."""
    picked = F.sha1(F.concat_ws("|", F.lit(str(seed)), "prompt", "response"))
    return pairs.withColumn("_pick", picked).orderBy("_pick").limit(n).drop("_pick")


def label_distribution(labelled: DataFrame) -> DataFrame:
    """``(label_kind, label, n, pct)`` for severities and causes."""
    both = labelled.groupBy("severity", "likely_cause").agg(F.count(F.lit(1)).alias("n"))
    share = Window.partitionBy("label_kind")
    return (
        both.unpivot("n", ["severity", "likely_cause"], "label_kind", "label")
        .groupBy("label_kind", "label")
        .agg(F.sum("n").alias("n"))
        .withColumn("pct", F.col("n") / F.sum("n").over(share) * 100)
    )
