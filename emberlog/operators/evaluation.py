"""Predictions against the truth. Flags per row first, then one conditional-sum aggregate per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import repair as R
from emberlog.operators.labelling import parse_response
from emberlog.operators.repair import (
    apply_override,
    parse_candidates,
    recover,
    strictly_valid,
)

TRUTH = {"severity": "true_severity", "likely_cause": "true_cause", "recommended_action": "true_action"}


def truth_columns(pairs: DataFrame) -> DataFrame:
    """Add the three truth columns parsed from ``response``, and ``true_keys``, how many keys it has."""
    parsed = pairs.withColumn("_t", parse_response())
    found = {name: F.try_element_at("_t", F.lit(k)) for k, name in TRUTH.items()}
    return parsed.withColumns(found | {"true_keys": F.size(F.map_keys("_t"))}).drop("_t")


def pair_predictions(
    predictions: DataFrame, truth: DataFrame, key: str = "example_id"
) -> DataFrame:
    """Predictions joined with the truth of the same example; ids are unique on the truth side."""
    return predictions.join(truth_columns(truth.select(key, "response")), key)


def _filled(name: str) -> Column:
    value = F.col(name)
    return F.coalesce((value != "") & ~value.contains(vocab.UNKNOWN), F.lit(False))


def score_rows(paired: DataFrame) -> DataFrame:
    """Add one boolean per question asked of a prediction.

    An exact match has the same three keys and values on both sides and no key besides; truths without
    ``true_keys`` are taken to have no other key.
    """
    true_keys = F.col("true_keys") if "true_keys" in paired.columns else F.lit(3)
    ok = {k: F.col(k).eqNullSafe(F.col(t)) for k, t in TRUTH.items()}
    return paired.withColumns(
        {
            "severity_ok": ok["severity"],
            "cause_ok": ok["likely_cause"],
            "action_ok": ok["recommended_action"],
            "exact": ok["severity"]
            & ok["likely_cause"]
            & ok["recommended_action"]
            & F.coalesce((F.col("n_keys") == 3) & (true_keys == 3), F.lit(False)),
            "filled": _filled("severity") & _filled("likely_cause") & _filled("recommended_action"),
        }
    )


def rate(count: Column, total: Column) -> Column:
    """Percent; null where there is nothing to count."""
    return F.try_divide(count, total) * 100


def _counts(**flags: str) -> list[Column]:
    total = F.count(F.lit(1))
    out = [total.alias("total")]
    for name, flag in flags.items():
        hits = F.count_if(F.expr(flag))
        out += [hits.alias(f"{name}_n"), rate(hits, total).alias(f"{name}_pct")]
    return out


def field_accuracy(scored: DataFrame, by: str = "run") -> DataFrame:
    return scored.groupBy(by).agg(
        *_counts(severity="severity_ok", likely_cause="cause_ok", recommended_action="action_ok")
    )


def exact_match(scored: DataFrame, by: str = "run") -> DataFrame:
    return scored.groupBy(by).agg(*_counts(exact="exact"))


def valid_rate(scored: DataFrame, by: str = "run") -> DataFrame:
    """Share of complete predictions, after the override."""
    return scored.groupBy(by).agg(*_counts(valid="filled"))


def repair_rate(scored: DataFrame, by: str = "run") -> DataFrame:
    """Share of outputs whose brace slice is absent or no JSON."""
    return scored.groupBy(by).agg(*_counts(repair="not is_json"))


def override_rate(scored: DataFrame, by: str = "run") -> DataFrame:
    """Overrides that changed something, and every hit."""
    return scored.groupBy(by).agg(*_counts(changed="override_changed", hit="was_overridden"))


def confusion_matrix(
    scored: DataFrame, by: str = "run", labels: list[str] | None = None
) -> DataFrame:
    """``(run, truth, predicted, n)``; pairs outside ``labels`` are left out, ``[]`` keeps all.

    Pairs outside meet in one group per run that counts nothing. A filter on the two labels would be pushed below the
    parsing of the outputs, which it would then hold several times over.
    """
    labels = ["SEV-1", "SEV-3"] if labels is None else labels
    truth, predicted = F.col("true_severity"), F.col("severity")
    if not labels:
        return scored.groupBy(by, truth.alias("truth"), predicted.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    inside = truth.isin(labels) & predicted.isin(labels)
    pairs = scored.select(by, F.when(inside, truth).alias("truth"), F.when(inside, predicted).alias("predicted"))
    return pairs.groupBy(by, "truth", "predicted").agg(F.count("predicted").alias("n")).where("n > 0")


def confusion_pivot(
    scored: DataFrame, by: str = "run", labels: list[str] | None = None
) -> DataFrame:
    """One row per true label, one column per predicted label, zeros filled in."""
    labels = labels or ["SEV-1", "SEV-3"]
    cells = confusion_matrix(scored, by, labels)
    return cells.groupBy(by, "truth").pivot("predicted", labels).sum("n").fillna(0)


def per_cause_accuracy(scored: DataFrame, by: str = "run") -> DataFrame:
    hits = F.count_if("cause_ok")
    total = F.count(F.lit(1))
    return scored.groupBy(by, F.col("true_cause").alias("likely_cause")).agg(
        total.alias("total"), hits.alias("correct"), rate(hits, total).alias("accuracy")
    )


def class_recall(scored: DataFrame, by: str = "run") -> DataFrame:
    """Per true severity: rows, hits, misses and recall."""
    total, hits = F.count(F.lit(1)), F.count_if("severity_ok")
    return scored.groupBy(by, F.col("true_severity").alias("severity")).agg(
        total.alias("total"),
        hits.alias("true_positives"),
        (total - hits).alias("false_negatives"),
        rate(hits, total).alias("recall"),
    )


COMPARED = {"severity": "severity_ok", "likely_cause": "cause_ok", "exact_match": "exact"}


def compare_runs(
    scored: DataFrame, baseline: str = "baseline", candidate: str = "candidate", by: str = "run"
) -> DataFrame:
    """``(metric, baseline, candidate, difference)`` in percent; both runs in one aggregate. The side of a
    run that is absent is null, and so is its difference."""
    base, cand = F.col(by) == baseline, F.col(by) == candidate
    sums = scored.agg(
        *[
            rate(F.count_if(run & F.col(flag)), F.count_if(run)).alias(f"{name}_{side}")
            for name, flag in COMPARED.items()
            for side, run in (("b", base), ("c", cand))
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f"{name}_accuracy").alias("metric"),
                F.col(f"{name}_b").alias("baseline"),
                F.col(f"{name}_c").alias("candidate"),
                (F.col(f"{name}_c") - F.col(f"{name}_b")).alias("difference"),
            )
            for name in COMPARED
        ]
    )
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def error_flags(scored: DataFrame) -> DataFrame:
    """Per row: wrong severity, wrong cause, no brace slice, a slice that is only JSON after
    normalising or not at all. Needs ``raw_output``."""
    raw = F.coalesce(F.col("raw_output"), F.lit(""))
    clean = R.normalize_output(raw)
    complete = R.has_braces(clean)
    as_is = R.parse_object(R.slice_braces(raw)).isNotNull()
    return scored.withColumns(
        {
            "severity_misclassification": ~F.col("severity_ok"),
            "likely_cause_error": ~F.col("cause_ok"),
            "incomplete_json": ~complete,
            "formatting_issue": complete & ~as_is,
        }
    )


ERROR_CATEGORIES = [
    "severity_misclassification",
    "likely_cause_error",
    "incomplete_json",
    "formatting_issue",
]


def error_breakdown(scored: DataFrame, by: str = "run") -> DataFrame:
    """``(run, category, n, pct)``."""
    sums = (
        error_flags(scored)
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(c).alias(c) for c in ERROR_CATEGORIES])
    )
    return (
        sums.unpivot([by, "_total"], ERROR_CATEGORIES, "category", "n")
        .withColumn("pct", rate(F.col("n"), F.col("_total")))
        .drop("_total")
    )


def intervention_stats(scored: DataFrame, by: str = "run") -> DataFrame:
    """How each prediction came about: untouched, repaired, or overridden."""
    kind = (
        F.when(F.col("was_overridden"), "overridden")
        .when(F.col("was_repaired"), "repaired")
        .otherwise("none")
    )
    return scored.groupBy(by, kind.alias("intervention")).agg(F.count(F.lit(1)).alias("n"))


def stage_valid_rate(outputs: DataFrame, by: str = "run") -> DataFrame:
    """``(run, stage, n, pct)``: complete answers straight from the text, after normalising, after
    repair, and after override and defaults."""
    raw = F.coalesce(F.col("raw_output"), F.lit(""))
    filled = _filled("severity") & _filled("likely_cause") & _filled("recommended_action")
    rows = outputs.select(by, "incident_text", "raw_output")
    at_raw = parse_candidates(rows, raw).select(*rows.columns, strictly_valid().alias("s_raw"))
    parsed = parse_candidates(at_raw, R.normalize_output(raw)).withColumn(
        "s_normalized", strictly_valid()
    )
    # repair and defaults both start from this one parse
    marked = recover(parsed, "mark").select(*parsed.columns, filled.alias("s_repaired"))
    final = apply_override(recover(marked, "default")).withColumn("s_final", filled)
    stages = ["raw", "normalized", "repaired", "final"]
    sums = final.groupBy(by).agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(f"s_{s}").alias(s) for s in stages]
    )
    return (
        sums.unpivot([by, "_total"], stages, "stage", "n")
        .withColumn("pct", rate(F.col("n"), F.col("_total")))
        .drop("_total")
    )


def evaluation_report(scored: DataFrame, by: str = "run") -> DataFrame:
    """One nested row per run: rates, inference statistics, confusion matrix, causes.

    Everything hangs off one aggregate per ``(run, true cause)``, a handful of rows.
    """
    flags = {
        "severity": "severity_ok",
        "cause": "cause_ok",
        "action": "action_ok",
        "exact": "exact",
        "valid": "filled",
        "repair": "not is_json",
        "override": "override_changed",
    }
    cells = {
        f"{t[-1]}{p[-1]}": (F.col("true_severity") == t) & (F.col("severity") == p)
        for t in ("SEV-1", "SEV-3")
        for p in ("SEV-1", "SEV-3")
    }
    per_cause = scored.groupBy(by, "true_cause").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.expr(f)).alias(name) for name, f in flags.items()],
        *[F.count_if(cell).alias(f"c{name}") for name, cell in cells.items()],
    )
    cause_entry = F.struct(
        F.coalesce("true_cause", F.lit("")).alias("key"),
        F.struct(
            F.col("n").alias("total"),
            F.col("cause").alias("correct"),
            rate(F.col("cause"), F.col("n")).alias("accuracy"),
        ).alias("value"),
    )
    sums = per_cause.groupBy(by).agg(
        F.sum("n").alias("n"),
        *[F.sum(c).alias(c) for c in [*flags, *[f"c{x}" for x in cells]]],
        F.map_from_entries(F.array_sort(F.collect_list(cause_entry))).alias("by_likely_cause"),
    )

    def pct(name: str) -> Column:
        return rate(F.col(name), F.col("n"))

    return sums.select(
        by,
        F.col("n").alias("test_samples"),
        F.struct(
            pct("severity").alias("severity_accuracy"),
            pct("cause").alias("likely_cause_accuracy"),
            pct("action").alias("recommended_action_accuracy"),
            pct("exact").alias("exact_match_accuracy"),
            pct("valid").alias("valid_json_rate"),
        ).alias("metrics"),
        F.struct(
            pct("repair").alias("repair_rate"), pct("override").alias("heuristic_override_rate")
        ).alias("inference_stats"),
        F.struct(
            F.struct(F.col("c11").alias("SEV-1"), F.col("c13").alias("SEV-3")).alias("SEV-1"),
            F.struct(F.col("c31").alias("SEV-1"), F.col("c33").alias("SEV-3")).alias("SEV-3"),
        ).alias("confusion_matrix"),
        "by_likely_cause",
    )
