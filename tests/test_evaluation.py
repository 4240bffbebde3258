import json

import pytest
from pyspark.sql import functions as F

from emberlog.operators import evaluation as E
from emberlog.operators import experiments as X
from emberlog.operators import labelling
from emberlog.plans import flows


def answer(sev="SEV-1", cause="c", action="a", **extra):
    return json.dumps({"severity": sev, "likely_cause": cause, "recommended_action": action, **extra})


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        # run, incident, output, truth
        ("candidate", "fine", answer(), answer()),
        ("candidate", "fine", answer("SEV-3"), answer()),
        ("candidate", "fine", answer(note=1), answer()),
        ("candidate", "fine", "SEV-3 nothing else", answer("SEV-3", "d")),
        ("candidate", "fine", answer().replace('"', "`"), answer()),
        ("candidate", "got exception while serving", "narrative", answer()),
        ("baseline", "fine", "narrative", answer()),
        ("baseline", "fine", answer("SEV-2"), answer("SEV-2")),
    ]
    df = spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)],
        "example_id string, run string, incident_text string, raw_output string, response string",
    )
    return flows.outputs_to_scores(df).cache()


def by_run(df, *columns):
    return {r.run: tuple(r[c] for c in columns) for r in df.collect()}


def test_rates(scored):
    got = by_run(E.field_accuracy(scored), "total", "severity_n", "likely_cause_n", "recommended_action_n")
    assert got == {"candidate": (6, 5, 4, 4), "baseline": (2, 1, 1, 1)}
    assert by_run(E.exact_match(scored), "exact_n", "exact_pct") == {
        "candidate": (2, 2 / 6 * 100), "baseline": (1, 50.0),
    }
    assert by_run(E.valid_rate(scored), "valid_n") == {"candidate": (5,), "baseline": (1,)}
    assert by_run(E.repair_rate(scored), "repair_n") == {"candidate": (2,), "baseline": (1,)}
    assert by_run(E.override_rate(scored), "changed_n", "hit_n") == {
        "candidate": (1, 1), "baseline": (0, 0),
    }


def test_confusion(scored):
    cells = {(r.run, r.truth, r.predicted): r.n for r in E.confusion_matrix(scored).collect()}
    assert cells == {
        ("candidate", "SEV-1", "SEV-1"): 4,
        ("candidate", "SEV-1", "SEV-3"): 1,
        ("candidate", "SEV-3", "SEV-3"): 1,
    }
    every = E.confusion_matrix(scored, labels=[]).collect()
    assert sum(r.n for r in every) == 8
    pivot = {(r.run, r.truth): (r["SEV-1"], r["SEV-3"]) for r in E.confusion_pivot(scored).collect()}
    assert pivot == {("candidate", "SEV-1"): (4, 1), ("candidate", "SEV-3"): (0, 1)}
    recall = {(r.run, r.severity): (r.true_positives, r.false_negatives, r.recall)
              for r in E.class_recall(scored).collect()}
    assert recall[("candidate", "SEV-1")] == (4, 1, 80.0)
    assert recall[("baseline", "SEV-1")] == (0, 1, 0.0)


def test_breakdowns(scored):
    causes = {(r.run, r.likely_cause): (r.total, r.correct) for r in E.per_cause_accuracy(scored).collect()}
    assert causes == {
        ("candidate", "c"): (5, 4), ("candidate", "d"): (1, 0), ("baseline", "c"): (2, 1),
    }
    compared = {r.metric: (r.baseline, r.candidate) for r in E.compare_runs(scored).collect()}
    assert compared["severity_accuracy"] == (50.0, 5 / 6 * 100)
    assert compared["exact_match_accuracy"] == (50.0, 2 / 6 * 100)
    errors = {(r.run, r.category): r.n for r in E.error_breakdown(scored).collect()}
    assert errors == {
        ("candidate", "severity_misclassification"): 1,
        ("candidate", "likely_cause_error"): 2,
        ("candidate", "incomplete_json"): 2,
        ("candidate", "formatting_issue"): 1,
        ("baseline", "severity_misclassification"): 1,
        ("baseline", "likely_cause_error"): 1,
        ("baseline", "incomplete_json"): 1,
        ("baseline", "formatting_issue"): 0,
    }
    kinds = {(r.run, r.intervention): r.n for r in E.intervention_stats(scored).collect()}
    assert kinds == {
        ("candidate", "none"): 4, ("candidate", "repaired"): 1, ("candidate", "overridden"): 1,
        ("baseline", "repaired"): 1, ("baseline", "none"): 1,
    }
    stages = {(r.run, r.stage): r.n for r in E.stage_valid_rate(scored).collect()}
    assert [stages[("candidate", s)] for s in ("raw", "normalized", "repaired", "final")] == [3, 4, 4, 6]


def test_report(scored):
    report = {r.run: r for r in E.evaluation_report(scored).collect()}
    mine = report["candidate"]
    assert mine.test_samples == 6
    assert mine.metrics.severity_accuracy == 5 / 6 * 100
    assert mine.metrics.valid_json_rate == 5 / 6 * 100
    assert mine.inference_stats.repair_rate == 2 / 6 * 100
    assert mine.confusion_matrix["SEV-1"]["SEV-1"] == 4
    assert mine.confusion_matrix["SEV-1"]["SEV-3"] == 1
    assert mine.by_likely_cause["c"].asDict() == {"total": 5, "correct": 4, "accuracy": 80.0}


def test_pairing_is_by_id(spark):
    predictions = spark.createDataFrame([("1", "x"), ("2", "y"), ("9", "z")], "example_id string, severity string")
    truth = spark.createDataFrame([("2", answer("SEV-3")), ("1", "no json")], "example_id string, response string")
    got = {r.example_id: (r.severity, r.true_severity) for r in E.pair_predictions(predictions, truth).collect()}
    assert got == {"1": ("x", None), "2": ("y", "SEV-3")}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        (0, "Config A (Baseline)", 5e-5, 4, 3, 3.9450, 2.8075, 15.6),
        (1, "Config B (Lower LR)", 2e-5, 4, 3, 4.6322, 3.8554, 14.4),
        (2, "Config C (Higher Capacity)", 5e-5, 2, 5, 2.4405, 0.8110, 27.0),
        (3, "tie", 1e-5, 2, 5, 1.0, 0.8110, 60.0),
        (4, "no loss", 1e-5, 2, 5, 1.0, None, 60.0),
    ]
    return spark.createDataFrame(
        rows,
        "ord bigint, config_name string, learning_rate double, batch_size bigint, epochs bigint, "
        "train_loss double, val_loss double, runtime_seconds double",
    )


def test_experiments(runs):
    board = X.leaderboard(runs).collect()
    assert [r.ord for r in board] == [0, 1, 2, 3, 4]
    assert [r.runtime_minutes for r in board][:3] == pytest.approx([0.26, 0.24, 0.45])
    assert X.best_run(runs).first().config_name == "Config C (Higher Capacity)"
    assert X.best_run(runs.where("ord > 3")).count() == 0
    gains = {r.ord: r.improvement_pct for r in X.improvement_pct(runs).collect()}
    assert round(gains[2]) == 71 and gains[0] == 0.0 and gains[4] is None
    assert X.only_best(runs).select(F.max("ord")).first()[0] == 2


def test_confusion_parses_no_output_twice(spark):
    """The labels of interest are told apart behind the parsing, not in a filter that repeats it."""
    from emberlog.plans import registry

    scored = registry.scored(spark, "/root/testdata/sf0.001")
    parsed = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    assert parsed(E.confusion_matrix(scored)) == parsed(E.confusion_pivot(scored)) == parsed(E.confusion_matrix(scored, labels=[]))


def test_pairs_outside_the_labels_leave_no_row(spark):
    data = [("a", "SEV-1", "SEV-3"), ("a", "SEV-1", None), ("a", None, "SEV-1"), ("b", "SEV-2", "SEV-1"), (None, "SEV-3", "SEV-3")]
    scored = spark.createDataFrame(data, "run string, true_severity string, severity string")
    got = {tuple(r) for r in E.confusion_matrix(scored).collect()}
    assert got == {("a", "SEV-1", "SEV-3", 1), (None, "SEV-3", "SEV-3", 1)}


def test_confusion_reads_each_json_text_once(spark):
    """One parse of the output and one of the truth, neither repeated in branches or lambdas."""
    from emberlog.plans import registry

    scored = registry.scored(spark, "/root/testdata/sf0.001")
    for df in (E.confusion_pivot(scored), E.confusion_matrix(scored)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2


def test_truth_of_odd_responses(spark):
    """Last of equal keys, no JSON, text behind the object, null and an empty object."""
    texts = ['{"a": 1, "a": "x", "b": null}', "no json", '{"a": 1} {"a": 2}', None, "{}", "", "[1]", '{"a": {"k": [1]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, response string")
    got = {r.i: r.t for r in df.select("i", labelling.parse_response().alias("t")).collect()}
    assert got == {0: {"a": "x", "b": None}, 1: None, 2: None, 3: None, 4: {}, 5: None, 6: None, 7: {"a": '{"k":[1]}'}}
