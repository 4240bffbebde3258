"""A distributed text-to-label model over prompt/response pairs.

Severity and cause are each fitted with hashed token features and multinomial logistic regression.
It fills the ``raw_output`` column with JSON text, so repair and evaluation run on it unchanged.

Models are saved in the shared folder and loaded in other sessions. A save is visible once its last row is written,
so an interrupted one leaves the model before it in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    HashingTF,
    IDF,
    IndexToString,
    RegexTokenizer,
    StringIndexerModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import labels as B
from emberlog.operators.labelling import parse_response

TARGETS = ("severity", "likely_cause")
#: Labels are numbered over the fixed vocabulary; any other value shares the number after the last.
LABELS = {"severity": vocab.SEVERITIES, "likely_cause": list(vocab.ACTIONS)}


SMALL_DATA = 20.0


@dataclass(frozen=True)
class Params:
    """What a tuning configuration may vary."""

    name: str = vocab.BASELINE_CONFIG
    max_iter: int = 20
    reg_param: float = 0.0
    features: int = 1 << 14
    #: Shrinkage is raised by this over the number of training rows: few rows cannot settle many features.
    small_data: float = SMALL_DATA


# one trial per fixed configuration: more passes and less shrinkage from B over A to C
CONFIGS = (
    Params(vocab.CONFIGS[0][0], max_iter=5, reg_param=0.05),
    Params(vocab.CONFIGS[1][0], max_iter=5, reg_param=0.5),
    Params(vocab.CONFIGS[2][0], max_iter=20, reg_param=0.001),
)


@dataclass(frozen=True)
class TriageModel:
    features: PipelineModel
    targets: dict[str, PipelineModel]
    train_loss: float
    val_loss: float
    runtime_seconds: float


def _with_labels(pairs: DataFrame) -> DataFrame:
    """Prompt text with both labels; from the pair's own columns or parsed from the response."""
    if set(TARGETS) <= set(pairs.columns):
        return pairs.select("prompt", *TARGETS)
    parsed = parse_response()
    return pairs.select(
        "prompt", *[F.try_element_at(parsed, F.lit(t)).alias(t) for t in TARGETS]
    )


def train_triage_model(train: DataFrame, val: DataFrame, params: Params = Params()) -> TriageModel:
    """Fit both targets on ``train``; losses are mean log losses over the targets.

    Tokens and term weights are computed once and shared by the two fits. A label that ``train`` does
    not hold counts with its full loss in ``val``; no row is left out.
    """
    started = time.time()
    features = Pipeline(
        stages=[
            RegexTokenizer(inputCol="prompt", outputCol="_words", pattern=r"[^\w<>$.]+"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=params.features),
            IDF(inputCol="_tf", outputCol="_features"),
        ]
    ).fit(_with_labels(train))
    fit_rows = features.transform(_with_labels(train)).select("_features", *TARGETS)
    val_rows = features.transform(_with_labels(val)).select("_features", *TARGETS)
    fit_rows.persist()
    shrinkage = params.reg_param + params.small_data / max(1, fit_rows.count())
    fitted, losses = {}, {"train": [], "val": []}
    try:
        for target in TARGETS:
            fitted[target] = Pipeline(
                stages=[
                    StringIndexerModel.from_labels(
                        LABELS[target], inputCol=target, outputCol="_label", handleInvalid="keep"
                    ),
                    LogisticRegression(
                        featuresCol="_features", labelCol="_label", maxIter=params.max_iter,
                        regParam=shrinkage, predictionCol="_prediction",
                        probabilityCol="_probability", rawPredictionCol="_raw",
                        family="multinomial",
                    ),
                ]
            ).fit(fit_rows)
            judge = MulticlassClassificationEvaluator(
                labelCol="_label", predictionCol="_prediction", probabilityCol="_probability",
                metricName="logLoss",
            )
            for part, rows in (("train", fit_rows), ("val", val_rows)):
                losses[part].append(judge.evaluate(fitted[target].transform(rows)))
    finally:
        fit_rows.unpersist()
    return TriageModel(
        features,
        fitted,
        sum(losses["train"]) / len(TARGETS),
        sum(losses["val"]) / len(TARGETS),
        time.time() - started,
    )


def predict_triage(model: TriageModel, df: DataFrame) -> DataFrame:
    """Add ``raw_output``: the predicted labels and their action as JSON text."""
    out = model.features.transform(df)
    for target, fitted in model.targets.items():
        classifier = fitted.stages[-1]
        out = classifier.transform(out).drop("_raw", "_probability")
        name = IndexToString(
            inputCol="_prediction", outputCol=f"_{target}",
            labels=[*LABELS[target], vocab.UNKNOWN],
        )
        out = name.transform(out).drop("_prediction")
    cause = F.col("_likely_cause")
    text = B.response_json(F.col("_severity"), cause, B.recommended_action(cause))
    return out.select(*[c for c in df.columns if c != "raw_output"], text.alias("raw_output"))


def tune_triage_model(
    train: DataFrame, val: DataFrame, configs: Sequence[Params] = CONFIGS
) -> DataFrame:
    """One row per configuration, ready for the leaderboard. The list of configurations is short;
    each fit is distributed."""
    rows = []
    for i, params in enumerate(configs):
        model = train_triage_model(train, val, params)
        rows.append(
            (i, params.name, params.reg_param, params.max_iter, model.train_loss,
             model.val_loss, model.runtime_seconds)
        )
    schema = (
        "ord bigint, config_name string, reg_param double, max_iter int, train_loss double, "
        "val_loss double, runtime_seconds double"
    )
    return train.sparkSession.createDataFrame(rows, schema)


SAVED = "saved_at timestamp, folder string, train_loss double, val_loss double, runtime_seconds double"


def save_triage_model(model: TriageModel, spark: SparkSession, path: str) -> str:
    """Write ``model`` under ``path`` and return its own folder; earlier models there stay.

    All parts go to a fresh folder first; one row of the list of models, written last, makes it count.
    """
    folder = f"model-{uuid.uuid4().hex}"
    model.features.write().save(f"{path}/{folder}/features")
    for target, fitted in model.targets.items():
        fitted.write().save(f"{path}/{folder}/{target}")
    row = (folder, model.train_loss, model.val_loss, model.runtime_seconds)
    listed = spark.createDataFrame([row], SAVED.split(", ", 1)[1]).select(F.current_timestamp().alias("saved_at"), "*")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/models")
    return f"{path}/{folder}"


def saved_models(spark: SparkSession, path: str) -> DataFrame:
    """All models under ``path``, one row each (``SAVED``)."""
    return spark.read.schema(SAVED).parquet(f"{path}/models")


def load_triage_model(spark: SparkSession, path: str) -> TriageModel:
    """The model that was saved last under ``path``."""
    last = saved_models(spark, path).orderBy(F.desc("saved_at"), F.desc("folder")).first()
    if last is None:
        raise ValueError(f"no model under {path}")
    part = lambda name: PipelineModel.load(f"{path}/{last['folder']}/{name}")
    return TriageModel(
        part("features"), {t: part(t) for t in TARGETS}, last["train_loss"], last["val_loss"], last["runtime_seconds"]
    )
