import dataclasses

import pytest
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import labels as B
from emberlog.operators import model as M


def pairs(spark, n, start=0):
    causes = [vocab.BLOCK_SERVING, vocab.PACKET_RESPONDER]
    rows = []
    for i in range(start, start + n):
        cause = causes[i % 3 == 0]
        text = "got exception while serving" if cause == causes[0] else "packetresponder terminating"
        rows.append((f"{text} node{i} blk{i * 7}", "SEV-1" if cause == causes[0] else "SEV-3", cause))
    df = spark.createDataFrame(rows, "prompt string, severity string, likely_cause string")
    action = B.recommended_action(F.col("likely_cause"))
    return df.withColumn("response", B.response_json(F.col("severity"), F.col("likely_cause"), action))


def test_few_rows_are_fitted_with_more_shrinkage(spark):
    """Every row has tokens of its own; without shrinkage they settle everything, and unseen rows pay for it."""
    train, val = pairs(spark, 30), pairs(spark, 12, 100)
    held = M.train_triage_model(train, val)
    free = M.train_triage_model(train, val, dataclasses.replace(M.Params(), small_data=0.0))
    assert free.train_loss < held.train_loss
    assert held.val_loss < 0.69  # a fair coin's


def test_saved_models(spark, tmp_path):
    train, val = pairs(spark, 40), pairs(spark, 10, 100)
    path = str(tmp_path / "models")
    with pytest.raises(Exception):
        M.load_triage_model(spark, path)
    first = M.train_triage_model(train, val, M.Params("weak", max_iter=1, reg_param=5.0))
    second = M.train_triage_model(train, val)
    M.save_triage_model(first, spark, path)
    assert M.load_triage_model(spark, path).val_loss == first.val_loss
    M.save_triage_model(second, spark, path)
    # a save that was cut off has a folder but no row, and changes nothing
    second.features.write().save(f"{path}/model-cut-off/features")
    other = spark.newSession()
    again = M.load_triage_model(other, path)
    assert (again.train_loss, again.val_loss) == (second.train_loss, second.val_loss)
    prompts = val.select("prompt").unionByName(spark.createDataFrame([("",), ("unheard of",)], "prompt string"))
    said = lambda m, df: sorted(map(tuple, M.predict_triage(m, df).collect()))
    assert said(again, prompts) == said(second, prompts)
    assert M.saved_models(spark, path).count() == 2
