import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberlog.operators import splits as T


def rows_of(spark, sizes):
    rows = [
        (f"{sev}-{i}", sev, f"text {i}", "r")
        for sev, n in sizes.items()
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "incident_id string, severity string, prompt string, response string"
    ).repartition(5)


@pytest.mark.parametrize(
    "sizes",
    [
        {"SEV-1": 15, "SEV-3": 33},
        {"SEV-1": 90, "SEV-2": 170, "SEV-3": 180},
        {"SEV-1": 330, "SEV-2": 1, "SEV-3": 6},
        {"SEV-2": 2},
    ],
)
@pytest.mark.parametrize("ratios", [(0.7, 0.15, 0.15), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)])
def test_split_cuts_by_rank(spark, sizes, ratios):
    done = T.stratified_split(rows_of(spark, sizes), *ratios, seed=7, row_id=["incident_id"])
    got = {r.incident_id: r.split for r in done.collect()}
    assert len(got) == sum(sizes.values())
    for sev, n in sizes.items():
        order = sorted(
            (f"{sev}-{i}" for i in range(n)),
            key=lambda x: hashlib.sha1(f"7|{x}".encode()).hexdigest(),
        )
        a = int(n * ratios[0])
        b = a + int(n * ratios[1])
        want = dict.fromkeys(order[:a], "train")
        want.update(dict.fromkeys(order[a:b], "val"))
        want.update(dict.fromkeys(order[b:], "test"))
        assert {k: v for k, v in got.items() if k.startswith(sev)} == want


def test_shipped_split_sizes(spark):
    done = T.stratified_split(rows_of(spark, {"SEV-1": 15, "SEV-3": 33}), row_id=["incident_id"])
    got = Counter((r.severity, r.split) for r in done.collect())
    assert got == {
        ("SEV-1", "train"): 10, ("SEV-1", "val"): 2, ("SEV-1", "test"): 3,
        ("SEV-3", "train"): 23, ("SEV-3", "val"): 4, ("SEV-3", "test"): 6,
    }
    stats = {(r.split, r.severity): r.n for r in T.split_stats(done).collect()}
    assert stats[(None, None)] == 48
    assert [stats[(s, None)] for s in T.SPLITS] == [33, 6, 9]


def test_ratios_are_checked(spark):
    with pytest.raises(ValueError):
        T.stratified_split(rows_of(spark, {"SEV-1": 3}), 0.5, 0.1, 0.1)
    T.check_ratios(0.7, 0.15, 0.155)


def test_unknown_strata_are_not_dropped(spark):
    df = rows_of(spark, {"SEV-1": 4, "SEV-9": 10})
    with pytest.raises(Exception, match="unknown stratum: SEV-9"):
        T.stratified_split(df, row_id=["incident_id"]).collect()
    free = T.stratified_split(df, strata=None, row_id=["incident_id"])
    assert Counter(r.split for r in free.where("severity = 'SEV-9'").collect()) == {
        "train": 7, "val": 1, "test": 2,
    }


def test_leakage(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("a", "train"), ("b", "val"), ("b", "val"), ("c", "test")],
        "prompt string, split string",
    )
    assert T.split_leakage(df).first().asDict() == {
        "distinct_texts": 3, "leaked_texts": 1, "leaked_rows": 3,
    }


def test_shuffle_is_a_seeded_permutation(spark):
    df = rows_of(spark, {"SEV-1": 50}).withColumn(
        "split", F.when(F.col("prompt") < "text 3", "train").otherwise("val")
    )
    got = {(r.split, r.shuffle_pos): r.incident_id
           for r in T.shuffle_rows(df, seed=1, row_id=["incident_id"]).collect()}
    for split in ("train", "val"):
        ids = [r.incident_id for r in df.where(F.col("split") == split).collect()]
        order = sorted(ids, key=lambda x: hashlib.sha1(f"2|{x}".encode()).hexdigest())
        assert [got[(split, i)] for i in range(len(ids))] == order


def test_tokens_and_budget(spark, values):
    cases = {"": 0, "   ": 0, "a": 1, " a  b\tc\n": 3, "x y": 2}
    assert values(list(cases), F.size(T.tokens(F.col("x")))) == list(cases.values())
    df = spark.createDataFrame([("a b  c d",), ("a",), ("",)], "x string")
    got = [(r.n_tokens, r.truncated, r.over_budget) for r in T.truncate_to_budget(df, "x", 3).collect()]
    assert got == [(4, "a b c", True), (1, "a", False), (0, "", False)]


def test_length_audit(spark):
    df = spark.createDataFrame(
        [("train", "a b c", "r s"), ("train", "a", "r"), ("val", "", "r")],
        "split string, prompt string, response string",
    )
    got = {(r.split, r.field): tuple(r)[2:] for r in T.length_audit(df, 2, 1).collect()}
    assert got[("train", "prompt")] == (2, 3, 1.0, 3.0, 1)
    assert got[("train", "response")] == (2, 2, 1.0, 2.0, 1)
    assert got[("val", "prompt")] == (1, 0, 0.0, 0.0, 0)


def test_newline(spark):
    df = spark.createDataFrame([("p", "r")], "prompt string, response string")
    assert T.append_target_newline(df).first().response == "r\n"
