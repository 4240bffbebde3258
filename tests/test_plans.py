"""What the physical plans must and must not contain."""

import re

import pytest

from emberlog.operators import model
from emberlog.plans import registry

SF = "/root/testdata/sf0.001"
BATCH = [
    "triage_by_host", "normalize_text", "line_ordinal", "sliding_windows", "dedup_incidents",
    "label_incidents", "stratified_split", "shuffle_rows", "parse_and_repair_mark", "triage",
    "field_accuracy", "stage_valid_rate", "pair_predictions", "length_audit",
]


def plan(spark, name):
    return registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_global_window(spark, name):
    text = plan(spark, name)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    # a window behind a single-partition exchange would rank everything in one task
    assert not re.search(r"Window.*\n.*Sort.*\n.*Exchange SinglePartition", text)


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "triage_by_host")
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {"event_id:bigint,user_id:bigint,event_type:string,value:double"}
    assert "ReadSchema: struct<text:string" not in plan(spark, "line_ordinal")


def test_lines_are_filtered_once(spark):
    """Counting and ranking share one exchange of the filtered lines."""
    df = registry.positioned(spark, SF)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text
    assert text.count("FileScan") == 1


def test_model_round_trip(spark):
    rows, train, val = registry._parts(spark, SF)
    trained = model.train_triage_model(train, val, model.CONFIGS[2])
    assert trained.train_loss < 0.5
    answers = model.predict_triage(trained, rows.where("split = 'test'"))
    got = answers.select("response", "raw_output").collect()
    assert len(got) == rows.where("split = 'test'").count() > 0
    assert sum(r.response == r.raw_output for r in got) > len(got) / 2
    runs = model.tune_triage_model(train, val, model.CONFIGS[1:])
    assert [r.config_name for r in runs.collect()] == [c.name for c in model.CONFIGS[1:]]


def test_text_scans_of_large_tables_stay_few(spark):
    """Blocks grow with the lines: no more than some hundred tasks at 16 GB, and still many blocks on a small table."""
    from emberlog.plans import registry

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    found = []
    for size in (1 << 10, 1 << 30, 16 << 30, 1 << 50):
        with registry._small_blocks(spark, size):
            found.append(int(spark.conf.get(key).rstrip("b")))
    assert found == [64 << 10, 4 << 20, 64 << 20, 128 << 20] and spark.conf.get(key, None) == before


def test_line_files_hold_the_lines_in_order(spark):
    """Several tasks write a folder; its files, by name, hold the lines in order, and no folder takes those of another."""
    from emberlog.plans import registry

    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path, size = registry._line_files(spark, "/root/testdata/sf0.001")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    read = spark.read.text(f"{path}/*").selectExpr("value", "_metadata.file_path AS file", "monotonically_increasing_id() AS i").collect()
    rows = sorted((r["file"], r["i"], r["value"]) for r in read)
    assert len({r[0] for r in rows}) > 5 and sum(len(r[2].encode()) + 1 for r in rows) == size
    want = [r["line"] for r in registry.log_lines(spark, "/root/testdata/sf0.001").orderBy("seq").collect()]
    assert [r[2] for r in rows] == want


def test_line_ordinal_global_shuffles_its_lines_once(spark):
    """The columns asked for are all that is stored, so the counting and the ranking side read one exchange."""
    from emberlog.plans import registry

    df = registry.QUERIES["line_ordinal_global"](spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("ReusedExchange") == 1
    assert "level" not in plan and "component" not in plan
