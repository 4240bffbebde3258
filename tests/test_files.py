import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.operators import evaluation as E
from emberlog.operators import labelling, splits
from emberlog.operators.lines import informative_lines
from emberlog.operators.ordinal import global_ordinal
from emberlog.plans import flows
from emberlog.session import pin, shared_dir, stage_path
from emberlog.sources import files


@pytest.fixture
def log_file(tmp_path):
    lines = []
    for i in range(60):
        lines.append(f"0811{i:02d} 203615 {i} WARN dfs.DataNode$X: event {i % 7} blk_{i} slow")
        lines.append(f"081109 203615 {i} INFO dfs.Ok: fine")
        lines.append("   ")
    path = tmp_path / "app.log"
    path.write_bytes("\r\n".join(lines).encode() + b"\r\nWARN bad \xff\xfe bytes \xc3\xa9\n")
    return path


def test_read_log_lines(spark, log_file):
    df = files.read_log_lines(spark, str(log_file))
    rows = df.orderBy("block", "seq").collect()
    assert len(rows) == 181
    assert rows[0].line == "081100 203615 0 WARN dfs.DataNode$X: event 0 blk_0 slow"
    assert rows[2].line == ""
    assert rows[-1].line == "WARN bad  bytes é"
    assert {r.source for r in rows} == {"file:" + str(log_file)}


def test_file_blocks_do_not_change_incidents(spark, log_file):
    whole, counts = flows.files_to_incidents(spark, str(log_file))
    want = sorted((r.win, r.incident_id) for r in whole.collect())
    assert counts.get == {"total_lines": 181, "blank_lines": 60}
    assert len(want) == 7  # the events repeat every 7 lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        cut = files.read_log_lines(spark, str(log_file))
        assert cut.select("block").distinct().count() > 5
        pieces, counts = flows.files_to_incidents(spark, str(log_file))
        assert sorted((r.win, r.incident_id) for r in pieces.collect()) == want
        assert counts.get["total_lines"] == 181
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_incident_round_trip(spark, log_file, tmp_path):
    found, _ = flows.files_to_incidents(spark, str(log_file))
    path = str(tmp_path / "incidents")
    files.write_incidents(found, path)
    columns = ["incident_id", "service", "lines", "incident_text", "stats"]
    back = files.read_incidents(spark, path)
    assert back.columns == columns
    key = lambda r: r.incident_id
    assert sorted(back.collect(), key=key) == sorted(found.select(columns).collect(), key=key)
    text = next(p for p in (tmp_path / "incidents").iterdir() if p.suffix == ".json").read_text()
    assert set(json.loads(text.splitlines()[0])) == set(columns)


def test_split_files(spark, log_file, tmp_path):
    found, _ = flows.files_to_incidents(spark, str(log_file))
    done = flows.incidents_to_splits(found)
    path = str(tmp_path / "splits")
    files.write_splits(done, path)
    assert {p.name for p in (tmp_path / "splits").iterdir() if p.is_dir()} == {
        f"split={s}" for s in splits.SPLITS
    }
    back = files.read_splits(spark, path)
    assert sorted(map(tuple, back.select("split", "prompt", "response").collect())) == sorted(
        map(tuple, done.select("split", "prompt", "response").collect())
    )
    one = files.read_pairs(spark, path + "/split=train")
    assert one.count() == done.where("split = 'train'").count()
    plan = back.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_numbers_do_not_depend_on_the_scan(spark, tmp_path):
    """Several files, one of them empty, cut into blocks of two sizes: the same numbers, those of the files."""
    want = []
    for name, n in (("a", 70), ("b", 0), ("c", 1), ("d", 200)):
        lines = [f"{name} {i} " + "x" * (i * 7 % 40) if i % 5 else "" for i in range(n)]
        (tmp_path / f"{name}.log").write_text("".join(line + "\n" for line in lines))
        want += [(len(want) + i, i, line.strip()) for i, line in enumerate(lines)]
    got = []
    for size in ("300b", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            df = files.numbered_lines(spark, str(tmp_path))
            got.append(sorted((r.pos, r.line_no, r.line) for r in df.collect()))
            folder = files.numbered_lines(spark, str(tmp_path), by="folder")
            assert sorted((r.line_no, r.line) for r in folder.collect()) == [(p, line) for p, _, line in want]
            kept = pin(informative_lines(files.read_log_lines(spark, str(tmp_path)).withColumn("line", F.concat("line", F.lit(" slow")))), "kept")
            placed = global_ordinal(kept).orderBy("pos").select("pos", "normalized").collect()
            assert [tuple(r) for r in placed] == [(p, f"{line} slow".strip()) for p, _, line in want]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [want, want]
    with pytest.raises(ValueError):
        files.read_log_lines(spark, str(tmp_path), by="year")


GOOD = ['{"prompt": "a", "response": "b"}', ' {"prompt": "c"}\t', '{"response": "d", "other": [1, {"x": "}"}]}', "{}"]
BROKEN = ['{"prompt": "a"', '{"prompt": "a"} x', '{"prompt": "a"}{"prompt": "b"}', '{"prompt": "a"},{"prompt": "b"}', "[1]", "3", "null", "nope",
          "{'prompt': 'a'}", '{"prompt": NaN}', '{"prompt": "a",}', '[{"prompt": "a"}]', '{"a": 1}]', '"x"']


def test_broken_json_lines(spark, tmp_path):
    path = str(tmp_path / "pairs.jsonl")
    (tmp_path / "pairs.jsonl").write_text("\n".join([*GOOD[:2], "", *BROKEN, "   ", *GOOD[2:], ""]), encoding="utf-8")
    counts = Observation("json")
    rows = files.read_pairs(spark, path, broken="drop", counts=counts).collect()
    assert [tuple(r) for r in rows] == [("a", "b"), ("c", None), (None, "d"), (None, None)]
    assert counts.get == {"lines": len(GOOD) + len(BROKEN), "broken": len(BROKEN)}
    away = files.broken_lines(spark, path, vocab.PAIR_SCHEMA).collect()
    assert [r.line for r in away] == BROKEN and {r.file for r in away} == {f"file:{path}"}
    with pytest.raises(Exception, match="broken JSON in"):
        files.read_pairs(spark, path).count()  # even where no column is asked for
    with pytest.raises(ValueError):
        files.read_pairs(spark, path, broken="ignore")


def test_sinks_can_run_again(spark, tmp_path):
    path, schema = str(tmp_path / "splits"), "split string, prompt string, response string"
    rows = spark.createDataFrame([(s, f"p{i}", "r") for i, s in enumerate(["train"] * 7 + ["val", "test"])], schema)
    read = lambda: sorted((r.split, r.prompt) for r in files.read_splits(spark, path).collect())
    want = sorted((r.split, r.prompt) for r in rows.collect())
    for _ in range(2):
        files.write_splits(rows, path)
        assert read() == want
    # a job that fails leaves the files of the one before
    broken = rows.withColumn("prompt", F.when(F.col("prompt") == "p3", F.raise_error(F.lit("cut off")).cast("string")).otherwise("new"))
    with pytest.raises(Exception, match="cut off"):
        files.write_splits(broken, path)
    assert read() == want
    # what an earlier job left half done goes with the next one
    (tmp_path / "splits" / "_temporary").mkdir()
    (tmp_path / "splits" / "split=train" / "part-half.json").write_text('{"prompt": "half')
    files.write_splits(rows, path)
    assert read() == want
    files.write_splits(rows.where("split = 'val'").withColumn("prompt", F.lit("other")), path, only_given=True)
    assert read() == sorted([(s, p) for s, p in want if s != "val"] + [("val", "other")])
    files.write_splits(rows.where("split = 'val'"), path)
    assert read() == [("val", "p7")]
    # a table may replace the files it was read from, and long files are cut
    files.replace_json(files.read_splits(spark, path).unionByName(rows), path, by="split", rows_per_file=2)
    assert len(list((tmp_path / "splits" / "split=train").glob("*.json"))) >= 4
    assert len(read()) == 10


def test_merged_sketches(spark):
    rows = spark.range(20_000).select(
        F.lit("train").alias("split"), (F.col("id") % 5).alias("part"),
        F.repeat(F.lit("w "), (F.pow(F.rand(3), 2) * 300).cast("int")).alias("prompt"), F.lit("").alias("response"),
    )
    rows = pin(rows, "rows")
    exact = {r.field: r for r in splits.length_audit(rows, 100, 100).collect()}
    stored = pin(splits.length_sketches(rows, 100, 100, by=("split", "part")), "sketches")
    assert stored.count() == 10
    sketched = splits.sketched_percentiles(splits.merge_sketches(stored)).collect()
    for r in sketched:
        e = exact[r.field]
        assert (r.n, r.max_tokens, r.over_budget) == (e.n, e.max_tokens, e.over_budget)
        lengths = rows.select(F.size(splits.tokens(F.col(r.field))).alias("k"))
        for value, share in ((r.p50, 0.5), (r.p95, 0.95)):
            below, upto = lengths.agg(F.avg((F.col("k") < value).cast("int")), F.avg((F.col("k") <= value).cast("int"))).first()
            assert below <= share + splits.RANK_ERROR and upto >= share - splits.RANK_ERROR


def test_invalid_pairs_stop_the_build(spark, log_file, monkeypatch):
    found, _ = flows.files_to_incidents(spark, str(log_file))
    monkeypatch.setattr(
        labelling, "label_incidents",
        lambda df: labelling.label_columns(df).withColumns(
            {"prompt": F.lit("no template"), "response": F.lit("{}")}
        ),
    )
    with pytest.raises(ValueError, match="invalid prompt/response pairs"):
        flows.incidents_to_splits(found)


def test_report_and_experiment_files(spark, tmp_path):
    runs = spark.createDataFrame(
        [(0, "A", 2.0, 1.5), (1, "B", 1.0, 0.5)],
        "ord bigint, config_name string, train_loss double, val_loss double",
    )
    files.write_experiments(runs, str(tmp_path / "full"))
    files.write_experiments(runs.where("ord = 1"), str(tmp_path / "best"), best_only=True)

    def read(name):
        parts = [p for p in (tmp_path / name).iterdir() if p.suffix == ".json"]
        text = "".join(p.read_text() for p in parts)
        return json.loads(text)

    assert read("full") == {
        "experiments": [
            {"config_name": "A", "train_loss": 2.0, "val_loss": 1.5},
            {"config_name": "B", "train_loss": 1.0, "val_loss": 0.5},
        ],
        "best_config": "B",
        "best_val_loss": 0.5,
    }
    assert read("best") == {
        "mode": "best_only",
        "experiment": {"config_name": "B", "train_loss": 1.0, "val_loss": 0.5},
        "config": "B",
    }

    good = '{"severity": "SEV-1", "likely_cause": "c", "recommended_action": "a"}'
    outputs = spark.createDataFrame(
        [("1", "run", "fine", good, good)],
        "example_id string, run string, incident_text string, raw_output string, response string",
    )
    files.write_report(E.evaluation_report(flows.outputs_to_scores(outputs)), str(tmp_path / "report"))
    report = read("report")
    assert report["confusion_matrix"] == {"SEV-1": {"SEV-1": 1, "SEV-3": 0}, "SEV-3": {"SEV-1": 0, "SEV-3": 0}}
    assert report["by_likely_cause"] == {"c": {"total": 1, "correct": 1, "accuracy": 100.0}}
    assert report["metrics"]["exact_match_accuracy"] == 100.0


def test_stage_tables_go_to_the_named_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert stage_path(spark, "x").startswith(folder + "/emberlog-x-")
    df = pin(spark.range(3), "range")
    assert "parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 3


def test_a_finished_job_leaves_nothing(spark):
    from pathlib import Path

    from emberlog import session

    app = spark.sparkContext.applicationId
    others = session._STAGES.pop(app, [])  # stage tables of other tests stay
    try:
        assert session.pin(spark.range(3).toDF("n"), "stage").count() == 3
        folders = [Path(p.removeprefix("file:")) for p in session._STAGES[app]]
        assert folders and all(f.exists() for f in folders)
        session.drop_stages(spark)
        assert not any(f.exists() for f in folders)
    finally:
        session._STAGES[app] = others
