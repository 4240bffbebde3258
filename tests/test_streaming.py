import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.plans import flows
from emberlog.operators.lines import informative_lines
from emberlog.operators.windows import sliding_windows
from emberlog.streaming import lines as S
from emberlog.streaming import windows as W


def log_rows(n, start=0):
    """A hot source, a thin one, and lines that are not kept."""
    rows = []
    for i in range(start, start + n):
        source = "thin" if i % 10 == 0 else "hot"
        level = "INFO ok" if i % 3 == 0 else f"WARN dfs.DataNode: event {i % 4} slow"
        rows.append((source, i, level))
    return rows


def feed(spark, folder, number, rows):
    spark.createDataFrame(rows, vocab.LINE_SCHEMA).repartition(3).write.parquet(
        f"{folder}/in/part={number}"
    )


def stream(spark, folder):
    return spark.readStream.schema(vocab.LINE_SCHEMA).parquet(f"{folder}/in/part=*")


def advance(spark, folder, size, stride, checkpoint="checkpoint", **how):
    windows = W.stream_windows(S.stream_clean(stream(spark, folder)), size, stride, **how)
    return S.run_available(W.to_files(windows, f"{folder}/out"), f"{folder}/{checkpoint}")


def cut(df):
    return sorted((r.source, r.win, tuple(m.normalized for m in r.members)) for r in df.collect())


@pytest.mark.parametrize("size,stride", [(8, 4), (3, 5), (5, 5)])
def test_windows_over_several_batches(spark, tmp_path, size, stride):
    folder = str(tmp_path)
    chunks = [log_rows(50), log_rows(7, 50), log_rows(1, 57), log_rows(120, 58)]
    seen = []
    for number, rows in enumerate(chunks):
        seen += rows
        feed(spark, folder, number, rows)
        advance(spark, folder, size, stride)  # restarts from the checkpoint each time
        batch = flows.lines_to_windows(spark.createDataFrame(seen, vocab.LINE_SCHEMA), size, stride)
        assert cut(W.read_windows(spark, f"{folder}/out")) == cut(batch)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """A micro-batch whose end was never noted runs again, on the state that it started from."""
    folder = str(tmp_path)
    feed(spark, folder, 0, log_rows(40))
    advance(spark, folder, 8, 4)
    feed(spark, folder, 1, log_rows(30, 40))
    advance(spark, folder, 8, 4)
    once = cut(W.read_windows(spark, f"{folder}/out"))
    last = max(int(p.name) for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit())
    lost = lambda where, names: [n for n in names if where.endswith("commits") and str(last) in n]
    shutil.copytree(tmp_path / "checkpoint", tmp_path / "crashed", ignore=lost)
    advance(spark, folder, 8, 4, "crashed")
    assert cut(W.read_windows(spark, f"{folder}/out")) == once
    # what reads the windows as a stream sees no window twice either
    seen = W.windows_stream(spark, f"{folder}/out").select("source", "win")
    S.run_available(W.to_files(seen, f"{folder}/seen"), f"{folder}/seen-checkpoint")
    assert spark.read.schema(seen.schema).parquet(f"{folder}/seen").count() == len(once)
    feed(spark, folder, 2, log_rows(20, 70))
    advance(spark, folder, 8, 4, "crashed")
    whole = flows.lines_to_windows(spark.createDataFrame(log_rows(90), vocab.LINE_SCHEMA))
    assert cut(W.read_windows(spark, f"{folder}/out")) == cut(whole)


TIMED = vocab.LINE_SCHEMA + ", ts timestamp"


def timed_feed(spark, folder, number, rows):
    given = [(source, seq, f"WARN x.y: event {seq % 3} slow", datetime(2024, 1, 1) + timedelta(seconds=at)) for source, seq, at in rows]
    spark.createDataFrame(given, TIMED).write.parquet(f"{folder}/in/part={number}")


def timed_run(spark, folder, **how):
    lines = spark.readStream.schema(TIMED).parquet(f"{folder}/in/part=*")
    windows = W.stream_windows(S.stream_clean(lines), 4, 2, **how)
    return S.state_changes(spark, S.run_available(W.to_files(windows, f"{folder}/out"), f"{folder}/checkpoint"))


def test_silent_sources_leave_the_state(spark, tmp_path):
    folder, how = str(tmp_path), {"idle": "30 seconds", "delay": "5 seconds"}
    timed_feed(spark, folder, 0, [(None, i, i) for i in range(7)] + [("b", i, i) for i in range(3)])
    held = timed_run(spark, folder, **how).orderBy("batch").collect()
    assert [r.forgotten for r in held] == [0] * len(held) and held[-1].held > 0
    assert W.expired_sources(spark, f"{folder}/out").count() == 0
    timed_feed(spark, folder, 1, [("c", 100 + i, 50 + i) for i in range(6)])  # the watermark moves to 50
    gone = timed_run(spark, folder, **how).collect()
    assert sum(r.forgotten for r in gone) > 0
    got = {(r.source, r.lines, r.open, r.ts.second) for r in W.expired_sources(spark, f"{folder}/out").collect()}
    # 7 lines make windows from 0 and 2; the lines from 4 on stay open
    assert got == {(None, 7, 3, 6), ("b", 3, 3, 2)}
    timed_feed(spark, folder, 2, [("b", 200 + i, 60 + i) for i in range(4)] + [("d", 0, 49)])  # b is back, d is late
    back = timed_run(spark, folder, **how).collect()
    assert sum(r.late for r in back) == 1
    windows = {(r.source, r.win, tuple(m.pos for m in r.members)) for r in W.read_windows(spark, f"{folder}/out").collect()}
    assert windows == {
        (None, 0, (0, 1, 2, 3)), (None, 1, (2, 3, 4, 5)), ("c", 0, (0, 1, 2, 3)), ("c", 1, (2, 3, 4, 5)), ("b", 0, (0, 1, 2, 3)),
    }


def test_windows_without_an_event_time_never_expire(spark, tmp_path):
    feed(spark, str(tmp_path), 0, log_rows(5))
    with pytest.raises(ValueError):
        W.stream_windows(S.stream_clean(stream(spark, str(tmp_path))), idle="1 day")
    with pytest.raises(ValueError):
        W.stream_windows(S.stream_clean(stream(spark, str(tmp_path))), 0)


def test_ids_come_back_and_late_rows_are_counted(spark, tmp_path):
    folder = str(tmp_path)
    schema = "incident_id string, ts timestamp"

    def run(number, *rows):
        given = [(i, datetime(2024, 1, 1, hour)) for i, hour in rows]
        spark.createDataFrame(given, schema).write.parquet(f"{folder}/in/part={number}")
        once = S.stream_dedup(spark.readStream.schema(schema).parquet(f"{folder}/in/part=*"), delay="1 hour")
        progress = S.run_available(W.to_files(once, f"{folder}/out"), f"{folder}/checkpoint")
        total = S.state_changes(spark, progress).groupBy().sum("rows", "late", "forgotten").first()
        return tuple(total)

    out = lambda: sorted((r.incident_id, r.ts.hour) for r in spark.read.schema(schema).parquet(f"{folder}/out").collect())
    assert run(0, ("a", 1), ("a", 1), ("b", 1)) == (3, 0, 0)
    assert run(1, ("a", 2), ("c", 3)) == (2, 0, 2)  # the watermark is at 2 now: a and b are forgotten
    assert out() == [("a", 1), ("b", 1), ("c", 3)]
    assert run(2, ("a", 3), ("b", 2)) == (2, 1, 0)  # b is late
    assert out() == [("a", 1), ("a", 3), ("b", 1), ("c", 3)]


def test_clean_equals_batch(spark, tmp_path):
    folder = str(tmp_path)
    feed(spark, folder, 0, log_rows(60))
    cleaned = S.stream_clean(stream(spark, folder))
    S.run_available(W.to_files(cleaned, f"{folder}/clean"), f"{folder}/clean-checkpoint")
    got = spark.read.schema(cleaned.schema).parquet(f"{folder}/clean")
    want = informative_lines(spark.createDataFrame(log_rows(60), vocab.LINE_SCHEMA))
    columns = ["source", "seq", "normalized", "level", "component"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.select(columns).collect())
    )


def test_dedup_and_triage(spark, tmp_path):
    folder = str(tmp_path)
    feed(spark, folder, 0, log_rows(100))
    advance(spark, folder, 8, 4)
    incidents = S.stream_incidents(W.windows_stream(spark, f"{folder}/out"))
    stamped = incidents.withColumn("ts", F.timestamp_seconds("win"))
    S.run_available(W.to_files(S.stream_dedup(stamped), f"{folder}/unique"), f"{folder}/c1")
    unique = spark.read.schema(stamped.schema).parquet(f"{folder}/unique")
    batch = flows.lines_to_incidents(spark.createDataFrame(log_rows(100), vocab.LINE_SCHEMA))
    assert sorted(r.incident_id for r in unique.collect()) == sorted(
        r.incident_id for r in batch.collect()
    )

    answers = S.stream_triage(incidents)
    S.run_available(W.to_files(answers, f"{folder}/answers"), f"{folder}/c2")
    got = spark.read.schema(answers.schema).parquet(f"{folder}/answers")
    assert got.count() == len(cut(W.read_windows(spark, f"{folder}/out")))
    assert set(r.severity for r in got.collect()) <= set(vocab.SEVERITIES)

    raw = S.stream_triage(incidents.withColumn("raw_output", F.lit("sev-1 packet responder")))
    S.run_available(W.to_files(raw, f"{folder}/raw"), f"{folder}/c3")
    rows = spark.read.schema(raw.schema).parquet(f"{folder}/raw").collect()
    assert {(r.severity, r.likely_cause) for r in rows} == {("SEV-1", vocab.PACKET_RESPONDER)}


def test_absolute_positions_cut_like_fresh_ones(spark):
    """Windows over a run that starts in the middle are the later windows of the whole run."""
    rows = [("a", p, f"t{p}", "INFO", "c") for p in range(50)]
    schema = "source string, pos bigint, normalized string, level string, component string"
    df = spark.createDataFrame(rows, schema)
    late = cut(sliding_windows(df.where("pos >= 21"), 8, 4))
    assert late == [w for w in cut(sliding_windows(df, 8, 4)) if w[1] * 4 >= 21]


def test_windows_leave_the_processor_slice_by_slice(monkeypatch):
    """A large micro-batch of one source gives its windows in bounded frames; they are those of the whole."""
    import pandas as pd

    from emberlog.streaming import windows as W

    class State:
        def __init__(self):
            self.held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held if isinstance(self.held, tuple) else iter(self.held or [])

        def put(self, x):
            self.held = x

        def update(self, x):
            self.held = x

        def clear(self):
            self.held = None

    class Handle:
        def getValueState(self, *_):
            return State()

        def getListState(self, *_):
            return State()

    def frame(seqs):
        seqs = list(seqs)
        return pd.DataFrame({"source": "s", "seq": seqs, "normalized": [f"l{i}" for i in seqs], "level": "INFO", "component": "c", "us": seqs})

    for size, stride in ((8, 4), (2, 5), (3, 1)):
        got = {}
        for cut in (7, 10_000):
            monkeypatch.setattr(W, "SLICE", cut)
            p = W.WindowProcessor(size, stride, None)
            p.init(Handle())
            frames = [f for batch in ([frame(range(40, 75)), frame(range(40))], [frame(range(75, 101))]) for f in p.handleInputRows(("s",), iter(batch), None)]
            assert cut > 7 or max(len(f) for f in frames) <= 8
            out = pd.concat(frames)
            got[cut] = [(w, [m["normalized"] for m in ms], n, o) for w, ms, n, o in zip(out["win"], out["members"], out["lines"], out["open"], strict=True)]
        assert got[7] == got[10_000] and len(got[7]) == W.full_windows(101, size, stride)
        assert all(m == [f"l{i}" for i in range(w * stride, w * stride + size)] for w, m, _, _ in got[7])
