import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import incidents as I
from emberlog.operators.incidents import build_incidents, dedup_incidents, ingest_funnel
from emberlog.operators.ordinal import line_ordinal
from emberlog.operators.windows import expected_windows, sliding_windows
from emberlog.plans import flows


def positioned(spark, counts, seed=1):
    rng = random.Random(seed)
    rows = [
        (s, p, f"{s} line {rng.randrange(4)}", rng.choice(["INFO", "WARN"]), rng.choice("abc") + ".x")
        for s, n in counts.items()
        for p in range(n)
    ]
    schema = "source string, pos bigint, normalized string, level string, component string"
    return rows, spark.createDataFrame(rows, schema).repartition(5, "normalized")


def expected(rows, size, stride, cap=None):
    """Windows the slow way: slice each source's list."""
    lists = {}
    for source, _, text, _, _ in sorted(rows):
        lists.setdefault(source, []).append(text)
    out = {}
    for source, texts in lists.items():
        starts = range(0, len(texts) - size + 1, stride)
        for win, at in enumerate(list(starts)[:cap] if cap else starts):
            out[(source, win)] = texts[at : at + size]
    return out


@pytest.mark.parametrize(
    "size,stride,cap",
    [(8, 4, None), (8, 8, None), (8, 1, None), (3, 5, None), (1, 1, None), (8, 4, 1), (8, 4, 7),
     (8, 4, 0), (2, 300, None), (300, 7, None), (3, 5, 2), (5, 3, 1000)],
)
def test_windows_match_slicing(spark, size, stride, cap):
    rows, df = positioned(spark, {"hot": 1200, "a": 8, "b": 7, "c": 9, "d": 1, "e": 301})
    got = {
        (r.source, r.win): [m.normalized for m in r.members]
        for r in sliding_windows(df, size, stride, cap).collect()
    }
    assert got == expected(rows, size, stride, cap)


def test_windows_need_valid_sizes(spark):
    _, df = positioned(spark, {"a": 3})
    with pytest.raises(ValueError):
        sliding_windows(df, 0, 1)
    with pytest.raises(ValueError):
        sliding_windows(df, 1, 0)


def test_no_lines_no_windows(spark):
    _, df = positioned(spark, {"a": 3})
    assert sliding_windows(df.where("false")).count() == 0
    assert sliding_windows(df).count() == 0


@pytest.mark.parametrize("span", [1, 7, 100, 1_000_000])
def test_ordinal_is_dense_in_file_order(spark, span):
    rng = random.Random(3)
    rows = []
    for source, n in {"hot": 500, "x": 40, "y": 1}.items():
        rows += [(source, s, "l") for s in rng.sample(range(5000), n)]
    df = spark.createDataFrame(rows, vocab.LINE_SCHEMA).repartition(4)
    want = {}
    for source in {"hot", "x", "y"}:
        for pos, seq in enumerate(sorted(s for o, s, _ in rows if o == source)):
            want[(source, seq)] = pos
    got = {(r.source, r.seq): r.pos for r in line_ordinal(df, span=span).collect()}
    assert got == want


def test_ordinal_by_file_block(spark):
    rows = [("f", b, i, "l") for b in (0, 128, 256) for i in range(b, b + 5)]
    # row numbers restart per scan partition: only the block orders across them
    rows = [(s, b, i if b == 128 else 10_000 - b * 10 + i, l) for s, b, i, l in rows]
    df = spark.createDataFrame(rows, "source string, block bigint, seq bigint, line string")
    got = [(r.block, r.seq) for r in line_ordinal(df).orderBy("pos").collect()]
    assert got == sorted((b, s) for _, b, s, _ in rows)


def test_ordinal_continues_from_starts(spark):
    df = spark.createDataFrame([("a", 5, "x"), ("a", 9, "y"), ("b", 1, "z")], vocab.LINE_SCHEMA)
    starts = spark.createDataFrame([("a", 100)], "source string, start bigint")
    got = {(r.source, r.seq): r.pos for r in line_ordinal(df, starts=starts).collect()}
    assert got == {("a", 5): 100, ("a", 9): 101, ("b", 1): 0}


def members(spark, components, levels=None):
    levels = levels or ["INFO"] * len(components)
    rows = [(i, f"t{i}", lv, c) for i, (c, lv) in enumerate(zip(components, levels))]
    schema = "members array<struct<pos:bigint,normalized:string,level:string,component:string>>"
    return spark.createDataFrame([(rows,)], schema)


def test_ties_go_to_the_first_seen(spark):
    df = members(spark, "baabc", ["WARN", "INFO", "WARN", "ERROR", "INFO"])
    m = F.col("members")
    row = df.select(
        I.majority_component(m).alias("top"),
        I.top_components(m).alias("three"),
        F.map_keys(I.top_components(m)).alias("ranked"),
        I.levels_count(m).alias("levels"),
    ).first()
    assert row.top == "b"
    assert row.three == {"b": 2, "a": 2, "c": 1}
    assert row.ranked == ["b", "a", "c"]
    assert row.levels == {"WARN": 2, "INFO": 2, "ERROR": 1}
    four = members(spark, "dcbaa").select(I.top_components(m)).first()[0]
    assert four == {"a": 2, "d": 1, "c": 1}


def test_incident_content_and_dedup(spark):
    rows, df = positioned(spark, {"a": 30, "b": 30})
    same = df.withColumn("normalized", F.lit("same")).withColumn("component", F.lit("datanode.x"))
    found = build_incidents(sliding_windows(same), dedup=False)
    assert found.count() == 12
    first = dedup_incidents(found).collect()
    assert [(r.source, r.win) for r in first] == [("a", 0)]
    assert first[0].lines == ["same"] * 8
    text = "service: hdfs-datanode\n" + "\n".join(["same"] * 8)
    assert first[0].incident_text == text
    assert first[0].incident_id == hashlib.sha1(text.encode()).hexdigest()[:12]
    assert [tuple(r) for r in build_incidents(sliding_windows(same)).collect()] == [
        tuple(first[0])
    ]

    every = build_incidents(sliding_windows(df), dedup=False).collect()
    source = {(s, p): (lv, c) for s, p, _, lv, c in rows}
    for r in every:
        span = [source[(r.source, p)] for p in range(r.win * 4, r.win * 4 + 8)]
        assert r.stats.levels_count == Counter(lv for lv, _ in span)
        assert r.stats.top_components == dict(Counter(c for _, c in span).most_common(3))


def test_partitioning_does_not_change_incidents(spark):
    rows = [
        ("s%d" % (i % 3), i, f"WARN dfs.DataNode: event {i % 5} slow") for i in range(300)
    ]
    lines = spark.createDataFrame(rows, vocab.LINE_SCHEMA)

    def ids(df):
        return sorted(
            (r.source, r.win, r.incident_id) for r in flows.lines_to_incidents(df).collect()
        )

    assert ids(lines.coalesce(1)) == ids(lines.repartition(7, "line")) != []


def test_funnel_counts(spark):
    rows = [("a", i, "WARN x.y same") for i in range(16)] + [("b", 0, ""), ("b", 1, "INFO ok")]
    lines = spark.createDataFrame(rows, vocab.LINE_SCHEMA)
    got = dict(
        tuple(r) for r in ingest_funnel(lines, flows.lines_to_windows(lines)).collect()
    )
    assert got == {
        "total_lines": 18, "informative_lines": 16, "expected_windows": 3, "windows": 3,
        "unique_ids": 1, "duplicates_removed": 2,
    }
    empty = lines.where("false")
    got = dict(tuple(r) for r in ingest_funnel(empty, flows.lines_to_windows(empty)).collect())
    assert set(got.values()) == {0}


def test_expected_windows_never_negative(spark):
    n = F.col("id")
    got = [r[0] for r in spark.range(0, 14).select(expected_windows(n)).collect()]
    assert got == [max(0, (k - 8) // 4 + 1) for k in range(14)]
    assert spark.range(391, 392).select(expected_windows(n)).first()[0] == 96
    assert spark.range(391, 392).select(expected_windows(n, 8, 8)).first()[0] == 48
    assert spark.range(391, 392).select(expected_windows(n, 3, 5)).first()[0] == 78


def test_null_sources_keep_their_lines_and_null_orders_are_an_error(spark):
    import pytest as _pytest

    from emberlog.operators.ordinal import line_ordinal as ordinal

    rows = [(None, i, "a") for i in range(20)] + [("s", i, "b") for i in range(20)]
    placed = ordinal(spark.createDataFrame(rows, "source string, seq bigint, line string"))
    found = sorted((r.source or "", r.pos) for r in placed.collect())
    assert found == [("", i) for i in range(20)] + [("s", i) for i in range(20)]
    with _pytest.raises(Exception, match="null in the order columns"):
        ordinal(spark.createDataFrame([("s", None, "a")], "source string, seq bigint, line string")).collect()
