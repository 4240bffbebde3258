from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import lines as L
from emberlog.operators.lines import dry_run_sample, informative_lines

X = F.col("x")

PARSED = [
    # line, level, component, message
    ("", "INFO", "unknown", ""),
    ("081109 203615 148 INFO dfs.DataNode$PacketResponder: Packet 1 terminating", "INFO",
     "dfs.DataNode", "dfs.DataNode$PacketResponder: Packet 1 terminating"),
    ("nothing to see", "INFO", "unknown", "nothing to see"),
    ("WARNING a.b c", "INFO", "a.b", "WARNING a.b c"),
    ("ERROR::: a.b fail", "ERROR", "a.b", "a.b fail"),
    ("ERROR : : x", "ERROR", "unknown", ": x"),
    ("10.250.1.2 WARN dfs.FSNamesystem: slow", "WARN", "10.250", "dfs.FSNamesystem: slow"),
    ("xINFO INFOx DEBUG done", "DEBUG", "unknown", "done"),
    ("FATAL", "FATAL", "unknown", ""),
    ("  WARN : é.ü out  ", "WARN", "é.ü", "é.ü out"),
    ("warn lower a..b c.d", "INFO", "c.d", "warn lower a..b c.d"),
    ("INFO first ERROR second", "INFO", "unknown", "first ERROR second"),
]


def test_parse(values):
    got = values(
        [r[0] for r in PARSED],
        L.parse_level(L.strip(X)), L.parse_component(L.strip(X)), L.parse_message(L.strip(X)),
    )
    assert got == [r[1:] for r in PARSED]


def test_strip_follows_text_white_space(values):
    texts = ["\t a \x1c", " 　b\x85", "c", "   ", "​d"]
    assert values(texts, L.strip(X)) == [t.strip() for t in texts]


def test_normalize(values):
    cases = {
        "081109 203615 148 INFO dfs.X: got BLK_-12 from 10.0.0.1:50 to /10.0.0.2 size 91":
            "info dfs.x: got blk_<ID> from <IP:PORT> to /<IP> size <SIZE>",
        "a  b\t\tc d ": "a b c d",
        "1.2.3.4.5:80": "1.<IP:PORT>",
        "1.2.3.4:50x": "<IP>:50x",
        "resize 5 size  7 size 8x size 9": "resize 5 size <SIZE> size 8x size <SIZE>",
        "12345 203615 148 x": "12345 203615 148 x",
        "x 081109 203615 148 y": "x 081109 203615 148 y",
        "é1.2.3.4": "é1.2.3.4",
        "999.999.999.999": "<IP>",
    }
    assert values(list(cases), L.normalize_text(X)) == list(cases.values())


def test_informative_looks_at_the_message_only(values):
    cases = {
        "INFO all fine": False,
        "INFO Slow disk": True,
        "retry before INFO fine": False,
        "retry without level": True,
        "WARN fine": True,
        "ERROR": True,
        "FATAL x": True,
        "DEBUG x": False,
        "WARNING fine": False,
        "INFO flag set": True,
        "": False,
    }
    assert values(list(cases), L.is_informative(X)) == list(cases.values())
    for keyword in vocab.INFORMATIVE_KEYWORDS:
        assert values([f"INFO x{keyword.upper()}y"], L.is_informative(X)) == [True]


def test_service(values):
    cases = {
        "dfs.DataNode": "hdfs-datanode",
        "dfs.NameNode": "hdfs-namenode",
        "dfs.FSNamesystem": "hdfs-namenode",
        "a.b": "hdfs",
        "unknown": "hdfs",
    }
    assert values(list(cases), L.infer_service(X)) == list(cases.values())


def test_dry_run_sample_is_the_head(spark):
    rows = [("s", i, "WARN line" if i % 2 else "INFO ok") for i in range(40)]
    lines = spark.createDataFrame(rows, vocab.LINE_SCHEMA).repartition(4)
    got = [r.seq for r in dry_run_sample(lines).collect()]
    assert got == [1, 3, 5, 7, 9]
    assert informative_lines(lines).count() == 20
