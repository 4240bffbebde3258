import json

import pytest
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import repair as R
from emberlog.operators import repair as rep

X = F.col("x")
GOOD = {"severity": "SEV-1", "likely_cause": "c", "recommended_action": "a"}
TEXT = json.dumps(GOOD)


def outputs(spark, texts, incident="service: hdfs\nfine"):
    rows = [(i, incident, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "i int, incident_text string, raw_output string").coalesce(1)


def fields(rows):
    return [tuple(r[k] for k in vocab.FIELDS) for r in rows]


def test_normalize(values):
    cases = {"  `a` ": '"a"', "“a” ‘b’": "\"a\" 'b'", "\t\n": ""}
    assert values(list(cases), R.normalize_output(X)) == list(cases.values())
    assert values(["“a” `b` "], R.normalize_output(X, as_written=True)) == ['“a” "b"']
    assert values(['{"a": (b c)}'], R.normalize_output(X, parentheses=True)) == ['{"a": "b c"}']


def test_slice(values):
    cases = {
        "a {b} c {d} e": "{b} c {d}",
        "{a\nb}": "{a\nb}",
        "} x {": "} x {",
        "{ open": "{ open",
        "none": "none",
        "{}": "{}",
    }
    assert values(list(cases), R.slice_braces(X)) == list(cases.values())


JSON_TEXTS = [
    TEXT,
    "{'severity': 1}",
    '{"a": 1}{"b": 2}',
    '{"a": 1} x',
    '{"a": 1}, {"b": 2}',
    '{"a": 1}],[{"b": 2}',
    '{"a": 1,}',
    '{"a": 01}',
    '{"a": "x\ty"}',
    '{"a": "\\q"}',
    "[1]",
    "5",
    '"x"',
    "null",
    "",
    "  ",
    "{a: 1}",
    '{"a": tru}',
    '{"a": {"b": [1, {"c": null}]}}',
    '{"a": "é\\u00e9"}',
    "{}",
    "],[",
    '{"a": 1} // c',
]


def test_object_parse_agrees_with_a_strict_parser(values):
    def strict(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False

    got = values(JSON_TEXTS, R.parse_object(X).isNotNull())
    assert got == [strict(t) for t in JSON_TEXTS]


def test_not_a_number_is_rejected(values):
    assert values(['{"a": NaN}'], R.parse_object(X).isNotNull()) == [False]


TRUTH = ["1", "0", "0.0", "-0", "1.5", "true", "false", "null", '""', '"0"', '" "', "[]", "[0]", "{}", '{"a": 0}', '"false"']


def test_truth_of_json_values(values):
    texts = ['{"k": %s}' % v for v in TRUTH]
    column = R.is_truthy(R.object_entry(R.parse_object(X), "k")["value"])
    got = [bool(v) for v in values(texts, column)]
    assert got == [bool(json.loads(v)) for v in TRUTH]
    assert values(['{"z": 1}'], F.coalesce(column, F.lit(False))) == [False]


def test_last_duplicate_key_wins(spark):
    text = '{"severity": "SEV-3", "severity": "SEV-1", "likely_cause": "c", "recommended_action": "a"}'
    row = rep.parse_and_repair(outputs(spark, [text])).first()
    assert (row.severity, row.n_keys, row.was_repaired) == ("SEV-1", 3, False)


def test_extractors(values):
    severities = {"x sev-3 SEV-1": "SEV-3", "SEV-2": "", "SEV-12": "", "aSEV-1": "", "(Sev-1)": "SEV-1"}
    assert values(list(severities), R.extract_severity(X)) == list(severities.values())
    assert values(["SEV-2"], R.extract_severity(X, ["1", "2", "3"])) == ["SEV-2"]
    causes = {
        "Packet Responder and BLOCK SERVING": vocab.BLOCK_SERVING,
        "packet responder": vocab.PACKET_RESPONDER,
        "packetresponder": "",
    }
    assert values(list(causes), R.extract_cause(X)) == list(causes.values())


ACTIONS = {
    '"recommended_action": "Check it"}': "Check it",
    "recommended_action: (Check it)": "Check it",
    '"Recommended_Action" : ("do this; that")}': "do this; that",
    '"recommended_action": "first line\nsecond"': "first line",
    '"recommended_action": "': "",
    "no key here": "",
}


def test_extract_action(values):
    assert values(list(ACTIONS), R.extract_action(X)) == list(ACTIONS.values())
    cut = '{"severity": "SEV-1", "recommended_action":'
    assert values([cut], R.extract_action(X)) == [""]
    assert values([cut], R.extract_action(X, as_written=True)) == [":"]


def test_clean_value(values):
    cases = {
        ' ("x") ': "x",
        ')"x")': "x",
        '\\"x\\"': "x\\",
        "''x''": "x",
        "x (y)": "x (y",
        ")x": ")x",
        "(( \"x": '"x',
        "": "",
        '""': "",
    }
    assert values(list(cases), R.clean_value(X)) == list(cases.values())


CASES = [
    # raw output, mark, default, blank
    (TEXT, ("SEV-1", "c", "a"), ("SEV-1", "c", "a"), ("SEV-1", "c", "a")),
    ("Answer: " + TEXT + " ok", ("SEV-1", "c", "a"), ("SEV-1", "c", "a"), ("SEV-1", "c", "a")),
    ("", (vocab.UNKNOWN_FIELD,) * 3, ("SEV-3", vocab.DEFAULT_CAUSE, vocab.DEFAULT_ACTION), ("",) * 3),
    (None, (vocab.UNKNOWN_FIELD,) * 3, ("SEV-3", vocab.DEFAULT_CAUSE, vocab.DEFAULT_ACTION), ("",) * 3),
    (
        'sev-1 packet responder "recommended_action": (look)',
        ("SEV-1", vocab.PACKET_RESPONDER, "look"),
        ("SEV-1", vocab.PACKET_RESPONDER, vocab.ACTIONS[vocab.PACKET_RESPONDER]),
        ("SEV-1", vocab.PACKET_RESPONDER, ""),
    ),
    (
        "block serving",
        (vocab.UNKNOWN_FIELD, vocab.BLOCK_SERVING, vocab.ACTIONS[vocab.BLOCK_SERVING]),
        ("SEV-3", vocab.BLOCK_SERVING, vocab.ACTIONS[vocab.BLOCK_SERVING]),
        ("", vocab.BLOCK_SERVING, ""),
    ),
    (
        '{"severity": "SEV-1", "likely_cause": "UNKNOWN", "recommended_action": "a"}',
        ("SEV-1", vocab.UNKNOWN_FIELD, "a"),
        ("SEV-1", vocab.DEFAULT_CAUSE, vocab.DEFAULT_ACTION),
        ("SEV-1", "UNKNOWN", "a"),
    ),
    (
        '{"severity": 0, "likely_cause": "c", "recommended_action": "a"}',
        (vocab.UNKNOWN_FIELD, vocab.UNKNOWN_FIELD, "a"),
        ("SEV-3", vocab.DEFAULT_CAUSE, vocab.DEFAULT_ACTION),
        ("0", "c", "a"),
    ),
]


@pytest.mark.parametrize("at,policy", [(1, "mark"), (2, "default"), (3, "blank")])
def test_policies(spark, at, policy):
    rows = rep.parse_and_repair(outputs(spark, [c[0] for c in CASES]), policy).orderBy("i").collect()
    assert fields(rows) == [c[at] for c in CASES]


def test_flags(spark):
    texts = [TEXT, TEXT[:-1] + ', "note": 1}', "{'x'}", "nothing", '{"severity": "SEV-1"}']
    rows = rep.parse_and_repair(outputs(spark, texts), "mark").orderBy("i").collect()
    assert [r.was_repaired for r in rows] == [False, False, True, True, True]
    assert [r.is_json for r in rows] == [True, True, False, False, True]
    assert [r.n_keys for r in rows] == [3, 4, 3, 3, 3]
    strict = rep.strict_parse(outputs(spark, texts)).orderBy("i").collect()
    assert [r.has_keys for r in strict] == [True, True, False, False, False]
    assert [r.is_valid for r in strict] == [True, True, False, False, False]


def test_curly_quotes(spark):
    curly = TEXT.replace('"', "”")
    assert not rep.parse_and_repair(outputs(spark, [curly])).first().was_repaired
    assert rep.parse_and_repair(outputs(spark, [curly]), as_written=True).first().was_repaired


def test_override(spark):
    forced = ("SEV-1", vocab.BLOCK_SERVING, vocab.ACTIONS[vocab.BLOCK_SERVING])
    right = json.dumps(dict(zip(vocab.FIELDS, forced)))
    hit = outputs(spark, [TEXT, right], "X Got Exception while serving y")
    rows = rep.predict(hit, "mark").orderBy("i").collect()
    assert fields(rows) == [forced, forced]
    assert [r.was_overridden for r in rows] == [True, True]
    assert [r.override_changed for r in rows] == [True, False]
    miss = rep.predict(outputs(spark, [TEXT], None), "mark").first()
    assert (miss.was_overridden, miss.severity) == (False, "SEV-1")


def test_format_status(spark):
    rows = [
        ("SEV-1", "c", "a", False, vocab.STATUS_OK),
        ("SEV-3", "c", "a", True, vocab.STATUS_REPAIRED),
        ("SEV-2", "c", "a", False, vocab.STATUS_BAD_SEVERITY),
        ("SEV-11", "c", "a", False, vocab.STATUS_BAD_SEVERITY),
        ("SEV-2", " ", "a", False, vocab.STATUS_INCOMPLETE),
        ("SEV-1", "c", "UNKNOWN yet", True, vocab.STATUS_INCOMPLETE),
        (None, "", "a", False, vocab.STATUS_MISSING),
    ]
    df = spark.createDataFrame(rows, vocab.LABEL_SCHEMA + ", was_repaired boolean, want string")
    for r in rep.check_format(df).collect():
        assert r.format_status == r.want


def test_triage(spark):
    rows = [
        (0, "fine", TEXT),
        (1, "  \n", TEXT),
        (2, None, "nothing"),
        (3, "fine", "nothing"),
        (4, "got exception while serving", "nothing"),
    ]
    df = spark.createDataFrame(rows, "i int, incident_text string, raw_output string")
    got = [
        (r.severity, r.confidence, r.raw_output) for r in rep.triage(df).orderBy("i").collect()
    ]
    assert got == [
        ("SEV-1", vocab.CONFIDENCE_HIGH, TEXT),
        ("N/A", "N/A", ""),
        ("N/A", "N/A", ""),
        ("SEV-3", vocab.CONFIDENCE_MEDIUM, "nothing"),
        ("SEV-1", vocab.CONFIDENCE_MEDIUM, "nothing"),
    ]
    assert rep.triage(df).where("i = 1").first().recommended_action == vocab.EMPTY_INPUT_HINT


def test_incident_from_prompt(values):
    cases = {
        vocab.PROMPT_HEAD + "a\nb" + vocab.PROMPT_TAIL: "a\nb",
        "bare text": "bare text",
        "Incident:\nx Incident:\ny": "x Incident:\ny",
        "Incident:\nx\n\nSTRICT REQUIREMENTS: 1\n\nSTRICT REQUIREMENTS: 2": "x",
        "x\n\nSTRICT REQUIREMENTS:": "x\n\nSTRICT REQUIREMENTS:",
    }
    assert values(list(cases), R.incident_from_prompt(X)) == list(cases.values())


def test_preview(values):
    head, more = R.preview(X, 2)
    assert values(["a\nb\nc\nd\n", "a", ""], head, more) == [("a\nb", 2), ("a", 0), ("", 0)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 20])
def test_diverse_sample(spark, n):
    causes = ["x", vocab.PACKET_RESPONDER, vocab.PACKET_RESPONDER, "y", vocab.BLOCK_SERVING, "z"]
    df = spark.createDataFrame(list(enumerate(causes)), "ord int, likely_cause string")
    got = [r.ord for r in rep.diverse_sample(df.repartition(3), n, ["ord"]).orderBy("sample_no").collect()]
    assert got == [1, 4, 0, 2, 3, 5][:n]
    only = df.where("ord in (0, 3)")
    assert [r.ord for r in rep.diverse_sample(only, n, ["ord"]).collect()] == [0, 3][:n]
