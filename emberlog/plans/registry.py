"""Every operator as a query over the given tables, next to the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import incidents as I
from emberlog.functions import labels as B
from emberlog.functions import lines as L
from emberlog.functions import repair as R
from emberlog.operators import evaluation as E
from emberlog.operators import experiments as X
from emberlog.operators import incidents as inc
from emberlog.operators import labelling, model, splits
from emberlog.operators import lines as lin
from emberlog.operators import repair as rep
from emberlog.operators.labelling import parse_response
from emberlog.operators.ordinal import global_ordinal, line_ordinal
from emberlog.operators.windows import expected_windows, sliding_windows
from emberlog.plans import flows
from emberlog.plans import oracles as Q
from emberlog.session import pin, stage_path
from emberlog.sources import files, rendered
from emberlog.streaming import lines as stream_ops
from emberlog.streaming import windows as stream_win

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *deps: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = Q.with_sql(sql, *deps)
        return fn

    return add


# --- shared inputs -----------------------------------------------------------
def log_lines(spark, sf):
    return rendered.log_lines(spark, sf)


def all_lines(spark, sf):
    """Rendered log lines and all document lines."""

    def tagged(df, tag):
        return df.select(F.concat(F.lit(tag), "source").alias("source"), "seq", "line")

    logs = tagged(rendered.log_lines(spark, sf), "log-")
    return logs.unionByName(tagged(rendered.document_lines(spark, sf), "doc-"))


def positioned(spark, sf):
    return flows.positioned_lines(log_lines(spark, sf))


def windows(spark, sf):
    return sliding_windows(positioned(spark, sf))


def all_incidents(spark, sf):
    return inc.build_incidents(windows(spark, sf), dedup=False)


def incidents(spark, sf):
    return inc.build_incidents(windows(spark, sf))


def labelled(spark, sf):
    return labelling.label_incidents(incidents(spark, sf))


def split_rows(spark, sf):
    """Labelled incidents are pinned first, as the splitter passes over them several times."""
    return splits.stratified_split(pin(labelled(spark, sf), "labelled"))


def outputs(spark, sf):
    return rendered.model_outputs(labelling.label_incidents(all_incidents(spark, sf)))


def scored(spark, sf):
    return flows.outputs_to_scores(outputs(spark, sf))


def tuning_runs(spark, sf):
    return rendered.tuning_runs(split_rows(spark, sf))


OUT = ["example_id", "run"]


# --- flagship ----------------------------------------------------------------
@query(
    "triage_by_host",
    """SELECT source, service, severity, likely_cause, recommended_action, count(*) AS incidents,
         min(win) AS first_window, max(win) AS last_window
       FROM labelled GROUP BY ALL""",
    "labelled",
)
def _(spark, sf):
    return flows.triage_by_host(log_lines(spark, sf))


# --- sources and sinks -------------------------------------------------------
@query("read_log_lines", "SELECT line FROM log_lines", "log_lines")
def _(spark, sf):
    path = stage_path(spark, "text")
    log_lines(spark, sf).select("line").write.text(path)
    return files.read_log_lines(spark, path).select("line")


@query(
    "numbered_lines",
    """SELECT row_number() OVER (ORDER BY seq) - 1 AS pos,
         row_number() OVER (PARTITION BY part ORDER BY seq) - 1 AS line_no, line
       FROM (SELECT *, (seq - min(seq) OVER ()) * 5 // (max(seq) OVER () - min(seq) OVER () + 1) AS part FROM log_lines)""",
    "log_lines",
)
def _(spark, sf):
    """Line numbers over five folders of files, read in small blocks."""
    path, size = _line_files(spark, sf)
    with _small_blocks(spark, size):
        return files.numbered_lines(spark, f"{path}/*", by="folder").select("pos", "line_no", "line")


@query(
    "line_ordinal_global",
    "SELECT row_number() OVER (ORDER BY seq) - 1 AS pos, normalized FROM kept",
    "kept",
)
def _(spark, sf):
    """One sequence of informative lines over five folders of files, without any key. Only what is ranked is stored and
    shuffled, so that the counts and the ranks share one exchange."""
    path, size = _line_files(spark, sf)
    with _small_blocks(spark, size):
        kept = lin.informative_lines(files.read_log_lines(spark, f"{path}/*", by="folder"))
        kept = pin(kept.select("source", "block", "seq", "normalized"), "informative")
    return global_ordinal(kept).select("pos", "normalized")


@contextmanager
def _small_blocks(spark, size: int):
    """Text scans in some 256 blocks, as large files are cut into many: of 64 KB at least, of 128 MB at most."""
    block = min(max(size // 256, 64 << 10), 128 << 20)
    conf = {"spark.sql.files.maxPartitionBytes": f"{block}b", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _line_files(spark, sf, parts: int = 5) -> tuple[str, int]:
    """The log lines in order, dealt to folders ``a`` to ``e`` of text files that follow one another by name; and their bytes."""
    path = stage_path(spark, "text")
    lines = pin(log_lines(spark, sf).select("seq", "line"), "lines")
    low, high, size = lines.agg(F.min("seq"), F.max("seq"), F.sum(F.octet_length("line") + 1)).first()
    part = F.floor((F.col("seq") - low) * parts / (high - low + 1))
    named = lines.withColumn("part", F.substring(F.lit("abcde"), (part + 1).cast("int"), F.lit(1))).where(F.col("seq").isNotNull())
    # each task writes a range of the lines; its number begins the name of its files
    ordered = named.repartitionByRange("seq").sortWithinPartitions("part", "seq").select("part", "line")
    ordered.write.partitionBy("part").text(path)
    return path, size


def _source_folders(spark, sf) -> str:
    """The log lines as text, a folder of several numbered files per source, with a blank line before every tenth."""
    path = stage_path(spark, "text")
    lines = log_lines(spark, sf).select("source", "seq", "line")
    blank = lines.where(F.pmod("seq", F.lit(10)) == 0).withColumn("line", F.lit(""))
    both = lines.withColumn("_n", F.lit(1)).unionByName(blank.withColumn("_n", F.lit(0)))
    # ranges of (source, seq): a source may be spread over many tasks, and its files follow one another by name
    ordered = both.repartitionByRange(12, "source", "seq", "_n").sortWithinPartitions("source", "seq", "_n")
    ordered.select("source", F.col("line").alias("value")).write.partitionBy("source").text(path)
    return f"{path}/source=*"


@query(
    "files_to_windows",
    """SELECT source, win, string_agg(normalized, '|' ORDER BY pos) AS body FROM wl GROUP BY source, win""",
    "wl",
)
def _(spark, sf):
    """Windows of text files, with a folder of several files per source."""
    lines = files.read_log_lines(spark, _source_folders(spark, sf), by="folder")
    kept = pin(lin.informative_lines(lines), "informative")
    found = sliding_windows(line_ordinal(kept))
    source = F.regexp_extract("source", "source=([^/]+)$", 1)
    return found.select(source.alias("source"), "win", F.array_join("members.normalized", "|").alias("body"))


@query(
    "files_to_incidents",
    "SELECT source, win, incident_id, service FROM incidents",
    "incidents",
)
def _(spark, sf):
    """Text files, a folder of several files per source, to incidents."""
    found, _ = flows.files_to_incidents(spark, _source_folders(spark, sf), by="folder")
    source = F.regexp_extract("source", "source=([^/]+)$", 1)
    return found.select(source.alias("source"), "win", "incident_id", "service")


@query(
    "broken_json_lines",
    """SELECT incident_id, incident_text, NULL AS broken FROM labelled
       UNION ALL SELECT NULL, NULL, substr(response, 1, len(response) - 1) FROM labelled
       UNION ALL SELECT NULL, NULL, response || ' ' || response FROM labelled WHERE severity = 'SEV-1'""",
    "labelled",
)
def _(spark, sf):
    """Files with broken lines among the good ones: the good rows, the quarantine, and the numbers observed."""
    path = stage_path(spark, "mixed")
    good = pin(labelled(spark, sf), "labelled")
    line = F.to_json(F.struct("incident_id", "incident_text"))
    cut = F.expr("substr(response, 1, length(response) - 1)")
    twice = F.concat("response", F.lit(" "), "response")
    lines = good.select(line.alias("value")).unionByName(good.select(cut.alias("value")))
    lines = lines.unionByName(good.where("severity = 'SEV-1'").select(twice.alias("value")))
    lines.unionByName(spark.createDataFrame([("",), ("  ",)], "value string")).write.text(path)
    schema, counts = "incident_id string, incident_text string", Observation("json")
    read = pin(files.read_json_lines(spark, path, schema, broken="drop", counts=counts), "read")
    away = files.broken_lines(spark, path, schema).select(F.col("line").alias("broken"))
    if counts.get["lines"] - counts.get["broken"] != read.count() or counts.get["broken"] != away.count():
        raise RuntimeError("the numbers observed differ from the rows")
    return read.unionByName(away, allowMissingColumns=True)


@query("rewritten_splits", "SELECT split, prompt, response FROM splits", "splits")
def _(spark, sf):
    """Splits written to one place again and again: two of them, all, and one alone."""
    path = stage_path(spark, "splits")
    rows = pin(split_rows(spark, sf), "splits")
    files.write_splits(rows.where("split != 'val'"), path)
    files.write_splits(rows, path)
    files.write_splits(rows.where("split = 'val'"), path, only_given=True)
    return files.read_splits(spark, path).select("split", "prompt", "response")


@query(
    "incidents_json",
    """SELECT incident_id, service, incident_text, warn AS warn_lines, 8 AS n_lines FROM incidents""",
    "incidents",
)
def _(spark, sf):
    path = stage_path(spark, "incidents")
    files.write_incidents(incidents(spark, sf), path)
    return files.read_incidents(spark, path).select(
        "incident_id",
        "service",
        "incident_text",
        F.coalesce(F.try_element_at("stats.levels_count", F.lit("WARN")), F.lit(0)).alias(
            "warn_lines"
        ),
        F.size("lines").alias("n_lines"),
    )


@query("pairs_json", "SELECT prompt, response FROM labelled", "labelled")
def _(spark, sf):
    path = stage_path(spark, "pairs")
    labelled(spark, sf).select("prompt", "response").write.json(path)
    return files.read_pairs(spark, path)


@query("splits_json", "SELECT split, prompt, response FROM splits", "splits")
def _(spark, sf):
    path = stage_path(spark, "splits")
    files.write_splits(split_rows(spark, sf), path)
    return files.read_splits(spark, path).select("split", "prompt", "response")


@query(
    "report_json",
    """SELECT run, count(*) AS test_samples,
         (count(*) FILTER (severity_ok) / count(*)) * 100 AS severity_accuracy,
         (count(*) FILTER (exact) / count(*)) * 100 AS exact_match_accuracy,
         (count(*) FILTER (NOT is_json) / count(*)) * 100 AS repair_rate,
         (count(*) FILTER (override_changed) / count(*)) * 100 AS override_rate,
         count(*) FILTER (true_severity = 'SEV-3' AND severity = 'SEV-1') AS sev3_as_sev1
       FROM scored GROUP BY run""",
    "scored",
)
def _(spark, sf):
    path = stage_path(spark, "report")
    report = E.evaluation_report(scored(spark, sf))
    files.write_report(report, path)
    return spark.read.schema(report.schema).json(path).select(
        "run",
        "test_samples",
        "metrics.severity_accuracy",
        "metrics.exact_match_accuracy",
        "inference_stats.repair_rate",
        F.col("inference_stats.heuristic_override_rate").alias("override_rate"),
        F.col("confusion_matrix.SEV-3.SEV-1").alias("sev3_as_sev1"),
    )


_RATES = {
    "severity_accuracy": "severity_ok", "likely_cause_accuracy": "cause_ok", "recommended_action_accuracy": "action_ok",
    "exact_match_accuracy": "exact", "valid_json_rate": "filled", "repair_rate": "NOT is_json",
    "heuristic_override_rate": "override_changed",
}
_CELLS = [(t, p) for t in ("SEV-1", "SEV-3") for p in ("SEV-1", "SEV-3")]


@query(
    "report_json_whole",
    " UNION ALL ".join(
        [f"SELECT run, '{name}' AS name, (count(*) FILTER ({test}) / count(*)) * 100 AS value FROM scored GROUP BY run"
         for name, test in _RATES.items()]
        + [f"SELECT run, '{t} as {p}', count(*) FILTER (true_severity = '{t}' AND severity = '{p}') FROM scored GROUP BY run"
           for t, p in _CELLS]
        + ["SELECT run, 'test_samples', count(*) FROM scored GROUP BY run"]
        + [f"SELECT run, true_cause || ' {what}', {value} FROM scored GROUP BY run, true_cause"
           for what, value in (("total", "count(*)"), ("correct", "count(*) FILTER (cause_ok)"),
                               ("accuracy", "(count(*) FILTER (cause_ok) / count(*)) * 100"))]
    ),
    "scored",
)
def _(spark, sf):
    """Every value of the written report, one row each: rates, all four cells, and the causes."""
    path = stage_path(spark, "report")
    report = E.evaluation_report(pin(scored(spark, sf), "scored"))
    files.write_report(report, path)
    back = spark.read.schema(report.schema).json(path)
    value = lambda name, column: F.struct(F.lit(name).alias("name"), F.col(column).cast("double").alias("value"))
    plain = [value("test_samples", "test_samples"), *[value(f"{t} as {p}", f"confusion_matrix.`{t}`.`{p}`") for t, p in _CELLS]]
    for part in ("metrics", "inference_stats"):
        plain += [value(f.name, f"{part}.{f.name}") for f in report.schema[part].dataType.fields]
    cause = F.col("by_likely_cause")

    def of_causes(what: str):
        named = lambda e: F.struct(F.concat(e["key"], F.lit(f" {what}")).alias("name"), e["value"][what].cast("double").alias("value"))
        return F.transform(F.map_entries(cause), named)

    causes = [of_causes(what) for what in ("total", "correct", "accuracy")]
    return back.select("run", F.inline(F.concat(F.array(*plain), *causes)))


@query(
    "experiments_json_best",
    """SELECT 'best_only' AS mode, config_name AS config, val_loss, epochs
       FROM runs ORDER BY runs.val_loss, ord LIMIT 1""",
    "runs",
)
def _(spark, sf):
    path = stage_path(spark, "experiments")
    files.write_experiments(X.only_best(tuning_runs(spark, sf)), path, best_only=True)
    schema = "mode string, experiment struct<val_loss: double, epochs: int>, config string"
    return spark.read.schema(schema).json(path).select("mode", "config", "experiment.val_loss", "experiment.epochs")


@query(
    "experiments_json",
    """SELECT config_name, val_loss, (SELECT config_name FROM runs ORDER BY val_loss, ord LIMIT 1)
         AS best_config FROM runs""",
    "runs",
)
def _(spark, sf):
    path = stage_path(spark, "experiments")
    files.write_experiments(pin(tuning_runs(spark, sf), "runs"), path)
    schema = (
        "experiments array<struct<config_name: string, val_loss: double>>, best_config string"
    )
    return spark.read.schema(schema).json(path).select("best_config", F.inline("experiments"))


# --- lines -------------------------------------------------------------------
@query("parse_level", "SELECT source, seq, level FROM parsed", "parsed")
def _(spark, sf):
    return log_lines(spark, sf).select("source", "seq", L.parse_level(F.col("line")).alias("level"))


@query("parse_component", "SELECT source, seq, component FROM parsed", "parsed")
def _(spark, sf):
    column = L.parse_component(F.col("line")).alias("component")
    return log_lines(spark, sf).select("source", "seq", column)


@query("parse_message", "SELECT source, seq, message FROM parsed", "parsed")
def _(spark, sf):
    column = L.parse_message(F.col("line")).alias("message")
    return log_lines(spark, sf).select("source", "seq", column)


def _mask_query(name: str, column: Callable) -> None:
    """Masks look at lower-cased text, as in the composed normaliser."""
    low = Q.MASKS["lowercase"]("line")
    sql = low if name == "lowercase" else Q.MASKS[name](low)

    @query(name, f"SELECT source, seq, {sql} AS text FROM all_lines", "all_lines")
    def _(spark, sf):
        lowered = L.lowercase(F.col("line"))
        text = lowered if name == "lowercase" else column(lowered)
        return all_lines(spark, sf).select("source", "seq", text.alias("text"))


for _mask in Q.MASKS:
    _mask_query(_mask, getattr(L, _mask))


@query(
    "normalize_text",
    f"SELECT source, seq, {Q.normalized('line')} AS text FROM all_lines",
    "all_lines",
)
def _(spark, sf):
    text = L.normalize_text(F.col("line")).alias("text")
    return all_lines(spark, sf).select("source", "seq", text)


@query("is_informative", "SELECT source, seq, level, normalized FROM kept", "kept")
def _(spark, sf):
    return lin.informative_lines(log_lines(spark, sf)).select(
        "source", "seq", "level", "normalized"
    )


@query(
    "infer_service",
    f"SELECT source, seq, {Q.service('component')} AS service FROM parsed",
    "parsed",
)
def _(spark, sf):
    column = L.infer_service(L.parse_component(F.col("line"))).alias("service")
    return log_lines(spark, sf).select("source", "seq", column)


# --- windows and incidents ---------------------------------------------------
@query("line_ordinal", "SELECT source, seq, pos FROM kept", "kept")
def _(spark, sf):
    return positioned(spark, sf).select("source", "seq", "pos")


def _window_query(name: str, table: str, **params) -> None:
    where = f" WHERE win < {params['cap']}" if "cap" in params else ""

    @query(
        name,
        f"""SELECT source, win, count(*) AS n_lines, min(pos) AS first_pos, max(pos) AS last_pos,
              string_agg(normalized, '|' ORDER BY pos) AS body
            FROM {table}{where} GROUP BY source, win""",
        table,
    )
    def _(spark, sf):
        lines = positioned(spark, sf)
        # carry the original position along: gaps renumber ``pos``
        found = sliding_windows(
            lines.withColumn("at", F.col("pos")), fields=("pos", "at", "normalized"), **params
        )
        return found.select(
            "source",
            "win",
            F.size("members").cast("bigint").alias("n_lines"),
            F.array_min("members.at").alias("first_pos"),
            F.array_max("members.at").alias("last_pos"),
            F.array_join("members.normalized", "|").alias("body"),
        )


_window_query("sliding_windows", "wl")
_window_query("sliding_windows_gap", "wl_gap", size=3, stride=5)
_window_query("sliding_windows_dense", "wl_dense", size=8, stride=1)
_window_query("max_incidents", "wl", cap=20)


@query(
    "majority_component",
    "SELECT source, win, component FROM comp_rank WHERE place = 1",
    "comp_rank",
)
def _(spark, sf):
    component = I.majority_component(F.col("members")).alias("component")
    return windows(spark, sf).select("source", "win", component)


@query(
    "levels_count",
    "SELECT source, win, level, count(*) AS n FROM wl GROUP BY source, win, level",
    "wl",
)
def _(spark, sf):
    return windows(spark, sf).select(
        "source", "win", F.explode(I.levels_count(F.col("members"))).alias("level", "n")
    )


@query(
    "top_components",
    "SELECT source, win, component, n FROM comp_rank WHERE place <= 3",
    "comp_rank",
)
def _(spark, sf):
    return windows(spark, sf).select(
        "source", "win", F.explode(I.top_components(F.col("members"))).alias("component", "n")
    )


@query("incident_text", "SELECT source, win, incident_text FROM windows", "windows")
def _(spark, sf):
    return all_incidents(spark, sf).select("source", "win", "incident_text")


@query("incident_id", "SELECT source, win, service, incident_id FROM windows", "windows")
def _(spark, sf):
    return inc.identify_windows(windows(spark, sf)).select(
        "source", "win", "service", "incident_id"
    )


@query(
    "dedup_incidents",
    "SELECT source, win, incident_id, service, incident_text FROM incidents",
    "incidents",
)
def _(spark, sf):
    return inc.dedup_incidents(all_incidents(spark, sf)).select(
        "source", "win", "incident_id", "service", "incident_text"
    )


@query(
    "ingest_funnel",
    """SELECT 'total_lines' AS metric, count(*) AS value FROM log_lines
       UNION ALL SELECT 'informative_lines', count(*) FROM kept
       UNION ALL SELECT 'expected_windows', CAST(sum(greatest(0, (n - 8) // 4 + 1)) AS BIGINT)
         FROM (SELECT count(*) AS n FROM kept GROUP BY source)
       UNION ALL SELECT 'windows', count(*) FROM windows
       UNION ALL SELECT 'unique_ids', count(DISTINCT incident_id) FROM windows
       UNION ALL SELECT 'duplicates_removed', count(*) - count(DISTINCT incident_id) FROM windows""",
    "windows",
)
def _(spark, sf):
    return inc.ingest_funnel(log_lines(spark, sf), windows(spark, sf))


@query(
    "expected_windows",
    """SELECT source, greatest(0, (count(*) - 8) // 4 + 1) AS windows,
         least(20, greatest(0, (count(*) - 8) // 4 + 1)) AS capped FROM kept GROUP BY source""",
    "kept",
)
def _(spark, sf):
    n = F.count(F.lit(1))
    return (
        lin.keep_informative(log_lines(spark, sf))
        .groupBy("source")
        .agg(
            expected_windows(n).alias("windows"),
            expected_windows(n, cap=20).cast("bigint").alias("capped"),
        )
    )


@query(
    "dry_run_sample",
    """SELECT source, seq, level, component, normalized FROM kept ORDER BY source, seq LIMIT 5""",
    "kept",
)
def _(spark, sf):
    return lin.dry_run_sample(log_lines(spark, sf))


# --- labels ------------------------------------------------------------------
@query("assign_severity", "SELECT source, win, severity FROM all_labelled", "all_labelled")
def _(spark, sf):
    column = B.severity(F.col("incident_text"), F.col("stats.levels_count")).alias("severity")
    return all_incidents(spark, sf).select("source", "win", column)


@query("assign_likely_cause", "SELECT source, win, likely_cause FROM all_labelled", "all_labelled")
def _(spark, sf):
    column = B.likely_cause(F.col("incident_text")).alias("likely_cause")
    return all_incidents(spark, sf).select("source", "win", column)


@query(
    "assign_recommended_action",
    "SELECT source, win, likely_cause, recommended_action FROM all_labelled",
    "all_labelled",
)
def _(spark, sf):
    causes = all_incidents(spark, sf).select(
        "source", "win", B.likely_cause(F.col("incident_text")).alias("likely_cause")
    )
    return labelling.assign_recommended_action(causes)


@query("format_prompt", "SELECT source, win, prompt FROM all_labelled", "all_labelled")
def _(spark, sf):
    column = B.format_prompt(F.col("incident_text")).alias("prompt")
    return all_incidents(spark, sf).select("source", "win", column)


@query("response_json", "SELECT source, win, response FROM all_labelled", "all_labelled")
def _(spark, sf):
    return labelling.label_incidents(all_incidents(spark, sf)).select("source", "win", "response")


@query(
    "label_incidents",
    """SELECT incident_id, severity, likely_cause, recommended_action, prompt, response
       FROM labelled""",
    "labelled",
)
def _(spark, sf):
    return labelled(spark, sf).select("incident_id", *vocab.FIELDS, "prompt", "response")


@query(
    "validate_pairs",
    """SELECT count(*) AS pairs, count(*) FILTER (NOT json_valid(response)) AS bad_json,
         count(*) FILTER (json_extract_string(response, '$.severity') IS NULL
           OR json_extract_string(response, '$.likely_cause') IS NULL
           OR json_extract_string(response, '$.recommended_action') IS NULL) AS missing_keys,
         count(*) FILTER (NOT starts_with(json_extract_string(response, '$.severity'), 'SEV-'))
           AS bad_severity,
         count(*) FILTER (NOT contains(prompt, '"severity": ""')) AS missing_template
       FROM labelled""",
    "labelled",
)
def _(spark, sf):
    return labelling.validate_pairs(labelled(spark, sf))


@query(
    "validation_sample",
    """SELECT prompt, response FROM labelled
       ORDER BY sha1(concat('42|', prompt, '|', response)) LIMIT 5""",
    "labelled",
)
def _(spark, sf):
    return labelling.validation_sample(labelled(spark, sf).select("prompt", "response"))


@query(
    "label_distribution",
    """SELECT label_kind, label, n, n / sum(n) OVER (PARTITION BY label_kind) * 100 AS pct FROM (
         SELECT 'severity' AS label_kind, severity AS label, count(*) AS n
         FROM labelled GROUP BY severity
         UNION ALL SELECT 'likely_cause', likely_cause, count(*)
         FROM labelled GROUP BY likely_cause)""",
    "labelled",
)
def _(spark, sf):
    return labelling.label_distribution(labelled(spark, sf))


# --- splits ------------------------------------------------------------------
@query("stratified_split", "SELECT incident_id, severity, split FROM splits", "splits")
def _(spark, sf):
    return split_rows(spark, sf).select("incident_id", "severity", "split")


@query(
    "split_stats",
    "SELECT split, severity, count(*) AS n FROM splits GROUP BY ROLLUP (split, severity)",
    "splits",
)
def _(spark, sf):
    return splits.split_stats(split_rows(spark, sf))


@query(
    "split_leakage",
    """SELECT count(*) AS distinct_texts, count(*) FILTER (s > 1) AS leaked_texts,
         CAST(coalesce(sum(n) FILTER (s > 1), 0) AS BIGINT) AS leaked_rows
       FROM (SELECT prompt, count(*) AS n, count(DISTINCT split) AS s FROM all_splits GROUP BY prompt)""",
    "all_splits",
)
def _(spark, sf):
    every = pin(labelling.label_incidents(all_incidents(spark, sf)), "labelled")
    return splits.split_leakage(splits.stratified_split(every))


@query(
    "shuffle_rows",
    """SELECT split, incident_id, row_number() OVER (PARTITION BY split
         ORDER BY sha1(concat('43|', source, '|', win, '|', incident_id))) - 1 AS shuffle_pos
       FROM splits""",
    "splits",
)
def _(spark, sf):
    return splits.shuffle_rows(split_rows(spark, sf)).select("split", "incident_id", "shuffle_pos")


@query(
    "append_target_newline", "SELECT incident_id, response || chr(10) AS response FROM labelled",
    "labelled",
)
def _(spark, sf):
    return splits.append_target_newline(labelled(spark, sf)).select("incident_id", "response")


def _tokens(x: str) -> str:
    text = Q.strip(x)
    return f"CASE WHEN {text} = '' THEN [] ELSE string_split_regex({text}, '{Q.SPACE}+') END"



@query(
    "length_audit",
    f"""SELECT split, field, count(*) AS n, max(k) AS max_tokens, CAST(quantile_disc(k, 0.5) AS DOUBLE) AS p50,
          CAST(quantile_disc(k, 0.95) AS DOUBLE) AS p95, count(*) FILTER (k > budget) AS over_budget
        FROM (SELECT split, 'prompt' AS field, 40 AS budget,
                len({_tokens('prompt')}) AS k FROM splits
              UNION ALL SELECT split, 'response', 256,
                len({_tokens('response')}) FROM splits)
        GROUP BY split, field""",
    "splits",
)
def _(spark, sf):
    return splits.length_audit(split_rows(spark, sf), prompt_budget=40)


@query(
    "length_sketches",
    f"""SELECT split, field, count(*) AS n, max(k) AS max_tokens, count(*) FILTER (k > budget) AS over_budget,
          true AS p50_close, true AS p95_close
        FROM (SELECT split, 'prompt' AS field, 40 AS budget,
                len({_tokens('prompt')}) AS k FROM splits
              UNION ALL SELECT split, 'response', 256,
                len({_tokens('response')}) FROM splits)
        GROUP BY split, field""",
    "splits",
)
def _(spark, sf):
    """Audits of sixteen parts, stored, merged and read: how far the ranks of their percentiles are off."""
    rows = pin(split_rows(spark, sf), "splits").withColumn("part", F.pmod(F.crc32("incident_id"), F.lit(16)))
    stored = pin(splits.length_sketches(rows, prompt_budget=40, by=("split", "part")), "sketches")
    merged = splits.sketched_percentiles(splits.merge_sketches(stored))
    lengths = splits.token_lengths(rows, 40, 256, "split").select("split", "field", "n_tokens")
    error = splits.RANK_ERROR

    def close(p: str, share: float):
        below, upto = F.avg((F.col("n_tokens") < F.col(p)).cast("int")), F.avg((F.col("n_tokens") <= F.col(p)).cast("int"))
        return ((below <= share + error) & (upto >= share - error)).alias(f"{p}_close")

    return (
        lengths.join(merged, ["split", "field"]).groupBy("split", "field", "n", "max_tokens", "over_budget")
        .agg(close("p50", 0.5), close("p95", 0.95))
    )


@query(
    "truncate_to_budget",
    f"""SELECT doc_id, len(t) AS n_tokens, len(t) > 512 AS over_budget,
          array_to_string(t[1:512], ' ') AS truncated
        FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)""",
)
def _(spark, sf):
    documents = rendered.table(spark, sf, "documents")
    return splits.truncate_to_budget(documents, "text", 512).select(
        "doc_id", "n_tokens", "over_budget", "truncated"
    )


# --- model output repair -----------------------------------------------------
@query("normalize_output", "SELECT example_id, run, clean FROM p_norm", "p_norm")
def _(spark, sf):
    clean = R.normalize_output(F.col("raw_output")).alias("clean")
    return outputs(spark, sf).select(*OUT, clean)


@query("slice_braces", "SELECT example_id, run, cand AS candidate FROM p_raw", "p_raw")
def _(spark, sf):
    return outputs(spark, sf).select(*OUT, R.slice_braces(F.col("raw_output")).alias("candidate"))


@query(
    "strict_parse",
    f"""SELECT example_id, run, j IS NOT NULL AS is_json, {Q.HAS_KEYS} AS has_keys,
          {Q.VALID} AS is_valid FROM p_norm""",
    "p_norm",
)
def _(spark, sf):
    return rep.strict_parse(outputs(spark, sf)).select(*OUT, "is_json", "has_keys", "is_valid")


@query(
    "extract_severity", f"SELECT example_id, run, {Q.FOUND_SEVERITY} AS found FROM p_norm", "p_norm"
)
def _(spark, sf):
    clean = R.normalize_output(F.col("raw_output"))
    return outputs(spark, sf).select(*OUT, R.extract_severity(clean).alias("found"))


@query("extract_cause", f"SELECT example_id, run, {Q.FOUND_CAUSE} AS found FROM p_norm", "p_norm")
def _(spark, sf):
    clean = R.normalize_output(F.col("raw_output"))
    return outputs(spark, sf).select(*OUT, R.extract_cause(clean).alias("found"))


@query("extract_action", f"SELECT example_id, run, {Q.FOUND_ACTION} AS found FROM p_norm", "p_norm")
def _(spark, sf):
    clean = R.normalize_output(F.col("raw_output"))
    return outputs(spark, sf).select(*OUT, R.extract_action(clean).alias("found"))


@query(
    "clean_value", f"SELECT example_id, run, {Q.cleaned('raw_output')} AS value FROM outputs",
    "outputs",
)
def _(spark, sf):
    return outputs(spark, sf).select(*OUT, R.clean_value(F.col("raw_output")).alias("value"))


@query(
    "default_action",
    f"SELECT source, win, {Q.actions('likely_cause', vocab.REPAIR_CAUSES)} AS action FROM all_labelled",
    "all_labelled",
)
def _(spark, sf):
    cause = B.likely_cause(F.col("incident_text"))
    return all_incidents(spark, sf).select("source", "win", R.default_action(cause).alias("action"))


def _fill_query(policy: str) -> None:
    fills = [Q.lit(v) for v in vocab.FILL_VALUES[policy]]
    columns = ", ".join(
        f"CASE WHEN {c} = '' THEN {v} ELSE {c} END AS {c}" for c, v in zip(vocab.FIELDS, fills)
    )

    @query(
        f"fill_missing_{policy}", f"SELECT example_id, run, {columns} FROM rep_blank", "rep_blank"
    )
    def _(spark, sf):
        blank = rep.parse_and_repair(outputs(spark, sf), "blank")
        return rep.fill_missing(blank, policy).select(*OUT, *vocab.FIELDS)


for _policy in ("mark", "default", "blank"):
    _fill_query(_policy)


def _repair_query(name: str, table: str, **params) -> None:
    @query(
        name,
        f"""SELECT example_id, run, severity, likely_cause, recommended_action, n_keys,
              was_repaired, is_json FROM {table}""",
        table,
    )
    def _(spark, sf):
        return rep.parse_and_repair(outputs(spark, sf), **params).select(
            *OUT, *vocab.FIELDS, "n_keys", "was_repaired", "is_json"
        )


_repair_query("parse_and_repair_mark", "rep_mark", policy="mark")
_repair_query("parse_and_repair_default", "rep_default", policy="default")
_repair_query("parse_and_repair_blank", "rep_blank", policy="blank")
_repair_query("parse_and_repair_as_written", "rep_written", policy="mark", as_written=True)


@query(
    "apply_override",
    """SELECT example_id, run, severity, likely_cause, recommended_action, was_overridden,
         override_changed FROM pred_mark""",
    "pred_mark",
)
def _(spark, sf):
    return rep.predict(outputs(spark, sf), "mark").select(
        *OUT, *vocab.FIELDS, "was_overridden", "override_changed"
    )


@query(
    "check_format",
    f"""SELECT example_id, run, CASE
          WHEN {Q.strip('severity')} = '' OR {Q.strip('likely_cause')} = ''
            OR {Q.strip('recommended_action')} = ''
            OR contains(severity || likely_cause || recommended_action, 'UNKNOWN')
            THEN {Q.lit(vocab.STATUS_INCOMPLETE)}
          WHEN NOT regexp_full_match(severity, 'SEV-[13]') THEN {Q.lit(vocab.STATUS_BAD_SEVERITY)}
          WHEN was_repaired THEN {Q.lit(vocab.STATUS_REPAIRED)}
          ELSE {Q.lit(vocab.STATUS_OK)} END AS format_status
        FROM pred_mark""",
    "pred_mark",
)
def _(spark, sf):
    return rep.check_format(rep.predict(outputs(spark, sf), "mark")).select(*OUT, "format_status")


@query(
    "confidence",
    f"""SELECT example_id, run, CASE WHEN is_json THEN {Q.lit(vocab.CONFIDENCE_HIGH)}
          ELSE {Q.lit(vocab.CONFIDENCE_MEDIUM)} END AS confidence FROM rep_default""",
    "rep_default",
)
def _(spark, sf):
    parsed = rep.parse_and_repair(outputs(spark, sf), "default")
    return rep.confidence(parsed).select(*OUT, "confidence")


@query(
    "incident_from_prompt",
    """SELECT source, win, split_part(substr(prompt,
         strpos(prompt, 'Incident:' || chr(10)) + 10),
         chr(10) || chr(10) || 'STRICT REQUIREMENTS:', 1) AS incident_text FROM all_labelled""",
    "all_labelled",
)
def _(spark, sf):
    rows = labelling.label_incidents(all_incidents(spark, sf))
    text = R.incident_from_prompt(F.col("prompt")).alias("incident_text")
    return rows.select("source", "win", text)


@query(
    "triage",
    f"""SELECT example_id, run,
          CASE WHEN blank THEN 'N/A' ELSE severity END AS severity,
          CASE WHEN blank THEN 'N/A' ELSE likely_cause END AS likely_cause,
          CASE WHEN blank THEN {Q.lit(vocab.EMPTY_INPUT_HINT)} ELSE recommended_action END
            AS recommended_action,
          CASE WHEN blank THEN '' ELSE raw_output END AS raw_output,
          CASE WHEN blank THEN 'N/A' WHEN is_json THEN {Q.lit(vocab.CONFIDENCE_HIGH)}
            ELSE {Q.lit(vocab.CONFIDENCE_MEDIUM)} END AS confidence
        FROM (SELECT *, {Q.strip('incident_text')} = '' AS blank FROM pred_default)""",
    "pred_default",
)
def _(spark, sf):
    return rep.triage(outputs(spark, sf)).select(*OUT, *vocab.FIELDS, "raw_output", "confidence")


@query(
    "diverse_sample",
    """SELECT incident_id, likely_cause, row_number() OVER (ORDER BY pick, source, win) AS sample_no
       FROM (SELECT *, CASE
               WHEN likely_cause = 'Packet responder termination' AND place = 1 THEN 0
               WHEN likely_cause = 'Block serving exception' AND place = 1 THEN 1 ELSE 2 END AS pick
             FROM (SELECT *, row_number() OVER (PARTITION BY likely_cause ORDER BY source, win) AS place
                   FROM labelled))
       QUALIFY sample_no <= 6""",
    "labelled",
)
def _(spark, sf):
    rows = labelled(spark, sf).select("source", "win", "incident_id", "likely_cause")
    return rep.diverse_sample(rows, 6, ["source", "win"]).select(
        "incident_id", "likely_cause", "sample_no"
    )


@query(
    "preview",
    """SELECT source, win, array_to_string(string_split(incident_text, chr(10))[1:6], chr(10)) AS head,
         greatest(len(string_split(incident_text, chr(10))) - 6, 0) AS more FROM windows""",
    "windows",
)
def _(spark, sf):
    head, more = R.preview(F.col("incident_text"))
    return all_incidents(spark, sf).select("source", "win", head.alias("head"), more.alias("more"))


# --- evaluation --------------------------------------------------------------
@query(
    "pair_predictions",
    "SELECT example_id, run, severity, true_severity, likely_cause, true_cause FROM scored",
    "scored",
)
def _(spark, sf):
    rows = outputs(spark, sf)
    truth = labelling.label_incidents(all_incidents(spark, sf)).select(
        F.concat_ws("-", "source", F.col("win").cast("string")).alias("example_id"), "response"
    )
    predictions = rep.predict(rows.drop("response"))
    return E.pair_predictions(predictions, truth).select(
        *OUT, "severity", "true_severity", "likely_cause", "true_cause"
    )


def _rate(flag: str, name: str) -> str:
    hits = f"count(*) FILTER ({flag})"
    return f"{hits} AS {name}_n, ({hits} / count(*)) * 100 AS {name}_pct"


def _rate_query(name: str, fn: Callable, **flags: str) -> None:
    columns = ", ".join(_rate(flag, key) for key, flag in flags.items())

    @query(name, f"SELECT run, count(*) AS total, {columns} FROM scored GROUP BY run", "scored")
    def _(spark, sf):
        return fn(scored(spark, sf))


_rate_query(
    "field_accuracy", E.field_accuracy,
    severity="severity_ok", likely_cause="cause_ok", recommended_action="action_ok",
)
_rate_query("exact_match", E.exact_match, exact="exact")
_rate_query("valid_rate", E.valid_rate, valid="filled")
_rate_query("repair_rate", E.repair_rate, repair="NOT is_json")
_rate_query("override_rate", E.override_rate, changed="override_changed", hit="was_overridden")


@query(
    "confusion_matrix",
    """SELECT run, true_severity AS truth, severity AS predicted, count(*) AS n FROM scored
       WHERE true_severity IN ('SEV-1', 'SEV-3') AND severity IN ('SEV-1', 'SEV-3') GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return E.confusion_matrix(scored(spark, sf))


@query(
    "confusion_matrix_all_labels",
    """SELECT run, true_severity AS truth, severity AS predicted, count(*) AS n
       FROM scored GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return E.confusion_matrix(scored(spark, sf), labels=[])


@query(
    "confusion_pivot",
    """SELECT run, true_severity AS truth, count(*) FILTER (severity = 'SEV-1') AS "SEV-1",
         count(*) FILTER (severity = 'SEV-3') AS "SEV-3" FROM scored
       WHERE true_severity IN ('SEV-1', 'SEV-3') AND severity IN ('SEV-1', 'SEV-3') GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return E.confusion_pivot(scored(spark, sf))


@query(
    "confusion_matrix_documents",
    """SELECT run, truth, predicted, count(*) AS n FROM (
         SELECT 'length rule' AS run, CAST(quality AS VARCHAR) AS truth,
           CASE WHEN n_chars BETWEEN 200 AND 20000 THEN '1' ELSE '0' END AS predicted
         FROM labels JOIN documents USING (doc_id)) GROUP BY ALL""",
)
def _(spark, sf):
    guess = F.when(F.col("n_chars").between(200, 20000), "1").otherwise("0")
    documents = rendered.table(spark, sf, "documents").select("doc_id", guess.alias("severity"))
    labels = rendered.table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("true_severity")
    )
    paired = labels.join(documents, "doc_id").withColumn("run", F.lit("length rule"))
    return E.confusion_matrix(paired, labels=["0", "1"])


@query(
    "per_cause_accuracy",
    """SELECT run, true_cause AS likely_cause, count(*) AS total, count(*) FILTER (cause_ok) AS correct,
         (count(*) FILTER (cause_ok) / count(*)) * 100 AS accuracy FROM scored GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return E.per_cause_accuracy(scored(spark, sf))


@query(
    "class_recall",
    """SELECT run, true_severity AS severity, count(*) AS total,
         count(*) FILTER (severity_ok) AS true_positives,
         count(*) FILTER (NOT severity_ok) AS false_negatives,
         (count(*) FILTER (severity_ok) / count(*)) * 100 AS recall
       FROM scored GROUP BY run, true_severity""",
    "scored",
)
def _(spark, sf):
    return E.class_recall(scored(spark, sf))


def _compare_arm(metric: str, flag: str) -> str:
    def share(run: str) -> str:
        mine = f"run = '{run}'"
        return (
            f"(count(*) FILTER ({mine} AND {flag}) / count(*) FILTER ({mine})) * 100"
        )

    return (
        f"SELECT '{metric}_accuracy' AS metric, {share('baseline')} AS baseline, "
        f"{share('candidate')} AS candidate, {share('candidate')} - {share('baseline')} "
        "AS difference FROM scored"
    )


@query(
    "compare_runs",
    " UNION ALL ".join(_compare_arm(m, f) for m, f in E.COMPARED.items()),
    "scored",
)
def _(spark, sf):
    return E.compare_runs(scored(spark, sf))


_ERROR_FLAGS = {
    "severity_misclassification": "NOT severity_ok",
    "likely_cause_error": "NOT cause_ok",
    "incomplete_json": "NOT braces",
    "formatting_issue": r"braces AND NOT coalesce(json_valid(regexp_extract(raw_output, '(?s)\{.*\}', 0)), false)",
}


@query(
    "error_breakdown",
    " UNION ALL ".join(
        f"SELECT run, '{name}' AS category, count(*) FILTER ({flag}) AS n, "
        f"(count(*) FILTER ({flag}) / count(*)) * 100 AS pct FROM scored GROUP BY run"
        for name, flag in _ERROR_FLAGS.items()
    ),
    "scored",
)
def _(spark, sf):
    return E.error_breakdown(scored(spark, sf))


@query(
    "intervention_stats",
    """SELECT run, CASE WHEN was_overridden THEN 'overridden' WHEN was_repaired THEN 'repaired'
         ELSE 'none' END AS intervention, count(*) AS n FROM scored GROUP BY ALL""",
    "scored",
)
def _(spark, sf):
    return E.intervention_stats(scored(spark, sf))


def _stage_arm(stage: str, table: str, valid: str) -> str:
    return (
        f"SELECT run, '{stage}' AS stage, count(*) FILTER ({valid}) AS n, "
        f"(count(*) FILTER ({valid}) / count(*)) * 100 AS pct FROM {table} GROUP BY run"
    )


_FILLED = (
    "severity <> '' AND likely_cause <> '' AND recommended_action <> '' "
    "AND NOT contains(severity || likely_cause || recommended_action, 'UNKNOWN')"
)


@query(
    "stage_valid_rate",
    " UNION ALL ".join(
        [
            _stage_arm("raw", "p_raw", Q.VALID),
            _stage_arm("normalized", "p_norm", Q.VALID),
            _stage_arm("repaired", "rep_mark", _FILLED),
            _stage_arm("final", "pred_default", _FILLED),
        ]
    ),
    "p_raw", "p_norm", "rep_mark", "pred_default",
)
def _(spark, sf):
    return E.stage_valid_rate(outputs(spark, sf))


# --- tuning runs -------------------------------------------------------------
@query(
    "leaderboard",
    """SELECT ord, config_name, train_loss, val_loss, runtime_seconds / 60 AS runtime_minutes
       FROM runs""",
    "runs",
)
def _(spark, sf):
    return X.leaderboard(tuning_runs(spark, sf))


@query(
    "best_run",
    "SELECT config_name, val_loss, train_loss FROM runs ORDER BY val_loss, ord LIMIT 1",
    "runs",
)
def _(spark, sf):
    return X.best_run(tuning_runs(spark, sf)).select("config_name", "val_loss", "train_loss")


@query(
    "improvement_pct",
    """SELECT ord, config_name, val_loss, (base - val_loss) / base * 100 AS improvement_pct
       FROM (SELECT *, (SELECT val_loss FROM runs WHERE ord = 0) AS base FROM runs)""",
    "runs",
)
def _(spark, sf):
    return X.improvement_pct(tuning_runs(spark, sf))


@query(
    "only_best",
    "SELECT config_name, epochs, val_loss FROM runs WHERE config_name = 'Config C (Higher Capacity)'",
    "runs",
)
def _(spark, sf):
    return X.only_best(tuning_runs(spark, sf)).select("config_name", "epochs", "val_loss")


# --- text-to-label model -----------------------------------------------------
def _parts(spark, sf):
    rows = pin(split_rows(spark, sf), "splits")
    return rows, rows.where("split = 'train'"), rows.where("split = 'val'")


def _guess_sql(side: str) -> str:
    """Mean log loss on ``side`` of the label shares of the training split, as ``_constant_loss`` has it."""
    part = """SELECT avg(-ln(coalesce(p, 1e-15))) FROM splits s LEFT JOIN (
        SELECT {t} AS label, count(*) / (SELECT count(*) FROM splits WHERE split = 'train') AS p
        FROM splits WHERE split = 'train' GROUP BY {t}) g ON g.label = s.{t} WHERE s.split = '{side}'"""
    return "round((" + " + ".join(f"({part.format(t=t, side=side)})" for t in model.TARGETS) + f") / {len(model.TARGETS)}, 9)"


@query(
    "train_triage_model",
    f"""SELECT count_if(split = 'train') AS train_rows, count_if(split = 'val') AS val_rows,
         {_guess_sql('train')} AS constant_train_loss, {_guess_sql('val')} AS constant_val_loss,
         true AS better_than_constant FROM splits""",
    "splits",
)
def _(spark, sf):
    """Both losses must beat those of the constant guess, the class frequencies of the training split."""
    rows, train, val = _parts(spark, sf)
    trained = model.train_triage_model(train, val)
    constant = {part: _constant_loss(train, side) for part, side in (("t", train), ("v", val))}
    better = trained.train_loss < constant["t"] and trained.val_loss < constant["v"]
    return rows.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "val").alias("val_rows"),
        F.round(F.lit(constant["t"]), 9).alias("constant_train_loss"),
        F.round(F.lit(constant["v"]), 9).alias("constant_val_loss"),
        F.lit(better).alias("better_than_constant"),
    )


def _constant_loss(train: DataFrame, side: DataFrame) -> float:
    """Mean log loss on ``side`` of the label shares of ``train``."""
    total, n = 0.0, train.count()
    for target in model.TARGETS:
        share = train.groupBy(target).agg((F.count(F.lit(1)) / n).alias("p"))
        found = side.join(share, target, "left").select(F.coalesce("p", F.lit(1e-15)).alias("p"))
        total += found.agg(F.avg(-F.log("p"))).first()[0]
    return total / len(model.TARGETS)


@query(
    "predict_triage",
    """SELECT count(*) AS rows, count(*) AS valid_json, count(*) AS listed_labels,
         count(*) AS action_of_cause FROM splits WHERE split = 'test'""",
    "splits",
)
def _(spark, sf):
    """What the model writes on the test split: strict JSON, listed labels, the action of its cause."""
    rows, train, val = _parts(spark, sf)
    answers = model.predict_triage(
        model.train_triage_model(train, val), rows.where("split = 'test'").select("prompt")
    )
    said = answers.select(parse_response("raw_output").alias("m"))
    part = {k: F.try_element_at("m", F.lit(k)) for k in vocab.FIELDS}
    listed = part["severity"].isin(vocab.SEVERITIES) & part["likely_cause"].isin(list(vocab.ACTIONS))
    action = part["recommended_action"].eqNullSafe(B.recommended_action(part["likely_cause"]))
    return said.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("m").isNotNull()).alias("valid_json"),
        F.count_if(listed).alias("listed_labels"),
        F.count_if(action).alias("action_of_cause"),
    )


@query(
    "saved_triage_model",
    """SELECT incident_id, true AS same_output, true AS listed_once FROM splits WHERE split = 'test'""",
    "splits",
)
def _(spark, sf):
    """A model read back from the shared folder says the same of every test row; of two, the later one counts."""
    rows, train, val = _parts(spark, sf)
    test, path = rows.where("split = 'test'").select("incident_id", "prompt"), stage_path(spark, "models")
    first = model.train_triage_model(train, val, model.CONFIGS[1])
    trained = model.train_triage_model(train, val)
    for each in (first, trained):
        model.save_triage_model(each, spark, path)
    again = model.load_triage_model(spark, path)
    said = model.predict_triage(trained, test).withColumnRenamed("raw_output", "said")
    both = model.predict_triage(again, said)
    # one folder for each of the two, and the losses of the one that was loaded
    kept = model.saved_models(spark, path).select("folder", "val_loss").collect()
    listed = len({k["folder"] for k in kept}) == 2 and again.val_loss == trained.val_loss
    return both.select("incident_id", (F.col("said") == F.col("raw_output")).alias("same_output"), F.lit(listed).alias("listed_once"))


@query("predict_triage_scores")
def _(spark, sf):
    """Predictions on the test split, through repair, override and scoring."""
    rows, train, val = _parts(spark, sf)
    test = rows.where("split = 'test'").select(
        F.col("incident_id").alias("example_id"), "prompt", "incident_text", "response"
    )
    answers = model.predict_triage(model.train_triage_model(train, val), test)
    return E.field_accuracy(flows.outputs_to_scores(answers.withColumn("run", F.lit("model"))))


@query(
    "tune_triage_model",
    f"""SELECT ord, config_name, (SELECT count(*) FROM splits WHERE split = 'train') AS train_rows,
          (SELECT count(*) FROM splits WHERE split = 'val') AS val_rows, true AS has_losses, ord = 2 AS wins
        FROM (VALUES {", ".join(f"({i}, {Q.lit(c.name)})" for i, c in enumerate(model.CONFIGS))}) t(ord, config_name)""",
    "splits",
)
def _(spark, sf):
    """The winner, by least validation loss, is the configuration with most passes and least shrinkage."""
    _, train, val = _parts(spark, sf)
    runs = pin(model.tune_triage_model(train, val), "tuning")
    best = X.best_run(runs).select(F.col("ord").alias("best"))
    return runs.join(best, F.col("ord") == F.col("best"), "left").select(
        "ord", "config_name", F.lit(train.count()).alias("train_rows"), F.lit(val.count()).alias("val_rows"),
        (F.col("train_loss").isNotNull() & F.col("val_loss").isNotNull()).alias("has_losses"),
        F.col("best").isNotNull().alias("wins"),
    )


# --- streams -----------------------------------------------------------------
def event_stream(spark, sf):
    """The events table as a stream of log lines with their event time."""
    schema = rendered.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return rendered.lines_of_events(events, "ts")


def _drain(spark, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream into files until nothing is left, and read them back."""
    path = stage_path(spark, name)
    stream_ops.run_available(stream_win.to_files(stream, path), path + "-checkpoint")
    return spark.read.schema(stream.schema).parquet(path)


#: Events of a micro-batch, about: a source's lines of one micro-batch are in one task's memory.
BATCH_EVENTS = 1_500_000


def _window_files(spark, sf, parts: int = 3, until=None, **how) -> str:
    """Windows of the events in several micro-batches; the stream stops and starts again in between.

    ``parts`` is the least number of micro-batches, which grows with the table. ``until`` may leave out events by their
    place in the table, from 0 to 1.
    """
    path, feed = stage_path(spark, "windows"), stage_path(spark, "events")
    events = rendered.table(spark, sf, "events")
    low, high, n = events.agg(F.min("event_id"), F.max("event_id"), F.count(F.lit(1))).first()
    parts = max(parts, -(-n // BATCH_EVENTS))
    part = F.least(F.floor((F.col("event_id") - low) * parts / (high - low + 1)), F.lit(parts - 1))
    if until is not None:
        events = events.where(until((F.col("event_id") - low) / (high - low + 1)))
    for i in range(parts):
        # the bounds, one event too wide for rounding, let the scan pass over row groups
        about = F.col("event_id").between(*[low + (high - low + 1) * (i + j) // parts + (2 * j - 1) for j in (0, 1)])
        events.where(about & (part == i)).write.parquet(f"{feed}/part={i}")
        read = spark.readStream.schema(events.schema).parquet(f"{feed}/part=*")
        cleaned = stream_ops.stream_clean(rendered.lines_of_events(read, "ts"))
        writer = stream_win.to_files(stream_win.stream_windows(cleaned, **how), path)
        stream_ops.run_available(writer, path + "-checkpoint")
    return path


@query("stream_clean", "SELECT source, seq, level, component, normalized FROM kept", "kept")
def _(spark, sf):
    cleaned = stream_ops.stream_clean(event_stream(spark, sf)).drop("ts")
    return _drain(spark, cleaned, "clean")


@query(
    "stream_windows",
    """SELECT source, win, string_agg(normalized, '|' ORDER BY pos) AS body
       FROM wl GROUP BY source, win""",
    "wl",
)
def _(spark, sf):
    found = stream_win.read_windows(spark, _window_files(spark, sf))
    return found.select("source", "win", F.array_join("members.normalized", "|").alias("body"))


@query(
    "stream_windows_expiry",
    """SELECT source, count(*) AS lines, count(*) - 4 * greatest((count(*) - 8) // 4 + 1, 0) AS open, max(ts) AS ts
       FROM early GROUP BY source
       HAVING max(ts) + to_microseconds((SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) // 4 FROM events))
         < (SELECT max(ts) FROM early) - INTERVAL 1 SECOND""",
    "early",
)
def _(spark, sf):
    """Sources that fall silent leave the state of the windows, and are reported with what they leave behind."""
    times = rendered.table(spark, sf, "events").agg(
        F.unix_micros(F.min("ts").cast("timestamp")).alias("a"), F.unix_micros(F.max("ts").cast("timestamp")).alias("b")
    ).first()
    path = _window_files(
        spark, sf, until=lambda place: place <= (F.col("user_id") % 8 + 1) / 8,
        idle=f"{(times['b'] - times['a']) // 4} microseconds", delay="1 second",
    )
    return stream_win.expired_sources(spark, path)


@query("stream_dedup", "SELECT DISTINCT incident_id, service FROM windows", "windows")
def _(spark, sf):
    # the delay covers all events of the table, so that the result is that of the whole
    found = stream_win.windows_stream(spark, _window_files(spark, sf))
    once = stream_ops.stream_dedup(stream_ops.stream_incidents(found), delay="36500 days")
    return _drain(spark, once, "dedup").select("incident_id", "service")


HOURS = 5


def _late_runs(spark, sf) -> tuple[DataFrame, list[DataFrame]]:
    """What the dedup lets through of windows that come in runs of one hour each, those of two sources in three one or
    two runs late, with a delay of one hour; and the state's changes in each run."""
    path, feed = stage_path(spark, "late"), stage_path(spark, "late-feed")
    found = all_incidents(spark, sf).select("source", "win", "incident_id")
    last = found.agg(F.max("win").alias("last"))
    hour = F.floor(F.col("win") * HOURS / (F.col("last") + 1))
    rows = pin(
        found.join(F.broadcast(last)).select(
            "source", F.concat_ws("/", "source", "incident_id").alias("incident_id"), hour.alias("hour"),
            (hour + F.col("source").cast("bigint") % 3).alias("run"), F.timestamp_seconds(3600 * (hour + 1)).alias("ts"),
        ),
        "late-rows",
    )
    changes = []
    for run in range(HOURS + 2):
        rows.where(F.col("run") == run).write.parquet(f"{feed}/run={run}")
        incoming = spark.readStream.schema(rows.schema).parquet(f"{feed}/run=*")
        writer = stream_win.to_files(stream_ops.stream_dedup(incoming, delay="1 hour"), path)
        progress = stream_ops.run_available(writer, path + "-checkpoint")
        changes.append(stream_ops.state_changes(spark, progress).withColumn("run", F.lit(run).cast("bigint")))
    return spark.read.schema(rows.schema).parquet(path), changes


@query(
    "stream_dedup_expiry",
    """SELECT * FROM (
         WITH RECURSIVE told AS (
           SELECT source, incident_id, min(hour) AS hour FROM late_facts WHERE NOT late GROUP BY source, incident_id
           UNION ALL
           SELECT t.source, t.incident_id, min(f.hour) AS hour
           FROM told t JOIN late_facts f ON f.incident_id = t.incident_id
           WHERE NOT f.late AND f.hour > t.hour AND t.hour + 1 <= f.before - 1
           GROUP BY t.source, t.incident_id, t.hour
         )
         SELECT source, incident_id, hour FROM told)""",
    "late_facts",
)
def _(spark, sf):
    """Ids come back once the watermark has passed them by the delay; late rows do not come at all."""
    return _late_runs(spark, sf)[0].select("source", "incident_id", "hour")


@query(
    "stream_late_rows",
    "SELECT run, count(*) AS rows, count_if(late) AS late FROM late_facts GROUP BY run",
    "late_facts",
)
def _(spark, sf):
    """Rows that each run read, and those it dropped behind the watermark, as the query's progress has them."""
    changes = reduce(DataFrame.unionByName, _late_runs(spark, sf)[1])
    return changes.groupBy("run").agg(F.sum("rows").alias("rows"), F.sum("late").alias("late"))


@query(
    "stream_triage",
    "SELECT source, win, severity, likely_cause, recommended_action FROM all_labelled",
    "all_labelled",
)
def _(spark, sf):
    found = stream_win.windows_stream(spark, _window_files(spark, sf))
    answers = stream_ops.stream_triage(stream_ops.stream_incidents(found))
    return _drain(spark, answers.select("source", "win", *vocab.FIELDS), "triage")
