"""Text and JSON-lines sources and sinks. Every reader has an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions.lines import strip
from emberlog.operators.experiments import best_run
from emberlog.session import pin

#: Rows of the longest file that a sink writes.
ROWS_PER_FILE = 1_000_000


def decoded(text):
    """Drop bytes that are no valid UTF-8."""
    return F.replace(F.make_valid_utf8(text), F.lit(chr(0xFFFD)), F.lit(""))


def read_log_lines(spark: SparkSession, path: str | list[str], by: str = "file") -> DataFrame:
    """``(source, block, seq, line)`` of text files, stripped, blank lines included.

    ``by`` makes each file a source, or each folder, whose files then follow one another by name. Order within a
    source is ``(block, seq)``: the file block, then the row's place in the scan. Both follow from how Spark cuts
    the files for one scan, so pin the table, or what is derived from it, before ranking lines in several passes;
    ``numbered_lines`` gives numbers that do not depend on it.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    if by not in ("file", "folder"):
        raise ValueError("lines are read by file or by folder")
    whole = by == "file"
    return spark.read.text(path).select(
        (file if whole else F.regexp_extract(file, "^(.*)/[^/]*$", 1)).alias("source"),
        (start if whole else F.struct(file.alias("file"), start.alias("start"))).alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        strip(decoded(F.col("value"))).alias("line"),
    )


def numbered_lines(spark: SparkSession, path: str | list[str], by: str = "file") -> DataFrame:
    """``(source, line_no, pos, line)``: a line's number in its source, and in all sources in order of their names.

    Both count from 0, blank lines included, and are the same however the files are cut into blocks and packed into
    tasks. Lines are neither sorted nor shuffled: a block's lines are read one after the other, so a
    line's number is its distance from the block's first one, plus the lines of the blocks before. The lines
    are pinned; the blocks make a table of one row each, and the sources one of one row each.
    """
    lines = pin(read_log_lines(spark, path, by), "numbered")
    blocks = lines.groupBy("source", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sources = blocks.groupBy("source").agg(F.sum("n").alias("n"))
    offsets = blocks.select("source", "block", "first", before(Window.partitionBy("source").orderBy("block")).alias("offset"))
    offsets = offsets.join(sources.select("source", before(Window.orderBy("source")).alias("start")), "source")
    line_no = F.col("offset") + F.col("seq") - F.col("first")
    return lines.join(offsets, ["source", "block"]).select(
        "source", line_no.alias("line_no"), (F.col("start") + line_no).alias("pos"), "line"
    )


def checked_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """``(file, line, row, broken)`` and partition columns of JSON-lines files, blank lines left out.

    A line is broken unless it holds one JSON object and nothing else, strictly: no single quotes, ``NaN`` or trailing
    commas. A field that the object lacks is null.
    """
    text = spark.read.text(path)
    line = F.btrim("value", F.lit(" \t\r"))
    found = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")), f"array<struct<{schema}>>",
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"},
    )
    rows = text.where(line != "").select(
        F.col("_metadata.file_path").alias("file"), *[c for c in text.columns if c != "value"], line.alias("line"), found.alias("found")
    )
    whole = F.col("line").startswith("{") & F.col("line").endswith("}") & (F.size("found") == 1) & F.get("found", F.lit(0)).isNotNull()
    return rows.select(
        *[c for c in rows.columns if c != "found"], F.get("found", F.lit(0)).alias("row"), (~F.coalesce(whole, F.lit(False))).alias("broken")
    )


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: str, broken: str = "abort", counts: Observation | None = None
) -> DataFrame:
    """The rows of JSON-lines files, with partition columns.

    ``broken`` lines make the job fail, or are left out (``drop``): read them with ``broken_lines``. ``counts``
    observes the numbers of lines and of broken ones in passing.
    """
    if broken not in ("abort", "drop"):
        raise ValueError("broken lines abort the job or are dropped")
    checked = checked_json(spark, path, schema)
    if counts is not None:
        checked = checked.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if("broken").alias("broken"))
    told = F.concat(F.lit("broken JSON in "), "file", F.lit(": "), F.substring("line", 1, 200))
    # in the filter, so that no column pruning can skip it
    fails = F.raise_error(told) if broken == "abort" else F.lit(False)
    good = checked.where(F.when(F.col("broken"), fails.cast("boolean")).otherwise(F.lit(True)))
    return good.select("row.*", *[c for c in checked.columns if c not in ("file", "line", "row", "broken")])


def broken_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """``(file, line)`` of the lines that ``read_json_lines`` would not read, for a quarantine."""
    return checked_json(spark, path, schema).where("broken").select("file", "line")


def read_incidents(spark: SparkSession, path: str, broken: str = "abort", counts: Observation | None = None) -> DataFrame:
    return read_json_lines(spark, path, vocab.INCIDENT_SCHEMA, broken, counts)


def read_pairs(spark: SparkSession, path: str | list[str], broken: str = "abort", counts: Observation | None = None) -> DataFrame:
    return read_json_lines(spark, path, vocab.PAIR_SCHEMA, broken, counts)


def replace_json(df: DataFrame, path: str, by: str | None = None, only_given: bool = False, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` as JSON lines in place of what ``path`` holds.

    The rows are worked out and staged in the shared folder first. A job that fails until then leaves the old files as
    they are, one that fails while they are copied shows no part of the new ones, and running it again gives the
    same as if it had never failed. With ``by`` there is a folder per value; ``only_given`` replaces the folders of
    the values that ``df`` holds and leaves the others. No file has more than ``rows_per_file`` rows.
    """
    writer = pin(df, "staged").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if by is not None:
        mode = "dynamic" if only_given else "static"
        writer = writer.option("partitionOverwriteMode", mode).partitionBy(by)
    writer.json(path)


def write_incidents(incidents: DataFrame, path: str) -> None:
    replace_json(incidents.select("incident_id", "service", "lines", "incident_text", "stats"), path)


def write_splits(splits: DataFrame, path: str, only_given: bool = False) -> None:
    """One folder of JSON lines per split; ``only_given`` leaves splits alone that have no row here."""
    replace_json(splits.select("prompt", "response", "split"), path, by="split", only_given=only_given)


def read_splits(spark: SparkSession, path: str, broken: str = "abort") -> DataFrame:
    """All splits; a filter on ``split`` reads only that folder."""
    return read_json_lines(spark, path, vocab.PAIR_SCHEMA, broken)


def write_report(report: DataFrame, path: str) -> None:
    """Nested metrics, one JSON row per run."""
    replace_json(report, path)


def write_experiments(runs: DataFrame, path: str, best_only: bool = False) -> None:
    """All runs with the best one named, or the best configuration's run alone."""
    experiment = F.struct(*[c for c in runs.columns if c != "ord"])
    if best_only:
        out = runs.select(
            F.lit("best_only").alias("mode"),
            experiment.alias("experiment"),
            F.col("config_name").alias("config"),
        )
    else:
        # one row per tuned configuration, so the list is small
        best = best_run(runs)
        listed = F.array_sort(F.collect_list(F.struct("ord", experiment.alias("e"))))
        out = runs.agg(listed["e"].alias("experiments")).select(
            "experiments",
            best.select("config_name").scalar().alias("best_config"),
            best.select("val_loss").scalar().alias("best_val_loss"),
        )
    replace_json(out, path)
