"""Model outputs to predictions. One implementation; ``policy`` picks the variant:

``mark``     unrecoverable fields become UNKNOWN, actions are extracted from the text
``default``  unrecoverable fields become safe defaults (the live triage path)
``blank``    unrecoverable fields stay empty, keys alone make a parse valid (the evaluation path)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions import repair as R
from emberlog.functions.lines import strip


def _entry(key: str) -> str:
    return f"_e_{key}"


def _valid_field(key: str) -> Column:
    """A parsed value that is filled in and not marked unknown."""
    value = F.col(_entry(key))["value"]
    text = value.cast("string")
    return (
        R.is_truthy(value) & (strip(text) != "") & ~text.contains(vocab.UNKNOWN)
    )


def parse_candidates(df: DataFrame, text: Column, source: str = "raw_output") -> DataFrame:
    """Add ``_clean``, ``_braces``, ``_object`` and one entry per field for normalised ``text``."""
    return (
        df.withColumn("_clean", F.coalesce(text, F.lit("")))
        .withColumn("_braces", R.has_braces(F.col("_clean")))
        .withColumn("_object", R.parse_object(R.slice_braces(F.col("_clean"))))
        .withColumns({_entry(k): R.object_entry(F.col("_object"), k) for k in vocab.FIELDS})
    )


def all_of(parts: list[Column]) -> Column:
    out = parts[0]
    for part in parts[1:]:
        out = out & part
    return F.coalesce(out, F.lit(False))


def strictly_valid() -> Column:
    return all_of([_valid_field(k) for k in vocab.FIELDS])


def has_all_keys() -> Column:
    return all_of([F.col(_entry(k)).isNotNull() for k in vocab.FIELDS])


def strict_parse(df: DataFrame, as_written: bool = False) -> DataFrame:
    """Add ``is_json``, ``has_keys`` and ``is_valid`` for the normalised output."""
    text = R.normalize_output(F.col("raw_output"), as_written)
    parsed = parse_candidates(df, text)
    return parsed.select(
        *df.columns,
        F.col("_object").isNotNull().alias("is_json"),
        has_all_keys().alias("has_keys"),
        strictly_valid().alias("is_valid"),
    )


def fill_missing(df: DataFrame, policy: str = "mark") -> DataFrame:
    """Write the policy's value into empty or null fields."""
    fills = zip(vocab.FIELDS, vocab.FILL_VALUES[policy])
    return df.withColumns({k: R.or_fill(F.col(k), fill) for k, fill in fills})


def recover(
    parsed: DataFrame,
    policy: str = "mark",
    as_written: bool = False,
    labels: list[str] = vocab.EXTRACTED_SEVERITIES,
) -> DataFrame:
    """From parsed candidates to the three fields, ``n_keys``, ``was_repaired`` and ``is_json``
    (the brace slice parses)."""
    clean = F.col("_clean")
    found = parsed.withColumns(
        {
            "_ok": has_all_keys() if policy == "blank" else strictly_valid(),
            "_f_severity": R.extract_severity(clean, labels),
            "_f_likely_cause": R.extract_cause(clean),
            "_f_recommended_action": R.extract_action(clean, as_written)
            if policy == "mark"
            else F.lit(""),
        }
    )
    action = F.col("_f_recommended_action")
    if policy != "blank":
        cause = F.col("_f_likely_cause")
        action = F.when((action == "") & (cause != ""), R.default_action(cause)).otherwise(action)
    recovered = {
        "severity": F.col("_f_severity"),
        "likely_cause": F.col("_f_likely_cause"),
        "recommended_action": action,
    }
    fills = dict(zip(vocab.FIELDS, vocab.FILL_VALUES[policy]))
    return found.select(
        *[c for c in parsed.columns if c not in vocab.FIELDS],
        *[
            F.when(F.col("_ok"), F.col(_entry(k))["value"].cast("string"))
            .otherwise(R.or_fill(recovered[k], fills[k]))
            .alias(k)
            for k in vocab.FIELDS
        ],
        F.when(F.col("_ok"), R.key_count(F.col("_object"))).otherwise(3).alias("n_keys"),
        (~F.col("_ok")).alias("was_repaired"),
        (F.col("_object").isNotNull() & F.col("_braces")).alias("is_json"),
    )


def parse_and_repair(
    df: DataFrame,
    policy: str = "mark",
    as_written: bool = False,
    labels: list[str] = vocab.EXTRACTED_SEVERITIES,
) -> DataFrame:
    """Parse ``raw_output`` and fill in what does not parse.

    Narrow: one stage, no shuffle. A null output counts as empty text.
    """
    text = R.normalize_output(F.col("raw_output"), as_written)
    out = recover(parse_candidates(df, text), policy, as_written, labels)
    kept = [c for c in df.columns if c not in vocab.FIELDS]
    return out.select(*kept, *vocab.FIELDS, "n_keys", "was_repaired", "is_json")


def apply_override(df: DataFrame) -> DataFrame:
    """Force the block-serving labels on incidents that show the phrase.

    ``was_overridden`` marks every hit, ``override_changed`` only hits that changed a field.
    """
    forced = dict(
        zip(vocab.FIELDS, ["SEV-1", vocab.BLOCK_SERVING, vocab.ACTIONS[vocab.BLOCK_SERVING]])
    )
    hit = F.col("was_overridden")
    same = all_of([F.col(k).eqNullSafe(F.lit(v)) for k, v in forced.items()])
    marked = df.withColumn("was_overridden", R.needs_override(F.col("incident_text")))
    return marked.withColumn("override_changed", hit & ~same).withColumns(
        {k: F.when(hit, F.lit(v)).otherwise(F.col(k)) for k, v in forced.items()}
    )


def check_format(df: DataFrame) -> DataFrame:
    """Add ``format_status``; a null field stands for a missing key."""
    missing = F.lit(False)
    incomplete = F.lit(False)
    for k in vocab.FIELDS:
        missing = missing | F.col(k).isNull()
        incomplete = incomplete | (strip(F.col(k)) == "") | F.col(k).contains(vocab.UNKNOWN)
    status = (
        F.when(missing, vocab.STATUS_MISSING)
        .when(incomplete, vocab.STATUS_INCOMPLETE)
        .when(~F.col("severity").rlike(r"^SEV-[13]$"), vocab.STATUS_BAD_SEVERITY)
        .when(F.col("was_repaired"), vocab.STATUS_REPAIRED)
        .otherwise(vocab.STATUS_OK)
    )
    return df.withColumn("format_status", status)


def confidence(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "confidence",
        F.when(F.col("is_json"), vocab.CONFIDENCE_HIGH).otherwise(vocab.CONFIDENCE_MEDIUM),
    )


def triage(df: DataFrame, as_written: bool = False) -> DataFrame:
    """The live path on a table or stream with ``incident_text`` and ``raw_output``."""
    done = confidence(apply_override(parse_and_repair(df, "default", as_written)))
    blank = strip(F.coalesce(F.col("incident_text"), F.lit(""))) == ""
    na = vocab.NOT_AVAILABLE
    answers = {
        "severity": na,
        "likely_cause": na,
        "recommended_action": vocab.EMPTY_INPUT_HINT,
        "raw_output": "",
        "confidence": na,
    }
    return done.withColumns(
        {k: F.when(blank, F.lit(v)).otherwise(F.col(k)) for k, v in answers.items()}
    )


def predict(df: DataFrame, policy: str = "blank", as_written: bool = False) -> DataFrame:
    """Raw outputs to predictions: parse, repair, override."""
    return apply_override(parse_and_repair(df, policy, as_written))


def diverse_sample(pairs: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first packet-responder pair, the first block-serving pair, then the rest in ``order``.

    ``pairs`` has ``likely_cause``. Three top-k reads; nothing is ranked as a whole.
    """
    cause = F.lower("likely_cause")

    def first(label: str, pick: int) -> DataFrame:
        hits = pairs.where(cause.contains(label)).orderBy(*order).limit(1)
        return hits.withColumn("_pick", F.lit(pick))

    candidates = (
        first("packet responder", 0)
        .union(first("block serving", 1))
        .union(pairs.orderBy(*order).limit(n + 2).withColumn("_pick", F.lit(2)))
    )
    # at most n + 4 rows from here on
    nearest = candidates.groupBy(*pairs.columns).agg(F.min("_pick").alias("_pick"))
    place = F.row_number().over(Window.orderBy("_pick", *order))
    return (
        nearest.withColumn("sample_no", place.cast("bigint"))
        .where(F.col("sample_no") <= n)
        .drop("_pick")
    )
