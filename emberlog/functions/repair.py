"""Column expressions that normalise, parse and repair raw model output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions.labels import recommended_action
from emberlog.functions.lines import SPACE, strip

# closes the array around a candidate, so that text behind the first value cannot be ignored
SENTINEL = '{"\\u0001":"\\u0001"}'


def normalize_output(raw: Column, as_written: bool = False, parentheses: bool = False) -> Column:
    """Quotes to ASCII, then strip.

    ``as_written`` leaves curly quotes alone; ``parentheses`` also turns ``: (x)`` into ``: "x"``.
    """
    text = F.translate(raw, "`", '"') if as_written else F.translate(raw, "“”`‘’", '"""\'\'')
    if parentheses:
        text = F.regexp_replace(text, r": \(([^)]+)\)", r': "$1"')
    return strip(text)


def has_braces(text: Column) -> Column:
    """Whether a ``}`` follows the first ``{``."""
    return text.rlike(r"(?s)\{.*\}")


def slice_braces(text: Column) -> Column:
    """First ``{`` to last ``}``; the whole text when there is no such slice."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found == "", text).otherwise(found)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once: the one-element array binds it.

    Written out, a costly value would be worked out again wherever ``use`` names it inside a lambda or a branch.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_object(candidate: Column) -> Column:
    """``map<string,variant>`` of a JSON object, null when the text is anything else.

    The JSON reader stops after the first value and forgives single quotes; wrapping the text in
    an array with a closing sentinel and turning the leniencies off makes it strict.
    """
    values = F.from_json(
        F.concat(F.lit("["), candidate, F.lit("," + SENTINEL + "]")),
        "array<map<string,variant>>",
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"},
    )

    def first(found: Column) -> Column:
        closed = (F.size(found) == 2) & F.map_contains_key(F.get(found, F.lit(1)), F.lit("\u0001"))
        return F.when(closed, F.get(found, F.lit(0)))

    return F.when(strip(candidate) != "", bound(values, first))


def object_entry(obj: Column, key: str | Column) -> Column:
    """``struct<key, value>`` of the last ``key`` in the object, null when it is absent."""
    return F.try_element_at(
        F.filter(F.map_entries(obj), lambda e: e["key"] == key), F.lit(-1)
    )


def key_count(obj: Column) -> Column:
    return F.size(F.array_distinct(F.map_keys(obj))).cast("int")


def is_truthy(value: Column) -> Column:
    """Python truth of a JSON value: empty text, zero, false, null and empty containers are not."""
    text = value.cast("string")
    empty = F.when(F.schema_of_variant(value) == "STRING", text == "").otherwise(
        text.rlike(r"^(?:false|\[\]|\{\}|-?0+(?:\.0*)?(?:[eE].*)?)$")
    )
    return text.isNotNull() & ~empty


def extract_severity(text: Column, labels: list[str] = vocab.EXTRACTED_SEVERITIES) -> Column:
    """First severity mentioned, in any case; empty when none is."""
    digit = F.regexp_extract(text, rf"(?iU)\bSEV-({'|'.join(labels)})\b", 1)
    return F.when(digit == "", "").otherwise(F.concat(F.lit("SEV-"), digit))


def extract_cause(text: Column) -> Column:
    lowered = F.lower(text)
    return (
        F.when(lowered.contains("block serving"), vocab.BLOCK_SERVING)
        .when(lowered.contains("packet responder"), vocab.PACKET_RESPONDER)
        .otherwise("")
    )


def clean_value(value: Column) -> Column:
    """Peel stray quotes and parentheses off both ends."""
    text = F.regexp_replace(strip(value), r"""\A(?:\(|\)"|\\"|"|')+""", "")
    return strip(F.regexp_replace(text, r"""[)"']+\z""", ""))


def extract_action(text: Column, as_written: bool = False) -> Column:
    """What follows the action key, up to a brace or line end.

    A text cut right behind the key leaves only punctuation; that counts as empty unless
    ``as_written``.
    """
    found = clean_value(
        F.regexp_extract(
            text,
            rf"""(?iU)recommended_action["']?{SPACE}*:?{SPACE}*["']?{SPACE}*\(?{SPACE}*([^}}\n]+)""",
            1,
        )
    )
    if as_written:
        return found
    return F.when(found.rlike(r"[\p{L}\p{Nd}]"), found).otherwise("")


def default_action(cause: Column) -> Column:
    return recommended_action(cause, vocab.REPAIR_CAUSES)


def or_fill(value: Column, fill: str) -> Column:
    return F.when(F.coalesce(value, F.lit("")) == "", fill).otherwise(value)


def needs_override(incident_text: Column) -> Column:
    return F.coalesce(F.lower(incident_text).contains(vocab.OVERRIDE_PHRASE), F.lit(False))


def incident_from_prompt(prompt: Column) -> Column:
    """The incident inside a templated prompt; a bare prompt is the incident itself."""
    start = F.locate(vocab.INCIDENT_MARKER, prompt)
    behind = prompt.substr(start + len(vocab.INCIDENT_MARKER), F.length(prompt))
    return F.when(
        start > 0, F.substring_index(behind, vocab.REQUIREMENTS_MARKER, 1)
    ).otherwise(prompt)


def preview(text: Column, k: int = 6) -> tuple[Column, Column]:
    """The first ``k`` lines and how many more there are."""
    lines = F.split(strip(text), "\n")
    return (
        F.array_join(F.slice(lines, 1, k), "\n"),
        F.greatest(F.size(lines) - k, F.lit(0)).cast("bigint"),
    )
