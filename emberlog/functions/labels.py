"""Column expressions for the rule labels and the prompt/response texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog import vocab
from emberlog.functions.lines import contains_any


def severity(text: Column, levels_count: Column) -> Column:
    """``text`` is the whole incident text, the ``service:`` line included."""

    def n(level: str) -> Column:
        return F.coalesce(F.try_element_at(levels_count, F.lit(level)), F.lit(0))

    critical = (
        (n("ERROR") > 0)
        | (n("FATAL") > 0)
        | (n("WARN") >= 4)
        | contains_any(F.lower(text), vocab.CRITICAL_KEYWORDS + [vocab.SERVING_PHRASE])
    )
    return F.when(critical, "SEV-1").when(n("WARN") >= 2, "SEV-2").otherwise("SEV-3")


def likely_cause(text: Column) -> Column:
    """First match wins."""
    lowered = F.lower(text)
    return (
        F.when(lowered.contains(vocab.SERVING_PHRASE), vocab.BLOCK_SERVING)
        .when(contains_any(lowered, vocab.NETWORK_KEYWORDS), vocab.NETWORK)
        .when(contains_any(lowered, vocab.DEGRADATION_KEYWORDS), vocab.DEGRADATION)
        .when(
            lowered.contains("packetresponder") & lowered.contains("terminating"),
            vocab.PACKET_RESPONDER,
        )
        .otherwise(vocab.DEFAULT_CAUSE)
    )


def recommended_action(cause: Column, causes: list[str] | None = None) -> Column:
    """The action of a cause; ``causes`` restricts the rows that are known."""
    known = F.create_map(
        *[F.lit(x) for c in causes or vocab.ACTIONS for x in (c, vocab.ACTIONS[c])]
    )
    return F.coalesce(F.try_element_at(known, cause), F.lit(vocab.DEFAULT_ACTION))


def format_prompt(text: Column) -> Column:
    return F.concat(F.lit(vocab.PROMPT_HEAD), text, F.lit(vocab.PROMPT_TAIL))


def response_json(sev: Column, cause: Column, action: Column) -> Column:
    """JSON text with ``", "`` and ``": "`` separators, which ``to_json`` does not write."""

    def quoted(value: Column) -> Column:
        # to_json escapes the text; cut it out of its one-element array
        array = F.to_json(F.array(value))
        return array.substr(F.lit(2), F.length(array) - 2)

    return F.concat(
        F.lit('{"severity": '), quoted(sev),
        F.lit(', "likely_cause": '), quoted(cause),
        F.lit(', "recommended_action": '), quoted(action),
        F.lit("}"),
    )
