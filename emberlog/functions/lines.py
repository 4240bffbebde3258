"""Column expressions over raw log lines: parse, filter, normalise.

Patterns carry ``(?U)`` so that word characters, digits and white space follow Unicode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog import vocab

# white space inside patterns; the four separators \x1c-\x1f are not in Java's \s
SPACE = r"[\s\x1c-\x1f]"
LEVEL = r"\b(?:" + "|".join(vocab.LEVELS) + r")\b"
IPV4 = r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def strip(text: Column) -> Column:
    """Drop white space at both ends (``trim`` alone only drops blanks)."""
    return F.btrim(text, F.lit(vocab.WHITESPACE))


def contains_any(text: Column, needles: list[str]) -> Column:
    """Whether ``text`` holds one of ``needles``.

    The one-element array binds ``text`` once; a plain OR chain inside a pushed-down filter
    would evaluate the expression behind ``text`` again for every needle.
    """
    return F.exists(
        F.array(text),
        lambda bound: reduce(lambda a, b: a | b, [F.contains(bound, F.lit(n)) for n in needles]),
    )


def any_word_pattern(words: list[str]) -> str:
    """Pattern for one of ``words``. The character classes in front rule out most positions before
    the alternatives are tried, which makes it faster than a substring search per word."""
    depth = min(3, *map(len, words))
    heads = "".join("[" + "".join(sorted({w[i] for w in words})) + "]" for i in range(depth))
    return f"(?={heads})(?:{'|'.join(words)})"


INFORMATIVE = any_word_pattern(vocab.INFORMATIVE_KEYWORDS)


def parse_level(line: Column) -> Column:
    found = F.regexp_extract(line, f"(?U)({LEVEL})", 1)
    return F.when(found == "", vocab.DEFAULT_LEVEL).otherwise(found)


def parse_component(line: Column) -> Column:
    """First ``word.word`` token; possessive quantifiers keep the scan linear."""
    found = F.regexp_extract(line, r"(?U)\b\w++\.\w++", 0)
    return F.when(found == "", vocab.DEFAULT_COMPONENT).otherwise(found)


def parse_message(line: Column) -> Column:
    """Text behind the level and its colons; the whole line when there is no level."""
    return strip(F.regexp_replace(line, rf"(?sU)\A.*?{LEVEL}{SPACE}*:*{SPACE}*", ""))


def is_informative(line: Column) -> Column:
    """A level that is always kept, or a keyword in the message.

    The cheap tests on the whole line come first: a line without any of the words is never parsed.
    """
    kept_level = contains_any(line, vocab.ALWAYS_KEPT_LEVELS) & parse_level(line).isin(
        vocab.ALWAYS_KEPT_LEVELS
    )
    keyword = F.lower(line).rlike(INFORMATIVE) & F.lower(parse_message(line)).rlike(INFORMATIVE)
    return kept_level | keyword


def infer_service(component: Column) -> Column:
    lowered = F.lower(component)
    return (
        F.when(lowered.contains("datanode"), "hdfs-datanode")
        .when(lowered.contains("namenode") | lowered.contains("namesystem"), "hdfs-namenode")
        .otherwise("hdfs")
    )


def lowercase(text: Column) -> Column:
    return F.lower(text)


def strip_timestamp(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A\d{{6}}{SPACE}+\d{{6}}{SPACE}+\d+{SPACE}*", "")


def mask_block_id(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)blk_-?\d+", "blk_<ID>")


def mask_ip_port(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){IPV4}:\d+\b", "<IP:PORT>")


def mask_ip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){IPV4}\b", "<IP>")


def mask_size(text: Column) -> Column:
    """The word boundary is tested behind the literal, which lets the matcher skip ahead to it."""
    return F.regexp_replace(text, rf"(?U)size(?<!\wsize){SPACE}+\d+\b", "size <SIZE>")


def collapse_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def normalize_text(text: Column) -> Column:
    """All masks over the whole line, lower case first so that mask names stay upper case.

    Every mask needs a digit, so text without one skips them.
    """
    lowered = lowercase(text)
    masked = lowered
    for mask in (strip_timestamp, mask_block_id, mask_ip_port, mask_ip, mask_size):
        masked = mask(masked)
    return collapse_whitespace(
        F.when(lowered.rlike(r"(?U)\d"), masked).otherwise(lowered)
    )
