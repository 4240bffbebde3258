"""URL filters: pattern rules behind an index of their rarest literal token.

A rule is a pattern over ``host + path + query``: literal text, ``||`` at its start for "at a host
or any of its subdomains", ``|`` at its start for "at the very start", ``*`` for anything and ``^``
for a separator (a character other than letters, digits, ``_ - . %``, or the end).

A token is a run of ASCII letters and digits. A rule's *closed* tokens are those which, wherever the
rule fits, stand in the url as whole tokens. Each rule is posted under that one of its closed tokens
which is rarest in the given urls; a url fetches the rules posted under its own tokens and only these
run their regular expression. A rule without a closed token is a candidate for every url, so that
none is missed.

Everything happens inside the row: the index is one constant, an array of buckets addressed by the
token's CRC-32. There is no shuffle of pages and no Python on the main path; the only aggregate counts
how many urls hold each token of the rules, and yields one row per such token.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import ascii_lower, own

#: Rules one index may hold; it travels with every task.
MAX_RULES = 100_000

TOKEN = "[A-Za-z0-9]+"
SEPARATOR = r"(?:[^A-Za-z0-9_.%\-]|$)"


@dataclass(frozen=True)
class Rule:
    """``action`` is allow or block. ``name`` is what the result calls the rule; ``rank`` decides
    between rules that fit the same url (the largest wins, then the larger name)."""

    action: str
    pattern: str
    name: str
    rank: int = 0

    @property
    def regex(self) -> str:
        """The same pattern as a regular expression over lower-case host, path and query."""
        rest, head = self.pattern, ""
        if rest.startswith("||"):
            rest, head = rest[2:], r"^(?:[^/?#]*\.)?"
        elif rest.startswith("|"):
            rest, head = rest[1:], "^"
        parts = {"*": ".*", "^": SEPARATOR}
        return "(?s)" + head + "".join(parts.get(c) or re.sub(r"([^A-Za-z0-9/])", r"\\\1", c) for c in rest)

    @property
    def tokens(self) -> list[str]:
        """Closed tokens in lower case: runs with a delimiter or an anchor on either side."""
        rest = self.pattern.lstrip("|")
        anchored = rest != self.pattern
        found = []
        for m in re.finditer(TOKEN, rest):
            before = rest[m.start() - 1] if m.start() else ("^" if anchored else "*")
            after = rest[m.end()] if m.end() < len(rest) else "*"
            if "*" not in (before, after):
                found.append(m.group().lower())
        return sorted(set(found))


def host_rule(action: str, host: str, path: str) -> Rule:
    """``host`` with its subdomains, if the path starts with ``path``; the longest such rule wins."""
    return Rule(action, f"||{host}{path}", host + path, len(host) + len(path))


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*[^?#]*(\?[^#]*)", 1), F.lit(""))


def url_tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(target), F.lit(f"({TOKEN})"), F.lit(1)))


def token_counts(targets: DataFrame, column: str, rules: Sequence[Rule]) -> dict[str, int]:
    """How many rows hold each token of ``rules``: at most one row per token comes to the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    known = targets.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    seen = targets.select(F.explode(url_tokens(F.col(column))).alias("token"))
    rows = seen.join(F.broadcast(known), "token").groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def rule_index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[Column, int]:
    """The rules in buckets, each under its rarest closed token (ties: the longer, then the lesser);
    rules without one under the empty token."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index takes {MAX_RULES}")
    n = max(16, 2 * len(rules))
    buckets: list[list[dict]] = [[] for _ in range(n)]
    for r in rules:
        token = min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t), default="")
        buckets[zlib.crc32(token.encode()) % n].append(
            {"token": token, "regex": r.regex, "rank": r.rank, "name": r.name, "action": r.action}
        )
    kind = "array<array<struct<token:string,regex:string,rank:bigint,name:string,action:string>>>"
    return F.from_json(F.lit(json.dumps(buckets)), kind), n


def best_rule(target: Column, rules: Sequence[Rule], counts: dict[str, int]) -> Column:
    """Struct (rank, name, action) of the rule that fits ``target`` and ranks highest, or null."""
    index, n = rule_index(rules, counts)

    def posted(token: Column) -> Column:
        bucket = F.get(index, F.pmod(F.crc32(token.cast("binary")), F.lit(n)).cast("int"))
        return F.filter(bucket, lambda r: r["token"] == token)

    candidates = F.flatten(F.transform(F.concat(url_tokens(target), F.array(F.lit(""))), posted))
    fitting = F.filter(candidates, lambda r: F.rlike(target, r["regex"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["rank"], r["name"], r["action"])))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    patterns: Sequence[Rule] = (),
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` to every row of ``pages``.

    ``rules`` see host and path, letter case of the path kept. Where none fits, ``patterns`` decide,
    which see host, path and query in lower case, and after them ``otherwise``. ``rule`` and
    ``pattern`` are the names of what decided, else null.

    A null url, or one without ``://``, has an empty host and path: no rule fits it and ``otherwise``
    holds (a pattern that fits the empty text still fits). Repeated rows are judged alike and all
    kept; an empty table gives an empty one. Columns of the input that bear a name of the result are
    replaced.
    """
    at, seen = own("at"), own("seen")
    host, path = url_host(F.col(url)), url_path(F.col(url))
    work = pages.withColumns(
        {at: F.concat(host, path), seen: ascii_lower(F.concat(host, path, url_query(F.col(url))))}
    )
    rule, pattern = F.lit(None), F.lit(None)
    shape = "struct<rank:bigint,name:string,action:string>"
    rule = best_rule(F.col(at), rules, token_counts(work, at, rules)) if rules else rule.cast(shape)
    if patterns:
        pattern = best_rule(F.col(seen), patterns, token_counts(work, seen, patterns))
    else:
        pattern = pattern.cast(shape)
    r, p = own("rule"), own("pattern")
    judged = work.withColumn(r, rule).withColumn(p, F.when(F.col(r).isNull(), pattern))
    return judged.withColumns(
        {
            "host": host,
            "path": path,
            "rule": F.col(r)["name"],
            "verdict": F.coalesce(F.col(r)["action"], F.col(p)["action"], F.lit(otherwise)),
            "pattern": F.col(p)["name"],
        }
    ).drop(at, seen, r, p)


#: The host rules of the registered query.
HOST_RULES = (
    host_rule("allow", "com", "/"),
    host_rule("block", "example.com", "/en/"),
    host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"),
    host_rule("block", "net", "/fr/"),
)

#: Pages that hold no text worth learning from: sign-in, carts, searches, archives and programs.
PATTERNS = tuple(
    Rule("block", p, p)
    for p in (
        "/login^", "/signin^", "/signup^", "/register^", "/logout^", "/cart^", "/checkout^",
        "/wp-admin/", "/cgi-bin/", "/wp-login.php^", "/search^", "/calendar/", "/feed^",
        "^sessionid=", "^jsessionid=", "^replytocom=", "||ads.*", "||adserver.*", "/advert^",
        ".zip^", ".gz^", ".exe^", ".iso^", ".dmg^", ".apk^", ".mp4^", ".jpg^", ".png^", ".css^", ".js^",
    )
)


def op7_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page's url under the host rules, then the patterns."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = judge_urls(pages, HOST_RULES, PATTERNS)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '://[^/?#]*[^?#]*(\?[^#]*)', 1), '') AS query
  FROM pages),
rules(action, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
patterns(pattern, regex) AS (VALUES SQL_PATTERNS),
urls AS (SELECT DISTINCT host, path, query FROM parts),
ruled AS (
  SELECT host, path, query, max({'n': length(rule_host) + length(rule_path),
    'rule': rule_host || rule_path, 'action': action}) AS best
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY ALL),
fitted AS (
  SELECT host, path, query, max(pattern) AS pattern FROM urls JOIN patterns
    ON regexp_matches(translate(host || path || query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), regex) GROUP BY ALL)
SELECT page_id, host, path, best.rule AS rule,
  CASE WHEN best IS NOT NULL THEN best.action WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END
    AS verdict, CASE WHEN best IS NULL THEN pattern END AS pattern
FROM parts LEFT JOIN ruled USING (host, path, query) LEFT JOIN fitted USING (host, path, query)
""".replace("SQL_PATTERNS", ", ".join(f"('{r.pattern}', '{r.regex}')" for r in PATTERNS))
