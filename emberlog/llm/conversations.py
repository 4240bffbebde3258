"""Conversation structure repair by a bidirectional Dijkstra over the edit lattice.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: nothing, or user and assistant by
turns, after a system row if there is one. Blank rows and rows that repeat an earlier role and text must go;
a row cut off before its last full stop costs extra if it stays. Edits of a row: Keep 0, Rerole to user or assistant 3,
Delete 4; a row without text may be Inserted anywhere for 3.

* A lattice node is (rows used, state of the pattern). A forward search from the start and a reverse one
  from the two ends go on by least cost until no cheaper or equally cheap meeting is left; of all crossings of the
  least cost the one whose two halves make the least audit is taken. No search holds more than one label a
  node, and none sees texts: a row is one letter for its initial and its fault.
* Rows are dealt and sorted by ranges of (conversation, turn), so that one conversation may spread over many
  tasks. First occurrences are a grouping by digest; letters are gathered per (conversation, task), then
  per conversation, which is as long as the audit that it asks for.
* Edits meet the texts again in one shuffle by conversation, as a sorted stream that holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import own, pin, table

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
BLANKS = " \t\n\x0b\f\r"
#: A row's letter is the initial's place in "sua?" plus four times its fault.
WHOLE, TRUNCATED, BLANK, DUPLICATE = range(4)
FIRST_LETTER = ord("A")
#: States of the pattern: nothing yet, after s, after u, after ua. What a user or assistant row leads to:
NEXT = (2, 2, 3, 2)
#: Where an initial (s, u, a, other) leads to, if it fits.
FITS = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
ENDS = (0, 3)
#: Conversations up to this length are remembered by a task, so many of them.
SHORT, REMEMBERED = 64, 200_000


class Search:
    """One direction of the search: labels, settled nodes, and the heap, nearest to the own end first."""

    def __init__(self, roots: list[int], sign: int) -> None:
        self.cost = dict.fromkeys(roots, 0)
        self.step: dict[int, tuple[int, str]] = {}  # the node before (or behind) and the edit in between
        self.depth = dict.fromkeys(roots, 0)
        self.settled: set[int] = set()
        # among equal costs those nearer to the roots first: a Keep costs nothing and moves on by one row
        self.sign = sign
        self.heap = sorted((0, sign * r, r) for r in roots)

    def top(self) -> float:
        while self.heap and self.heap[0][2] in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def reach(self, node: int, cost: int, by: int, edit: str) -> None:
        known = self.cost.get(node)
        if known is not None and (known < cost or (known == cost and (node not in self.step or not self.better(by, edit, *self.step[node])))):
            return
        if known != cost:
            heappush(self.heap, (cost, self.sign * node, node))
        self.cost[node], self.step[node], self.depth[node] = cost, (by, edit), self.depth[by] + 1

    def better(self, a: int, x: str, b: int, y: str) -> bool:
        raise NotImplementedError

    def edits(self, node: int) -> list[str]:
        out = []
        while node in self.step:
            node, edit = self.step[node]
            out.append(edit)
        return out


class Forward(Search):
    def better(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether the edits up to ``a``, then ``x``, come before those up to ``b``, then ``y``: at the fork of both ways."""
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a, x = self.step[a]
            else:
                b, y = self.step[b]
        return x < y


class Reverse(Search):
    def better(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether ``x``, then the edits from ``a`` on, come before ``y``, then those from ``b`` on."""
        while x == y and a != b and a in self.step and b in self.step:
            (a, x), (b, y) = self.step[a], self.step[b]
        return x < y


def cheapest_edits(letters: str) -> tuple[int, str]:
    """Least cost and the ASCII-least audit of that cost for the rows ``letters``."""
    rows = [(c % 4, c // 4) for c in (ord(x) - FIRST_LETTER for x in letters)]
    n = len(rows)
    ahead, back = Forward([0], 1), Reverse([4 * n + q for q in ENDS], -1)

    def choices(row: int, state: int) -> Iterator[tuple[int, int, str]]:
        """(state, cost, edit) of the edits that use the row."""
        initial, fault = rows[row]
        yield state, DELETE, "D"
        if fault in (WHOLE, TRUNCATED):
            extra = CUT if fault == TRUNCATED else 0
            if FITS[state][initial] is not None:
                yield FITS[state][initial], extra, "K"
            yield NEXT[state], REROLE + extra, "R"

    best = float("inf")
    while (f := ahead.top()) + (r := back.top()) <= best:
        side = ahead if f <= r else back
        cost, _, node = heappop(side.heap)
        side.settled.add(node)
        if node in ahead.cost and node in back.cost:
            best = min(best, ahead.cost[node] + back.cost[node])
        row, state = divmod(node, 4)
        if side is ahead:
            ahead.reach(4 * row + NEXT[state], cost + INSERT, node, "I")
            if row < n:
                for to, price, edit in choices(row, state):
                    ahead.reach(4 * (row + 1) + to, cost + price, node, edit)
        else:
            for p in range(4):
                if NEXT[p] == state:
                    back.reach(4 * row + p, cost + INSERT, node, "I")
                if row:
                    for to, price, edit in choices(row - 1, p):
                        if to == state:
                            back.reach(4 * (row - 1) + p, cost + price, node, edit)
    crossings = {v for v in ahead.settled if v in back.cost and ahead.cost[v] + back.cost[v] == best}
    # where the way into a crossing leaves another one, that other one's halves say it all
    apart = [v for v in crossings if v not in back.settled or v not in ahead.step or ahead.step[v][0] not in crossings]
    return int(best), min("".join(ahead.edits(v)[::-1] + back.edits(v)) for v in apart)


remembered = lru_cache(REMEMBERED)(cheapest_edits)


def findings(letters: str) -> dict:
    """Counts of faults and of illegal neighbours, least cost and audit of one conversation."""
    codes = [ord(x) - FIRST_LETTER for x in letters]
    faults = [c // 4 for c in codes]
    initials = "".join("sua?"[c % 4] for c in codes)
    cost, audit = (remembered if len(letters) <= SHORT else cheapest_edits)(letters)
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1)),
        "cost": cost,
        "audit": audit,
    }


FOUND = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def findings_column(parts: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([findings("".join(p["letters"] for p in found)) for found in batch], columns=[c.split()[0] for c in FOUND.split(", ")])

    return F.pandas_udf(run, FOUND)(parts)


def placed_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest, seq): a stored table in which ``seq`` orders all rows by conversation,
    turn (null first), role and the text's digest. Nulls in role or text read as one space."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    given = rows.select(F.struct("conv_id").alias("conv"), "turn", blank("role"), blank("text"), F.monotonically_increasing_id().alias("at"))
    given = given.withColumn("digest", F.unhex(F.md5("text")))
    # equal rows differ in ``at`` alone, so that a crowd of them spreads too
    order = ["conv.conv_id", "turn", "role", "digest", "at"]
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order)
    return pin(dealt.select("conv", "turn", "role", "text", "digest", F.monotonically_increasing_id().alias("seq")), "turns")


def conversation_plans(placed: DataFrame) -> DataFrame:
    """One row per conversation of ``placed_rows``: conv, conv_no, parts, gaps, and what ``findings`` says.

    ``conv_no`` is the first ``seq``, ``parts`` holds (seq, letters) of its stretches of consecutive ``seq``.
    """
    bare = F.btrim("text", F.lit(BLANKS))
    initial = F.position(F.substring("role", 1, 1), F.lit("sua")) - 1
    rows = placed.select(
        "conv", "role", "digest", "seq", (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when((F.col("role") == "") | (initial < 0), F.lit(3)).otherwise(initial).alias("initial"),
    )
    key = ["conv", "role", "digest"]
    first = rows.groupBy(*key).agg(F.min("seq").alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("seq") > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(WHOLE)
    letter = F.chr(F.lit(FIRST_LETTER) + F.col("initial") + 4 * fault)
    lettered = rows.join(first, key).select("conv", "seq", letter.alias("letter"))
    stretch = F.array_sort(F.collect_list(F.struct("seq", "letter")))
    parts = lettered.groupBy("conv", F.shiftright("seq", 33).alias("task")).agg(
        F.min("seq").alias("seq"), F.array_join(F.transform(stretch, lambda x: x["letter"]), "").alias("letters")
    )
    whole = parts.groupBy("conv").agg(
        F.min("seq").alias("conv_no"), F.array_sort(F.collect_list(F.struct("seq", "letters"))).alias("parts")
    )
    turns = placed.select("conv", "turn").where("turn IS NOT NULL").distinct().groupBy("conv")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("bigint").alias("gaps"))
    found = whole.withColumn("found", findings_column(F.col("parts")))
    return found.join(gaps, "conv", "left").select("conv", "conv_no", "parts", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), "found.*")


EDITS = "conv_no bigint, owner bigint, seq bigint, kind tinyint, step int, edit string, role string"


def edit_rows(plans: DataFrame) -> DataFrame:
    """Keep, Rerole and Insert of every plan in order (``EDITS``); an Insert stands with the row behind it, or
    as kind 2 behind the last one. ``role`` is null where the row's own stays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in EDITS.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for conv_no, owner, parts, audit in zip(batch["conv_no"], batch["owner"], batch["parts"], batch["audit"], strict=True):
                seqs = (p["seq"] + i for p in parts for i in range(len(p["letters"])))
                letters = iter("".join(p["letters"] for p in parts))
                state, seq, kind = 0, next(seqs), 0
                for step, edit in enumerate(audit):
                    at, at_kind = seq, kind
                    if edit != "I":
                        initial = (ord(next(letters)) - FIRST_LETTER) % 4
                        following = next(seqs, None)
                        seq, kind = (seq, 2) if following is None else (following, 0)
                    if edit == "D":
                        continue
                    state = FITS[state][initial] if edit == "K" else NEXT[state]
                    role = None if edit == "K" else ("user" if state == 2 else "assistant")
                    out.append((conv_no, owner, at, at_kind, step, edit, role))
                    if len(out) >= 100_000:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    return plans.select("conv_no", F.xxhash64("conv").alias("owner"), "parts", "audit").mapInPandas(run, EDITS)


REPAIRED = "conv_no bigint, step int, edit string, role string, text string"


def repaired_rows(placed: DataFrame, plans: DataFrame) -> DataFrame:
    """The conversations as repaired (``REPAIRED``), each in order and in one piece within its partition."""
    edits = edit_rows(plans).withColumn("text", F.lit(None).cast("string"))
    texts = placed.select(
        F.lit(None).cast("bigint").alias("conv_no"), F.xxhash64("conv").alias("owner"), "seq", F.lit(1).cast("tinyint").alias("kind"),
        F.lit(None).cast("int").alias("step"), F.lit(None).cast("string").alias("edit"), "role", "text",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in REPAIRED.split(", ")]
        waiting = None
        for batch in batches:
            out = []
            for conv_no, seq, kind, step, edit, role, text in zip(
                *(batch[c] for c in ("conv_no", "seq", "kind", "step", "edit", "role", "text")), strict=True
            ):
                if edit == "I":
                    out.append((int(conv_no), int(step), edit, role, ""))
                elif kind == 0:
                    waiting = (int(conv_no), int(step), edit, role, seq)
                elif waiting is not None and waiting[4] == seq:
                    out.append((*waiting[:3], waiting[3] if waiting[3] is not None else role, text))
                    waiting = None
            yield pd.DataFrame(out, columns=columns).astype({"conv_no": "int64", "step": "int32"})

    # conv_no travels as text: pandas turns whole numbers with nulls into floats
    both = edits.select("conv_no", "owner", "seq", "kind", "step", "edit", "role", "text").unionByName(texts)
    both = both.withColumn("conv_no", F.col("conv_no").cast("string"))
    return both.repartition("owner").sortWithinPartitions("seq", "kind", "step").mapInPandas(run, REPAIRED)


def repaired_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plans and repaired rows of conversations (conv_id, turn, role, text).

    The first has a row per conversation with ``conv_id``, ``conv_no``, the counts, ``cost`` and ``audit``; the
    second a row per row that stays or is inserted: conv_no, step (place in the audit), edit, role, text.

    Rows are taken by turn, null first; rows of one turn by role, then by the MD5 of the text, so equal rows stand
    side by side and all but the first are duplicates. Nulls in role or text read as one space; null ids are one
    conversation. A role that starts neither with s, u nor a, or is empty, never fits. Rows of any length count
    whole. Other columns are not read; an empty table has no conversations.
    """
    placed = placed_rows(rows)
    plans = pin(conversation_plans(placed), "plans")
    return plans.select(F.col("conv.conv_id").alias("conv_id"), *[c for c in plans.columns if c not in ("conv", "parts")]), repaired_rows(placed, plans)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_no, sha256) of the repaired rows as ``role:text`` lines. A digest is one chain over its
    conversation, so it is worked out as the rows stream by, right where they were repaired."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, chain = None, None
        for batch in batches:
            out = []
            for conv_no, role, text in zip(batch["conv_no"], batch["role"], batch["text"], strict=True):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if conv_no == now:
                    chain.update(b"\n" + line)
                else:
                    if now is not None:
                        out.append((now, chain.hexdigest()))
                    now, chain = conv_no, hashlib.sha256(line)
            if out:
                yield pd.DataFrame(out, columns=["conv_no", "sha256"])
        if now is not None:
            yield pd.DataFrame([(now, chain.hexdigest())], columns=["conv_no", "sha256"])

    return repaired.mapInPandas(run, "conv_no bigint, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with one row in five spoilt, by the checksum of ``conv_id:turn``; nulls read as one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")), F.lit(20))
    role, text = shown("role"), shown("text")
    spoilt = rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return spoilt.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.nullif("times", F.lit(0)))).alias("copy")).drop("copy")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: its faults, the cheapest edits and a digest of the outcome."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    plans, repaired = repaired_conversations(damaged(rows))
    digests = conversation_digests(repaired)
    id_, none = own("id"), F.sha2(F.lit("").cast("binary"), 256)
    done = plans.join(digests, "conv_no", "left").withColumnRenamed("conv_id", id_)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    all_ = rows.select("conv_id").distinct()
    return all_.join(done, all_["conv_id"].eqNullSafe(done[id_]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", none).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The same by recursion over the rows: four labels a row, each ten digits of cost and the audit."""

    def plus(label: str, cost: str, edit: str) -> str:
        return f"lpad((left({label}, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({label}, 11) || '{edit}'"

    def when(test: str, *labels: str) -> str:
        return f"CASE WHEN {test} THEN least({', '.join(labels)}, NULL) END"

    stays, extra = "fault IN ('', 't')", "(CASE fault WHEN 't' THEN 3 ELSE 0 END)"
    keep, rerole = (lambda s: plus(s, extra, "K")), (lambda s: plus(s, f"3 + {extra}", "R"))
    before_user = ["s0", "s1", "s3"]
    return f"""
WITH RECURSIVE shown AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
),
summed AS (
    SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT)),
        lambda s, b: xor(s >> 8, list_reduce(list_concat([xor(s, b) & 255], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))), 4294967295) % 20 AS kind
    FROM shown
),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM summed
),
coded AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS ini,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
           CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'd'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS fault
    FROM damaged
),
pairs AS (SELECT *, ini || lead(ini) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM coded),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           count(*) AS n
    FROM pairs GROUP BY conv_id
),
labels AS (
    SELECT conv_id, 0::BIGINT AS i, '0000000000' AS s0, NULL::VARCHAR AS s1, '0000000003I' AS s2, '0000000006II' AS s3 FROM counted
    UNION ALL
    SELECT conv_id, i, n0, n1, least(n2, {plus("n0", "3", "I")}, {plus("n1", "3", "I")}, {plus("n3", "3", "I")}),
           least(n3, {plus("n2", "3", "I")}, {plus("n0", "6", "II")}, {plus("n1", "6", "II")})
    FROM (
        SELECT l.conv_id, c.i, {plus("s0", "4", "D")} AS n0,
               least({plus("s1", "4", "D")}, {when(stays + " AND ini = 's'", keep("s0"))}) AS n1,
               least({plus("s2", "4", "D")}, {when(stays + " AND ini = 'u'", *map(keep, before_user))},
                     {when(stays, *map(rerole, before_user))}) AS n2,
               least({plus("s3", "4", "D")}, {when(stays + " AND ini = 'a'", keep("s2"))}, {when(stays, rerole("s2"))}) AS n3
        FROM labels l JOIN coded c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.i = l.i + 1
    )
),
audits AS (
    SELECT c.*, left(least(s0, s3), 10)::BIGINT AS cost, substr(least(s0, s3), 11) AS audit
    FROM counted c JOIN labels l ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.n = l.i
),
played AS (
    SELECT conv_id, audit, 0::BIGINT AS step, 0::BIGINT AS i, 0 AS q, NULL::VARCHAR AS line FROM audits
    UNION ALL
    SELECT conv_id, audit, step + 1, j, r,
           CASE e WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
                  ELSE CASE r WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE e WHEN 'I' THEN '' ELSE text END END
    FROM (
        SELECT *, CASE WHEN e = 'D' THEN q WHEN e = 'K' AND q = 0 AND ini = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END AS r
        FROM (
            SELECT p.conv_id, p.audit, p.step, p.q, p.e, p.j, c.role, c.text, c.ini
            FROM (SELECT *, substr(audit, step + 1, 1) AS e, i + CASE substr(audit, step + 1, 1) WHEN 'I' THEN 0 ELSE 1 END AS j
                  FROM played WHERE step < length(audit)) p
            LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = p.j
        )
    )
),
hashed AS (
    SELECT conv_id, sha256(coalesce(string_agg(line, chr(10) ORDER BY step), '')) AS sha FROM played GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP11_SQL = _sql()
