"""Conversation repair against a plain dynamic program."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from emberlog.llm import conversations

NEXT = conversations.NEXT
WORD = re.compile(r"[^\x20\x09-\x0D]")


def by_program(letters):
    """Least (cost, audit) over whole strings, row by row."""
    fits, labels = conversations.FITS, {0: (0, "")}

    def with_inserts(found):
        for _ in range(3):
            for q, (c, a) in list(found.items()):
                found[NEXT[q]] = min(found.get(NEXT[q], (10**9, "")), (c + 3, a + "I"))
        return found

    labels = with_inserts(labels)
    for code in (ord(x) - ord("A") for x in letters):
        initial, fault = code % 4, code // 4
        new = {}
        for q, (c, a) in labels.items():
            ways = [(q, (c + 4, a + "D"))]
            if fault < 2:
                ways.append((NEXT[q], (c + 3 + 3 * fault, a + "R")))
                if fits[q][initial] is not None:
                    ways.append((fits[q][initial], (c + 3 * fault, a + "K")))
            for to, label in ways:
                new[to] = min(new.get(to, label), label)
        labels = with_inserts(new)
    return min(labels[q] for q in (0, 3) if q in labels)


def test_all_short_conversations():
    for n in range(5):
        for letters in map("".join, itertools.product("ABCDFGM", repeat=n)):
            assert conversations.cheapest_edits(letters) == by_program(letters), letters


def test_longer_conversations():
    r = random.Random(2)
    for _ in range(500):
        letters = "".join(r.choice("ABCDBCBCBCBCEFGHIJKLMNOP") for _ in range(r.randint(5, 70)))
        assert conversations.cheapest_edits(letters) == by_program(letters), letters
    assert conversations.cheapest_edits("BC" * 5000) == (0, "K" * 10000)


def by_rows(rows):
    """What the operator says of each conversation, row by row in plain Python."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, held in found.items():
        held.sort(key=lambda x: (*x[:3], hashlib.md5(x[3].encode()).digest()))
        seen, letters = set(), ""
        for _, _, role, text in held:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            fault = 2 if not WORD.search(text) else 3 if (role, text) in seen else 0 if last in set(".!?") else 1
            seen.add((role, text))
            letters += chr(65 + "sua".find(role[:1]) % 4 * (role != "") + 3 * (role == "") + 4 * fault)
        initials = [role[:1] for _, _, role, _ in held]
        turns = [t for known, t, _, _ in held if known]
        cost, audit = by_program(letters)
        state, lines, left = 0, [], iter(held)
        for edit in audit:
            _, _, role, text = next(left) if edit != "I" else (0, 0, "", "")
            if edit == "D":
                continue
            state = 1 if edit == "K" and state == 0 and role[:1] == "s" else 3 if state == 2 else 2
            lines.append((role if edit == "K" else "user" if state == 2 else "assistant") + ":" + text)
        faults = [(ord(x) - 65) // 4 for x in letters]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(2), faults.count(3), faults.count(1),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def answers(df):
    plans, repaired = conversations.repaired_conversations(df)
    done = plans.join(conversations.conversation_digests(repaired), "conv_no", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return {
        x["conv_id"]: (x["gaps"], x["blank"], x["duplicate"], x["truncated"], x["illegal"], x["cost"], x["audit"], x["sha256"] or empty)
        for x in done
    }


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def made_up(seed=7):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut of", "cut. ", "", " \n", None, "Ünïcode 中文.", "a\nb."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    rows = [
        (conv, r.choice([None, *range(9)]), r.choice(roles), r.choice(texts))
        for conv in [None, *range(40)]
        for _ in range(r.randint(1, 14))
    ]
    rows += [(50, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(400)]  # a hot and clean one
    rows += [(51, 3, "user", "Same.")] * 300  # one row over and over
    rows += [(52, None, None, None), (53, 1, "user", "word " * 30_000 + "."), *rows[:5]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_faults_edits_and_outcome(rows, spark, partitions):
    data = made_up()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == 1).lower())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert answers(rows(data, SCHEMA, clash=True).repartition(3)) == by_rows(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_rows(rows):
    data = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", ""), (2, 0, "user", " ")]
    plans, repaired = conversations.repaired_conversations(rows(data, SCHEMA))
    no = {x["conv_id"]: x["conv_no"] for x in plans.collect()}
    got = sorted(tuple(x) for x in repaired.collect())
    assert got == [(no[1], 0, "K", "system", "Be kind."), (no[1], 1, "I", "user", ""), (no[1], 2, "K", "assistant", "Hi.")]
    assert {x["conv_id"]: x["audit"] for x in plans.collect()} == {1: "KIKD", 2: "D"}


def test_empty_table_and_damage(rows):
    plans, repaired = conversations.repaired_conversations(rows([], SCHEMA))
    assert plans.count() == 0 and conversations.conversation_digests(repaired).count() == 0
    import zlib

    data = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, *range(40)) for r, x in (("system", "A. b? c!"), (None, None))]
    want = []
    for c, t, r, x in data:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        row = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, (tuple(x) for x in conversations.damaged(rows(data, SCHEMA)).collect()))) == sorted(map(str, want))
