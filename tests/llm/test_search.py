"""Ranked lexical search against a plain version."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberlog.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda c: c.group().lower(), text or "")


def by_scan(docs, items, k):
    counted = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item_id, text in set(items):
        scored = []
        for i, c in counted:
            n = sum(c.values())
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(TERM.findall(lower(text)))
                if t in c
            )
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out.update((item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k]))
    return out


def corpus(seed=5, n=300):
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "d3lta", "été", "ÉTÉ", "zeta x", "eta", "theta", "iota", "kappa", "中文", "x_y", "a-b"]
    text = lambda n: " ".join(r.choices(words, weights=range(1, len(words) + 1), k=n))
    docs = [(i, text(r.choice([1, 2, 5, 5, 5, 40, 400]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " ,.;"), (None, "alpha beta"), (None, "alpha"), (3, "alpha"), *docs[:7], *docs[:7]]
    items = [(i, text(r.randint(1, 9))) for i in range(25)]
    items += [(90, None), (91, "?!"), (92, "nowhere"), (93, "alpha ALPHA Alpha"), (93, "beta"), (None, "gamma"), items[0]]
    return docs, items


@pytest.mark.parametrize(("k", "shard", "block_bytes"), [(50, 2_000_000, 8_000_000), (3, 200, 300)])
def test_ranks_and_scores_are_those_of_a_scan(rows, monkeypatch, k, shard, block_bytes):
    monkeypatch.setattr(ranked_search, "FIRST_VISIT", 4)  # several visits even here
    docs, items = corpus()
    got = ranked_search.ranked(rows(docs, clash=True), rows(items, "item_id bigint, text string", clash=True), k, shard, block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(x) for x in got.collect()) == by_scan(docs, items, k)


def test_equal_documents_fill_the_ranks_by_id(rows):
    docs = [(i, "same words here") for i in range(200, 0, -1)] + [(500, "other"), (501, "things")]
    got = ranked_search.ranked(rows(docs), rows([(1, "same here")], "item_id bigint, text string"))
    assert [(x["rank"], x["doc_id"]) for x in got.orderBy("rank").collect()] == [(i, i) for i in range(1, 51)]


def test_empty_tables(rows):
    item = rows([(1, "a")], "item_id bigint, text string")
    assert ranked_search.ranked(rows([]), item).count() == 0
    assert ranked_search.ranked(rows([(1, None)]), item).count() == 0
    assert ranked_search.ranked(rows([(1, "a")]), rows([], "item_id bigint, text string")).count() == 0


def test_strata_that_cannot_win_are_not_scored():
    r = np.random.default_rng(1)
    m = np.sort(r.integers(50, 90, 4000))
    doc = np.arange(4000)
    shard = ranked_search.Shard(m, doc, np.zeros(4000, np.int64), np.ones(4000, np.int64))
    docs, scores = shard.best(np.array([0]), np.array([7]), doc, 10)
    assert docs.tolist() == list(range(10)) and len(set(scores.tolist())) == 1
    # the strata are bounded by one impact each
    assert len(shard.group_bound) == len(np.unique(m))
    assert shard.group_bound.tolist() == [1_000_000_000 // (1000 + 20 * x) for x in shard.normalisers]
    by_stratum = defaultdict(set)
    for g, s in zip(shard.group_bound.tolist(), shard.group_stratum.tolist(), strict=True):
        by_stratum[s].add(g)
    assert all(len(g) == 1 for g in by_stratum.values())
