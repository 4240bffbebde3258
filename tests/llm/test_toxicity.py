"""Toxicity scores: the index against a scan, calibration, held-out accuracy, and edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from emberlog.llm import toxicity

SF = "/root/testdata/sf0.1"


def random_vectors(seed, n, n_terms):
    r = random.Random(seed)
    idf = np.array([1 + r.random() * 5 for _ in range(n_terms)])
    counts = [{r.randrange(n_terms): r.randint(1, 4) for _ in range(r.randint(1, 9))} for _ in range(n)]
    return [toxicity.unit(c, idf) for c in counts + counts[: n // 3]], idf


@pytest.mark.parametrize("k", [1, 5, 15])
def test_nearest_examples_are_those_of_a_scan(k):
    vectors, _ = random_vectors(3, 300, 40)
    ids = [7 * i % 1000 for i in range(len(vectors))]
    index = toxicity.BlockIndex(vectors, ids, [i % 2 for i in range(len(vectors))], 40)
    queries, _ = random_vectors(4, 60, 40)
    for q in queries + vectors[:40]:
        found, cosine = index.nearest(np.array(list(q)), np.array(list(q.values())), k)
        plain = sorted(((-sum(w * v.get(t, 0) for t, w in q.items()), i) for v, i in zip(vectors, ids, strict=True)))
        plain = [(-c, i) for c, i in plain if c < 0][:k]
        assert np.allclose(cosine, [c for c, _ in plain], atol=1e-12)
        # equal cosines may differ in the last bit between the two ways of adding up
        sure = [i for c, i in plain if sum(abs(c - d) < 1e-9 for d, _ in plain) == 1 and c > plain[-1][0] + 1e-9]
        assert set(sure) <= set(index.ids[found].tolist())


def test_copies_win_by_id():
    index = toxicity.BlockIndex([{0: 1.0}] * 200, list(range(500, 300, -1)), [1] * 200, 1)
    found, cosine = index.nearest(np.array([0]), np.array([1.0]), 15)
    assert index.ids[found].tolist() == list(range(301, 316)) and np.allclose(cosine, 1)
    found, _ = index.nearest(np.array([0]), np.array([1.0]), 15, without=found[0])
    assert index.ids[found].tolist() == list(range(302, 317))


def test_calibration_rises_and_fits():
    r = np.random.default_rng(0)
    votes = r.random(500).round(2)
    labels = (r.random(500) < votes**2).astype(int)
    least, rates = toxicity.rising(votes, labels, 0.3)
    assert (np.diff(rates) >= 0).all() and (np.diff(least) > 0).all() and 0 <= rates[0] and rates[-1] <= 1
    # the pooled means are those of the best non-decreasing fit: max-min formula
    values = np.unique(votes)
    ones = np.array([labels[votes == v].sum() for v in values], dtype=float)
    n = np.array([(votes == v).sum() for v in values], dtype=float)
    for i in range(0, len(values), 7):
        best = max(min(ones[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(values))) for a in range(i + 1))
        step = max(0, int(np.searchsorted(least, values[i], side="right")) - 1)
        inside = (votes >= least[step]) & (votes < (least[step + 1] if step + 1 < len(least) else 2))
        assert math.isclose(labels[inside].mean(), best, abs_tol=1e-9)


def test_terms_and_frequencies_are_those_of_a_scan(rows):
    r = random.Random(1)
    filler = [f"w{i}" for i in range(30)]
    texts = []
    for i in range(200):
        words = r.choices(filler, k=12) + (["Idiot", "morons"] if i % 8 == 0 else []) + (["kind"] if i % 8 else [])
        texts.append((i, int(i % 8 == 0), " ".join(words)))
    examples = rows(texts, "id bigint, y int, text string")
    terms = toxicity.telling_terms(examples)
    assert set(terms) == {b"idiot", b"idio*", b"morons", b"moro*", b"moron*", b"kind"}
    counted = [toxicity.all_terms(t) for _, _, t in texts]
    total, df = toxicity.document_frequencies(examples, terms)
    assert total == 200 and df.tolist() == [sum(t in c for c in counted) for t in terms]
    got = {x["id"]: x["counts"] for x in toxicity.term_vectors(examples, terms).collect()}
    assert got == {i: {j: c[t] for j, t in enumerate(terms) if t in c} for (i, _, _), c in zip(texts, counted, strict=True)}


def test_held_out_accuracy_and_evidence(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model).join(labels.select("doc_id", "toxic"), "doc_id")
    got = scored.where(toxicity.held_out(scored.doc_id)).select("doc_id", "toxic", "score", "predicted", "evidence").collect()
    right = Counter((x["toxic"], x["predicted"]) for x in got)
    assert right[0, 0] >= 0.99 * (right[0, 0] + right[0, 1])
    assert right[1, 1] >= 0.8 * (right[1, 0] + right[1, 1])
    import zlib

    for x in got:
        assert 0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.7)
        cosines = [e["cosine"] for e in x["evidence"]]
        assert cosines == sorted(cosines, reverse=True)
        assert all(zlib.crc32(str(e["doc_id"]).encode()) % 3 != 1 for e in x["evidence"])
    assert any(x["evidence"] for x in got)


def test_edge_cases(rows, spark):
    labels = rows([(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (7, None), (8, 3)], "doc_id bigint, toxic int")
    texts = [(i, "you idiot scum" if i % 5 == 0 else "a fine day") for i in range(300)]
    odd = [(900, None), (901, ""), (902, "scum " * 40_000), (None, "idiot"), (904, "nothing known"), *texts[:5]]
    docs = rows(texts + odd, clash=True)
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    assert {"id", "row", "score", "predicted", "evidence"} <= set(scored.columns)
    assert len(scored.columns) == len(set(scored.columns))
    got = {x["doc_id"]: x for x in scored.collect()}
    assert got[902]["predicted"] == 1 and got[None]["predicted"] == 1 and got[0]["predicted"] == 1
    assert [got[i]["predicted"] for i in (900, 901, 904, 1)] == [0, 0, 0, 0]
    assert got[900]["evidence"] == [] and got[900]["score"] == got[901]["score"]
    assert scored.count() == len(texts + odd)
    assert toxicity.score_toxicity(rows([]), model).count() == 0
    nobody = toxicity.train(rows([]), labels)
    assert {x["score"] for x in toxicity.score_toxicity(docs, nobody).collect()} == {0.0}
    one_class = toxicity.train(docs, labels.where("toxic = 0"))
    assert {x["predicted"] for x in toxicity.score_toxicity(docs, one_class).collect()} == {0}


def test_examples_are_bounded(rows):
    labels = rows([(i, int(i % 5 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    docs = rows([(i, f"idiot {i}" if i % 5 == 0 else f"fine {i}") for i in range(300)] * 2)
    assert len(toxicity.train(docs, labels, max_rows=90).index.ids) <= 90
