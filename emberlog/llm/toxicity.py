"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

* Examples are at most ``MAX_EXAMPLES`` labelled documents outside the held-out fold. The terms of the vector
  space are words, and beginnings of words, that tell the labels apart in them: a log-likelihood ratio of at least
  ``RATIO`` and odds of label 1 ``LIFT`` times above or below the common ones. Document frequencies are counted
  over all documents.
* The examples stand in an inverted index, similar ones side by side, in blocks of ``BLOCK``. Each posting list knows
  its largest weight per block; with them a document bounds its cosine to every block, visits the blocks from
  the highest bound down, and stops when no block can reach its ``k``-th nearest example.
* The nearest examples vote with weights that fall with their distance. Votes that the examples get from each
  other, each without its own, give the monotone table that turns votes into calibrated scores. A document
  without any of the terms has no neighbours; its score is the rate of label 1 among such examples.

The index and the tables are of bounded size and go to every task; documents are scored where they are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import pin, ranges, table, terms_of

#: Bound on the labelled rows that the examples are taken from.
MAX_EXAMPLES = 20_000
#: Bytes of the word beginnings that are terms besides the words.
BEGINNINGS = (4, 5, 6)
#: Bound on the terms of the space; the highest log-likelihood ratios stay.
MAX_TERMS = 20_000
NEAREST = 15
BLOCK = 32
RATIO = 20.0
LIFT = 20.0
#: Examples that a term occurs in at least.
LEAST = 3
#: Distance added to all, so that an equal example does not outvote everything.
SOFT = 0.1
#: Answers a task remembers; documents with equal vectors have equal answers.
REMEMBERED = 50_000


def all_terms(text: str | None) -> Counter[bytes]:
    """The words of a text and, marked with a star, the beginnings of longer ones, with their counts."""
    counts = Counter(terms_of(text))
    for word, n in list(counts.items()):
        for size in BEGINNINGS:
            if len(word) > size:
                counts[word[:size] + b"*"] += n
    return counts


def held_out(doc_id: Column) -> Column:
    """The fold that no example comes from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


class BlockIndex:
    """Unit vectors of examples behind block-max posting lists."""

    def __init__(self, vectors: list[dict[int, float]], ids: list[int], labels: list[int], n_terms: int) -> None:
        # examples with the same strongest terms share blocks, which keeps the blocks' bounds low
        def likeness(i: int) -> tuple:
            return (sorted(vectors[i], key=lambda t: (-vectors[i][t], t)), ids[i])

        order = sorted(range(len(vectors)), key=likeness)
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.labels = np.array([labels[i] for i in order], dtype=np.int64)
        self.place = np.empty(len(order), np.int64)  # ties go to the smaller id
        self.place[np.lexsort((np.arange(len(order)), self.ids))] = np.arange(len(order))
        entries = sorted((t, x, w) for x, i in enumerate(order) for t, w in vectors[i].items())
        term = np.array([e[0] for e in entries], dtype=np.int64)
        self.example = np.array([e[1] for e in entries], dtype=np.int64)
        self.weight = np.array([e[2] for e in entries], dtype=np.float64)
        block = self.example // BLOCK
        new = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(block, prepend=-1))
        self.list_block, self.list_start = block[new], new
        self.list_size = np.diff(np.append(new, len(term)))
        self.list_most = np.maximum.reduceat(self.weight, new) if len(new) else np.empty(0)
        self.of_term = np.searchsorted(term[new], np.arange(n_terms + 1))
        self.n_blocks = -(-len(order) // BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples and cosines of the ``k`` nearest by (cosine descending, id), only cosines above 0; ``terms`` ascend."""
        low, sizes = self.of_term[terms], self.of_term[terms + 1] - self.of_term[terms]
        lists, own = ranges(low, sizes), np.repeat(weights, sizes)
        bound = np.bincount(self.list_block[lists], own * self.list_most[lists], self.n_blocks)
        visits = np.argsort(-bound, kind="stable")
        visits = visits[bound[visits] > 0]
        found, cosine = np.empty(0, np.int64), np.empty(0)
        at, wanted = 0, 2
        while at < len(visits):
            # an equal cosine may still win by its id
            reach = len(visits)
            if len(found) >= k:
                reach = int(np.searchsorted(-bound[visits], -cosine[k - 1], side="right"))
            stop = min(reach, at + wanted)
            if stop <= at:
                break
            chosen = np.zeros(self.n_blocks, bool)
            chosen[visits[at:stop]] = True
            inside = chosen[self.list_block[lists]]
            taken, sizes = lists[inside], self.list_size[lists[inside]]
            posts = ranges(self.list_start[taken], sizes)
            total = np.bincount(self.example[posts], np.repeat(own[inside], sizes) * self.weight[posts], len(self.ids))
            new = np.flatnonzero(total)
            new = new[new != without]
            found, cosine = np.append(found, new), np.append(cosine, total[new])
            order = np.lexsort((self.place[found], -cosine))[:k]
            found, cosine = found[order], cosine[order]
            at, wanted = stop, wanted * 4
        return found, cosine


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    """Weights (1 + ln tf) * idf by ascending term, of length 1."""
    raw = {t: (1 + np.log(counts[t])) * idf[t] for t in sorted(counts)}
    length = np.sqrt(sum(w * w for w in raw.values()))
    return {t: float(w / length) for t, w in raw.items()}


def rising(votes: np.ndarray, labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of least square error: least votes and rates of its steps.

    Pool adjacent violators; every step counts one row of ``prior`` besides its own.
    """
    values, at = np.unique(votes, return_inverse=True)
    ones, n = np.bincount(at, labels, len(values)), np.bincount(at, minlength=len(values))
    pooled: list[list[float]] = []  # least vote, ones, rows
    for step in zip(values.tolist(), ones.tolist(), n.tolist(), strict=True):
        pooled.append(list(step))
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][2] >= pooled[-1][1] * pooled[-2][2]:
            _, hits, size = pooled.pop()
            pooled[-1][1] += hits
            pooled[-1][2] += size
    rates = np.array([(hits + prior) / (size + 1) for _, hits, size in pooled])
    return np.array([s[0] for s in pooled]), np.maximum.accumulate(rates) if len(rates) else rates


@dataclass
class Model:
    """Terms of the space with their weights, the examples' index, and the calibration."""

    terms: dict[bytes, int]
    idf: np.ndarray
    index: BlockIndex
    votes: np.ndarray
    rates: np.ndarray
    alone: float  # score of a document without neighbours

    def counts(self, text: str | None) -> dict[int, int]:
        found = all_terms(text)
        return {self.terms[t]: found[t] for t in found.keys() & self.terms.keys()}

    def neighbours(self, counts: dict[int, int], without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        vector = unit(counts, self.idf)
        terms = np.fromiter(vector.keys(), np.int64, len(vector))
        return self.index.nearest(terms, np.fromiter(vector.values(), np.float64, len(vector)), NEAREST, without)

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """Share of label 1 among the neighbours, by weights that fall with the distance."""
        trust = 1 / (SOFT + np.maximum(0.0, 1 - cosine))
        return float((trust * self.index.labels[found]).sum() / trust.sum())

    def calibrated(self, vote: float) -> float:
        if not len(self.votes):
            return self.alone
        return float(self.rates[max(0, int(np.searchsorted(self.votes, vote, side="right")) - 1)])

    def answer(self, counts: dict[int, int]) -> tuple[float, list[dict]]:
        """Score and evidence of a document."""
        found, cosine = self.neighbours(counts) if counts else ([], [])
        if not len(found):
            return self.alone, []
        evidence = [
            {"doc_id": int(self.index.ids[x]), "cosine": float(c), "label": int(self.index.labels[x])}
            for x, c in zip(found, cosine, strict=True)
        ]
        return self.calibrated(self.vote(found, cosine)), evidence


def fit(rows: list[tuple[int, int, dict[int, int]]], terms: list[bytes], idf: np.ndarray) -> Model:
    """A model of examples (id, label, term counts). Without examples nothing speaks for toxicity: every score is 0."""
    known = [r for r in rows if r[2]]
    bare = [r[1] for r in rows if not r[2]]
    ones = sum(r[1] for r in rows)
    prior = (ones + 1) / (len(rows) + 2) if rows else 0.0
    index = BlockIndex([unit(r[2], idf) for r in known], [r[0] for r in known], [r[1] for r in known], len(terms))
    model = Model({t: i for i, t in enumerate(terms)}, idf, index, np.empty(0), np.empty(0), (sum(bare) + prior) / (len(bare) + 1))
    votes, labels = [], []
    place = {}
    for x, (i, y) in enumerate(zip(index.ids.tolist(), index.labels.tolist(), strict=True)):
        place.setdefault((i, y), []).append(x)
    for i, y, counts in known:
        spots = place[i, y]
        found, cosine = model.neighbours(counts, spots[0])
        if len(found):
            votes.append(model.vote(found, cosine))
            labels.append(y)
    model.votes, model.rates = rising(np.array(votes), np.array(labels), prior)
    return model


def term_counts(examples: DataFrame) -> DataFrame:
    """(y, text) -> term, df, ones: examples with the term, and those of label 1; a task counts before it hands on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pd.DataFrame:
            terms = list(seen[0].keys() | seen[1].keys())
            ones = np.array([seen[1][t] for t in terms], dtype=np.int64)
            return pd.DataFrame({"term": terms, "df": ones + np.array([seen[0][t] for t in terms], dtype=np.int64), "ones": ones})

        for batch in batches:
            for y, text in zip(batch["y"], batch["text"], strict=True):
                seen[y].update(all_terms(text).keys())
            if len(seen[0]) + len(seen[1]) > 1_000_000:
                yield out()
                seen = (Counter(), Counter())
        if seen[0] or seen[1]:
            yield out()

    counted = examples.select("y", "text").mapInPandas(run, "term binary, df bigint, ones bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ones").alias("ones"))


def term_vectors(examples: DataFrame, terms: list[bytes]) -> DataFrame:
    """(id, y, text) -> id, y, counts: how often each of ``terms``, by number, is in the text."""
    number = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counted = [all_terms(t) for t in batch["text"]]
            found = [{number[t]: c[t] for t in c.keys() & number.keys()} for c in counted]
            yield batch[["id", "y"]].assign(counts=pd.Series(found, index=batch.index, dtype=object))

    return examples.mapInPandas(run, "id bigint, y int, counts map<int, int>")


def telling_terms(examples: DataFrame) -> list[bytes]:
    """The terms of (y, text) that tell the labels apart, the strongest first."""
    rows, ones = examples.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not rows or not 0 < ones < rows:
        return []
    n, p = float(rows), ones / rows
    df, hit = F.col("df").cast("double"), F.col("ones").cast("double")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (
        part(hit, df * p) + part(df - hit, df * (1 - p))
        + part(ones - hit, (n - df) * p) + part((n - ones) - (df - hit), (n - df) * (1 - p))
    )
    apart = (hit * (1 - p) >= LIFT * p * (df - hit)) | (LIFT * hit * (1 - p) <= p * (df - hit))
    chosen = term_counts(examples).where((F.col("df") >= LEAST) & apart).withColumn("ratio", ratio).where(F.col("ratio") >= RATIO)
    return [bytes(r["term"]) for r in chosen.orderBy(F.desc("ratio"), "term").limit(MAX_TERMS).select("term").collect()]


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over the whole table; a task counts before it hands on."""
    number = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = 0, np.zeros(len(number), np.int64)
        for batch in batches:
            total += len(batch)
            for text in batch["text"]:
                found = number.keys() & all_terms(text).keys()
                seen[[number[t] for t in found]] += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"term": np.append(at, -1), "n": np.append(seen[at], total)})

    counts = dict(docs.select("text").mapInPandas(run, "term int, n bigint").groupBy("term").agg(F.sum("n")).collect())
    return counts.get(-1, 0), np.array([counts.get(i, 0) for i in range(len(terms))], dtype=np.float64)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_EXAMPLES) -> Model:
    """Examples from labelled documents outside the held-out fold, at most ``max_rows`` of them, the least by a hash.

    Labels without id or value teach nothing. Rows equal in id, text and label are one example.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("int").alias("y")).distinct()
    some = F.broadcast(known.orderBy(F.xxhash64("id"), "y").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.withColumn("hash", F.xxhash64("text")).join(some, "id")
    key = ["id", "y", "hash"]
    taken = rows.select(*key).distinct().orderBy(F.xxhash64("id", "hash"), *key).limit(max_rows)
    examples = pin(rows.join(F.broadcast(taken), key).dropDuplicates(key).select("id", "y", "text"), "examples")
    terms = telling_terms(examples)
    held = [(r["id"], r["y"], r["counts"]) for r in term_vectors(examples, terms).collect()]
    total, df = document_frequencies(docs, terms) if terms else (0, np.empty(0))
    return fit(sorted(held, key=lambda r: (r[0], r[1], sorted(r[2].items()))), terms, np.log((total + 1) / (df + 1)) + 1)


ANSWER = "score double, evidence array<struct<doc_id: bigint, cosine: double, label: int>>"


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 if at least ``threshold``) and ``evidence`` (the nearest examples with
    cosine and label, nearest first) to every row.

    Null and empty texts, and all others without a term of the space, have no evidence and the score of such examples.
    Rows are independent; an empty table gives an empty result. Columns of the input that bear a name of the result
    are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            out = []
            for text in batch:
                counts = shared.value.counts(text)
                key = tuple(sorted(counts.items()))
                if key not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[key] = shared.value.answer(counts)
                out.append(known[key])
            yield pd.DataFrame({"score": [s for s, _ in out], "evidence": [e for _, e in out]})

    new = ["score", "predicted", "evidence"]
    rest = [c for c in docs.columns if c not in new]
    # the input's other columns stay out of the way of the names used here
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col("text"))
    done = packed.withColumn("answer", F.pandas_udf(run, ANSWER)("text"))
    score = F.col("answer.score")
    return done.select(
        *[F.col(f"row.`{c}`").alias(c) for c in rest], score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), F.col("answer.evidence").alias("evidence"),
    )


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's chance to be toxic; see ``score_toxicity``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
