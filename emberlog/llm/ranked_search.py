"""Ranked lexical search over a length-stratified index.

A document's score depends on its length only through an integer normaliser ``m``, so documents of equal
``m`` form a stratum, and within a stratum the impact of a term depends on its frequency alone.

* Every document is cut into terms once, where it is read. Only the terms that some item asks for go into its
  postings; the lengths and the number of all documents with terms, and the document frequencies of the
  asked terms, are counted over the whole table.
* Postings are dealt by ranges of ``m``, so that a stratum lies together; a hot one is spread over several
  tasks. A task reads its documents in order of ``m`` as shards of a bounded number of postings. In a shard they
  are grouped by (term, stratum) and ordered by frequency; the impact of each (stratum, frequency) is worked
  out once, and the largest of a group bounds what the term can add in that stratum.
* An item visits the strata of a shard in order of their bounds, and stops at the first one that cannot
  reach its present ``k``-th score. All documents that may be among the best are scored exactly, in integers.
* Each shard hands on at most ``k`` rows per item; these are ranked in two steps.

Items are taken in blocks of bounded size, so the data sent to every task do not grow with their number.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import pin, ranges, table, terms_of

BEST = 50
#: Bytes of item texts that one block of items holds at most, apart from a single longer item.
BLOCK_BYTES = 8_000_000
#: Postings that a task holds at once.
SHARD = 2_000_000
#: Groups into which an item's rows are dealt for the first of the two ranking steps.
SLOTS = 64
#: Documents of the strata that an item visits first.
FIRST_VISIT = 256

@dataclass
class Item:
    """A query: its distinct terms as numbers of the block's vocabulary."""

    item_id: int | None
    terms: np.ndarray


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list[Item], list[bytes]]]:
    """Items and the vocabulary of their terms, block by block."""
    items = items.select(F.col("item_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(2 * total / block_bytes)  # half full on average, as a hash deals unevenly
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    for b in range(blocks):
        numbers: dict[bytes, int] = {}
        held = []
        for item_id, text in dealt.where(F.col("_block") == b).select("item_id", "text").collect():
            found = {numbers.setdefault(t, len(numbers)) for t in terms_of(text)}
            if found:
                held.append(Item(item_id, np.array(sorted(found), dtype=np.int64)))
        if held:
            yield held, list(numbers)


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(known, doc_id, n, terms, tfs) of every document with at least one term; ``n`` counts all its terms,
    the arrays hold those of ``vocabulary``. ``known`` is false for a null id, which then reads 0."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value
        for batch in batches:
            kept, lengths, terms, tfs = [], [], [], []
            for row, text in enumerate(batch["text"]):
                words = terms_of(text)
                if not words:
                    continue
                counts = Counter(filter(number.__contains__, words))
                kept.append(row)
                lengths.append(len(words))
                terms.append(np.array([number[t] for t in counts], dtype=np.int32))
                tfs.append(np.array(list(counts.values()), dtype=np.int32))
            if not kept:
                continue
            ids = batch.iloc[kept]
            yield pd.DataFrame(
                {"known": ids["known"].to_numpy(), "doc_id": ids["doc_id"].to_numpy(), "n": lengths, "terms": terms, "tfs": tfs}
            )

    given = docs.select(
        F.col("doc_id").isNotNull().alias("known"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"), "text"
    )
    return given.mapInPandas(run, "known boolean, doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """The postings of some documents, by term, stratum and frequency."""

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """``m`` of each document in ascending order; document, term and frequency of each posting."""
        self.normalisers, stratum_of = np.unique(m, return_inverse=True)
        self.first = np.searchsorted(m, self.normalisers)  # each stratum's first document
        self.n_docs = np.diff(np.append(self.first, len(m)))
        stratum = stratum_of[doc]
        order = np.lexsort((tf, stratum, term))
        self.doc, term, stratum, tf = doc[order], term[order], stratum[order], tf[order].astype(np.int64)
        # one impact for each frequency of a stratum
        most = int(tf.max(initial=0)) + 1
        cells, cell_of = np.unique(stratum * most + tf, return_inverse=True)
        count, norm = cells % most, self.normalisers[cells // most]
        self.impact = ((1_000_000_000 * count) // (1000 * count + 20 * norm))[cell_of]
        new = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(stratum, prepend=-1))
        self.group_term, self.group_stratum, self.group_start = term[new], stratum[new], new
        self.group_size = np.diff(np.append(new, len(term)))
        # frequencies ascend within a group, and impacts with them
        self.group_bound = self.impact[new + self.group_size - 1] if len(new) else np.empty(0, np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` best by (score descending, ``ids``), scores above 0 only."""
        low, high = np.searchsorted(self.group_term, terms), np.searchsorted(self.group_term, terms, side="right")
        groups = ranges(low, high - low)
        weighted = np.repeat(weights, high - low)
        bound = np.zeros(len(self.normalisers), np.int64)
        np.add.at(bound, self.group_stratum[groups], weighted * self.group_bound[groups])
        visits = np.argsort(-bound, kind="stable")
        visits = visits[bound[visits] > 0]
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        at, wanted = 0, max(FIRST_VISIT, k)
        while at < len(visits):
            if len(scores) >= k:
                # an equal score may still win by its id
                reach = at + int(np.searchsorted(-bound[visits[at:]], -scores[k - 1], side="right"))
                if reach == at:
                    break
            else:
                reach = len(visits)
            stop = min(reach, at + int(np.searchsorted(np.cumsum(self.n_docs[visits[at:]]), wanted)) + 1)
            chosen = np.zeros(len(bound), bool)
            chosen[visits[at:stop]] = True
            inside = chosen[self.group_stratum[groups]]
            taken, sizes = groups[inside], self.group_size[groups[inside]]
            places = ranges(self.group_start[taken], sizes)
            total = np.zeros(len(ids), np.int64)
            np.add.at(total, self.doc[places], np.repeat(weighted[inside], sizes) * self.impact[places])
            found = np.flatnonzero(total)
            docs, scores = np.append(docs, found), np.append(scores, total[found])
            order = np.lexsort((ids[docs], -scores))[:k]
            docs, scores = docs[order], scores[order]
            at, wanted = stop, wanted * 4
        return docs, scores


def search_block(indexed: DataFrame, held: list[Item], weights: np.ndarray, k: int, shard: int) -> DataFrame:
    """Postings with ``m`` -> (item, known, doc_id, score): what each shard has to offer for each item."""
    shared = indexed.sparkSession.sparkContext.broadcast([(i.terms, weights[i.terms]) for i in held])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            # null ids come first among equal scores
            keys = np.lexsort((rows["doc_id"].to_numpy(), rows["known"].to_numpy()))
            place = np.empty(len(rows), np.int64)
            place[keys] = np.arange(len(rows))
            m = rows["m"].to_numpy()
            sizes = rows["terms"].map(len).to_numpy(dtype=np.int64)
            doc = np.repeat(np.arange(len(rows)), sizes)
            index = Shard(m, doc, np.concatenate(rows["terms"].to_numpy()).astype(np.int64), np.concatenate(rows["tfs"].to_numpy()))
            for number, (terms, w) in enumerate(shared.value):
                docs, scores = index.best(terms, w, place, k)
                if len(docs):
                    chosen = rows.iloc[docs]
                    yield pd.DataFrame(
                        {"item": number, "known": chosen["known"].to_numpy(), "doc_id": chosen["doc_id"].to_numpy(), "score": scores}
                    )

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += int(batch["terms"].map(len).sum())
            if size >= shard:
                yield from answer(pd.concat(waiting, ignore_index=True))
                waiting, size = [], 0
        if waiting:
            yield from answer(pd.concat(waiting, ignore_index=True))

    return indexed.mapInPandas(run, "item int, known boolean, doc_id bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, shard: int = SHARD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters beyond ASCII, only A to Z lower-cased. Scores are integers
    above 0; equal ones by ascending doc_id, null first. Every row of ``docs`` is a document, so repeated rows take
    places of their own. Items equal in id and text are one; several texts under one id are ranked
    apart. A null or empty text has no terms: as an item it has no rows, as a document it counts nowhere. Long
    texts are read whole. An empty table on either side gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = []
    for held, vocabulary in item_blocks(items, block_bytes):
        stored = pin(postings(docs.select("doc_id", "text"), vocabulary), "postings")
        documents, terms = stored.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            break
        df = dict(stored.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weights = np.array([weight(documents, df.get(i, 0)) for i in range(len(vocabulary))], dtype=np.int64)
        m = F.expr(f"50 + (50 * n * {documents}L) div {terms}L").alias("m")
        asked = stored.where(F.size("terms") > 0).select(m, F.monotonically_increasing_id().alias("at"), "known", "doc_id", "terms", "tfs")
        # a stratum lies together, unless it is too large for one task
        dealt = asked.repartitionByRange("m", "at").sortWithinPartitions("m")
        offers = search_block(dealt, held, weights, k, shard)
        better = [F.col("score").desc(), F.col("known"), F.col("doc_id")]
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("slot")
        by_slot = offers.select("*", slot).withColumn("r", F.row_number().over(Window.partitionBy("item", "slot").orderBy(*better)))
        last = F.row_number().over(Window.partitionBy("item").orderBy(*better))
        top = by_slot.where(F.col("r") <= k).withColumn("rank", last).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, i.item_id) for n, i in enumerate(held)], "item int, item_id bigint")
        # at most one block of items
        parts.append(
            top.join(F.broadcast(names), "item").select(
                "item_id", "rank", F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "score"
            )
        )
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, parts)


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item; see ``ranked``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked(docs, table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
),
doc AS (SELECT doc_id, r, t, len(t) AS n FROM cut WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
tf AS (
    SELECT r, doc_id, n, term, count(*) AS tf
    FROM (SELECT r, doc_id, n, unnest(t) AS term FROM doc) GROUP BY r, doc_id, n, term
),
weights AS (
    SELECT term, floor(1000 * ln(((2 * docs + 2)::DOUBLE) / ((2 * count(*) + 1)::DOUBLE)))::BIGINT AS w
    FROM tf, total GROUP BY term, docs
),
item AS (
    SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
scored AS (
    SELECT item_id, item.text AS text, r, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM item JOIN tf USING (term) JOIN weights USING (term) CROSS JOIN total
    GROUP BY item_id, item.text, r, doc_id
),
placed AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 50
"""
