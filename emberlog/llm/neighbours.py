"""Nearest neighbours by a permutation index.

* Pivots: a bounded sample of the vectors (``pivots`` of them, by least keyed hash).
* A vector is represented by its ``prefix`` nearest pivots in order.
* The index is cut into blocks of about ``block`` vectors. Each block holds pivot inverted files: for a
  pivot, the vectors that have it in their prefix, with its place there.
* A query reads the files of its own pivots. With places counted down from ``prefix`` and 0 for "not in
  the prefix", the footrule distance of two prefixes is a constant less twice the sum of
  ``min(place, place)`` over shared pivots, so one pass over the postings ranks the whole block.
* The best ``rerank`` share of the block is scored exactly and its nearest go on.

Every vector is indexed; the share, not a fixed number, keeps the recall the same at every size.
Vectors and queries meet in blocks of bounded size, (vector block, query block), never as single pairs.
Equal vectors are one entry that carries its ``k + 1`` smallest ids, more of which no answer can hold;
these are found by a group limit that works before the shuffle, so a vector that a third of all rows
share costs a few rows per task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import pin, table

PIVOTS = 256
PREFIX = 48
RERANK = 0.25
BLOCK = 4096
#: So many of a block are scored at least, so small tables are answered exactly.
LEAST = 64


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def places(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each vector, nearest first; ties by pivot number."""
    return np.argsort(-(unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :prefix]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Block:
    """The inverted files of one block of vectors."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        order = places(vectors, pivots, prefix)
        n, length = order.shape
        by_pivot = np.argsort(order.ravel(), kind="stable")
        self.rows = by_pivot // length
        self.place = (length - by_pivot % length).astype(np.int16)
        self.starts = np.searchsorted(order.ravel()[by_pivot], np.arange(len(pivots) + 1))
        self.n = n

    def shared(self, query: np.ndarray) -> np.ndarray:
        """Sum of min(place, place) over shared pivots: the larger, the smaller the footrule distance."""
        total = np.zeros(self.n, dtype=np.int32)
        for i, p in enumerate(query):
            here = slice(self.starts[p], self.starts[p + 1])
            total[self.rows[here]] += np.minimum(self.place[here], len(query) - i)
        return total


def search_block(
    left: pd.DataFrame, right: pd.DataFrame, pivots: np.ndarray, prefix: int, rerank: float, k: int
) -> pd.DataFrame:
    """left: vectors with their ids; right: queries. The k nearest of the block for each query."""
    found: dict[str, list] = {"query_id": [], "twin": [], "vec_id": [], "score": []}
    if len(left) and len(right):
        vectors, queries = (np.array(x["embedding"].tolist(), dtype=np.float64) for x in (left, right))
        block, orders = Block(vectors, pivots, prefix), places(queries, pivots, prefix)
        units, wanted = unit(vectors), unit(queries)
        members = left["ids"].tolist()
        n = min(len(left), max(LEAST, int(np.ceil(rerank * len(left)))))
        for query_id, twin, order, query in zip(right["vec_id"], right["twin"], orders, wanted, strict=True):
            shared = block.shared(order)
            best = np.argpartition(-shared, n - 1)[:n] if n < len(shared) else np.arange(len(shared))
            scores = (units[best] * query).sum(axis=1)
            edge = np.partition(scores, -(k + 1))[-(k + 1)] if len(scores) > k + 1 else -np.inf
            near = scores >= edge
            nearest = [
                (-s, i) for at, s in zip(best[near], scores[near], strict=True) for i in members[at] if i != query_id
            ]
            for s, i in sorted(nearest)[:k]:
                for name, value in zip(found, (query_id, twin, i, -s), strict=True):
                    found[name].append(value)
    return pd.DataFrame(found)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    rerank: float = RERANK,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, embedding) -> query_id, rank, vec_id, score: the k nearest found by cosine for every row
    where ``is_query``, nearest first, ties to the smaller id; all candidates if there are fewer.

    Rows without a usable vector or without an id take no part, nor do vectors of another length than
    most have (of equally many, the shorter). Rows repeated with the same id and vector count once; an
    id is never its own neighbour. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = pin(
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", is_query.alias("is_query"))
        .where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
        .withColumn("twin", F.xxhash64("embedding")),
        "vectors",
    )
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("embedding") == lengths["n"])
    n_blocks = -(-lengths["count"] // block)
    first = F.row_number().over(Window.partitionBy("twin", "embedding").orderBy("vec_id"))
    # a repeated row may take one of the k + 1 places: distinct ids first, combined before the shuffle
    few = rows.select("twin", "embedding", "vec_id").distinct().withColumn("_n", first).where(F.col("_n") <= k + 1)
    index = pin(
        few.groupBy("twin", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "index"
    )
    sample = index.orderBy(F.xxhash64(F.lit("pivot"), "embedding")).limit(pivots).select("embedding").collect()
    chosen = unit(np.array([r["embedding"] for r in sample], dtype=np.float64))
    depth = min(prefix, len(chosen))

    queries = rows.where("is_query").select("vec_id", "embedding", "twin").distinct()
    q_blocks = -(-queries.count() // block)
    at = F.array([F.lit(i) for i in range(max(1, q_blocks))])
    left = index.select(
        "embedding", "ids", F.pmod("twin", F.lit(n_blocks)).alias("vb"), F.explode(at).alias("qb")
    )
    right = queries.select(
        "vec_id", "twin", "embedding", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")).alias("vb"),
        F.pmod(F.xxhash64("vec_id"), F.lit(max(1, q_blocks))).cast("int").alias("qb"),
    )

    def met(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_block(a, b, chosen, depth, rerank, k)

    found = (
        left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb"))
        .applyInPandas(met, "query_id bigint, twin bigint, vec_id bigint, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.coalesce(F.pmod("vec_id", F.lit(50)) == 0, F.lit(False)))
