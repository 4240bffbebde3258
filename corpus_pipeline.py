"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again before the next
one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberlog.llm import gam
from emberlog.llm.common import table
from emberlog.llm.line_dedup import without_duplicate_lines
from emberlog.llm.mixing import mixed_documents, with_places
from emberlog.llm.near_dedup import without_near_duplicates
from emberlog.llm.pieces import encode_documents
from emberlog.session import pin


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    model = gam.train(docs, table(spark, sf_dir, "labels"))
    return gam.score_quality(docs, model).where("predicted = 1").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand, nearly alike, earlier in the corpus; of short lines exact repeats go."""
    return without_duplicate_lines(docs, shortest=1).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares, in the order of the schedule; a document stays whole, once for every pass that
    holds it."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, checked by decoding them, and ``place``, its place in the mix.

    ``docs`` is the stage table of the mix, whose files hold its order.
    """
    return encode_documents(with_places(docs))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Boosted tables, signatures and piece ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None
