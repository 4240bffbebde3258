"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.session import pin, small_batches

__all__ = ["SPACE", "ascii_lower", "n_words", "own", "pin", "ranges", "small_batches", "table", "terms_of"]

#: The characters between words: space, tab to carriage return.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def n_words(text: Column | str) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, f"[{SPACE}]+"))).cast("bigint")


def own(name: str) -> str:
    """A column name that no input table has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


#: For bytes.translate: A to Z in lower case; digits, letters and all bytes of characters beyond ASCII as they are.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text, in order, only A to Z lower-cased; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + size), one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
