"""Quality rules: base limits, and robust multivariate outliers per language and source.

Each text becomes a vector of transformed shares (``FEATURES``). In every group of one language and
source, the minimum-covariance-determinant estimate finds the centre and scatter of the ``core`` share of
documents that lie closest together, so junk does not pull the estimate towards itself. A document
whose Mahalanobis distance from its group's estimate is beyond the cutoff is rejected.

Concentration steps run over *all* documents of the group: distances under the present estimate, their ``core``
quantile, mean and covariance of the documents below it. They start from the coordinate-wise median and from both
quartiles, with the spread about the median, and go on until no determinant changes any more; the start with the
least determinant is the group's estimate. With half of the documents as core, up to nearly half of a group may be junk.
A step is two aggregates with map-side combine over the narrow table
of vectors, and a small table of one row per group which numpy inverts where the row lies. Quantiles
come from mergeable sketches; nothing of a group is ever gathered in one task.

Documents of a group with fewer than ``least`` members are held against all documents of their language,
or, if these are still too few, against all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import pin, table

#: Mean word length (log); symbols, other signs, capitals and digits as shares, and how often words recur (square roots).
FEATURES = ("f_length", "f_symbols", "f_signs", "f_upper", "f_digits", "f_repeat")
#: Least standard deviation of each feature: a share that is nearly constant in a group must not reject trifles.
FLOOR = (0.06, 0.035, 0.05, 0.05, 0.12, 0.12)
CORE = 0.75
STEPS = 4
#: The core, starts (quantiles of each feature) and most steps of the quality rules; ``estimate`` alone takes the above and the median.
HALF = 0.5
STARTS = (0.5, 0.25, 0.75)
MOST_STEPS = 60
#: Change of a determinant's logarithm that counts as none: quantiles come from sketches.
STILL = 1e-3
#: Documents that six features need for an estimate of their own.
LEAST = 40
#: Chance of a distance beyond the cutoff if a group's core were normal and went on so: clean texts of
#: natural language have heavier tails, so it is kept small.
TAIL = 1e-9

SYMBOLS = b"#*$%&|<>"
SYMBOL_BYTES = bytes(c for c in range(256) if c not in SYMBOLS)
NOT_LOWER = bytes(c for c in range(256) if not 97 <= c <= 122 and c < 128)
UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
LETTERS = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128))
DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
FOLLOW = bytes(c for c in range(256) if not 128 <= c < 192)


def kept_bytes(text: bytes, dropped: bytes) -> int:
    return len(text.translate(None, dropped))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more, the first one included."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    size = len(numbers)
    if size < 2_000_000:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # three numbers no longer fit into 63 bits
        _, pairs = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)
        keys = pairs * size + ids[2:]
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    marked = np.zeros(len(words) + 3, dtype=np.int64)
    twice = np.flatnonzero(counts[back] > 1)
    np.add.at(marked, twice, 1)
    np.add.at(marked, twice + 3, -1)
    return int((np.cumsum(marked) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.split(None, 1):
            seen.add(line)
    return n


def text_counts(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, letters, upper, digits (bytes)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = b"".join(words)
    return (
        len(words),
        len(joined) - kept_bytes(joined, FOLLOW),
        kept_bytes(raw, SYMBOL_BYTES),
        duplicate_lines(raw),
        repeated_words(words),
        kept_bytes(joined, LETTERS) - kept_bytes(joined, FOLLOW),
        kept_bytes(joined, UPPER),
        kept_bytes(joined, DIGITS),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "letters", "upper", "digits")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns ``COUNTS`` (bigint) to the other columns of ``docs``; the text goes."""

    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([text_counts(t) for t in batch], columns=list(COUNTS), dtype="int64")

    kind = ", ".join(f"{c} bigint" for c in COUNTS)
    with_counts = docs.withColumn("_counts", F.pandas_udf(counted, kind.join(("struct<", ">")).replace(" bigint", ":bigint"))(text))
    kept = [c for c in docs.columns if c not in (text, *COUNTS)]
    return with_counts.select(*kept, *[F.col(f"_counts.{c}").alias(c) for c in COUNTS])


def vector_columns() -> dict[str, Column]:
    """``FEATURES`` from ``COUNTS``; a text without words has none of its own and gets zeros."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    signs = F.greatest(F.col("word_chars") - F.col("letters") - F.col("digits"), F.lit(0))
    return {
        "f_length": F.log(chars / words),
        "f_symbols": F.sqrt(F.col("n_symbols") / chars),
        "f_signs": F.sqrt(signs / chars),
        "f_upper": F.sqrt(F.col("upper") / chars),
        "f_digits": F.sqrt(F.col("digits") / chars),
        "f_repeat": F.sqrt(F.col("n_repeat_words") / words),
    }


def chi_square(x: float, dof: float) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi_square_quantile(q: float, dof: float) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dof) < q else (low, mid)
    return high


def consistency(core: float, p: int) -> float:
    """What the covariance of the inner ``core`` share of a normal sample must be multiplied by."""
    return core / chi_square(chi_square_quantile(core, p), p + 2)


def with_groups(rows: DataFrame, keys: tuple[str, str], least: int) -> DataFrame:
    """Add ``grp``: language and source, or the language, or everything, whichever has ``least`` rows."""
    lang, source = keys
    both, one = F.struct(lang, source), F.struct(F.col(lang), F.lit(None).cast("string").alias(source))
    counts = rows.groupBy(lang, source).count()
    by_lang = F.sum("count").over(Window.partitionBy(lang))
    level = F.when(F.col("count") >= least, 2).when(by_lang >= least, 1).otherwise(0)
    sizes = pin(counts.select(F.col(lang).alias("_l"), F.col(source).alias("_s"), level.alias("_level")), "groups")
    same = rows[lang].eqNullSafe(sizes["_l"]) & rows[source].eqNullSafe(sizes["_s"])
    text = lambda s: F.to_json(s, {"ignoreNullFields": "false"})
    grp = F.when(F.col("_level") == 2, text(both)).when(F.col("_level") == 1, F.concat(F.lit("lang "), text(one)))
    return rows.join(sizes, same).withColumn("grp", F.coalesce(grp, F.lit("all"))).drop("_l", "_s", "_level")


def distance(features: tuple[str, ...]) -> Column:
    """Squared Mahalanobis distance under the row's ``centre`` and ``inverse`` (upper triangle, by rows)."""
    d = [F.col(f) - F.get("centre", F.lit(i)) for i, f in enumerate(features)]
    total, at = F.lit(0.0), 0
    for i in range(len(d)):
        for j in range(i, len(d)):
            total = total + d[i] * d[j] * F.get("inverse", F.lit(at)) * (1 if i == j else 2)
            at += 1
    return total


def inverted(moments: DataFrame, p: int, factor: float, floor: tuple[float, ...]) -> DataFrame:
    """Moments per group and start -> grp, start, centre, inverse, logdet. One small matrix per row, inverted where
    the row lies."""
    upper = np.triu_indices(p)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for grp, start, n, sums, squares in zip(*(batch[c] for c in ("grp", "start", "n", "sums", "squares")), strict=True):
                centre = np.array(sums) / n
                cov = np.zeros((p, p))
                cov[upper] = np.array(squares) / n
                cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(centre, centre)
                cov = factor * cov + np.diag(np.square(floor))
                out.append((grp, start, centre.tolist(), np.linalg.inv(cov)[upper].tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=["grp", "start", "centre", "inverse", "logdet"])

    return moments.mapInPandas(run, "grp string, start int, centre array<double>, inverse array<double>, logdet double")


def estimate(
    rows: DataFrame,
    features: tuple[str, ...] = FEATURES,
    floor: tuple[float, ...] = FLOOR,
    core: float = CORE,
    steps: int = STEPS,
    starts: tuple[float, ...] = (0.5,),
) -> DataFrame:
    """rows: grp and the features. One row per group: grp, centre, inverse, of the start with the least determinant
    after ``steps`` steps or when all stand still."""
    p = len(features)
    middle = [F.percentile_approx(f, [0.5, *starts], 10_000).alias(f"m_{f}") for f in features]
    medians = pin(rows.groupBy("grp").agg(*middle), "medians")
    off = [F.percentile_approx(F.abs(F.col(f) - F.get(f"m_{f}", F.lit(0))), 0.5, 10_000).alias(f"s_{f}") for f in features]
    spreads = rows.join(medians, "grp").groupBy("grp").agg(*off, *[F.first(f"m_{f}").alias(f"m_{f}") for f in features])
    diagonal = [
        1 / (F.pow(F.col(f"s_{features[i]}") * 1.4826, F.lit(2.0)) + floor[i] ** 2) if i == j else F.lit(0.0)
        for i in range(p) for j in range(i, p)
    ]
    begun = spreads.withColumn("start", F.explode(F.array(*[F.lit(i) for i in range(1, len(starts) + 1)])))
    centre = F.array(*[F.get(f"m_{f}", F.col("start")) for f in features])
    first = begun.select("grp", "start", centre.alias("centre"), F.array(*diagonal).alias("inverse"))
    now = pin(first.withColumn("logdet", F.lit(math.inf)), "estimate")
    sums = F.array(*[F.sum(f) for f in features]).alias("sums")
    squares = F.array(
        *[F.sum(F.col(features[i]) * F.col(features[j])) for i in range(p) for j in range(i, p)]
    ).alias("squares")
    for _ in range(steps):
        measured = rows.join(now, "grp").withColumn("d2", distance(features))
        edge = pin(measured.groupBy("grp", "start").agg(F.percentile_approx("d2", core, 10_000).alias("edge")), "edge")
        inner = measured.join(edge, ["grp", "start"]).where(F.col("d2") <= F.col("edge"))
        moments = inner.groupBy("grp", "start").agg(F.count(F.lit(1)).alias("n"), sums, squares)
        last, now = now, pin(inverted(moments, p, consistency(core, p), floor), "estimate")
        before = last.select("grp", "start", F.col("logdet").alias("_last"))
        moved = now.join(before, ["grp", "start"]).where(F.abs(F.col("logdet") - F.col("_last")) > STILL)
        if not moved.limit(1).count():
            break
    best = F.min_by(F.struct("centre", "inverse"), F.struct("logdet", "start"))
    return now.groupBy("grp").agg(best.alias("_best")).select("grp", "_best.centre", "_best.inverse")


def quality_rules(
    docs: DataFrame,
    least: int = LEAST,
    core: float = HALF,
    steps: int = MOST_STEPS,
    starts: tuple[float, ...] = STARTS,
    tail: float = TAIL,
    min_words: int = 50,
    max_repeat: int = 50,
) -> DataFrame:
    """(doc_id, text, lang, source) -> doc_id, the counts of the contract, base_failed, kept, distance.

    Fewer than ``min_words`` words, or more than ``max_repeat`` percent of them in repeated windows, fails the base
    rules; such documents are not part of any estimate. Null and empty texts have no words and fail. A null
    language or source is a value of its own. Repeated rows are rows of their own; an empty table gives
    an empty result. ``distance`` (squared) is null where the base rules fail.
    """
    stats = text_statistics(docs.select("doc_id", "text", "lang", "source"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    stats = pin(stats.withColumn("base_failed", failed).withColumns(vector_columns()), "statistics")
    rows = pin(with_groups(stats.where(~F.col("base_failed")), ("lang", "source"), least).select("doc_id", *COUNTS, "grp", *FEATURES), "vectors")
    found = pin(estimate(rows.select("grp", *FEATURES), core=core, steps=steps, starts=starts), "found")
    cutoff = chi_square_quantile(1 - tail, len(FEATURES))
    judged = rows.join(found, "grp", "left").withColumn("distance", distance(FEATURES))
    out = ["doc_id", *COUNTS[:5], "base_failed", "kept", "distance"]
    passed = judged.withColumns({"base_failed": F.lit(False), "kept": F.col("distance") <= cutoff}).select(*out)
    below = stats.where("base_failed").withColumns({"kept": F.lit(False), "distance": F.lit(None).cast("double")})
    return passed.unionByName(below.select(*out))


def op9_outliers(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
