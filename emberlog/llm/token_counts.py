"""Token counts without token ids: pieces per distinct pre-token times pre-token frequencies.

1. Each task counts the distinct pre-tokens of its texts; the counts are added up per pre-token.
2. The model splits each distinct pre-token once; only its number of pieces is kept.
3. A document's count is the sum of frequency times pieces over its pre-tokens. The ``HEAD`` most
   frequent pre-tokens (a fixed bound) go to every task with their numbers, so that most of the sum
   is made where the text is read and no frequent pre-token is shuffled. All other pre-tokens of a document
   are joined with the table of step 2, whatever its size, and added up.

Texts of the common Latin letters (below U+0250, where normalization changes nothing but case) are cut into
pre-tokens by the tokenizer's own pattern in one scan. All other texts go through the tokenizer's own normalizer and
pre-tokenizer, stretch by stretch between ASCII white space, which no pre-token crosses; what a stretch is made of is
remembered (a bounded memory).
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberlog.llm.common import pin, table

TOKENIZER = "word_bpe_49k.json"
#: At most so many pre-tokens' numbers of pieces go to every task.
HEAD = 1 << 17
#: Entries a task holds before it hands them on (counting) or forgets them (splitting).
HELD = 300_000


#: The tokenizer's pattern on lower-case text, white space written out. Fixed value, as in its file.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\xa0\p{L}\p{N}]+")
#: What only the tokenizer itself takes apart.
UNCOMMON = re.compile("[^\t-\r\x20-\x7e\x85\xa0-\u024f]")


class Splitter:
    """The tokenizer's own normalizer, pre-tokenizer and model, taken apart."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = set(special)
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        self.known: dict[str, tuple[str, ...]] = {}
        # the scan holds for this pattern and normalizer only
        parts = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        same = split.get("pattern", {}).get("Regex") == PATTERN.pattern.replace(r"\t-\r \x85\xa0", r"\s")
        self.scans = same and kinds == ["NFC", "Replace", "Lowercase"]

    def scanned(self, text: str) -> list[str] | None:
        """All pre-tokens of a text of common letters; null for others and for texts with special tokens."""
        if not self.scans or UNCOMMON.search(text) or (self.cut and self.cut.search(text)):
            return None
        return PATTERN.findall(text.lower())

    def pretokens(self, stretch: str) -> tuple[str, ...]:
        """Pre-tokens of a stretch without white space; a special token's string stays whole."""
        found = self.known.get(stretch)
        if found is None:
            if len(self.known) >= HELD:
                self.known.clear()
            parts = self.cut.split(stretch) if self.cut else [stretch]
            found = tuple(p for part in parts if part for p in self.plain(part))
            self.known[stretch] = found
        return found

    def plain(self, part: str) -> list[str]:
        if part in self.special:
            return ["\1" + part]
        normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
        # kept apart from special tokens and from scanned pre-tokens, which never begin like this
        return ["\0" + p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def add(self, text: str | None, total: Counter[str]) -> Counter[str]:
        """Add the frequencies of a text's pre-tokens to ``total``."""
        found = self.scanned(text or "")
        if found is not None:
            total.update(found)
            return total
        for stretch, n in Counter(re.split(r"[ \t-\r]+", text)).items():
            if stretch:
                for p in self.pretokens(stretch):
                    total[p] += n
        return total

    def n_pieces(self, pretoken: str) -> int:
        if pretoken[0] == "\1":
            return 1
        mapped = [pretoken[1:]] if pretoken[0] == "\0" else [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(pretoken)]
        return sum(len(self.tokenizer.model.tokenize(p)) for p in mapped)


@cache
def splitter(path: str) -> Splitter:
    """One per worker process."""
    return Splitter(path)


def pretoken_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Each distinct pre-token of all texts: pretoken, n (occurrences), pieces."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, held = splitter(path), Counter()
        for batch in batches:
            for text in batch["text"]:
                split.add(text, held)
                if len(held) >= HELD:
                    yield pd.DataFrame({"pretoken": list(held.keys()), "n": list(held.values())})
                    held = Counter()
        if held:
            yield pd.DataFrame({"pretoken": list(held.keys()), "n": list(held.values())})

    def sized(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split = splitter(path)
        for batch in batches:
            yield batch.map(split.n_pieces).astype("int32")

    counted_all = docs.select("text").mapInPandas(counted, "pretoken string, n bigint")
    distinct = counted_all.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return distinct.withColumn("pieces", F.pandas_udf(sized, "int")("pretoken"))


def rank_of(n: Column) -> Column:
    """Frequencies in steps of an eighth of a doubling."""
    return F.floor(F.log2(n) * 8).cast("int")


def least_rank(pieces: DataFrame, head: int) -> int:
    """The least rank from which on at most ``head`` pre-tokens are as frequent. A few hundred rows come to
    the driver; nothing is sorted in one task."""
    total, least = 0, 1 << 20
    for r in pieces.groupBy(rank_of(F.col("n")).alias("rank")).count().orderBy(F.desc("rank")).collect():
        total += r["count"]
        if total > head:
            break
        least = r["rank"]
    return least


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = 2048, head: int = HEAD) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    The numbers are the library's for each whole text, without added begin and end tokens. A null text is empty: 0 bytes,
    0 tokens. Repeated rows and null ids are rows of their own. An empty table gives an empty result.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    docs = docs.select("doc_id", "text")
    pieces = pin(pretoken_pieces(docs, path), "pretokens")
    frequent = pieces.where(rank_of(F.col("n")) >= least_rank(pieces, head)).select("pretoken", "pieces").toPandas()
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent["pretoken"], frequent["pieces"].tolist(), strict=True)))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, known = splitter(path), shared.value
        for batch in batches:
            sums, rest, times = [], [], []
            for text in batch["text"]:
                total, other = 0, []
                for p, n in split.add(text, Counter()).items():
                    size = known.get(p)
                    if size is None:
                        other.append((p, n))
                    else:
                        total += size * n
                sums.append(total)
                rest.append([p for p, _ in other])
                times.append([n for _, n in other])
            yield pd.DataFrame(
                {"row": batch["row"], "doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "total": sums, "rest": rest, "times": times}
            )

    # rows are told apart by their place in the input, which a task that runs again finds the same
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    schema = "row bigint, doc_id bigint, n_bytes bigint, total bigint, rest array<string>, times array<bigint>"
    first = numbered.mapInPandas(summed, schema)
    each = first.select(
        "row", "doc_id", "n_bytes", "total", F.explode_outer(F.arrays_zip("rest", "times")).alias("other")
    ).select("row", "doc_id", "n_bytes", "total", F.col("other.rest").alias("pretoken"), F.col("other.times").alias("times"))
    # a document without other pre-tokens goes by its row, not by the null that all of them share
    each = each.withColumn("_at", F.coalesce("pretoken", F.concat(F.lit("\1"), F.col("row").cast("string"))))
    table_of = pieces.select(F.col("pretoken").alias("_at"), "pieces")
    joined = each.join(table_of, "_at", "left")
    total = F.max("total") + F.coalesce(F.sum(F.col("pieces") * F.col("times")), F.lit(0))
    counted = joined.groupBy("row", "doc_id", "n_bytes").agg(total.alias("n_tokens"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
