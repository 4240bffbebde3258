"""SentencePiece encoding and decoding by Viterbi over an Aho-Corasick automaton.

The automaton holds all pieces. One pass over a text follows it and, at each position, its output
links: every piece that ends there may improve the best score at that position. The best path is the
segmentation with the largest sum of piece scores. A character without a piece of its own may be
covered by its UTF-8 bytes, at the worst score less ten. Ties: the longer last piece.

Spaces become U+2581 and one is put in front, as the model file asks. No piece holds U+2581 behind
another character, so no piece crosses the start of a run of spaces: the best path of a text is that of
its chunks one after the other, and a task remembers the chunks it has seen (a bounded memory). The same
holds for characters that occur in no piece. A U+2581 of the text itself is written as bytes, so
that decoding gives back every text exactly.

Documents are encoded where they are read: no shuffle, state of a fixed size, any task can run again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from math import inf

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb

from emberlog.llm.common import small_batches, table

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Chunks a task remembers, and the longest that it remembers.
REMEMBERED = 400_000
LONGEST = 64
#: Characters of text after which a task hands on its ids.
CHARACTERS = 2_000_000
NORMAL, USER_DEFINED, BYTE = 1, 4, 6


class Pieces:
    """A piece table with its automaton."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], ids: list[int]) -> None:
        self.byte_ids = byte_ids
        # what an id stands for in a text
        self.raw = {i: p.replace(SPACE, " ").encode() for i, (p, _) in zip(ids, pieces, strict=True)}
        self.raw |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.fallback = min(s for _, s in pieces) - 10
        self.automaton = ahocorasick.Automaton()
        for (piece, score), i in zip(pieces, ids, strict=True):
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        inside = {c for p, _ in pieces for c in p.lstrip(SPACE)}
        if SPACE in inside:
            raise ValueError("a piece holds a space mark behind another character")
        lonely = "" if "\n" in inside else "\n"
        either = f"{SPACE}*[^{SPACE}{lonely}]+|{SPACE}+"
        self.chunks = re.compile(f"{lonely}|{either}" if lonely else either)
        self.known: dict[str, tuple[int, ...]] = {}

    @classmethod
    def read(cls, path: str) -> Pieces:
        model = model_pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        entries = list(enumerate(model.pieces))
        byte_ids = [i for i, p in entries if p.type == BYTE]
        if len(byte_ids) != 256:
            raise ValueError("the model has no pieces for all bytes, so some texts could not be encoded")
        if model.normalizer_spec.precompiled_charsmap or any(p.type == USER_DEFINED for _, p in entries):
            raise ValueError("models that rewrite characters or have pieces of their users' are not supported")
        plain = [(i, p.piece, p.score) for i, p in entries if p.type == NORMAL]
        return cls([(p, s) for _, p, s in plain], byte_ids, [i for i, _, _ in plain])

    def viterbi(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of ``chunk``."""
        n = len(chunk)
        if self.single.issuperset(chunk):  # no character needs its bytes, so every position is reached
            return self.viterbi_of_pieces(chunk, n)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        place = 0  # positions up to here have had their fallback

        def by_bytes(upto: int, place: int) -> int:
            # a character is relaxed by its bytes after the pieces that end with it, before any later one
            while place < upto:
                place += 1
                if chunk[place - 1] not in self.single:
                    score = best[place - 1] + self.fallback
                    if best[place] is None or score > best[place]:
                        best[place], back[place] = score, (place - 1, -1)
            return place

        for last, (length, score, i) in self.automaton.iter(chunk):
            place = by_bytes(last, place)
            end = last + 1
            score += best[end - length]
            if best[end] is None or score > best[end]:
                best[end], back[end] = score, (end - length, i)
        by_bytes(n, place)
        ids: list[int] = []
        at = n
        while at:
            start, i = back[at]
            ids += [i] if i >= 0 else [self.byte_ids[b] for b in reversed(chunk[start:at].encode())]
            at = start
        return ids[::-1]

    def viterbi_of_pieces(self, chunk: str, n: int) -> list[int]:
        """The same where every character is a piece: an end's best entry of the table is all that is kept of it."""
        best = [0.0] + [-inf] * n
        back = [(0, 0.0, 0)] * (n + 1)
        for last, entry in self.automaton.iter(chunk):
            end = last + 1
            score = best[end - entry[0]] + entry[1]
            if score > best[end]:
                best[end], back[end] = score, entry
        ids = []
        while n:
            length, _, i = back[n]
            ids.append(i)
            n -= length
        return ids[::-1]

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; none for null or the empty text."""
        if not text:
            return []
        ids: list[int] = []
        for n, part in enumerate(text.split(SPACE)):
            if n:
                ids += [self.byte_ids[b] for b in SPACE.encode()]
            for chunk in self.chunks.findall((SPACE if not n else "") + part.replace(" ", SPACE)):
                found = self.known.get(chunk)
                if found is None:
                    found = tuple(self.viterbi(chunk))  # smaller than a list, and garbage collection skips it
                    if len(chunk) <= LONGEST:
                        if len(self.known) >= REMEMBERED:
                            self.known.clear()
                        self.known[chunk] = found
                ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


@cache
def pieces(path: str) -> Pieces:
    """One automaton per worker process."""
    return Pieces.read(path)


def encode_documents(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``ids`` (array of piece ids), ``n_tokens`` and
    ``round_trip`` (decoding the ids gives the text).

    A null text counts as empty: no ids, ``round_trip`` true. Texts of any length are encoded whole.
    Rows are independent: repeated rows and an empty table need nothing special. Columns of the input
    that bear a name of the result are replaced.
    """
    small_batches(docs.sparkSession)
    path = model or public_tokenizers.path(MODEL)
    new = ["ids", "n_tokens", "round_trip"]
    kept = [f for f in docs.schema.fields if f.name not in (text, *new)]
    # the other columns travel as they are, in one struct that pandas does not have to understand
    packed = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row"), F.col(text).alias("text"))

    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = pieces(path)
        for texts in batches:
            held, same, characters = [], [], 0
            for t in texts:
                ids = table.encode(t)
                held.append(np.array(ids, dtype=np.int32))  # half of a list's memory
                same.append(table.decode(ids) == (t or ""))
                characters += len(t or "")
                if characters >= CHARACTERS:
                    yield pd.DataFrame({"ids": held, "round_trip": same})
                    held, same, characters = [], [], 0
            if held:
                yield pd.DataFrame({"ids": held, "round_trip": same})

    run = F.pandas_udf(encoded, "struct<ids:array<int>,round_trip:boolean>")
    done = packed.withColumn("code", run("text"))
    columns = [F.col(f"row.`{f.name}`").alias(f.name) for f in kept]
    return done.select(
        *columns, F.col("code.ids").alias("ids"), F.size("code.ids").cast("bigint").alias("n_tokens"),
        F.col("code.round_trip").alias("round_trip"),
    )


def decode_documents(encoded: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """Add ``text``, the decoded ``ids``; null ids give null."""
    path = model or public_tokenizers.path(MODEL)

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = pieces(path)
        for batch in batches:
            yield batch.map(lambda x: None if x is None else table.decode(x))

    return encoded.withColumn("text", F.pandas_udf(decoded, "string")(F.col(ids)))


def op8_pieces(spark, sf_dir: str) -> DataFrame:
    """Every document's piece ids and whether they decode to its text."""
    return encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
