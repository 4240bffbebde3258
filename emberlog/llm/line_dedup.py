"""Line dedup by a segment-partition edit join.

A line of at least ``MIN_CHARS`` characters goes if an earlier line of the corpus is equal to it or within
``MAX_EDITS`` edits of it; earlier is by document id (null first), document hash and place. A shorter line goes, where
``shortest`` says so, if an earlier line is equal to it; that takes digests only, no edit join. Blank lines stay.

* A line is split into ``MAX_EDITS + 1`` segments. Two lines within the edits agree in a segment of the
  shorter one, at a place of the longer one that the edits before and behind it allow. So each line is
  posted under its segments (with its length) and probes the few substrings that can meet a segment of lines
  of its own length or up to ``MAX_EDITS`` less.
* Postings and probes are two numbers a row, shuffled once by the hash of the substring, whose lowest bit
  gives way to the role, so that postings sort before the probes they meet. A sorted stream
  over them yields candidate pairs; it holds at most ``FEW`` postings of a substring.
* Under a substring with more postings than that no pairs are made. Its lines come with their texts, in order of
  their first spots, and each is compared with the earlier ones inside the task until one is near. Only lines
  that go leave the task, so the rows stay in proportion to the lines. A task holds at most ``HELD`` lines of a
  substring; those behind them are compared with these, then among themselves in a further round.
* Texts are compared by bits of their character pairs first, where one edit changes four at most, then with common
  ends cut off, by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import SPACE, pin, small_batches, table

MAX_EDITS = 2
MIN_CHARS = 20
#: Postings of a substring that are compared with all its probes at once.
FEW = 8
#: Lines of a crowded substring that a task holds.
HELD = 50_000
#: Lines a task remembers to have posted.
REMEMBERED = 500_000
#: Rows up to which a side of a join is sent to every task.
SMALL = 100_000

PAIR, POSTED, PROBED = 0, 1, 2


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of ``edits + 1`` nearly equal segments."""
    n = edits + 1
    size, longer = divmod(length, n)
    sizes = [size] * (n - longer) + [size + 1] * longer
    starts = np.cumsum([0, *sizes[:-1]]).tolist()
    return list(zip(starts, sizes, strict=True))


def probe_places(length: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, size) of the substrings of a line that may equal a segment of a line of ``other``
    characters, ``other <= length``: i edits at most before segment i, the rest behind it."""
    more, found = length - other, []
    for i, (p, size) in enumerate(segments(other, edits)):
        low = max(0, p - i, p + more - (edits - i))
        high = min(length - size, p + i, p + more + (edits - i))
        found += [(i, start, size) for start in range(low, high + 1)]
    return found


@lru_cache(maxsize=4_000)
def cuts(length: int, edits: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, end, seed) of the substrings that a line of ``length`` characters posts and probes; the
    seed tells lengths and segments apart."""
    posted = [(p, p + size, length * 64 + i) for i, (p, size) in enumerate(segments(length, edits))]
    probed = [
        (p, p + size, other * 64 + i)
        for other in range(max(edits + 1, length - edits), length + 1)
        for i, p, size in probe_places(length, other, edits)
    ]
    return posted, probed


def line_keys(line: str, edits: int) -> tuple[list[int], list[int]]:
    """Hashes under which a line is posted, and hashes that it probes."""
    key = xxhash.xxh64_intdigest
    posted, probed = cuts(len(line), edits)
    if line.isascii():
        raw = line.encode()
        return [key(raw[a:b], s) for a, b, s in posted], [key(raw[a:b], s) for a, b, s in probed]
    code = lambda a, b: line[a:b].encode("utf-8", "surrogatepass")
    return [key(code(a, b), s) for a, b, s in posted], [key(code(a, b), s) for a, b, s in probed]


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: a band of ``2 * edits + 1`` rows as bits.

    Bit ``r`` at column ``j`` is row ``j - edits + r``, so the band moves down one row per column and
    the usual shift of the horizontal differences falls away.
    """
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > edits:
        return False
    low, high = 0, m  # common beginning, then common end, by halving
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        same = a[len(a) - mid : len(a) - low] == b[len(b) - mid : len(b) - low]
        low, high = (mid, high) if same else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    m, n = len(a), len(b)
    width = 2 * edits + 1
    full = (1 << width) - 1
    up, down, score = full ^ ((1 << edits) - 1), 0, 0  # vertical differences +1 and -1
    for j in range(1, n + 1):
        c, equal = b[j - 1], 0
        for r in range(width):
            i = j - edits + r - 1
            if 0 <= i < m and a[i] == c:
                equal |= 1 << r
        zero = ((((equal & up) + up) ^ up) | equal | down) & full  # diagonal difference 0
        plus, minus = (down | ~(zero | up)) & full, zero & up  # horizontal differences
        if j <= m:
            score += not zero >> edits & 1
            if score > edits + n - m:
                return False
        else:
            r = m - j + edits
            score += (plus >> r & 1) - (minus >> r & 1)
        up, down = (minus | ~(zero >> 1 | plus)) & full, zero >> 1 & plus
    return score <= edits


def postings(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """(text) -> key, lid: lines' postings (even keys) and probes (the odd key behind); each task names a line once as
    long as it remembers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            keys: list[int] = []
            lids: list[int] = []
            sizes: list[int] = []
            roles: list[tuple[int, int]] = []
            for text in batch["text"]:
                for line in (text or "").split("\n"):
                    if len(line) < least:
                        continue
                    lid = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
                    if lid in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(lid)
                    posted, probed = line_keys(line, edits)
                    keys += posted
                    keys += probed
                    lids.append(lid)
                    sizes.append(len(posted) + len(probed))
                    roles.append((len(posted), len(probed)))
            key = np.array(keys, dtype=np.uint64).view(np.int64)
            lid = np.repeat(np.array(lids, dtype=np.uint64).view(np.int64), sizes)
            probe = np.repeat(np.tile(np.array([0, 1]), len(roles)), np.array(roles, dtype=np.int64).ravel())
            key = key & ~1 | probe
            for i in range(0, len(key), 200_000):
                part = slice(i, i + 200_000)
                yield pd.DataFrame({"key": key[part], "lid": lid[part]})

    return docs.select("text").mapInPandas(run, "key bigint, lid bigint")


def candidates(rows: DataFrame, few: int = FEW) -> DataFrame:
    """Postings and probes -> rows (kind, key, a, b): pairs to verify, and, with their role as kind, the members
    (twice the same) of substrings with more than ``few`` postings."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, crowded = None, [], False
        carried = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            # the last row waits for the next batch, so that a row's neighbours are always known
            keys, lids = (np.concatenate([c, batch[name].to_numpy()]) for c, name in zip(carried, ("key", "lid"), strict=True))
            carried = keys[-1:], lids[-1:]
            if len(keys) < 2:
                continue
            same = keys[1:] >> 1 == keys[:-1] >> 1
            shared = np.concatenate([same, [False]])[:-1] | np.concatenate([[False], same])[:-1]
            if key is not None and keys[0] >> 1 == key:
                shared[0] = True
            for i in np.flatnonzero(shared).tolist():
                key, held, crowded = step(int(keys[i]), int(lids[i]), key, held, crowded, out)
            if out:
                yield pd.DataFrame(out, columns=["kind", "key", "a", "b"])
        out = []
        for k, lid in zip(*(c.tolist() for c in carried), strict=True):
            if k >> 1 == key:
                step(k, lid, key, held, crowded, out)
        if out:
            yield pd.DataFrame(out, columns=["kind", "key", "a", "b"])

    def step(k: int, lid: int, key: int | None, held: list[int], crowded: bool, out: list) -> tuple[int, list[int], bool]:
        if k >> 1 != key:
            key, held, crowded = k >> 1, [], False
        if k % 2 == 0:
            if held and held[-1] == lid:
                return key, held, crowded  # the same line from another task
            if len(held) < few:
                held.append(lid)
            elif not crowded:
                crowded = True
                out += [(POSTED, key, x, x) for x in held]
            if crowded:
                out.append((POSTED, key, lid, lid))
        elif crowded:
            out.append((PROBED, key, lid, lid))
        else:
            out += [(PAIR, key, lid, x) for x in held if x != lid]
        return key, held, crowded

    ordered = rows.repartition(F.shiftright("key", 1)).sortWithinPartitions("key", "lid")
    return ordered.mapInPandas(run, "kind tinyint, key bigint, a bigint, b bigint")


def near(a: Column, b: Column, edits: int) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([within(s, t, edits) for s, t in zip(x, y, strict=True)], dtype=bool)

    return F.pandas_udf(run, "boolean")(a, b)


def keyed(docs: DataFrame) -> DataFrame:
    """Add ``_doc``, ``_hash``: rows equal in both are one document."""
    return docs.withColumns({"_doc": F.col("doc_id").cast("string"), "_hash": F.xxhash64("doc_id", "text")})


def duplicate_lines(docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, shortest: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text) -> rows (_doc, _hash, pos): the lines that go; below ``least`` characters only exact repeats."""
    small_batches(docs.sparkSession)
    docs = keyed(docs.select("doc_id", "text"))
    lines = docs.select("doc_id", "_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    short = (F.char_length("line") >= shortest) & F.col("line").rlike(f"[^{SPACE}]")
    lines = lines.where((F.char_length("line") >= least) | short)
    spots = lines.select(
        F.unhex(F.md5("line")).alias("digest"), F.xxhash64("line").alias("lid"), F.struct("doc_id", "_hash", "pos").alias("spot")
    )
    firsts = pin(
        spots.groupBy("digest", "lid").agg(F.min("spot").alias("spot"), F.count(F.lit(1)).alias("n"))
        .withColumn("_doc", F.col("spot.doc_id").cast("string")),
        "lines",
    )
    met = pin(candidates(postings(docs, edits, least)), "candidates")
    pairs = pin(
        met.where(F.col("kind") == PAIR).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs"
    )
    crowded = met.where(F.col("kind") != PAIR).select("key", "kind", F.col("a").alias("lid"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("lid")).union(crowded.select("lid")).distinct()
    texts = texts_of(wanted, firsts, docs)
    gone = pin(later(pairs, texts, edits), "gone")
    if crowded.limit(1).count():
        gone = gone.union(later_in_crowds(crowded, texts, gone, edits)).distinct()
    marked = firsts.join(gone.withColumn("_gone", F.lit(True)), "digest", "left")
    marked = marked.where(F.col("_gone") | (F.col("n") > 1)).select("digest", "_gone", F.col("spot").alias("_first"))
    hit = spots.join(marked, "digest").where(F.col("_gone").isNotNull() | (F.col("spot") != F.col("_first")))
    return hit.select(F.col("spot.doc_id").cast("string").alias("_doc"), F.col("spot._hash").alias("_hash"), F.col("spot.pos").alias("pos"))


def texts_of(wanted: DataFrame, firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The lines with a wanted ``lid``: lid, digest, spot, line. Read where they occur first; few enough
    of them are sent to all tasks, more are joined by document."""
    spots = pin(firsts.join(wanted, "lid").select("lid", "digest", "spot", F.col("_doc").alias("_d"), F.col("spot._hash").alias("_h")), "spots")
    if spots.count() <= SMALL:
        spots = F.broadcast(spots)
    same = docs["_doc"].eqNullSafe(spots["_d"]) & (docs["_hash"] == spots["_h"])
    line = F.get(F.split("text", "\n"), F.col("spot.pos"))
    found = docs.join(spots, same).select("lid", "digest", "spot", line.alias("line"))
    return pin(found.dropDuplicates(["digest"]), "texts")


def later(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Digests of those lines of verified pairs that occur first after their partner."""
    one = texts.select(F.col("lid").alias("a"), F.struct("spot", "digest", "line").alias("_a"))
    two = texts.select(F.col("lid").alias("b"), F.struct("spot", "digest", "line").alias("_b"))
    both = pairs.join(one, "a").join(two, "b").where(near(F.col("_a.line"), F.col("_b.line"), edits))
    return both.select(
        F.when(F.col("_a.spot") > F.col("_b.spot"), F.col("_a.digest")).otherwise(F.col("_b.digest")).alias("digest")
    ).distinct()


def marks(line: str) -> np.ndarray:
    """256 bits, one set for each character pair of the line; an edit changes four of them at most."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bits = np.zeros(256, bool)
    bits[(codes[:-1] * np.uint32(2_654_435_761) + codes[1:] * np.uint32(40_503)) >> np.uint32(7) & np.uint32(255)] = True
    return np.packbits(bits).view(np.uint64)


class Earlier:
    """Lines of one role under a crowded substring, earliest first."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.lids = np.empty(16, np.int64)
        self.bits = np.empty((16, 4), np.uint64)

    def add(self, lid: int, line: str, bits: np.ndarray) -> None:
        n = len(self.lines)
        if n == len(self.lids):
            self.lids = np.concatenate([self.lids, np.empty_like(self.lids)])
            self.bits = np.concatenate([self.bits, np.empty_like(self.bits)])
        self.lids[n], self.bits[n] = lid, bits
        self.lines.append(line)

    def has_near(self, lid: int, line: str, bits: np.ndarray, edits: int) -> bool:
        n = len(self.lines)
        few = np.bitwise_count(self.bits[:n] ^ bits).sum(axis=1) <= 4 * edits
        return any(self.lids[i] != lid and within(self.lines[i], line, edits) for i in np.flatnonzero(few).tolist())


MEMBER = "key bigint, kind tinyint, lid bigint, digest binary, line string, known boolean"


def compared_in_order(members: DataFrame, edits: int, held: int) -> DataFrame:
    """``MEMBER`` rows, all of a key together and in order of their spots -> (gone, at, ``MEMBER``): digests of lines
    that go, and the members behind the first ``held`` lines of a key, with their place ``at`` among them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["gone", "at", *(c.split()[0] for c in MEMBER.split(", "))]
        now, posted, probed, at = None, Earlier(), Earlier(), 0
        for batch in batches:
            out = []
            for key, kind, lid, digest, line, known in zip(*(batch[c] for c in names[2:]), strict=True):
                if key != now:
                    now, posted, probed, at = key, Earlier(), Earlier(), 0
                bits = marks(line)
                if not known:
                    known = (probed if kind == POSTED else posted).has_near(lid, line, bits, edits)
                    if known:
                        out.append((True, 0, key, kind, lid, digest, None, True))
                if at == 0 and len(posted.lines) < held and len(probed.lines) < held:
                    (posted if kind == POSTED else probed).add(lid, line, bits)
                else:
                    at += 1
                    out.append((False, at, key, kind, lid, digest, line, known))
            if out:
                yield pd.DataFrame(out, columns=names)

    return members.mapInPandas(run, f"gone boolean, at bigint, {MEMBER}")


def later_in_crowds(crowded: DataFrame, texts: DataFrame, gone: DataFrame, edits: int, held: int = HELD) -> DataFrame:
    """Digests of those lines under crowded substrings that are near an earlier one and not known to go."""
    known = gone.withColumn("known", F.lit(True))
    named = texts.join(known, "digest", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    order, found = ["key", "spot", "lid", "kind"], []
    left = crowded.join(named, "lid")
    while True:
        ordered = left.repartition("key").sortWithinPartitions(*order)
        done = pin(compared_in_order(ordered.select("key", "kind", "lid", "digest", "line", "known"), edits, held), "crowds")
        found.append(done.where("gone").select("digest"))
        left, order = done.where("not gone"), ["key", "at"]
        if not left.limit(1).count():
            return reduce(DataFrame.union, found).distinct()


def without_duplicate_lines(docs: DataFrame, edits: int = MAX_EDITS, least: int = MIN_CHARS, shortest: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that go, with ``n_lines`` (before) and ``n_removed``; other columns as given,
    ``n_chars``, if there, made to fit.

    A null text stays null and has no lines; an empty text is one blank line. A document that loses all its lines keeps
    an empty text. Rows equal in id and text are one document and lose the same lines, so the first
    copy's lines stay in all of them; null ids come first in order. An empty table gives an empty result.
    Columns of the input that bear a name of the result are replaced.
    """
    drop = duplicate_lines(docs, edits, least, shortest).groupBy(F.col("_doc").alias("_d"), F.col("_hash").alias("_h"))
    drop = drop.agg(F.collect_set("pos").alias("_drop"))
    # the columns of the input travel in one struct, out of the way of the names used here
    rest = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    held = docs.select(F.struct(*rest).alias("_row"), "text", F.col("doc_id").cast("string").alias("_doc"), F.xxhash64("doc_id", "text").alias("_hash"))
    same = held["_doc"].eqNullSafe(drop["_d"]) & (held["_hash"] == drop["_h"])
    lines = F.col("_lines")  # a column of its own: inside a transform the split would run once a line
    whole = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_join(F.transform(F.array_except(whole, "_drop"), lambda i: F.get(lines, i)), "\n")
    joined = held.join(drop, same, "left").withColumn("_lines", F.split("text", "\n"))
    joined = joined.withColumn("_new", F.when(F.col("_drop").isNull(), F.col("text")).otherwise(kept))
    out = {c: F.col("_row")[c] for c in rest} | {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        fits = F.char_length("_new").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("_drop").isNull(), out["n_chars"]).otherwise(fits)
    n_lines = F.greatest(F.coalesce(F.size(lines), F.lit(0)), F.lit(0)).cast("bigint")
    return joined.select(
        *[value.alias(c) for c, value in out.items()], n_lines.alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line makes superfluous."""
    return without_duplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), shortest=1)
