"""Near-duplicate documents by SuperMinHash.

1. A document's set: hashes of its distinct ``WIDTH``-word shingles (64 bits). Documents with equal sets (equal
   128-bit digest of the sorted set) form a class; only one of its texts goes on.
2. SuperMinHash: each element runs through the ``SIZE`` places of the signature in a random order of its own
   and offers ``step + random`` to each; a place keeps its least offer. Since later steps offer more,
   a document stops as soon as no place can still be improved: after two or three steps for long ones.
3. Bands of ``ROWS`` places: two documents of similarity 0.75 share a band with probability
   1 - (1 - 0.75**4)**32, all but 5 in a million, and more similar ones more surely.
4. Verification on full sets, then union-find components.

A band's bucket with m documents does not make m*m pairs. Each document is first compared with the two
*hubs* of its buckets, the members that share the largest buckets and so lie in the middle of a
group. Buckets whose documents then are in one component are done. The others are put together by
their first hub, with which all members of such a group share a band. Members outside the hub's component are
compared with all members, block by block inside tasks: a block pair holds about ``BLOCK`` sets a side, counts all its intersections with array operations and hands on only the
links that join components, so neither pairs nor intersections become rows and no link between
different components is missed. A text goes once to each block of the other side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.common import own, pin, small_batches, table
from emberlog.llm.components import UnionFind, components

WIDTH = 5
SIZE = 128
ROWS = 4
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Members of a bucket that all others are compared with first.
HUBS = 2
#: Documents of one side of a block pair.
BLOCK = 512

M1, M2, GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Words a task remembers the hashes of.
REMEMBERED = 200_000
#: Elements whose orders of places are held at once.
AT_ONCE = 25_000


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes; remembers the hashes of words."""

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def word(self, w: bytes) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        self.known[w] = h
        return h

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the set; empty without words."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        known, word = self.known, self.word
        h = np.array([known[w] if w in known else word(w) for w in words], dtype=np.uint64)
        width = min(self.width, len(words))
        with np.errstate(over="ignore"):
            total = np.zeros(len(words) - width + 1, dtype=np.uint64)
            for i in range(width):
                total = mix(total * GOLD + h[i : i + len(total)] + np.uint64(width))
        return np.unique(total)


def super_minhash(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """Signatures (documents x size); places of an empty set stay infinite.

    The steps run over the elements of all documents at once. Orders of places are drawn by
    swapping, as in a shuffle that stops early.
    """
    out = np.full((len(sets), size), np.inf)
    start = 0
    while start < len(sets):
        stop, n = start, 0
        while stop < len(sets) and (stop == start or n + len(sets[stop]) <= AT_ONCE):
            n += len(sets[stop])
            stop += 1
        if stop == start + 1 and n > AT_ONCE:  # one very long document: least of its parts' signatures
            whole = sets[start]
            for i in range(0, n, AT_ONCE):
                np.minimum(out[start], signatures([whole[i : i + AT_ONCE]], size)[0], out=out[start])
        else:
            out[start:stop] = signatures(sets[start:stop], size)
        start = stop
    return out


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    sig = np.full((len(sets), size), np.inf)
    lengths = np.array([len(s) for s in sets])
    if not lengths.sum():
        return sig
    flat = sig.ravel()
    owner = np.repeat(np.arange(len(sets)), lengths)
    elements = np.concatenate(sets)
    order = None
    with np.errstate(over="ignore"):
        for j in range(size):
            if j:
                open_ = sig.max(axis=1) >= j  # a place above j can still be improved
                keep = open_[owner]
                if not keep.any():
                    break
                if order is None:
                    order = np.empty((int(keep.sum()), size), dtype=np.int16)
                    order[:] = np.arange(size, dtype=np.int16)
                    first = place[keep]
                    rows = np.arange(len(first))
                    order[rows, first] = 0
                    order[:, 0] = first
                elif not keep.all():
                    order = order[keep]
                if not keep.all():
                    owner, elements = owner[keep], elements[keep]
            bits = mix(elements + GOLD * np.uint64(2 * j + 1))
            draw = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
            other = mix(elements + GOLD * np.uint64(2 * j + 2)) >> np.uint64(32)
            swap = j + ((other * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
            if order is None:
                place = swap
            else:
                rows = np.arange(len(owner))
                place = order[rows, swap].astype(np.int64)
                order[rows, swap] = order[:, j]
                order[:, j] = place
            np.minimum.at(flat, owner * size + place, j + draw)
    return sig


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per band, different bands differing."""
    bits = sig.view(np.uint64).reshape(len(sig), -1, rows)
    bands = bits.shape[1]
    with np.errstate(over="ignore"):
        total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
        for i in range(rows):
            total = mix(total * GOLD + bits[:, :, i])
    return total.view(np.int64)


def sketches(docs: DataFrame, width: int, size: int, rows: int) -> DataFrame:
    """(id, mark, text) -> id, mark, n, digest (of the set; null if empty), bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Shingler(width)
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i : i + 256]
                sets = [make.shingles(t) for t in part["text"]]
                bands = band_hashes(super_minhash(sets, size), rows)
                yield pd.DataFrame(
                    {
                        "id": part["id"],
                        "mark": part["mark"],
                        "n": [len(s) for s in sets],
                        "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        "bands": [b if len(s) else [] for s, b in zip(sets, bands, strict=True)],
                    }
                )

    return docs.select("id", "mark", "text").mapInPandas(run, "id bigint, mark bigint, n bigint, digest binary, bands array<bigint>")


def linked(left: Column, right: Column, width: int, percent: int) -> Column:
    """Whether two texts' full sets reach the similarity."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        make = Shingler(width)
        last: tuple[str | None, np.ndarray | None] = (None, None)
        for a, b in batches:
            out = []
            for x, y in zip(a, b, strict=True):
                if last[0] is not x and last[0] != x:
                    last = (x, make.shingles(x))
                s, t = last[1], make.shingles(y)
                common = len(np.intersect1d(s, t, assume_unique=True))
                out.append(100 * common >= percent * (len(s) + len(t) - common) and len(s) > 0)
            yield pd.Series(out, dtype=bool)

    return F.pandas_udf(run, "boolean")(left, right)


def shared_counts(one: list[np.ndarray], many: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set of ``one``, its intersection sizes with all (non-empty) sets of ``many``."""
    sizes = [len(x) for x in many]
    whole, place = np.unique(np.concatenate(many), return_inverse=True)
    starts = np.cumsum([0, *sizes[:-1]])
    here = np.zeros(len(whole) + 1, dtype=np.int32)
    for s in one:
        at = np.searchsorted(whole, s)
        at = at[whole[np.minimum(at, len(whole) - 1)] == s]
        here[at] = 1
        yield np.add.reduceat(here[place], starts)
        here[at] = 0


def joining_links(left: pd.DataFrame, right: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """(id, component, text) twice: pairs of components with a link between them, a spanning choice."""
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        make, groups = Shingler(width), UnionFind()
        one, many = ([make.shingles(t) for t in x["text"]] for x in (left, right))
        sizes, parts = np.array([len(x) for x in many]), right["component"].to_numpy()
        for s, own, shared in zip(one, left["component"].tolist(), shared_counts(one, many), strict=True):
            near = (100 * shared >= percent * (len(s) + sizes - shared)) & (parts != own)
            for other in np.unique(parts[near]).tolist():
                if groups.root(own) != groups.root(other):
                    groups.join(own, other)
                    out.append((own, other))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> id, mark, text; (id, mark) stands for a row, rows equal in both columns apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("mark"), "text")


def judged(
    docs: DataFrame, width: int = WIDTH, size: int = SIZE, rows: int = ROWS, percent: int = PERCENT, hubs: int = HUBS, block: int = BLOCK
) -> DataFrame:
    """(doc_id, text) -> id, mark, n, component (an id; null where the id is null), group (null without a set).

    A *node* is a class of rows with equal sets, whatever their ids. ``group`` is the node that stands for
    all rows linked with one another.
    """
    small_batches(docs.sparkSession)
    texts = marked(docs)
    made = pin(sketches(texts, width, size, rows), "sketches")
    members = made.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    least = members.groupBy("digest").agg(F.min("id").alias("rep"))
    classes = pin(least.withColumn("node", F.monotonically_increasing_id()), "classes")

    # one row of each class: any of its texts has the class's set
    reps = members.join(classes, "digest").where(F.col("id") == F.col("rep")).dropDuplicates(["digest"])
    posted = reps.select("id", "mark", "node", "n", F.explode("bands").alias("band"))
    shared = posted.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    bucket = pin(posted.join(shared, "band"), "buckets")
    wanted = bucket.groupBy("node").agg(F.sum("m").alias("score"))
    chosen = bucket.select("id", "mark", "node").distinct()
    body = pin(texts.join(chosen, ["id", "mark"]).select("node", "text").dropDuplicates(["node"]), "texts")
    bucket = bucket.select("node", "n", "band", "m")

    scored = bucket.join(wanted, "node")
    order = Window.partitionBy("band").orderBy(F.desc("score"), "node")
    top = scored.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= hubs)
    top = top.select("band", F.col("node").alias("b"), F.col("n").alias("_n"))
    bound = F.least("n", "_n") * 100 >= F.greatest("n", "_n") * percent
    pairs = bucket.join(top, "band").where(bound & (F.col("node") != F.col("b")))
    pairs = pairs.select(F.col("node").alias("a"), "b").distinct()
    one = body.select(F.col("node").alias("a"), F.col("text").alias("_s"))
    two = body.select(F.col("node").alias("b"), F.col("text").alias("_t"))
    found = pairs.join(one, "a").join(two, "b").where(linked(F.col("_t"), F.col("_s"), width, percent))
    labels = components(pin(found.select("a", "b"), "links")).withColumnRenamed("id", "node")

    named = bucket.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(wanted, "node")
    hub = F.max_by(F.struct("node", "component"), F.struct("score", -F.col("node")))
    state = named.groupBy("band").agg(hub.alias("_h"), F.count_distinct("component").alias("_k")).where("_k > 1")
    # buckets with the same hub make one group: all its members share a band with the hub
    group = named.join(state, "band").select(F.col("_h.node").alias("hub"), F.col("_h.component").alias("_hub"), "node", "component")
    rest = pin(group.distinct(), "rest")
    counts = rest.groupBy("hub").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("component") != F.col("_hub")).alias("u"))
    sized = rest.join(counts.where("u > 0"), "hub").withColumns(
        {"nu": F.ceil(F.col("u") / block), "nm": F.ceil(F.col("m") / block), "_x": F.xxhash64("node")}
    )
    blocks = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = lambda n: F.pmod("_x", F.col(n))
    left = sized.where(F.col("component") != F.col("_hub")).select("hub", "node", "component", mine("nu").alias("i"), blocks("nm").alias("j"))
    right = sized.select("hub", "node", "component", blocks("nu").alias("i"), mine("nm").alias("j"))
    names = ["hub", "i", "j", "component", "text"]
    left, right = (x.join(body, "node").select(*names).toDF(*names) for x in (left, right))
    compared = left.groupBy("hub", "i", "j").cogroup(right.groupBy("hub", "i", "j"))
    more = pin(compared.applyInPandas(lambda a, b: joining_links(a, b, width, percent), "a bigint, b bigint"), "links")
    above = components(more).select(F.col("id").alias("component"), F.col("component").alias("_up"))
    labels = labels.join(above, "component", "left").select("node", F.coalesce("_up", "component").alias("group"))
    # components of single classes that only the blocks linked
    single = above.join(labels, F.col("node") == above["component"], "left_anti")
    labels = labels.union(single.select(F.col("component").alias("node"), F.col("_up").alias("group")))

    grouped = pin(classes.join(labels, "node", "left").withColumn("group", F.coalesce("group", "node")), "groups")
    several = grouped.groupBy("group").agg(F.min("rep").alias("_low"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    lowest = pin(several.drop("_m"), "lowest")
    by_set = grouped.join(lowest, "group", "left").select("digest", "group", F.coalesce("_low", "rep").alias("component"))
    out = made.drop("bands").join(by_set, "digest", "left")
    return out.select(
        "id", "mark", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"), "group"
    )


def near_duplicates(docs: DataFrame, **params: int) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id, kept; one row per row of ``docs``.

    Null texts and texts without words have an empty set, are linked with nothing and kept. Equal texts
    are linked. Rows of a repeated id are documents of their own: each has the component of its text, and each
    counts as kept if its id is that component's. A null id takes no part: no component, kept.
    An empty table gives an empty result.
    """
    out = judged(docs, **params)
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **params: int) -> DataFrame:
    """One row of each group of linked rows: one with the least id; columns as given.

    Among rows of that id it is the one whose text has the least hash, and of rows equal in id and text any one.
    Two texts under one id that are not linked both stay. Rows without words or without an id all stay.
    """
    out = pin(judged(docs, **params), "judged")
    sets = out.where(F.col("group").isNotNull() & F.col("id").isNotNull())
    first = sets.where(F.col("id") == F.col("component")).groupBy("group").agg(F.min("mark").alias("_first"))
    rows = sets.groupBy("id", "mark", "component", "group").agg(F.count(F.lit(1)).alias("_times")).join(first, "group")
    stays = (F.col("id") == F.col("component")) & (F.col("mark") == F.col("_first"))
    key_id, key_mark = own("id"), own("mark")
    key = [F.col("id").alias(key_id), F.col("mark").alias(key_mark)]
    gone, again = rows.where(~stays).select(*key), rows.where(stays & (F.col("_times") > 1)).select(*key)
    here = docs.withColumns({key_id: F.col("doc_id").cast("bigint"), key_mark: F.xxhash64("text")})
    kept = here.join(gone, [key_id, key_mark], "left_anti")
    single = kept.join(again, [key_id, key_mark], "left_anti")
    repeated = kept.join(again, [key_id, key_mark], "left_semi").dropDuplicates([key_id, key_mark])
    return single.unionByName(repeated).select(*docs.columns)


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the size of its set, its component, and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "documents"))
