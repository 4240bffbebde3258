"""Connected components of links, without gathering them anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import pin


class UnionFind:
    """Smallest member as root; path halving."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """The links of one partition as stars: (member, smallest member)."""
    groups = UnionFind()
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        groups.join(x, y)
    members = [x for x in groups.parent if groups.root(x) != x]
    return members, [groups.root(x) for x in members]


#: Links a task holds at once while it turns them into stars.
HELD = 2_000_000


def contracted(links: DataFrame) -> DataFrame:
    """(a, b) -> links with the same components: each task's own stars, by union-find."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= HELD:
                yield emit(held)
                held, n = [], 0
        if held:
            yield emit(held)

    def emit(held: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(held)
        a, b = forest(whole["a"].to_numpy(), whole["b"].to_numpy())
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    return links.select("a", "b").mapInPandas(run, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (id, component): the smallest id reachable, for every id that has a link to another.

    Union-find inside each task first turns its links into stars. Then, until nothing changes, every id
    takes the smallest label among its own and its neighbours', and then its label's label, which halves
    long chains. The minimum is combined before the shuffle, so an id with very many links costs a row
    per task. Every round is written to the shared folder; only a count comes to the driver.
    """
    stars = pin(contracted(links), "stars")
    both = pin(stars.union(stars.select("b", "a")).distinct(), "links")
    labels = pin(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.least("component", "m").alias("_low"), F.col("component").alias("_was")
        )
        up = labels.select(F.col("id").alias("_low"), F.col("component").alias("_up"))
        jumped = lower.join(up, "_low", "left")
        component = F.least("_low", "_up")
        done = pin(jumped.select("id", component.alias("component"), (component != F.col("_was")).alias("_new")), "labels")
        labels = done.select("id", "component")
        if not done.where("_new").limit(1).count():
            return labels
