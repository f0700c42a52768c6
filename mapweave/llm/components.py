"""Connected components of links held in a table.

Each batch of links is first contracted by a union-find of its own; then rounds of large-star and small-star run until
nothing changes, each written to the shared folder. Nothing is gathered on the driver but two sums per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


class Forest:
    """Union-find over 64-bit nodes; the smallest node is the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while (above := up.get(x, x)) != top:
            up[x] = top
            x = above
        return top

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))

    def stars(self) -> pa.RecordBatch:
        nodes = [x for x in self.up if self.up[x] != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([self.root(x) for x in nodes], pa.int64())], ["a", "b"])


def contracted(edges: DataFrame) -> DataFrame:
    """Links (a, b) as a star to the smallest node for what is connected within a batch."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forest = Forest()
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.link(a, b)
            yield forest.stars()

    return shared.map_arrow(edges, step, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of a link but the roots themselves; root is the smallest node of its component.

    edges: a, b, both long and not null; repeated links and loops don't matter.
    """
    now = shared.materialize(contracted(edges.select("a", "b")).distinct(), "links")
    state = None
    while True:
        sums = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (sums["n"], sums["h"]) == state or not sums["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (sums["n"], sums["h"])
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        then = shared.materialize(small.distinct(), "links")
        shared.release(now)
        now = then
