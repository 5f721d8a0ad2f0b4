"""Connected components of links, without gathering them: local forests, then alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


class Forest:
    """Union by smallest id, for the links of one partition or block."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (parent := self.up.get(x, x)) != x:
            path.append(x)
            x = parent
        for y in path:
            self.up[y] = x
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of many links, as few as connect the same: each node with the smallest of its component."""
    forest = Forest()
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        forest.join(x, y)
    nodes = [x for x in list(forest.up) if forest.root(x) != x]
    return nodes, [forest.root(x) for x in nodes]


def _contract(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.join(x, y)
        nodes = [x for x in list(forest.up) if forest.root(x) != x]
        for k in range(0, len(nodes), 50_000):
            part = nodes[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every neighbour is hung on the smallest node near it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    low = low.select("a", F.least("a", "low").alias("low"))
    large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    down = large.groupBy("a").agg(F.min("b").alias("low"))
    hung = large.join(down, "a")
    return hung.select("a", F.col("low").alias("b")).union(
        hung.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))).where("a != b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` of every linked node; ``component`` is the smallest node reachable over ``a, b``.

    Each round is a table in the shared folder. It ends when a round changes nothing.
    """
    print_ = F.bit_xor(F.xxhash64("a", "b"))
    now = stored(_contract(links), "links")
    seen = now.agg(F.count("*"), print_).first()
    for _ in range(most_rounds):
        if not seen[0]:
            break
        now = stored(_stars(now), "links")
        last, seen = seen, now.agg(F.count("*"), print_).first()
        if seen == last:
            break
    else:
        raise RuntimeError("the components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b"), F.col("b")).distinct())
