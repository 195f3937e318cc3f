"""Connected components of a link table, as written tables and joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


class Forest:
    """Union-find over arbitrary integer ids; the root of a set is its smallest id."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.up.setdefault(min(a, b), min(a, b))
        return True


def _contract(batches, most: int = 200_000):
    """Links as stars, those of ``most`` ids or so at a time: at most one row per id and time."""

    def stars(forest):
        nodes = [x for x in forest.up if forest.root(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([forest.root(x) for x in nodes], pa.int64())], ["u", "v"])

    forest = Forest()
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            forest.join(u, v)
        if len(forest.up) > most:
            yield stars(forest)
            forest = Forest()
    yield stars(forest)


def components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component): the smallest id that can be reached, for each id in ``links(u, v)``.

    Each round takes the smallest label among the neighbours, then the label's
    label, so paths shrink at least by half; a round is one written table. All
    grouping is by partial minimum, and joins have one row per id on one side,
    so an id with very many links is split like any skewed join.
    """
    stars = scratch.keep(links.select("u", "v").where("u <> v").mapInArrow(_contract, "u long, v long"), f"{name}_links")
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = scratch.keep(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("label")).withColumn("changed", F.lit(True)), f"{name}_0")
    step = 0
    while labels.where("changed").limit(1).count():
        step += 1
        near = both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("l")), "v").groupBy(F.col("u").alias("node")).agg(F.min("l").alias("least"))
        now = labels.drop("changed").join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "least").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = now.join(up, "label", "left").select("node", F.least("label", "up").alias("label"), "was")
        labels = scratch.keep(jumped.select("node", "label", (F.col("label") != F.col("was")).alias("changed")), f"{name}_{step}")
        scratch.drop(f"{name}_{step - 1}")
    return labels.select("node", F.col("label").alias("component"))


def local_stars(pairs: np.ndarray) -> np.ndarray:
    """A spanning set of stars for the pairs (two columns) of one task."""
    forest = Forest()
    for u, v in pairs.tolist():
        forest.join(u, v)
    return np.array([(x, forest.root(x)) for x in forest.up if forest.root(x) != x], np.int64).reshape(-1, 2)
