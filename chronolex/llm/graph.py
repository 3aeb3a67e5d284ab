"""Connected components of links, by local contraction and alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolex.llm.common import cut, few


def contracted(links: DataFrame) -> DataFrame:
    """(a, b) links, a above b, as stars: each node's link to the smallest node that the links of its own task reach.

    Links inside a task are joined by pointer jumping, so long paths shrink without an exchange; a task holds its own links only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
        if not held:
            return
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = place[: len(a)], place[len(a) :]
        root = np.arange(len(nodes))
        while True:
            x, y = root[a], root[b]
            if (x == y).all():
                break
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
        out = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[root[out]])], ["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): root is the smallest node reachable. Nodes without links have no row.

    Every round contracts the links of each task, hooks a node's larger neighbours (large star), then all its smaller ones (small
    star), to the smallest of them; the rounds end when no link changes, after about the logarithm of the longest path between
    tasks. Minima are pre-aggregated before each exchange, so a node with very many links is no hot group, and no list of neighbours is collected.
    """
    ordered = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = cut(contracted(few(ordered(links.select("a", "b")))))
    state = None
    while True:
        for star in ("large", "small"):
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))) if star == "large" else now
            least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
            side = both.where("b > a") if star == "large" else both
            hooked = side.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            if star == "small":  # the node itself hooks to its smallest neighbour too
                hooked = hooked.unionByName(least.select("a", F.col("m").alias("b")))
            now = ordered(hooked)
        now = cut(contracted(few(now.distinct())))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(seen):
            break
        state = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
