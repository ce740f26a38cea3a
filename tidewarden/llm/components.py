"""Connected components of a link table: contraction of blocks of links, then alternating large-star and small-star rounds.

A task turns each block of its links into stars around the smallest nodes, which keeps what is connected and leaves one link
a node and block; links of a single block are done by that. Blocks have a stated size, whatever the number of links. Every round is two grouped minima and two joins on DataFrames, written to the shared folder, so that nothing but a count
and a checksum reaches the driver and lost executors cost one round at most. The number of rounds grows with the logarithm
of the longest chain. A node with very many links is a hot join key that adaptive execution splits; its minimum is
aggregated partially before any shuffle. Rounds run on as many partitions as the links need, not on the session's number:
links are few beside the documents, and a round of very many tiny tasks costs the driver more than the links do.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise


#: Links a partition and a block: two longs each, some megabytes.
LINKS_A_TASK = 250_000


@contextmanager
def partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Shuffles inside have n partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, int(r.h or 0)


def _stars(block: list[pd.DataFrame]) -> pd.DataFrame:
    """Links -> (node, smallest node that these links reach from it) for every node but the smallest ones."""
    nodes, ends = np.unique(pd.concat(block)[["a", "b"]].to_numpy(), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        less = root.copy()
        for ends in (a, b, root[a], root[b]):
            np.minimum.at(less, ends, low)
        less = less[less]
        if (less == root).all():
            break
        root = less
    linked = root != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[linked], "b": nodes[root[linked]]})


def _blocks(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Stars of a task's links, block by block; most links or fewer are one block."""
    block, rows = [], 0
    for batch in batches:
        if rows and rows + len(batch) > most:
            yield _stars(block)
            block, rows = [], 0
        block.append(batch)
        rows += len(batch)
    if rows:
        yield _stars(block)


def components(links: DataFrame, links_a_task: int = LINKS_A_TASK) -> DataFrame:
    """links (a long, b long) -> (node, root) for every node that has a link; root is the smallest node of its component.

    links_a_task: size of a block; it changes the plan, not the result.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "links")
    tasks = -(-edges.count() // links_a_task)
    stars = (edges.coalesce(1) if tasks <= 1 else edges).mapInPandas(lambda batches: _blocks(batches, links_a_task), "a long, b long")
    edges = materialise(stars, "links")
    if tasks > 1:
        with partitions(edges.sparkSession, tasks):
            edges = _contracted(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def _contracted(edges: DataFrame) -> DataFrame:
    """The links (larger, smaller) as stars around each component's smallest node."""
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        star = materialise(star, "links")
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        near = star.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(near.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(edges)
        if after == before:
            return edges
        before = after
