"""Connected components of an edge table, by contraction within partitions and star steps between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import staged

ROWS_PER_TASK = 500_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: every node with the least node that they connect it to, without the least nodes."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        # Roots move under lesser roots, then all nodes to the root of their root.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch as stars."""
    for batch in batches:
        u, v = (c.to_numpy() for c in batch.columns)
        if len(u):
            u, v = stars(u, v)
            yield pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)})


def _least(pairs: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the least of u and its neighbours; mins are reduced before the shuffle."""
    return pairs.join(pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "u")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``u, v`` (long); the component is its least node.

    Contraction leaves one edge per node and batch. A large-star step then links all larger neighbours of a node to its least one, a
    small-star step all smaller ones; what does not change under these is a star for each component. A node with very many
    neighbours is reduced before it is shuffled. Rounds are written to the shared folder, which cuts the lineage, in as
    many tasks as their rows ask for.
    """
    schema = "u long, v long"
    edges = staged(edges.filter("u != v").select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(_contract, schema), "edges")
    mark = _mark(edges)
    while mark[0]:
        tasks = 1 + mark[0] // ROWS_PER_TASK
        edges = edges.coalesce(tasks)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").coalesce(tasks)
        large = staged(large.mapInArrow(_contract, schema), "large").coalesce(tasks)
        pairs = _least(large).coalesce(tasks)
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(pairs.select("u", F.col("m").alias("v")))
        small = small.filter("u != v").coalesce(tasks).mapInArrow(_contract, schema).distinct().coalesce(tasks)
        edges = staged(small, "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots).withColumnRenamed("u", "node")
