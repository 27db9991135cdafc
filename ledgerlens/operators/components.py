"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import skew_join
from ledgerlens.sources import Scratch


# Links that one task contracts at a time; half a million take about 80 MB of its Python.
_CHUNK = 500_000


def connected_components(edges: DataFrame, scratch: Scratch, chunk: int = _CHUNK) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    `edges` has bigint columns `a` and `b`. Each round links every node to the
    smallest node next to it, first from above, then from below, until the
    links form stars. Every round starts from links that were contracted where
    they lay. Rounds grow with the logarithm of the graph's size and hand over
    through stored tables.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = _contract(edges.select(a.alias("child"), b.alias("parent")).filter("child <> parent"), scratch, chunk)
    while not _are_stars(links):
        links = _contract(_small_star(_large_star(links, scratch), scratch), scratch, chunk)
    roots = links.select(F.col("parent").alias("node")).distinct()
    return links.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    roles = links.select(F.col("child").alias("node"), one.alias("up"), zero.alias("down")).unionByName(
        links.select(F.col("parent").alias("node"), zero.alias("up"), one.alias("down"))
    )
    totals = roles.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return totals.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _contract(links: DataFrame, scratch: Scratch, chunk: int) -> DataFrame:
    """Replace the links of each chunk by stars that connect the same nodes.

    The map-side combine of connectivity: a chunk of links becomes at most one
    link per node, and repeated links fall away.
    """
    # Gathers links of a node, yet splits what would make one task too large.
    gathered = links.hint("rebalance", "child")

    def stars_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One array takes the links of all chunks in turn.
        held, size = np.empty((2, chunk), dtype=np.int64), 0
        for batch in batches:
            links, at = np.stack([batch[k].to_numpy() for k in ("child", "parent")]), 0
            while at < links.shape[1]:
                taken = min(chunk - size, links.shape[1] - at)
                held[:, size : size + taken] = links[:, at : at + taken]
                size, at = size + taken, at + taken
                if size == chunk:
                    yield from _in_batches(*_stars(*held))
                    size = 0
        if size:
            yield from _in_batches(*_stars(*held[:, :size]))

    return scratch.write(gathered.mapInArrow(stars_of_chunks, "child long, parent long"), "links")


def _in_batches(child: np.ndarray, parent: np.ndarray, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Links in pieces that take little memory on their way to the JVM."""
    for at in range(0, len(child), rows):
        columns = [pa.array(x[at : at + rows]) for x in (child, parent)]
        yield pa.RecordBatch.from_arrays(columns, names=["child", "parent"])


def contracted(links: pd.DataFrame) -> pd.DataFrame:
    """Stars (child, parent) that connect the same nodes as the links."""
    child, parent = _stars(links["child"].to_numpy(), links["parent"].to_numpy())
    return pd.DataFrame({"child": child, "parent": parent})


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    # Places of nodes take half the memory of their numbers.
    a, b = places.astype(np.int32).reshape(2, -1)
    root = np.arange(len(nodes), dtype=np.int32)
    while True:
        # Hook the roots of both ends to the smaller one, then follow the hooks.
        low, before = np.minimum(root[a], root[b]), root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


def _large_star(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it, itself included."""
    both = links.select(F.col("child").alias("node"), F.col("parent").alias("near")).unionByName(
        links.select(F.col("parent").alias("node"), F.col("child").alias("near"))
    )
    smallest = both.groupBy("node").agg(F.min("near").alias("low"), F.count("*").alias("degree"))
    smallest = scratch.write(smallest.withColumn("low", F.least("node", "low")), "smallest")
    larger = both.filter(F.col("near") > F.col("node"))
    moved = skew_join(larger, smallest, ["node"], "degree", F.col("near")).select(
        F.col("near").alias("child"), F.col("low").alias("parent")
    )
    return scratch.write(moved.distinct(), "large-star")


def _small_star(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("child").agg(F.min("parent").alias("low"), F.count("*").alias("degree"))
    smallest = scratch.write(smallest, "smallest")
    # The node itself hangs under the smallest neighbour, as do the others.
    moved = skew_join(links, smallest, ["child"], "degree", F.col("parent")).select(
        F.inline(
            F.array(
                F.struct(F.col("parent").alias("child"), F.col("low").alias("parent")),
                F.struct(F.col("child"), F.col("low").alias("parent")),
            )
        )
    )
    return moved.filter("child <> parent")
