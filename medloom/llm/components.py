"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.mapping import arrow_map
from medloom.sources.shared import written

#: A graph of at most so many edges is finished in one task (some 100 MB); a larger one takes distributed rounds.
TASK_EDGES = 1_000_000


class Forest:
    """Union-find over numbers 0 to n - 1; the root of a tree is its smallest number."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if not ends:
        return
    u, v = (np.concatenate(x) for x in zip(*ends, strict=True))
    nodes, place = np.unique(np.append(u, v), return_inverse=True)
    forest = Forest(len(nodes))
    for i, j in zip(place[: len(u)].tolist(), place[len(u) :].tolist(), strict=True):
        forest.join(i, j)
    roots = nodes[[forest.root(i) for i in range(len(nodes))]]
    yield from pa.table({"node": nodes, "component": roots}).to_batches(max_chunksize=100_000)


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """The smallest node each node can reach: node, component, for every node on an edge.

    ``edges`` has columns a and b (longs). At most ``task_edges`` distinct edges are joined in one task. More take
    rounds of alternating stars: each round links the larger neighbours of a node to its smallest
    neighbour, then the smaller ones; every step is a combining aggregation and a join on the node, so a node with
    very many edges is not gathered. The number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder.
    """
    pairs = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if pairs.count() <= task_edges:
        return arrow_map(pairs.coalesce(1), _in_one_task, "node long, component long")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        # large star: neighbours above u move to the smallest node around u
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        # small star: all smaller neighbours of u, and u itself, move to the smallest of them
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = written(small.filter("u <> v").distinct(), "edges")
        marks = [p.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first() for p in (pairs, new)]
        pairs = new
        if marks[0] == marks[1]:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")))
