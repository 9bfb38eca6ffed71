"""Nearest neighbours by cosine from a forest of random-projection trees.

* Index: vectors of each length have trees of their own, fitted on a bounded sample (``SAMPLE`` rows of that length,
  those of least hash), so they are small whatever the table's size; every row is then sent down every tree. Rows with identical vectors are one entry, with the
  smallest ids that can appear in an answer, so a vector that a third of all rows share is one entry too.
* Search: a query goes down all trees through one shared priority queue of branches, ordered by the largest margin
  by which the query lies on the other side. Leaves are taken until they hold ``share`` times as many entries
  as there are in one tree, and ``LEAST`` at least.
* Rerank: queries meet the entries of their leaves in blocks, and get exact cosines in double precision. A leaf of
  more than ``LEAF_ROWS`` entries is dealt into parts; queries of a part are streamed in batches.

``share`` buys recall: vectors without structure need a large one, clustered vectors a small one.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.mapping import arrow_map
from medloom.sources.shared import written

TREES = 3
LEAVES = 256
SHARE = 1.2
LEAST = 1000
SAMPLE = 20_000
LEAF_ROWS = 20_000
QUERY_BATCH = 512


class Tree:
    """A random-projection tree: normals and thresholds of inner nodes, leaves numbered from 0."""

    def __init__(self, rows: np.ndarray, leaves: int, rng: np.random.Generator):
        self.normal: list[np.ndarray] = []
        self.threshold: list[float] = []
        self.child: list[list[int]] = []  # a leaf k is -1 - k
        self.leaves = 0
        self.root = self._grow(rows, max(1, -(-len(rows) // leaves)), rng)

    def _grow(self, rows: np.ndarray, most: int, rng: np.random.Generator) -> int:
        side = None
        if len(rows) > most:
            a, b = rows[rng.choice(len(rows), 2, replace=False)]
            normal = a - b
            if not normal.any():
                normal = rng.normal(size=rows.shape[1])
            normal /= np.linalg.norm(normal)
            along = rows @ normal
            threshold = float(np.median(along))
            side = along > threshold
        if side is None or side.all() or not side.any():
            self.leaves += 1
            return -self.leaves
        me = len(self.normal)
        self.normal.append(normal)
        self.threshold.append(threshold)
        self.child.append([0, 0])
        self.child[me] = [self._grow(rows[~side], most, rng), self._grow(rows[side], most, rng)]
        return me

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.full(len(rows), self.root)
        if self.root < 0:
            return -1 - at
        normal, threshold, child = np.array(self.normal), np.array(self.threshold), np.array(self.child)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            up = np.einsum("ij,ij->i", rows[inner], normal[node]) > threshold[node]
            at[inner] = child[node, up.astype(np.int64)]
        return -1 - at


def leaves_for(query: np.ndarray, trees: list[Tree], sizes: list[np.ndarray], wanted: float) -> list[tuple[int, int]]:
    """Leaves of all trees, most promising first, until they hold ``wanted`` entries."""
    queue: list[tuple[float, int, int]] = [(0.0, t, tree.root) for t, tree in enumerate(trees)]
    found, held = [], 0.0
    while queue and held < wanted:
        worst, t, node = heapq.heappop(queue)
        tree = trees[t]
        while node >= 0:
            margin = float(tree.normal[node] @ query) - tree.threshold[node]
            near = int(margin > 0)
            heapq.heappush(queue, (max(worst, abs(margin)), t, tree.child[node][1 - near]))
            node = tree.child[node][near]
        leaf = -1 - node
        if sizes[t][leaf]:
            found.append((t, leaf))
            held += sizes[t][leaf]
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that the largest component lies in 0.5 to 1: exact, and squares neither overflow nor vanish."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))[1])


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each batch whose vectors have the same length, with that length."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("vec")).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths).tolist():
            yield n, batch.take(pa.array(np.flatnonzero(lengths == n)))


def _place(forests: dict[int, tuple[int, list[Tree]]]) -> Callable:
    """The leaf of every entry in every tree; trees of a vector length are numbered from its first number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in by_length(batches):
            unit = _unit(_matrix(batch.column("vec")))
            first, trees = forests[length]
            for t, tree in enumerate(trees, first):
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array(np.full(len(unit), t, np.int32)),
                        "leaf": pa.array(tree.leaf_of(unit).astype(np.int32)),
                        "ids": batch.column("ids"),
                        "vec": batch.column("vec"),
                    }
                )

    return run


def _visit(forests: dict[int, tuple[int, list[Tree]]], sizes: list[np.ndarray], share: float) -> Callable:
    """The leaves of every query among the vectors of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in by_length(batches):
            if length not in forests:
                continue
            first, trees = forests[length]
            own = sizes[first : first + len(trees)]
            wanted = max(LEAST, share * int(own[0].sum()))
            for i, query in enumerate(_unit(_matrix(batch.column("vec")))):
                found = np.array(leaves_for(query, trees, own, wanted), np.int32).reshape(-1, 2)
                rows = pa.array([i] * len(found))
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array(found[:, 0] + np.int32(first)),
                        "leaf": pa.array(found[:, 1]),
                        "id": batch.column("id").take(rows),
                        "vec": batch.column("vec").take(rows),
                    }
                )

    return run


def nearest(queries: np.ndarray, names: list[int], rows: np.ndarray, ids: list[list[int]], k: int) -> Iterator[tuple[int, int, float]]:
    """(query, id, cosine) of the k nearest entries of each query, without the query's own id; ties may add some."""
    queries, rows = _scaled(queries), _scaled(rows)
    lengths = np.linalg.norm(rows, axis=1)
    rough = (queries @ rows.T) / (np.linalg.norm(queries, axis=1)[:, None] * lengths)
    last = min(len(rows), k + 1) - 1  # one more than asked: the query itself may be among them
    for q, name, near in zip(queries, names, rough, strict=True):
        at = np.flatnonzero(near >= -np.partition(-near, last)[last] - 1e-9)
        exact = (rows[at] * q).sum(axis=1) / (lengths[at] * np.sqrt((q * q).sum()))
        best = sorted((-s, i) for s, j in zip(exact.tolist(), at.tolist(), strict=True) for i in ids[j] if i != name)
        yield from ((name, i, -s) for s, i in best[:k])


def _rerank(k: int) -> Callable:
    """Rows arrive sorted by leaf part, entries before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, ids, names, queries = None, [], [], [], []

        def answer() -> Iterator[pa.RecordBatch]:
            if rows and queries:
                found = list(nearest(np.array(queries, np.float64), names, np.array(rows, np.float64), ids, k))
                if found:
                    q, i, s = zip(*found, strict=True)
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})
            names.clear()
            queries.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            flat, lengths = (x.to_numpy(zero_copy_only=False) for x in (batch.column("vec").flatten(), pc.list_value_length(batch.column("vec"))))
            vecs = np.split(flat.astype(np.float64), np.cumsum(lengths)[:-1])
            columns = (batch.column(c).to_pylist() for c in ("tree", "leaf", "part", "id", "ids"))
            for vec, tree, leaf, part, name, own in zip(vecs, *columns, strict=True):
                if (tree, leaf, part) != key:
                    yield from answer()
                    key, rows, ids = (tree, leaf, part), [], []
                if own is not None:
                    rows.append(vec)
                    ids.append(own)
                else:
                    names.append(name)
                    queries.append(vec)
                    if len(names) >= QUERY_BATCH:
                        yield from answer()
        yield from answer()

    return run


def search(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    trees: int = TREES,
    leaves: int = LEAVES,
    share: float = SHARE,
    sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """The k nearest rows found for each query by cosine: query_id, rank (from 1), vec_id, score.

    Nearest first, ties to the smaller id; a query's own id is no answer; with fewer candidates, all found. Vectors
    that are missing, zero, or hold a missing or non-finite component take no part, nor do rows without id. A query
    is answered among the vectors of its own length. An id with several vectors is asked, and found, by its best.
    Repeated rows count once. Other columns are ignored; an empty table gives an empty table. The index of each length
    is fitted on the ``sample`` rows of least hash and holds every row.
    """
    spark = vectors.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
        sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
        return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull()).filter(sound)

    rows = valid(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    first = Window.partitionBy("vec").orderBy("id")
    kept = rows.distinct().withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    entries = written(kept.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    lengths = sorted(r.n for r in entries.select(F.size("vec").alias("n")).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], schema)
    forests: dict[int, tuple[int, list[Tree]]] = {}
    for n in lengths:
        own = entries.filter(F.size("vec") == n)
        drawn = own.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(sample).collect()  # bounded by sample
        fitted = _unit(np.array([r.vec for r in drawn]))
        rng = np.random.default_rng(0)
        forests[n] = (trees * len(forests), [Tree(fitted, leaves, rng) for _ in range(trees)])

    placed = written(arrow_map(entries, _place(forests), "tree int, leaf int, ids array<long>, vec array<double>"), "leaves")
    counts = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()  # bounded by the forest's leaves
    sizes = [np.zeros(tree.leaves, np.int64) for _, forest in forests.values() for tree in forest]
    for r in counts:
        sizes[r.tree][r.leaf] = r.n
    parts = F.ceil(F.col("n") / leaf_rows).cast("int")
    dealing = spark.createDataFrame([(r.tree, r.leaf, r.n) for r in counts], "tree int, leaf int, n long").select("tree", "leaf", parts.alias("parts"))
    asked = valid(queries).distinct()
    visits = arrow_map(asked, _visit(forests, sizes, share), "tree int, leaf int, id long, vec array<double>")
    parted = placed.join(F.broadcast(dealing), ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int").alias("part"), F.lit(None).cast("long").alias("id"), "ids", "vec"
    )
    visiting = visits.join(F.broadcast(dealing), ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", F.lit(None).cast("array<long>").alias("ids"), "vec"
    )
    meeting = parted.unionByName(visiting).repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part", F.col("ids").isNull())
    found = arrow_map(meeting, _rerank(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
