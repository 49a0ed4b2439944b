"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a hash sample of at most ``SAMPLE`` vectors (its size, and
so what is broadcast, is bounded by that); every row of the table is indexed
into its leaf.  A query visits leaves best bin first: it descends to the
nearest child, keeps the other children in a priority queue by distance to
their centres, and goes on from the queue's nearest.

How many leaves to visit is calibrated: for ``CALIBRATION`` rows outside the
fitted sample (or, of a table no larger, inside it) the true neighbours are found by brute force over the whole table (in one pass,
a bounded list per task), and the visits are widened until the share of true
neighbours in visited leaves reaches ``recall``.  A query goes on past that
number until its leaves hold at least ``k`` rows other than its own id.  If the table has changed so
much that this needs all leaves, the search is exact.

Leaves and the queries that visit them are cut into blocks by counted size, so
a leaf of one vector a third of all rows share is many tasks.  Distances are
computed in double precision on the original vectors.

Defined results: vectors that are null, zero, hold null or non-finite
components, or whose length is not the table's commonest take no part; rows
with a null id take no part; rows of the query's id are not its candidates;
ties go to the smaller id; repeated candidate rows each count; repeated query
rows of equal vector are one query; fewer candidates give fewer results; an
empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.store import prepare, written

SAMPLE = 20_000
SAMPLE_NUMBERS = 8_000_000  # components of all sampled vectors
BRANCHES = 8
LEAF_SAMPLE = 64
CALIBRATION = 200
RECALL = 0.97
LEAF_BLOCK, QUERY_BLOCK = 4096, 2048


@dataclass
class Tree:
    """Nodes in order of creation; children of i are child[i]..child[i]+n[i]-1."""

    centre: np.ndarray   # nodes x dim
    child: np.ndarray    # first child, -1 at leaves
    n: np.ndarray        # children
    leaf: np.ndarray     # number of the leaf, -1 inside
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row by descent to the nearest child."""
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inside = np.flatnonzero(self.leaf[at] < 0)
            if not len(inside):
                return self.leaf[at]
            for node in np.unique(at[inside]):
                rows = inside[at[inside] == node]
                first, k = self.child[node], self.n[node]
                at[rows] = first + _squares(x[rows], self.centre[first: first + k]).argmin(axis=1)

    def visit(self, q: np.ndarray, most: int, held: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first ``most`` leaves of a query, best bin first, and further
        ones until they hold ``enough`` rows (``held`` by leaf)."""
        queue, out, rows = [(0.0, 0)], [], 0
        while queue and (len(out) < most or (held is not None and rows < enough)):
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                first, k = self.child[node], self.n[node]
                d = ((self.centre[first: first + k] - q) ** 2).sum(axis=1)
                best = int(d.argmin())
                for i in range(k):
                    if i != best:
                        heapq.heappush(queue, (float(d[i]), int(first + i)))
                node = first + best
            out.append(int(self.leaf[node]))
            if held is not None:
                rows += int(held[out[-1]])
        return out


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)


def fit_tree(x: np.ndarray, seed: int = 5, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE) -> Tree:
    rng = np.random.default_rng(seed)
    centre, child, n, leaf, rows = [x.mean(axis=0)], [-1], [0], [-1], [np.arange(len(x))]
    at = leaves = 0
    while at < len(centre):
        own = rows[at]
        parts = _split(x[own], branches, rng) if len(own) > leaf_sample else []
        if len(parts) < 2:
            leaf[at] = leaves
            leaves += 1
        else:
            child[at], n[at] = len(centre), len(parts)
            for part in parts:
                centre.append(x[own[part]].mean(axis=0))
                child.append(-1)
                n.append(0)
                leaf.append(-1)
                rows.append(own[part])
        rows[at] = None
        at += 1
    return Tree(np.array(centre), np.array(child), np.array(n), np.array(leaf), leaves)


def _split(x: np.ndarray, k: int, rng) -> list[np.ndarray]:
    """Lloyd's rounds from spread starts; the non-empty clusters' rows."""
    c = [x[rng.integers(len(x))]]
    d = ((x - c[0]) ** 2).sum(axis=1)
    while len(c) < k and d.max() > 0:
        c.append(x[rng.choice(len(x), p=d / d.sum())])
        d = np.minimum(d, ((x - c[-1]) ** 2).sum(axis=1))
    c = np.array(c)
    for _ in range(10):
        own = _squares(x, c).argmin(axis=1)
        new = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        if np.allclose(new, c):
            break
        c = new
    return [p for p in (np.flatnonzero(own == i) for i in range(len(c))) if len(p)]


def usable(v: Column) -> Column:
    """Non-null, non-zero, all components finite."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x.cast("double") != 0), F.lit(False))


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _index(tree, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column(1), dim)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tree.value.assign(x))],
                                                 names=["vec_id", "v", "leaf"])
    return run


def _nearest(ids: np.ndarray, x: np.ndarray, own, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, distances) of the k nearest, ties to the smaller id."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    other = np.flatnonzero(ids != own)
    if len(other) > 4 * k:
        bound = np.partition(d[other], k - 1)[k - 1]
        other = other[d[other] <= bound]
    top = other[np.lexsort((ids[other], d[other]))[:k]]
    return top, d[top]


def _brute(queries, dim: int, k: int):
    """Each task's k nearest rows of each calibration query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, qv = queries.value
        best = [[] for _ in qid]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x, leaf = batch.column(0).to_numpy(), _vectors(batch.column(1), dim), batch.column(2).to_numpy()
            for i, (own, q) in enumerate(zip(qid, qv)):
                top, d = _nearest(ids, x, own, q, k)
                best[i] = sorted([*best[i], *zip(d.tolist(), ids[top].tolist(), leaf[top].tolist())])[:k]
        rows = [(i, *r) for i, found in enumerate(best) for r in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(
            (pa.int64(), pa.float64(), pa.int64(), pa.int64()))], names=["q", "score", "vec_id", "leaf"])
    return run


def _visits(tree, held, dim: int, most: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = [tree.value.visit(q, most, held.value, k + own)  # rows of the query's id do not count
                          for q, own in zip(_vectors(batch.column(1), dim), batch.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.list_(pa.int64()))],
                                                 names=["query_id", "qv", "leaves"])
    return run


def _block(dim: int, k: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            ids, x = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy()).astype(np.float64)
            for own, q in zip(queries["query_id"], queries["qv"]):
                top, d = _nearest(ids, x, own, np.asarray(q, dtype=np.float64), k)
                if len(top):
                    out.append(pd.DataFrame({"query_id": own, "qv": [q] * len(top), "vec_id": ids[top], "score": d}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series([], dtype=object) for c in ("query_id", "qv", "vec_id", "score")})
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
            recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of each row
    that ``is_query`` picks (a condition on ``vectors``)."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], empty)
    dim = sizes[0].dim
    rows = rows.where(F.size("v") == dim)
    size = max(1, min(sample, SAMPLE_NUMBERS // dim))
    drawn = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(size + CALIBRATION).collect()
    x = np.array([r.v for r in drawn[:size]], dtype=np.float64)
    fitted = fit_tree(x)
    tree = spark.sparkContext.broadcast(fitted)
    indexed = written(rows.select("vec_id", "v").mapInArrow(_index(tree, dim), "vec_id long, v array<double>, leaf long"), "ann-rows")

    probes = [*drawn[size:], *drawn[:size]][:CALIBRATION]  # outside the fitted sample where there are such rows
    px = np.array([r.v for r in probes], dtype=np.float64)
    probe = spark.sparkContext.broadcast((np.array([r.vec_id for r in probes]), px))
    by = Window.partitionBy("q").orderBy("score", "vec_id")
    truth = (indexed.mapInArrow(_brute(probe, dim, k), "q long, score double, vec_id long, leaf long")
             .withColumn("r", F.row_number().over(by)).where(F.col("r") <= k).select("q", "leaf").collect())  # probes x k
    places = {}
    for q in {r.q for r in truth}:
        places[q] = {leaf: i for i, leaf in enumerate(fitted.visit(px[q], fitted.leaves))}
    needed = np.sort([places[r.q][r.leaf] + 1 for r in truth])
    visits = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else fitted.leaves

    in_leaf = written(indexed.groupBy("leaf").agg(F.count("*").alias("n")), "ann-leaves")  # a row per leaf, bounded by the tree
    held = np.zeros(fitted.leaves, dtype=np.int64)
    for r in in_leaf.collect():
        held[r.leaf] = r.n
    held = spark.sparkContext.broadcast(held)

    own = rows.groupBy("vec_id").agg(F.count("*").alias("own"), F.max("asks").alias("asks")).where("asks").select("vec_id", "own")
    queries = rows.where("asks").select("vec_id", "v").dropDuplicates(["vec_id", "v"]).join(own, "vec_id").select("vec_id", "v", "own")
    asked = (queries.mapInArrow(_visits(tree, held, dim, visits, k), "query_id long, qv array<double>, leaves array<long>")
             .withColumn("leaf", F.explode("leaves")).drop("leaves"))
    asked = written(asked, "ann-queries")
    # blocks by counted size
    in_leaf = in_leaf.select("leaf", F.ceil(F.col("n") / LEAF_BLOCK).alias("blocks"))
    of_leaf = asked.groupBy("leaf").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("q_blocks"))
    sizes = F.broadcast(in_leaf.join(F.broadcast(of_leaf), "leaf"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = (indexed.join(sizes, "leaf").withColumn("b", F.pmod(F.xxhash64("vec_id"), "blocks")).withColumn("c", every(F.col("q_blocks")))
            .select("leaf", "b", "c", "vec_id", "v"))
    right = (asked.join(sizes, "leaf").withColumn("c", F.pmod(F.xxhash64("query_id"), "q_blocks")).withColumn("b", every(F.col("blocks")))
             .select(F.col("leaf").alias("l"), F.col("b").alias("lb"), F.col("c").alias("lc"), "query_id", "qv"))
    found = left.groupBy("leaf", "b", "c").cogroup(right.groupBy("l", "lb", "lc")).applyInPandas(
        _block(dim, k), "query_id long, qv array<double>, vec_id long, score double")
    best = Window.partitionBy("query_id", "qv").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
