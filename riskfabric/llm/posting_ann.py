"""Approximate nearest neighbours by balanced posting lists.

*Centroids.* Spherical k-means on at most ``SAMPLE`` vectors (those with the smallest hash of
their identifier), started from the sample's own vectors. *Lists.* Every vector goes to its
nearest centroid's list and, if it lies near a boundary, to those of further centroids whose
distance is at most ``1 + BOUNDARY`` times the nearest one's (``REPLICAS`` lists at most). A list is dealt over
as many parts as it needs to hold ``PART`` vectors each, so a list that holds a large share of
all vectors is many tasks' work. *Search.* A query walks a graph of the centroids (each linked to
its ``LINKS`` nearest and, in ring order, to its neighbours) from an entry point, best first, and
takes the lists whose centroid distance is at most ``1 + RATIO`` times the nearest one's, ``MOST_LISTS``
at most. Every part returns its nearest ones for the queries that ask for it, by the
cosine of the original vectors in double precision, and they are merged by query.

The centroids and their graph are bounded by ``MAX_CENTROIDS``; the queries pass through Spark,
not through the driver. Recall is measured in the tests against brute force.

Defined results: vectors null, zero, of another length than the first sampled one, or holding
null or non-finite components take no part; a null identifier takes no part either; of repeated
identifiers each row is a candidate; ties go to the smaller identifier; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfabric.llm.common import hash_sample, map_arrow, scratch_table, ship_package

SAMPLE, MAX_CENTROIDS, ITERATIONS = 20_000, 512, 12
REPLICAS, BOUNDARY = 4, 0.10
MOST_LISTS, RATIO = 48, 0.5
LINKS, BEAM = 16, 96
PART = 2_000
DEPTH_SEED = 42


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array<double>): the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some: Column = F.exists(v, lambda x: x != 0)
    return vectors.where(fine & some).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids of the sample's unit vectors; an empty cluster takes the vector worst served."""
    x = _unit(sample)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    c = distinct[np.random.default_rng(DEPTH_SEED).permutation(len(distinct))[:k]]
    for _ in range(ITERATIONS):
        near = x @ c.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(axis=1))
        bad = size < 1e-12
        c = np.where(bad[:, None], c, sums / np.maximum(size, 1e-12)[:, None])
        if bad.any():
            c[bad] = x[np.argsort(near.max(axis=1), kind="stable")[: bad.sum()]]
    return c


class CentroidGraph:
    """Centroids linked to their nearest ones; searched best first from a fixed entry."""

    def __init__(self, c: np.ndarray):
        self.c, n = c, len(c)
        near = np.argsort(-(c @ c.T), axis=1, kind="stable")[:, 1 : LINKS + 1]
        links = [set(row.tolist()) for row in near]
        for i, row in enumerate(near.tolist()):
            for j in row:
                links[j].add(i)
            links[i].update({(i + 1) % n, (i - 1) % n} - {i})  # the ring keeps the graph in one piece
        self.links = [np.array(sorted(x), np.int64) for x in links]
        self.entry = int((c @ c.mean(axis=0)).argmax()) if n else 0

    def search(self, q: np.ndarray, beam: int = BEAM) -> list[tuple[float, int]]:
        """(squared distance, centroid) of the nearest found, nearest first."""
        first = 2 - 2 * float(self.c[self.entry] @ q)
        seen, todo, best = {self.entry}, [(first, self.entry)], [(-first, -self.entry)]
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = [j for j in self.links[i].tolist() if j not in seen]
            seen.update(new)
            for j, s in zip(new, (2 - 2 * (self.c[new] @ q)).tolist() if new else (), strict=True):
                if len(best) < beam or s < -best[0][0]:
                    heapq.heappush(todo, (s, j))
                    heapq.heappush(best, (-s, -j))
                    if len(best) > beam:
                        heapq.heappop(best)
        return sorted((-s, -j) for s, j in best)

    def lists(self, q: np.ndarray, sizes: np.ndarray, k: int) -> list[int]:
        """The lists to read: pruned by the ratio of distances; all lists if those don't hold ``k`` vectors."""
        found = self.search(q)
        limit = math.sqrt(max(found[0][0], 0.0)) * (1 + RATIO) + 1e-9
        near = [j for s, j in found[:MOST_LISTS] if math.sqrt(max(s, 0.0)) <= limit]
        return near if sizes[near].sum() >= k else list(range(len(self.c)))


def _homes(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, is the nearest list) of every copy of the vectors ``x``."""
    d = np.sqrt(np.maximum(2 - 2 * (_unit(x) @ c.T), 0))
    order = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
    near = np.take_along_axis(d, order, axis=1)
    keep = near <= near[:, :1] * (1 + BOUNDARY)
    keep[:, 0] = True
    row, at = np.nonzero(keep)
    return row, order[row, at], at == 0


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row of ``queries`` among ``vectors``, its own identifier left out."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    sample = hash_sample(rows, "vec_id", SAMPLE, "v").select("v").toArrow().column("v").combine_chunks()
    result = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], result)
    width = len(sample[0])
    points = np.array([x for x in sample.to_pylist() if len(x) == width])
    n = rows.count()
    k_lists = int(min(MAX_CENTROIDS, max(1, round(math.sqrt(n)))))
    graph = spark.sparkContext.broadcast(CentroidGraph(fit_centroids(points, k_lists)))
    rows, asked = rows.where(F.size("v") == width), asked.where(F.size("v") == width)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = graph.value.c
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                row, home, first = _homes(_rows(part.column("v")), c)
                moved = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), pa.array(first), moved.column("vec_id"), moved.column("v")], names=["list", "first", "vec_id", "v"])

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = [g.lists(q, sizes, k + 1) for q in _unit(_rows(batch.column("v")))]
            row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            moved = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array([j for x in lists for j in x], pa.int32()), moved.column("vec_id"), moved.column("v")], names=["list", "query_id", "q"])

    homes = scratch_table(map_arrow(rows, place, "list int, first boolean, vec_id long, v array<double>"), "posting_lists")
    # A list in as many parts as it needs; a vector's part is a hash of its identifier.
    parts = homes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"), F.sum(F.col("first").cast("int")).alias("own"))
    sizes = np.zeros(MAX_CENTROIDS, np.int64)
    for r in parts.collect():
        sizes[r["list"]] = r["own"]
    parts = parts.select("list", "parts")
    homes = homes.join(F.broadcast(parts), "list")  # MAX_CENTROIDS rows at most
    homes = homes.select("list", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"), "vec_id", "v")
    sent = map_arrow(asked, aim, "list int, query_id long, q array<double>").join(F.broadcast(parts), "list")
    sent = sent.select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query_id", "q")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _part_best(left, right, k)

    found = homes.groupBy("list", "part").cogroup(sent.groupBy("list", "part")).applyInPandas(score, "query_id long, vec_id long, score double")
    # A boundary vector may be found in several lists.
    once = found.dropDuplicates(["query_id", "vec_id", "score"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with the rows of ``x``, in double precision; each row by itself, so equal rows get equal values."""
    return np.einsum("ij,j->i", x, q) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * math.sqrt(float(np.einsum("i,i->", q, q))))


def _part_best(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(left) and len(right):
        x, ids = np.stack(left["v"].to_numpy()), left["vec_id"].to_numpy()
        for query, q in zip(right["query_id"].tolist(), right["q"], strict=True):
            s = cosine(np.asarray(q), x)
            own = ids != query
            order = np.lexsort((ids[own], -s[own]))[:k]
            out["query_id"] += [query] * len(order)
            out["vec_id"] += ids[own][order].tolist()
            out["score"] += s[own][order].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
