"""Exact k-means by Shallot search, in integers.

Components become integers floor(scale * x). Every vector remembers its centroid, its second
nearest, an upper bound of the distance to the first and a lower bound of that to all others;
the centroids' moves loosen both. A vector whose upper bound lies under the lower one, or under half the way
to the next centroid, keeps its centroid unseen. For the rest both remembered centroids are
measured, and the scan starts from the closer one: the other centroids follow in the order of
their distance from it, until that distance leaves the ball of (distance to the start + second
nearest distance so far); the ball shrinks with each closer find. Candidates that survive are compared by
squared distance in integers, ties to the smaller number; bounds only ever skip what is
farther by more than their rounding.

Each round reads the vectors' table, writes it anew with their state (the table before is
dropped) and, in the same pass, one row a task and centroid of what its vectors' moves changed in the
sums. The driver holds the centroids, their sums and counts, all bounded by k and the dimension.

Defined results: vectors null, of another length, or holding null or non-finite components take no
part; each repeated row is a vector, and repeated identifiers are starting centroids in the order of their
components; rows with a null identifier are assigned, but start as centroids only after all others; fewer
vectors than k are as many centroids; other columns are left out; an empty table gives no rows. Vectors with an
integer component beyond ``LARGE`` are compared with all centroids in Python's integers; distances and sums over
the largest long are returned as that.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfabric.llm.common import drop_table, map_arrow, scratch_table

DIM, K, ROUNDS, SCALE = 64, 40, 5, 256
#: Integer components up to this give squared distances that fit a long, and up to EXACT ones that doubles hold exactly.
LARGE, EXACT = 1 << 27, 1 << 22
LONGEST = 2**63 - 1
#: Bounds are widened by this share, far above the rounding of the sums and roots they come from.
SLACK = 1e-9

_STATE = "vec_id long, point array<int>, wide array<double>, cluster int, second int, upper double, lower double, distance long, part int, moved long, change array<string>"
_SCHEMA_NAMES = [x.split()[0] for x in _STATE.split(", ")]
_TYPES = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())]


def usable(vectors: DataFrame, dim: int = DIM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, wide (array<double>): the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("wide"))


def scaled(x: float, scale: int) -> int:
    """floor(scale * x) without rounding."""
    n, d = x.as_integer_ratio()
    return n * scale // d


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _as_points(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """First state of vectors: integers, or the doubles themselves where integers are large; no centroid yet."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = np.floor(_matrix(batch.column("wide")) * scale)
        small = (np.abs(x) <= LARGE).all(axis=1)
        points = np.where(small[:, None], x, 0).astype(np.int32)
        wide = pa.nulls(n, _TYPES[2]) if small.all() else _lists(_matrix(batch.column("wide")), pa.float64(), ~small)
        yield _rows(batch.column("vec_id"), _lists(points, pa.int32(), small), wide, np.full(n, -1), np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n, np.int64))


def _lists(rows: np.ndarray, kind: pa.DataType, there: np.ndarray) -> pa.Array:
    """Rows as lists, null where not ``there``."""
    n, dim = rows.shape
    ends = np.r_[0, np.cumsum(np.where(there, dim, 0))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[there].ravel(), kind), mask=pa.array(~there))


def _rows(ids: pa.Array, point: pa.Array, wide: pa.Array, *state: np.ndarray) -> pa.RecordBatch:
    state = [pa.array(np.asarray(x), t) for x, t in zip(state, _TYPES[3:8], strict=True)]
    return pa.RecordBatch.from_arrays([ids, point, wide, *state, *[pa.nulls(len(ids), t) for t in _TYPES[8:]]], names=_SCHEMA_NAMES)


class Search:
    """One round's centroids (lists of Python integers), and where they were in the round before."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.exact = centroids
        self.k = len(centroids)
        self.large = max((abs(x) for c in centroids for x in c), default=0) > LARGE
        if self.large:  # some vectors are out of range, so centroids may be, too
            return
        self.c = np.array(centroids, np.int64)
        self.biggest = int(np.abs(self.c).max())
        gap = np.sqrt([[float(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) for b in centroids] for a in centroids])
        np.fill_diagonal(gap, -1)
        self.near = np.argsort(gap, axis=1, kind="stable")[:, 1:]  # the other centroids, nearest first
        self.way = np.take_along_axis(gap, self.near, axis=1) * (1 - SLACK)
        self.half = self.way[:, 0] / 2 if self.k > 1 else np.full(1, np.inf)
        if before is not None:
            moved = np.sqrt([float(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) for a, b in zip(centroids, before, strict=True)]) * (1 + SLACK)
            self.moved = moved
            top = int(moved.argmax())
            others = np.delete(moved, top).max() if self.k > 1 else 0.0
            self.others = np.full(self.k, moved[top])
            self.others[top] = others

    def squared(self, x: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """Squared distances of rows to one centroid each, exact."""
        d = x - self.c[at]
        return np.einsum("ij,ij->i", d, d)

    def all(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second nearest of every row, and their squared distances, from all centroids."""
        n = len(x)
        if max(self.biggest, int(np.abs(x).max(initial=0))) <= EXACT:
            a, b = x.astype(np.float64), self.c.astype(np.float64)  # all sums are integers below 2 ** 53
            d = ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
        else:
            d = np.stack([self.squared(x, j) for j in range(self.k)], axis=1) if n else np.zeros((0, self.k), np.int64)
        rows, first = np.arange(n), d.argmin(axis=1) if n else np.zeros(0, np.int64)
        best = d[rows, first]
        if self.k == 1:
            return first, np.full(n, -1), best, np.full(n, LONGEST)
        d[rows, first] = LONGEST
        second = d.argmin(axis=1) if n else np.zeros(0, np.int64)
        return first, second, best, d[rows, second]

    def shallot(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, d_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for rows whose bounds failed, from their two remembered centroids; d_a is known."""
        first, second, d1 = a.copy(), b.copy(), d_a.copy()
        d2 = self.squared(x, b)
        swap = (d2 < d1) | ((d2 == d1) & (b < a))
        first[swap], second[swap], d1[swap], d2[swap] = b[swap], a[swap], d2[swap], d1[swap]
        start, known = first.copy(), second.copy()
        reach = np.sqrt(d1) * (1 + SLACK)
        for s in np.unique(start).tolist():
            going = np.flatnonzero(start == s)
            for j, way in zip(self.near[s].tolist(), self.way[s].tolist(), strict=True):
                # Beyond this a centroid is farther than the second nearest so far.
                going = going[way <= reach[going] + np.sqrt(d2[going]) * (1 + SLACK)]
                if not len(going):
                    break
                ask = going[known[going] != j]
                d = self.squared(x[ask], j)
                closer = (d < d1[ask]) | ((d == d1[ask]) & (j < first[ask]))
                between = ~closer & ((d < d2[ask]) | ((d == d2[ask]) & (j < second[ask])))
                up, mid = ask[closer], ask[between]
                d2[up], second[up], d1[up], first[up] = d1[up], first[up], d[closer], j
                d2[mid], second[mid] = d[between], j
        return first, second, d1, d2

    def wide(self, x: list[int]) -> tuple[int, int]:
        """Nearest centroid and squared distance of a vector in Python's integers."""
        return min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), j) for j, c in enumerate(self.exact))[::-1]


def _round(search: Search, dim: int, scale: int, last: bool):
    """One round over the state table: new state, and a row a centroid of what changed in the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((search.k, dim), object), np.zeros(search.k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            small = batch.column("point").is_valid().to_numpy(zero_copy_only=False)
            old, second = batch.column("cluster").to_numpy().astype(np.int64), batch.column("second").to_numpy().astype(np.int64)
            upper, lower = batch.column("upper").to_numpy().copy(), batch.column("lower").to_numpy().copy()
            points = np.zeros((len(small), dim), np.int32)
            points[small] = _matrix(batch.column("point").filter(pa.array(small)))
            cluster, second, distance = old.copy(), second.copy(), np.zeros(len(small), np.int64)
            vector = {i: [scaled(v, scale) for v in batch.column("wide")[i].as_py()] for i in np.flatnonzero(~small).tolist()}
            if search.large:
                vector |= {i: points[i].tolist() for i in np.flatnonzero(small).tolist()}
                upper[:], lower[:] = math.inf, 0  # no bounds are kept
            else:
                _bounded(search, points, np.flatnonzero(small), cluster, second, upper, lower, distance, last)
            for i, x in vector.items():
                cluster[i], d = search.wide(x)
                distance[i] = min(d, LONGEST)
            for i in np.flatnonzero(cluster != old) if vector else ():
                if int(i) in vector and not small[i]:
                    for j, sign in ((old[i], -1), (cluster[i], 1)):
                        if j >= 0:
                            sums[j] += np.array([sign * v for v in vector[int(i)]], object)
            moved = np.flatnonzero((cluster != old) & small)
            if len(moved):
                part = np.zeros((search.k, dim), np.int64)
                np.add.at(part, cluster[moved], points[moved])
                was = moved[old[moved] >= 0]
                np.subtract.at(part, old[was], points[was])
                sums += part
            changed = np.flatnonzero(cluster != old)
            counts += np.bincount(cluster[changed], minlength=search.k)
            counts -= np.bincount(old[changed][old[changed] >= 0], minlength=search.k)
            yield _rows(batch.column("vec_id"), batch.column("point"), batch.column("wide"), cluster, second, upper, lower, distance)
        # Unchanged centroids have no row; a count of 0 may hide vectors that changed places.
        own = [j for j in range(search.k) if counts[j] or any(sums[j])]
        state = [pa.nulls(len(own), t) for t in _TYPES[:8]]
        yield pa.RecordBatch.from_arrays(
            [*state, pa.array(own, pa.int32()), pa.array([int(counts[j]) for j in own], pa.int64()), pa.array([[str(v) for v in sums[j]] for j in own], _TYPES[10])], names=_SCHEMA_NAMES
        )

    return run


def _bounded(search: Search, points, at, cluster, second, upper, lower, distance, last: bool) -> None:
    """Assign the rows ``at`` by their bounds; arrays are changed in place."""
    if not len(at):
        return
    fresh = at[(cluster[at] < 0) | (second[at] < 0) | ~np.isfinite(upper[at])]
    x = points[fresh].astype(np.int64)
    first, other, d1, d2 = search.all(x)
    cluster[fresh], second[fresh], distance[fresh] = first, other, d1
    upper[fresh], lower[fresh] = np.sqrt(d1), np.sqrt(d2)
    held = np.setdiff1d(at, fresh, assume_unique=True)
    if len(held):
        a = cluster[held]
        upper[held] = (upper[held] + search.moved[a]) * (1 + SLACK)
        lower[held] = (lower[held] - search.others[a]) * (1 - SLACK)
        apart = np.maximum(lower[held], search.half[a])
        open_ = held[upper[held] >= apart]
        d = search.squared(points[open_].astype(np.int64), cluster[open_])
        distance[open_], upper[open_] = d, np.sqrt(d) * (1 + SLACK)
        look = upper[open_] >= np.maximum(lower[open_], search.half[cluster[open_]])
        open_, d = open_[look], d[look]
        first, other, d1, d2 = search.shallot(points[open_].astype(np.int64), cluster[open_], second[open_], d)
        cluster[open_], second[open_], distance[open_] = first, other, d1
        upper[open_], lower[open_] = np.sqrt(d1) * (1 + SLACK), np.sqrt(d2) * (1 - SLACK)
        if last:  # the distances of vectors that kept their centroid unseen
            distance[held] = search.squared(points[held].astype(np.int64), cluster[held])


def _add(part: pa.Table) -> pa.Table:
    """Exact sum of one centroid's changes: a row a task."""
    total = np.zeros(len(part["change"][0]), object)
    for change in part["change"].to_pylist():
        total += np.array([int(v) for v in change], object)
    return pa.table({"part": part["part"][:1].cast(pa.int32()), "moved": pa.array([sum(part["moved"].to_pylist())], pa.int64()), "change": pa.array([[str(v) for v in total]], _TYPES[10])})


def starts(vectors: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k first vectors by the SHA-256 of ``seed:vec_id``, as integers."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "vec_id", "wide").limit(k).collect()
    return [[scaled(v, scale) for v in r["wide"]] for r in rows]


def kmeans(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = 2, dim: int = DIM, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` after ``rounds`` moves and a last assignment; and the final centroids."""
    found = usable(vectors, dim, id_col, vector_col)
    now, before = starts(found, k, scale, seed), None
    sums, counts = [[0] * dim for _ in now], [0] * len(now)
    state, table = map_arrow(found, lambda batches: _as_points(batches, scale), _STATE), None
    for r in range(rounds + 1 if now else 0):
        last, held = r == rounds, table
        table = scratch_table(map_arrow(state, _round(Search(now, before), dim, scale, last), _STATE), f"shallot_{r}")
        if held is not None:
            drop_table(held)
        state = table.where("part IS NULL")
        if last:
            break
        change = table.where("part IS NOT NULL").select("part", "moved", "change").groupBy("part").applyInArrow(_add, "part int, moved long, change array<string>")
        for row in change.collect():  # k rows at most
            counts[row["part"]] += row["moved"]
            sums[row["part"]] = [s + int(v) for s, v in zip(sums[row["part"]], row["change"], strict=True)]
        before, now = now, [[s // n for s in own] if n else c for own, n, c in zip(sums, counts, now, strict=True)]
    return state.select("vec_id", "cluster", "distance"), now


def clusters(spark: SparkSession, vectors: DataFrame, **options) -> DataFrame:
    """``kmeans`` with each cluster's inertia, that of all, and the SHA-256 of its centroid's components."""
    rows, centroids = kmeans(vectors, **options)
    per = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    everything = min(sum(per.values()), LONGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    table = spark.createDataFrame(
        [(j, min(s, LONGEST), everything, digests[j]) for j, s in per.items()], "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return rows.join(F.broadcast(table), F.col("cluster") == F.col("_cluster")).drop("_cluster")  # a row a centroid


def _sql(k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = 2, dim: int = DIM) -> str:
    """The rounds as SQL, over all pairs of vectors and centroids."""
    ctes = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS p FROM embeddings
            WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), vec_id, p) - 1 AS c, p AS q FROM v QUALIFY c < {k})",
    ]
    for r in range(rounds + 1):
        nearest = "min({'d': list_inner_product(p, p) - 2 * list_inner_product(p, q) + list_inner_product(q, q), 'c': c})"
        ctes.append(f"a{r} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(p) AS p, {nearest} AS near FROM v, c{r} GROUP BY r)")
        if r < rounds:
            ctes.append(
                f"""c{r + 1} AS MATERIALIZED (
                SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS q FROM (
                    SELECT near.c AS c, i, sum(p[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) AS g(i) GROUP BY 1, 2) GROUP BY c
                UNION ALL SELECT c, q FROM c{r} WHERE c NOT IN (SELECT near.c FROM a{r}))"""
            )
    return f"""WITH {', '.join(ctes)}
        SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, CAST(near.d AS BIGINT) AS distance,
            CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
            sha256(list_aggregate(list_transform(q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = near.c"""


SQL = _sql()
