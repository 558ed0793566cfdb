"""Centroid clustering by a bisector tournament, in integers: exact rounds of k-means.

The points nearer to centroid a than to b lie on one side of the bisecting plane: |x - a|^2 <= |x - b|^2 means 2 (b - a).x <= |b|^2 - |a|^2.
Normals 2 (b - a) and thresholds of all pairs a < b are integers and are computed once a round. A vector meets the centroids in the order of
their numbers: the winner so far plays the next one, one sign test each, k - 1 in all; zero favours the smaller number. The distance is
computed for the last winner alone.

A round is one pass over the integer vectors, which are written once: tasks return sums by cluster and component, Spark adds them up, and
only k x dims sums reach the driver, whatever the number of vectors. No cluster is gathered anywhere, so its size doesn't matter.

Defined cases: vectors that are null, of another length than `dims`, or hold null or non-finite components take no part; nor do those with a
component of more than 2^27 after scaling, as their squared distances pass 64 bits. Repeated rows count as often as they stand. A null id
hashes as an empty one. Start vectors with the same hash (rows of one id) are taken in the order of their components. With fewer vectors than k there are as many centroids;
an empty table has no rows. An empty cluster keeps its centroid. Columns of the input that aren't read can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, settle, table

K = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
#: Components up to here keep every product, threshold and squared distance of `DIMS` of them within 64 bits.
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x array<int>) of every usable row."""
    if dims > 64:
        raise ValueError("with more than 64 components the sums may pass 64 bits")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST / scale))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where((F.size("v") == dims) & ~bad)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("int")).alias("x"))


def first_centroids(points: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hashes of seed and id, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = points.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["x"]) if rows else 0)


class Bisectors:
    """Normals and thresholds of all pairs of centroids a < b."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        square = (centroids * centroids).sum(axis=1)
        self.normal = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.threshold = square[None, :] - square[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row."""
        best = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            # every winner so far is one normal, tested on its rows together
            for a in np.unique(best):
                at = np.flatnonzero(best == a)
                best[at[x[at] @ self.normal[a, b] > self.threshold[a, b]]] = b
        return best


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def _sums(points: DataFrame, planes: Bisectors) -> np.ndarray:
    """For each cluster the number of its vectors and their componentwise sums."""

    def run(batches):
        k, dims = planes.centroids.shape
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            best = planes.winners(x)
            for c in np.unique(best):
                own = x[best == c]
                total[c, 0] += len(own)
                total[c, 1:] += own.sum(axis=0)
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(total[c, d])], names=["c", "d", "s"])

    parts = points.select("x").mapInArrow(run, "c long, d long, s long")
    out = np.zeros((planes.centroids.shape[0], planes.centroids.shape[1] + 1), object)
    # k x (dims + 1) rows at most
    for r in parts.groupBy("c", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r["c"], r["d"]] = int(r["s"])
    return out


def fit(points: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = "3") -> np.ndarray:
    """The centroids after `rounds` rounds; `points` is read once a round and should be a written table."""
    centroids = first_centroids(points, k, seed)
    if len(centroids) == 0:
        return centroids
    for _ in range(rounds):
        sums = _sums(points, Bisectors(centroids))
        for c in range(len(centroids)):
            if sums[c, 0]:
                centroids[c] = [int(s) // int(sums[c, 0]) for s in sums[c, 1:]]
    return centroids


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster int, distance long) of every point."""
    planes = Bisectors(centroids) if len(centroids) else None

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            best = planes.winners(x)
            away = x - planes.centroids[best]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array((away * away).sum(axis=1))], names=["id", "cluster", "distance"])

    return points.select("id", "x").mapInArrow(run, f"id {points.schema['id'].dataType.simpleString()}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid array<int>, centroid_sha256) of every usable row. An inertia is null if it passes 64 bits."""
    points = settle(integer_vectors(vectors, dims, scale, id_col, vector_col), "points")
    centroids = fit(points, k, rounds, seed)
    found = settle(assign(points, centroids), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows at most
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    long = lambda n: n if n < 1 << 63 else None
    total = long(sum(inertia.values()))
    each = [(c, long(inertia.get(c, 0)), total, v.tolist(), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest()) for c, v in enumerate(centroids)]
    about = vectors.sparkSession.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid array<int>, centroid_sha256 string")
    # one row a centroid
    return found.join(F.broadcast(about), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


def _sql() -> str:
    """Lloyd's rounds unrolled, with all k distances of every vector."""

    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
            SELECT id, x, o, arg_min(c, (d, c)) cluster, min(d) distance FROM (
                SELECT p.id, p.x, p.o, m.c, list_sum(list_transform(list_zip(p.x, m.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT d FROM points p, m{n} m)
            GROUP BY id, x, o)"""

    parts = [
        f"""points AS MATERIALIZED (
            SELECT vec_id id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) x, row_number() OVER () o FROM embeddings
            WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e) OR abs(e::DOUBLE) > {LARGEST / SCALE})) = 0)""",
        f"""m0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, x) - 1 c, x m FROM (SELECT x, sha256('3:' || coalesce(id::VARCHAR, '')) h FROM points ORDER BY h, x LIMIT {K}))""",
    ]
    for n in range(ROUNDS):
        parts.append(nearest(n))
        parts.append(f"""s{n} AS MATERIALIZED (
            SELECT cluster, list(v ORDER BY d) m FROM (
                SELECT cluster, d, (s - (((s % n) + n) % n)) // n v FROM (
                    SELECT cluster, d, sum(x[d])::HUGEINT s, count(*)::HUGEINT n FROM a{n}, range(1, {DIMS + 1}) r(d) GROUP BY cluster, d))
            GROUP BY cluster)""")
        parts.append(f"m{n + 1} AS MATERIALIZED (SELECT m{n}.c, coalesce(s{n}.m::BIGINT[], m{n}.m) m FROM m{n} LEFT JOIN s{n} ON s{n}.cluster = m{n}.c)")
    parts.append(nearest(ROUNDS))
    return f"""WITH {', '.join(parts)}
        SELECT id vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT cluster_inertia, sum(distance) OVER ()::BIGINT inertia,
            sha256(array_to_string(m, ',')) centroid_sha256
        FROM a{ROUNDS} JOIN m{ROUNDS} ON c = cluster"""


@query("op13_centroid_clustering", _sql())
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
