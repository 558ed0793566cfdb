"""Exact top-k search as a Voronoi join: vectors and queries are grouped by pivots, summaries of the groups bound every score
between two groups, and only groups that can hold a result are sent to each other and solved there.

Scores are inner products of the integer vectors floor(scale * x). For a query q of a group (pivot g, radius r) and a vector v of
a cell (pivot c, radius R), q.v lies within |g| R + r |c| + r R of g.c. The k best lower bounds, counted over the cells' sizes, give
a score that every query of the group surely reaches k times; a cell whose upper bound is less is not sent. The local solution of
the group's own best cells then raises this score to what its worst query has really found, before the other cells are sent.

A cell is stored as blocks of at most `BLOCK` vectors, and a query group as blocks too, so a pivot that attracts a third of all rows
is spread over many tasks, and each pair of blocks is one unit of work. Pivots, at most `PIVOTS`, are the vectors of the smallest
hashes; summaries of groups and cells are all that the driver sees.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part; nor do those whose length is not the
most common one. Rows that repeat id and vector count once; rows that share a query's id are the query's own. A null id takes no part.
Ties go to the smaller id. With fewer candidates than k all are returned; no queries, no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, settle, table

PIVOTS = 64
BLOCK = 4096
#: Query groups are blocks of this many queries at most.
QUERY_BLOCK = 1024
#: There is a query group for each so many queries, up to the number of pivots; cells may be sent to every group.
QUERIES_A_GROUP = 256


def integer_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<long>), one row for each distinct pair of valid rows of the usual length."""
    v = F.col("v")
    usable = F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(usable)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (usual["n"] if usual else 0))
    return rows.select("id", F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v")).distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pack(v: np.ndarray) -> bytes:
    """The matrix in the narrowest integers that hold it; the first byte is their width."""
    top = int(np.abs(v).max(initial=0))
    width = 2 if top < 2**15 else 4 if top < 2**31 else 8
    return bytes([width]) + v.astype(f"<i{width}").tobytes()


def _unpack(b: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(b, f"<i{b[0]}", offset=1).reshape(rows, -1).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T without rounding: in doubles where no sum can pass 2^53, else in 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def top_of_block(query_ids, queries, ids, vectors, k):
    """(query position, id, score) of the k best of each query, ties to the smaller id, own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    score = products(queries, vectors)
    floor = np.iinfo(np.int64).min
    score[query_ids[:, None] == ids[None, :]] = floor
    at = np.arange(len(query_ids))
    out = []
    for _ in range(min(k, len(ids))):
        best = score.argmax(axis=1)  # the first of equal scores has the smallest id
        value = score[at, best]
        ok = value > floor
        out.append((at[ok], ids[best[ok]], value[ok]))
        score[at, best] = floor
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _blocks(rows: DataFrame, pivots, size: int, label: str) -> DataFrame:
    """Blocks of one pivot's vectors: (cell, block, n, radius, ids binary, vectors binary)."""
    shared = rows.sparkSession.sparkContext.broadcast(np.asarray(pivots, np.float64))

    def nearest(batches):
        p = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            m = _matrix(batch.column(1)).astype(np.float64)
            d = (m * m).sum(1)[:, None] - 2 * m @ p.T + (p * p).sum(1)[None, :]
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32())], names=["id", "v", "cell"])

    marked = settle(rows.mapInArrow(nearest, "id long, v array<bigint>, cell int"), label)
    # how many blocks a cell needs follows from its size; ids are spread over them by hash
    need = marked.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = marked.join(F.broadcast(need), "cell").withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        p = shared.value
        cell, block = group["cell"][0].as_py(), group["block"][0].as_py()
        ids = group["id"].to_numpy().astype(np.int64)
        v = _matrix(group["v"].combine_chunks()).astype(np.int64)
        away = v - p[cell]
        radius = float(np.sqrt((away * away).sum(1).max())) if len(v) else 0.0
        return pa.table({"cell": pa.array([cell], pa.int32()), "block": pa.array([block], pa.int32()), "n": pa.array([len(ids)], pa.int64()), "radius": [radius], "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([_pack(v)], pa.binary())})

    built = dealt.select("cell", "block", "id", "v").groupBy("cell", "block").applyInArrow(build, "cell int, block int, n long, radius double, ids binary, vectors binary")
    return settle(built, label)


def _summary(blocks: DataFrame):
    """Per cell number, size, radius; one row for each pivot."""
    return {r["cell"]: (r["n"], r["radius"]) for r in blocks.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()}


def _solve(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of every pair of a query cell and a data cell; k rows at most for each query and pair of blocks."""
    q = queries.select(F.col("cell").alias("query_cell"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    # spread by pair of blocks, since one cell may hold most of them
    work = data.join(pairs, "cell").join(q, "query_cell").select("query_ids", "query_vectors", "ids", "vectors")
    work = work.repartition(F.xxhash64(F.substring("query_ids", 1, 64), F.substring("ids", 1, 64)))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                qi, qv, di, dv = (batch.column(c)[row].as_py() for c in range(4))
                qi, di = np.frombuffer(qi, np.int64), np.frombuffer(di, np.int64)
                at, ids, score = top_of_block(qi, _unpack(qv, len(qi)), di, _unpack(dv, len(di)), k)
                yield pa.RecordBatch.from_arrays([pa.array(qi[at]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    return work.mapInArrow(run, "query_id long, vec_id long, score long")


def voronoi_top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score). `is_query` is a condition on column `id`."""
    spark = vectors.sparkSession
    rows = settle(integer_vectors(vectors, scale, id_col, vector_col), "vectors")
    chosen = rows.orderBy(F.xxhash64("v"), "id").select("v").limit(pivots).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centre = np.unique(np.array([r["v"] for r in chosen], np.float64), axis=0)
    wanted = rows.where(is_query)
    groups_wanted = min(len(centre), max(1, -(-wanted.count() // QUERIES_A_GROUP)))
    data, asked = _blocks(rows, centre, BLOCK, "cells"), _blocks(wanted, centre[:groups_wanted], QUERY_BLOCK, "queries")
    cells, groups = _summary(data), _summary(asked)
    length = np.sqrt((centre * centre).sum(1))
    cell = np.array(sorted(cells), np.int64)
    size, radius = np.array([cells[c][0] for c in cell]), np.array([cells[c][1] for c in cell])
    bounds = {}
    for g in sorted(groups):
        r = groups[g][1]
        middle, slack = centre[cell] @ centre[g], length[g] * radius + r * length[cell] + r * radius
        bounds[g] = (middle - slack, middle + slack, middle)
    schema = "query_cell int, cell int"
    # first the cells nearest to the group's own pivot that hold k candidates beside the query, or all
    first, later = [], []
    for g, (_, _, middle) in bounds.items():
        order = np.argsort(-middle, kind="stable")
        enough = int(np.searchsorted(np.cumsum(size[order]), 4 * (k + 1))) + 1
        first += [(g, int(c)) for c in cell[order[:enough]]]
    done = set(first)
    near = settle(_solve(spark.createDataFrame(first, schema), asked, data, k), "near") if first else None
    if near is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # what the worst query of a group has found; a query without k results yet sets no bound
    kth = near.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    kth = kth.select("query_id", F.get("s", F.lit(k - 1)).alias("kth"))
    member = settle(_members(asked), "members")
    reached = member.join(kth, "query_id", "left").groupBy("cell").agg(F.min(F.coalesce("kth", F.lit(-(1 << 62)))).alias("kth")).collect()
    reached = {r["cell"]: r["kth"] for r in reached}
    for g, (low, high, _) in bounds.items():
        order = np.argsort(-low, kind="stable")
        sure = order[min(int(np.searchsorted(np.cumsum(size[order]), k + 1)), len(order) - 1)]
        least = max(low[sure] if size.sum() > k else -np.inf, reached.get(g, -(1 << 62)))
        later += [(g, int(c)) for n, c in enumerate(cell) if high[n] + 1e-6 * abs(high[n]) + 1 >= least and (g, int(c)) not in done]
    found = near
    if later:
        found = found.unionByName(_solve(spark.createDataFrame(later, schema), asked, data, k))
    # k results for each query and pair of blocks; reduced in two steps, so that no list grows with the number of blocks alone
    cut = F.expr(f"slice(array_sort(collect_list(struct(-score AS down, vec_id))), 1, {k})").alias("top")
    half = found.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("part")).agg(cut)
    best = half.select("query_id", F.inline("top").alias("down", "vec_id")).select("query_id", "vec_id", (-F.col("down")).alias("score")).groupBy("query_id").agg(cut)
    return best.select("query_id", F.posexplode("top").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.down")).alias("score")
    )


def _members(asked: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), batch.column(0)[row].as_py(), np.int32)), pa.array(ids)], names=["cell", "query_id"])

    return asked.select("cell", "ids").mapInArrow(run, "cell int, query_id long")


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op5_exact_top_k", SQL)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
