"""Vector best-fit packing: pieces of documents go to the sequence whose residual capacities they fit best.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). A piece goes to the
open sequence that has room under every constraint and is best by the weighted norm of what would be left (`residual`), or by
the weighted dot product of demand and residual (`dot`); the longest pieces go first. Pieces are dealt by chance into groups
of bounded size; groups are packed apart, which costs a fraction of one sequence each. The default capacities for documents and
attention cost never bind, so that the query gets as few sequences as tokens allow.

Defined cases: a null or empty text is one piece with the end id alone. Rows that repeat are packed each. No rows give no rows.
Input columns other than id and text are left out, so clashing names can't arise.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, settle, table
from .tokens import VOCABULARY, encode

TOKENS = 2048
END_ID = 0
#: Pieces of a packing group.
GROUP = 8192


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian 32-bit). Only documents over `tokens` are cut; the first piece is the short one."""

    def cut(batches):
        for batch in batches:
            text = batch.column(1)
            keys, number, start, length, ids = [], [], [], [], []
            for row in range(batch.num_rows):
                own = encode(text[row].as_py() or "", vocabulary)
                own = np.append(own, np.uint32(end_id)).astype("<u4")
                at, n = 0, 0
                while at < len(own):
                    size = (len(own) - at) % tokens or tokens
                    keys.append(row)
                    number.append(n)
                    start.append(at)
                    length.append(size)
                    ids.append(own[at : at + size].tobytes())
                    at, n = at + size, n + 1
                if len(keys) >= 2000:
                    yield made(batch, keys, number, start, length, ids)
                    keys, number, start, length, ids = [], [], [], [], []
            if keys:
                yield made(batch, keys, number, start, length, ids)

    def made(batch, keys, number, start, length, ids):
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keys)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
            names=["doc_id", "piece", "start", "length", "ids"],
        )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], weight=(1.0, 0.01, 0.01), by: str = "residual") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for each length."""
    n = len(length)
    bins, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    order = np.argsort(-length, kind="stable")
    least = length[order[-1]] if n else 0
    left = np.zeros((3, n))  # residual of open bins, as parts of the capacities
    number = np.zeros(n, np.int64)
    used = np.zeros(n, np.int64)
    open_bins = made = 0
    cap = np.array(capacity, float)
    w = np.array(weight)
    for k in order:
        size = int(length[k])
        need = np.array([size, 1.0, float(size) ** 2]) / cap
        pick = -1
        if open_bins:
            rest = left[:, :open_bins] - need[:, None]
            if by == "residual":
                score = w @ (rest * rest)
            else:
                score = -((w * need) @ left[:, :open_bins])
            score[(rest < -1e-9).any(axis=0)] = np.inf
            j = int(np.argmin(score))
            if score[j] < np.inf:
                pick = j
        if pick < 0:
            pick = open_bins
            number[pick], used[pick], left[:, pick] = made, 0, 1.0
            open_bins += 1
            made += 1
        bins[k], offset[k] = number[pick], used[pick]
        used[pick] += size
        left[:, pick] -= need
        if left[0, pick] * cap[0] < least - 0.5 or left[1, pick] * cap[1] < 0.5:
            open_bins -= 1  # nothing more fits: the last open one takes its place
            number[pick], used[pick], left[:, pick] = number[open_bins], used[open_bins], left[:, open_bins]
    return bins, offset


def pack(cut: DataFrame, tokens: int = TOKENS, documents: int | None = None, cost: int | None = None, weight=(1.0, 0.01, 0.01), by: str = "residual", group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces that has `length`; other columns go along.

    `cut` is written first, since its rows are counted to size the groups. Without `documents` and `cost` both capacities are
    so large that they never bind. A piece of more cost than `cost` fits no sequence: cut pieces to at most its square root.
    """
    capacity = (tokens, documents or tokens, cost or tokens * tokens)
    cut = settle(cut, "pieces")
    groups = max(1, math.ceil(cut.count() / group))

    def fit(rows: pa.Table) -> pa.Table:
        length = rows["length"].to_numpy()
        bins, offset = best_fit(length, capacity, weight, by)
        base = rows["pack_group"][0].as_py() << 32
        out = rows.drop_columns(["pack_group"])
        return out.append_column("sequence_id", pa.array(bins + base, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    # the number of a row in the written files, spread; not the id, which many rows may share
    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return dealt.groupBy("pack_group").applyInArrow(fit, f"{schema}, sequence_id long, offset long")


@query("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents"))
    return pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")))
