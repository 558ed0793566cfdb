"""Nearest-time, next and previous lookups as one sort of both sides.

Left and right rows are unioned, cut into time chunks, sorted once, and the last / next right
row is read by ignore-null frames; what lies in another chunk arrives through the chunk table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks


def _lookup(left, right, k, t, width, seq, left_first, prev, following) -> DataFrame:
    k = list(k)
    rank = F.col(seq) if seq else F.lit(0)
    side = 0 if left_first else 1
    lhs = left.select(
        *k,
        F.col(t).alias("_t"),
        F.lit(side).alias("_side"),
        F.lit(0).cast("bigint").alias("_seq"),
        F.struct(*left.columns).alias("_l"),
    )
    hit = F.struct(F.col(t).alias("_t"), *[F.col(c) for c in right.columns if c not in k])
    rhs = right.select(
        *k,
        F.col(t).alias("_t"),
        F.lit(1 - side).alias("_side"),
        rank.cast("bigint").alias("_seq"),
        hit.alias("_r"),
    )
    both = lhs.unionByName(rhs, allowMissingColumns=True).withColumn(
        "_c", blocks.chunk_of("_t", width)
    )
    return blocks.scan(
        both,
        k,
        "_c",
        ["_t", "_side", "_seq"],
        prev={"_prev": F.col("_r")} if prev else None,
        following={"_next": F.col("_r")} if following else None,
    ).filter(F.col("_side") == side)


def _attach(found: DataFrame, left: DataFrame, right: DataFrame, k, t, hit: Column, suffix: str):
    taken = set(left.columns)
    extra = [
        hit[c].alias(c + suffix if c in taken else c)
        for c in right.columns
        if c not in k and not (c == t and not suffix)
    ]
    return found.select(*[F.col(f"_l.{c}").alias(c) for c in left.columns], *extra)


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    k: Sequence[str],
    t: str,
    width: float,
    tol: float | None = None,
    suffix: str = "_r",
    seq: str | None = None,
) -> DataFrame:
    """Each left row with the right row nearest in time.

    An earlier row wins a tie in distance, and the last of rows at one instant wins in order
    of `seq`; nothing is attached beyond `tol`, which is inclusive.
    """
    found = _lookup(left, right, k, t, width, seq, False, True, True)
    back = F.col("_t") - F.col("_prev._t")
    ahead = F.col("_next._t") - F.col("_t")
    nearest = F.when(
        F.col("_prev").isNotNull() & (F.col("_next").isNull() | (back <= ahead)), F.col("_prev")
    ).otherwise(F.col("_next"))
    found = found.withColumn("_hit", nearest)
    if tol is not None:
        apart = F.abs(F.col("_t") - F.col("_hit._t"))
        found = found.withColumn("_hit", F.when(apart <= tol, F.col("_hit")))
    return _attach(found, left, right, list(k), t, F.col("_hit"), suffix)


def asof_next(left, right, k, t, width, suffix="_r", seq=None) -> DataFrame:
    """First right row at or after each left row."""
    found = _lookup(left, right, k, t, width, seq, True, False, True)
    return _attach(found, left, right, list(k), t, F.col("_next"), suffix)


def asof_prev(left, right, k, t, width, suffix="_r", seq=None) -> DataFrame:
    """Last right row at or before each left row."""
    found = _lookup(left, right, k, t, width, seq, False, True, False)
    return _attach(found, left, right, list(k), t, F.col("_prev"), suffix)


def asof_chain(frames: Sequence[DataFrame], k: Sequence[str], t: str, tol: float, width: float) -> DataFrame:
    """Join several series to the first one within `tol`, keeping complete rows only."""

    def attach(base: DataFrame, other: DataFrame) -> DataFrame:
        joined = asof_nearest(base, other, k, t, width, tol, "_other")
        return joined.drop(f"{t}_other")

    joined = reduce(attach, frames[1:], frames[0])
    return joined.dropna(subset=[c for f in frames for c in f.columns if c not in k])


def sample_at(series: DataFrame, probes: DataFrame, k, t, v: str, width: float) -> DataFrame:
    """Linear interpolation of `v` at the times of `probes`, flat beyond the ends."""
    points = series.select(*k, t, v).filter(F.col(v).isNotNull())
    found = _lookup(probes, points, k, t, width, None, True, True, True)
    return found.select(
        *[F.col(f"_l.{c}").alias(c) for c in probes.columns],
        interpolate(F.col("_t"), F.col("_prev"), F.col("_next"), v).alias(v),
    )


def interpolate(t: Column, prev: Column, nxt: Column, v: str) -> Column:
    """Value at `t` on the line between two (time, value) structs; the other end where one lacks."""
    slope = (nxt[v] - prev[v]) / (nxt["_t"] - prev["_t"])
    return (
        F.when(prev.isNull(), nxt[v])
        .when(nxt.isNull(), prev[v])
        .when(nxt["_t"] == t, nxt[v])
        .otherwise(prev[v] + slope * (t - prev["_t"]))
    )
