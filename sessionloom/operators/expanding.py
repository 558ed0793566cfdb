"""Exact median of everything seen so far, without walking a series in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import groups
from ..session import settle

COARSE = 32  # value buckets per level; two levels give COARSE * COARSE buckets per series
SALTS = 4
ROWS = 16_384  # rows per block


def expanding_median(
    df: DataFrame, k: Sequence[str], v: str, out: str, i: str = "i", block: int = ROWS
) -> DataFrame:
    """Column `out`: median of `v` over rows 0..i of the series (`i` dense, `v` not null)."""
    return df.join(prefix_medians(df, k, v, out, i, block), [*k, i])


def prefix_medians(
    df: DataFrame, k: Sequence[str], v: str, out: str, i: str = "i", block: int = ROWS
) -> DataFrame:
    """The medians of `expanding_median` by key and `i`, without the other columns.

    A block of n rows moves the median by at most n ranks, so it needs, of everything before it,
    only the values around the median at its start and the counts below and above them. Per
    series, value buckets are counted per block; running counts say which buckets a block
    needs, and only the rows of those are copied to it. Where every series is one block, nothing
    is counted or copied.
    """
    k = list(k)
    base = df.withColumn("_v", F.col(v).cast("double")).withColumn(
        "_b", F.floor(F.col(i) / F.lit(block)).cast("bigint")
    )
    schema = StructType([*(df.schema[c] for c in k), StructField(i, LongType()), StructField(out, DoubleType())])
    values = settle(base.select(*k, "_b", F.col(i).cast("bigint").alias(i), "_v"))
    own = _with_candidates(values, k, i)

    def medians(whole: pa.Table, starts: np.ndarray) -> pa.Table:
        # copies stand before the block's own rows
        mine, every = whole["_own"].to_numpy(), whole["_v"].to_numpy()
        below, before = (whole[c].to_numpy() for c in ("_below", "_total"))
        found = np.zeros(len(every))
        for a, b in zip(starts[:-1], starts[1:]):
            copied = int((~mine[a:b]).sum())
            n = np.arange(copied + 1, b - a + 1)  # values seen, of those in this block's reach
            missing = int(below[a])
            total = int(before[a]) + np.arange(1, len(n) + 1)
            v = every[a:b]
            found[a + copied : b] = (smallest_of_prefix(v, n, (total - 1) // 2 - missing) + smallest_of_prefix(v, n, total // 2 - missing)) / 2
        return whole.select([*k, i]).append_column(out, pa.array(found)).filter(pa.array(mine))

    return groups.over_groups(own, [*k, "_b"], ["_own", i], medians, schema)


def smallest_of_prefix(v: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each query the value at `place` (from 0) among the sorted first `n` values; all queries at once.

    Values become ranks, and the answer's bits are found from the highest: the values with a 0 at the bit stand before those with a
    1, in their old order, and a running count says how many of the prefix they are.
    """
    sorted_ = np.sort(v)
    rank = np.empty(len(v), np.int64)
    rank[np.argsort(v, kind="stable")] = np.arange(len(v))
    start, stop, place = np.zeros(len(n), np.int64), n.copy(), place.copy()
    answer = np.zeros(len(n), np.int64)
    for bit in range(max(len(v) - 1, 1).bit_length() - 1, -1, -1):
        one = (rank >> bit) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - one)])
        low, high = zeros[start], zeros[stop]
        up = place >= high - low
        place = np.where(up, place - (high - low), place)
        answer |= up.astype(np.int64) << bit
        start, stop = np.where(up, zeros[-1] + start - low, low), np.where(up, zeros[-1] + stop - high, high)
        rank = np.concatenate([rank[one == 0], rank[one == 1]])
    return sorted_[answer]


def _bucket(cuts: Column, v: Column) -> Column:
    """Number of cut points under `v`, found in two steps of COARSE."""
    coarse = F.transform(F.sequence(F.lit(1), F.lit(COARSE - 1)), lambda j: F.get(cuts, j * COARSE - 1))
    c = F.size(F.filter(coarse, lambda x: x < v))
    fine = F.slice(cuts, c * COARSE + 1, COARSE - 1)
    return c * COARSE + F.size(F.filter(fine, lambda x: x < v))


def _with_candidates(values: DataFrame, k: list[str], i: str) -> DataFrame:
    """Own rows of every block, plus copies of the earlier rows its medians can reach."""
    n = COARSE * COARSE
    every = values
    if not every.filter(F.col("_b") > 0).limit(1).count():
        none = F.lit(0).cast("bigint")
        return every.withColumns({"_own": F.lit(True), "_below": none, "_total": none})
    # a series of one block has nothing before it
    values = every.join(every.filter(F.col("_b") > 0).select(*k).distinct(), k, "left_semi")
    cuts = values.groupBy(*k).agg(
        F.percentile_approx("_v", [j / n for j in range(1, n)], 10_000).alias("_cuts")
    )
    placed = values.join(cuts, k).withColumn("_q", _bucket(F.col("_cuts"), F.col("_v"))).drop("_cuts")
    counts = placed.groupBy(*k, "_b", "_q").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy(*k, "_b").agg(F.sum("_n").alias("_size"))
    # every (block, earlier content of a bucket) pair: counts of a bucket carried to later blocks
    steps = counts.withColumn(
        "_upto", F.sum("_n").over(Window.partitionBy(*k, "_q").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("_next", F.lead("_b").over(Window.partitionBy(*k, "_q").orderBy("_b")))
    last = sizes.groupBy(*k).agg(F.max("_b").alias("_last"))
    carried = (
        steps.join(last, k)
        .withColumn("_stop", F.coalesce(F.col("_next"), F.col("_last")))
        .filter(F.col("_stop") > F.col("_b"))
        .select(*k, "_q", "_upto", F.explode(F.sequence(F.col("_b") + 1, F.col("_stop"))).alias("_b"))
    )
    w = Window.partitionBy(*k, "_b").orderBy("_q")
    ranked = carried.join(sizes, [*k, "_b"]).withColumns(
        {
            "_hi": F.sum("_upto").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "_total": F.sum("_upto").over(Window.partitionBy(*k, "_b")),
        }
    ).withColumn("_lo", F.col("_hi") - F.col("_upto"))
    # the median stays within size/2 + 1 ranks of where it starts
    reach = F.floor(F.col("_size") / 2) + 2
    middle = F.floor(F.col("_total") / 2)
    # few rows, read twice: written, so that the plan of the counts ends here
    needed = settle(ranked.filter((F.col("_hi") > middle - reach) & (F.col("_lo") <= middle + reach)))
    facts = needed.groupBy(*k, "_b").agg(F.min("_lo").alias("_below"), F.max("_total").alias("_total"))
    # copies are made per (bucket, salt of the target block): a central bucket serves many blocks
    wanted = needed.select(*k, "_q", F.col("_b").alias("_to"), F.pmod("_b", F.lit(SALTS)).alias("_salt"))
    sources = placed.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    copies = sources.join(wanted, [*k, "_q", "_salt"]).filter(F.col("_b") < F.col("_to")).select(
        *k, F.col("_to").alias("_b"), i, "_v", F.lit(False).alias("_own")
    )
    both = every.withColumn("_own", F.lit(True)).unionByName(copies)
    return both.join(facts, [*k, "_b"], "left").fillna(0, ["_below", "_total"])
