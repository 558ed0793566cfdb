"""Bounded frames over an indexed series: rolling statistics, derivatives, despiking.

Every function reads the dense index `i` (see `blocks.index_rows`, or the index of a uniform
grid) and runs on bounded blocks with halo rows, so one long session spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks

ROLLING = {"min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}


def sorted_median(s: Column) -> Column:
    """Midpoint median of a sorted array."""
    n = F.size(s)
    low = F.element_at(s, ((n + 1) / 2).cast("int"))
    high = F.element_at(s, (n / 2).cast("int") + 1)
    return F.when(n > 0, (low + high) / 2)


def reach(n: int, centred: bool = True) -> tuple[int, int]:
    """Rows before and after: trailing n, or centred (an even n leans one row back)."""
    return (n // 2, (n - 1) // 2) if centred else (n - 1, 0)


def rolling(w, v: Column | str, n: int, fn: str, name: str, centred: bool) -> list[dict[str, Column]]:
    """Layers for a rolling statistic; nulls are skipped and one value is enough."""
    v = F.col(v) if isinstance(v, str) else v
    before, after = reach(n, centred)
    frame = w.rowsBetween(-before, after)
    if fn == "median":
        if n <= 1:
            return [{name: v}]
        kept = f"_{name}_sorted"
        return [
            {kept: F.collect_list(v).over(frame)},
            {kept: F.sort_array(kept)},
            {name: sorted_median(F.col(kept))},
        ]
    return [{name: ROLLING[fn](v).over(frame)}]


def _rolling(df, k, v, n, fn, out, centred, i, block):
    before, after = reach(n, centred)
    done = blocks.over_blocks(
        df, k, before, after, lambda w: rolling(w, v, n, fn, out, centred), i, block
    )
    return done.drop(f"_{out}_sorted")


def rolling_trailing(
    df: DataFrame, k: Sequence[str], v: str, n: int, fn: str, out: str, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """Rolling statistic over the last `n` rows."""
    return _rolling(df, k, v, n, fn, out, False, i, block)


def rolling_centred(
    df: DataFrame, k: Sequence[str], v: str, n: int, fn: str, out: str, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """Rolling statistic over `n` rows around the row."""
    return _rolling(df, k, v, n, fn, out, True, i, block)


def derivative(
    df: DataFrame, k: Sequence[str], v: str, out: str, fs: float | None = None, dt: str | None = None,
    i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Backward difference times `fs`, or divided by the column `dt`; null on the first row."""

    def layer(w):
        step = F.col(v) - F.lag(v).over(w)
        if fs is not None:
            step = step * fs
        if dt is not None:
            step = F.try_divide(step, F.col(dt))
        return [{out: step}]

    return blocks.over_blocks(df, k, 1, 0, layer, i, block)


def central_gradient(
    df: DataFrame, k: Sequence[str], v: str, out: str, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """Central difference per step, one-sided at the two ends of the series."""

    def layer(w):
        # an end of the series is a missing row, not a missing value
        has_prev, has_next = F.lag(i).over(w).isNotNull(), F.lead(i).over(w).isNotNull()
        prev, nxt = F.lag(v).over(w), F.lead(v).over(w)
        return [
            {
                out: F.when(has_prev & has_next, (nxt - prev) / 2)
                .when(has_next, nxt - F.col(v))
                .when(has_prev, F.col(v) - prev)
            }
        ]

    return blocks.over_blocks(df, k, 1, 1, layer, i, block)


def detrend(df, k, v: str, n: int, out: str, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Value minus its centred rolling mean."""
    return rolling_centred(df, k, v, n, "avg", "_trend", i, block).withColumn(
        out, F.col(v) - F.col("_trend")
    ).drop("_trend")


def hampel(
    df: DataFrame,
    k: Sequence[str],
    v: str,
    out: str,
    half: int = 7,
    n_sigma: float = 3.0,
    abs_threshold: float | None = None,
    i="i",
    block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Replace local outliers by the local median.

    Rows with a null value must be dropped before indexing. A series shorter than a full
    window is left as it is: it lacks a row `2 * half` places away from either of its ends.
    """

    def layers(w):
        frame = w.rowsBetween(-half, half)
        # within 2*half rows of both ends means the whole series is shorter than the window
        short = F.count(F.lit(1)).over(w.rowsBetween(-2 * half, 2 * half)) < 2 * half + 1
        centre = F.col("_centre")
        mad = F.greatest(F.col("_mad") * 1.4826, F.lit(1e-6))
        outlier = (F.abs(F.col(v) - centre) > n_sigma * mad) & ~F.col("_short")
        if abs_threshold is not None:
            outlier = outlier & (F.abs(v) > abs_threshold)
        return [
            {"_seen": F.collect_list(v).over(frame), "_short": short},
            {"_seen": F.sort_array("_seen")},
            {"_centre": sorted_median(F.col("_seen"))},
            {"_away": F.sort_array(F.transform("_seen", lambda x: F.abs(x - F.col("_centre"))))},
            {"_mad": sorted_median(F.col("_away"))},
            {out: F.when(outlier, centre).otherwise(F.col(v))},
        ]

    done = blocks.over_blocks(df, k, 2 * half, 2 * half, layers, i, block)
    return done.drop("_seen", "_short", "_centre", "_away", "_mad")


def unwrap_angle(
    df: DataFrame, k: Sequence[str], v: str, out: str, unit: str = "deg", i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """Angle without wrap jumps (P11): first value plus the running sum of wrapped differences.

    The result is in radians, as are the inputs when `unit` is "rad".
    """
    from ..functions.scalars import wrapped_diff

    deg = F.col(v) if unit == "deg" else F.degrees(v)
    stepped = blocks.over_blocks(
        df.withColumn("_deg", deg),
        k,
        1,
        0,
        lambda w: [{"_step": F.coalesce(wrapped_diff(F.lag("_deg").over(w), F.col("_deg")), F.lit(0.0))}],
        i,
        block,
    )
    summed = blocks.scan(
        stepped.withColumn("_first", F.when(F.col(i) == 0, F.col("_deg"))),
        k,
        "_b",
        [i],
        prev={"_origin": F.col("_first")},
        running={"_turned": F.col("_step")},
    )
    return summed.withColumn(out, F.radians(F.col("_origin") + F.col("_turned"))).drop(
        "_deg", "_step", "_first", "_origin", "_turned", "_b"
    )


def time_bin(
    df: DataFrame, k: Sequence[str], t: str, v: str, fs: float, fn: str = "avg", fill_grid: bool = True
) -> DataFrame:
    """Mean (or other statistic) per time bin, empty bins as nulls when `fill_grid`."""
    from .resample import spread_index

    binned = df.groupBy(*k, F.floor(F.col(t) * fs).cast("bigint").alias("bin")).agg(
        ROLLING[fn](v).alias(v)
    )
    if not fill_grid:
        return binned
    span = binned.groupBy(*k).agg(F.min("bin").alias("_b0"), F.max("bin").alias("_b1"))
    full = spread_index(span, F.col("_b1") - F.col("_b0") + 1, "_n").select(
        *k, (F.col("_b0") + F.col("_n")).alias("bin")
    )
    return full.join(binned, [*k, "bin"], "left")
