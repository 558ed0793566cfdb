"""Uniform grids and resampling of irregular series onto them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .asof import interpolate


def overlap_window(
    reference: DataFrame, device: DataFrame, k: Sequence[str], t: str, min_s: float = 30.0
) -> DataFrame:
    """Common window of a reference stream and the union of the device channels.

    Sessions whose window is shorter than `min_s` are dropped.
    """
    a = reference.groupBy(*k).agg(F.min(t).alias("_a0"), F.max(t).alias("_a1"))
    b = device.groupBy(*k).agg(F.min(t).alias("_b0"), F.max(t).alias("_b1"))
    both = a.join(b, list(k)).select(
        *k, F.greatest("_a0", "_b0").alias("w_start"), F.least("_a1", "_b1").alias("w_end")
    )
    return both.filter(F.col("w_end") - F.col("w_start") >= min_s)


def clip_to_window(df: DataFrame, windows: DataFrame, k: Sequence[str], t: str) -> DataFrame:
    """Rows inside their session's window, both ends included.

    The window table has one row per session; adaptive execution broadcasts it when small.
    """
    return (
        df.join(windows.select(*k, "w_start", "w_end"), list(k))
        .filter(F.col(t).between(F.col("w_start"), F.col("w_end")))
        .drop("w_start", "w_end")
    )


def spread_index(df: DataFrame, n: Column, out: str, block: int = blocks.BLOCK_ROWS) -> DataFrame:
    """`n` copies of each row numbered from 0, produced in pieces of `block` by many tasks."""
    # a fixed number of partitions: the pieces are tiny, so adaptive execution would merge them
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        df.withColumn("_len", n.cast("bigint"))
        .filter("_len > 0")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_len") - 1) / block))))
        .repartition(tasks, *df.columns, "_piece")
    )
    start = F.col("_piece") * block
    stop = F.least(start + block, F.col("_len")) - 1
    return pieces.withColumn(out, F.explode(F.sequence(start, stop))).drop("_len", "_piece")


def uniform_grid(windows: DataFrame, k: Sequence[str], fs: float, t: str = "t") -> DataFrame:
    """Grid `w_start + i / fs` up to, and without, `w_end`."""
    dt = 1.0 / fs
    n = F.ceil((F.col("w_end") - F.col("w_start")) / F.lit(dt))
    grid = spread_index(windows.select(*k, "w_start", "w_end"), n, "i")
    return grid.select(*k, "i", (F.col("w_start") + F.col("i") * F.lit(dt)).alias(t))


def _bracket(
    samples: DataFrame, grid: DataFrame, k, t: str, v: str, channels: Sequence[str] | None, width: float
) -> DataFrame:
    """Grid rows with, per channel, the sample strictly before and the one at or after.

    All channels of a session share one sort: `prev_*` / `next_*` are (_t, v) structs.
    """
    k = list(k)
    point = F.struct(F.col(t).alias("_t"), F.col(v).alias(v))
    present = samples.filter(F.col(v).isNotNull())
    grid_columns = [c for c in grid.columns if c not in k]
    lhs = grid.select(
        *k, F.col(t).alias("_t"), F.lit(0).alias("_side"), F.struct(*grid_columns).alias("_g")
    )
    if channels is None:
        rhs = present.select(
            *k, F.col(t).alias("_t"), F.lit(1).alias("_side"), point.alias("_p"), F.lit("").alias("_ch")
        )
        names = [""]
    else:
        rhs = present.filter(F.col("channel").isin(list(channels))).select(
            *k, F.col(t).alias("_t"), F.lit(1).alias("_side"), point.alias("_p"), F.col("channel").alias("_ch")
        )
        names = list(channels)
    both = lhs.unionByName(rhs, allowMissingColumns=True).withColumn("_c", blocks.chunk_of("_t", width))
    pick = {n: F.when(F.col("_ch") == n, F.col("_p")) for n in names}
    found = blocks.scan(
        both,
        k,
        "_c",
        ["_t", "_side"],
        prev={f"prev_{n}": e for n, e in pick.items()},
        following={f"next_{n}": e for n, e in pick.items()},
    ).filter("_side = 0")
    return found.select(
        *k,
        *[F.col(f"_g.{c}").alias(c) for c in grid_columns],
        *[c for n in names for c in (f"prev_{n}", f"next_{n}")],
    )


def _counts(samples: DataFrame, k, v: str, channels: Sequence[str] | None) -> DataFrame:
    """Present samples per session, and per channel in the wide form."""
    if channels is None:
        return samples.groupBy(*k).agg(F.count(v).alias("_n_"))
    return samples.groupBy(*k).agg(
        *[F.count(F.when(F.col("channel") == c, F.col(v))).alias(f"_n_{c}") for c in channels]
    )


def resample_channels(
    samples: DataFrame,
    grid: DataFrame,
    k: Sequence[str],
    t: str,
    v: str,
    channels: Sequence[str],
    width: float,
    native_dt: Mapping[str, float] | None = None,
    gap_x: float = 3.0,
    min_samples: int = 4,
) -> DataFrame:
    """Long samples onto the grid, one wide column per channel (T4, T7 in one pass).

    Channels named in `native_dt` are gap-aware: null inside a hole of more than `gap_x`
    native periods, with a `<channel>_dropout_flag`.
    """
    native_dt = native_dt or {}
    found = _bracket(samples, grid, k, t, v, channels, width).join(
        _counts(samples, k, v, channels), list(k), "left"
    )
    out = {}
    for c in channels:
        prev, nxt = F.col(f"prev_{c}"), F.col(f"next_{c}")
        value = F.when(F.col(f"_n_{c}") >= min_samples, interpolate(F.col(t), prev, nxt, v))
        if c in native_dt:
            value = F.when(~in_gap(prev, nxt, gap_x * native_dt[c]), value)
            out[f"{c}_dropout_flag"] = value.isNull()
        out[c] = value
    base = [c for c in grid.columns if c not in k]
    return found.select(*k, *base, *[e.alias(n) for n, e in out.items()])


def in_gap(prev: Column, nxt: Column, max_gap: float) -> Column:
    """Between two samples more than `max_gap` apart, at or before the first, or after the last."""
    return prev.isNull() | nxt.isNull() | (nxt["_t"] - prev["_t"] > max_gap)


def resample_linear(samples, grid, k, t, v, width, min_samples: int = 4) -> DataFrame:
    """Linear interpolation, flat beyond the ends, null below `min_samples` values (T4)."""
    found = _bracket(samples, grid, k, t, v, None, width).join(_counts(samples, k, v, None), list(k), "left")
    value = interpolate(F.col(t), F.col("prev_"), F.col("next_"), v)
    return found.withColumn(v, F.when(F.col("_n_") >= min_samples, value)).drop("_n_", "prev_", "next_")


def resample_circular(samples, grid, k, t, v, width, min_samples: int = 4) -> DataFrame:
    """Angles in degrees interpolated by their unit vectors (T5)."""
    found = _bracket(samples, grid, k, t, v, None, width).join(_counts(samples, k, v, None), list(k), "left")

    def part(fn):
        def along(p):
            return F.when(p.isNotNull(), F.struct(p["_t"].alias("_t"), fn(F.radians(p[v])).alias(v)))

        return interpolate(F.col(t), along(F.col("prev_")), along(F.col("next_")), v)

    angle = F.pmod(F.degrees(F.atan2(part(F.sin), part(F.cos))), F.lit(360.0))
    angle = F.when(angle >= 360.0, 0.0).otherwise(angle)
    return found.withColumn(v, F.when(F.col("_n_") >= min_samples, angle)).drop("_n_", "prev_", "next_")


def gap_mask(samples, grid, k, t, v, max_gap_s: float, width: float) -> DataFrame:
    """Grid rows with `in_gap`."""
    found = _bracket(samples, grid, k, t, v, None, width)
    return found.withColumn("in_gap", in_gap(F.col("prev_"), F.col("next_"), max_gap_s)).drop("prev_", "next_")


def resample_gap_aware(samples, grid, k, t, v, native_dt, width, gap_x: float = 3.0, min_samples: int = 4):
    """Linear interpolation with nulls inside native dropouts, and a flag column."""
    found = _bracket(samples, grid, k, t, v, None, width).join(_counts(samples, k, v, None), list(k), "left")
    prev, nxt = F.col("prev_"), F.col("next_")
    value = F.when(
        (F.col("_n_") >= min_samples) & ~in_gap(prev, nxt, gap_x * native_dt),
        interpolate(F.col(t), prev, nxt, v),
    )
    return (
        found.withColumn(v, value)
        .withColumn(f"{v}_dropout_flag", F.col(v).isNull())
        .drop("_n_", "prev_", "next_")
    )


def resample_axes(samples, grid, k, t, axes: Sequence[str], width: float, prefix: str) -> DataFrame:
    """Each axis of a vector channel on the grid, plus its magnitude."""
    long = samples.select(
        *k, t, F.explode(F.array(*[F.struct(F.lit(a).alias("channel"), F.col(a).alias("value")) for a in axes])).alias("_s")
    ).select(*k, t, "_s.channel", "_s.value")
    wide = resample_channels(long, grid, k, t, "value", list(axes), width)
    square = reduce(lambda x, y: x + y, [F.col(a) * F.col(a) for a in axes])
    return wide.withColumn(f"{prefix}_mag", F.sqrt(square)).withColumnsRenamed({a: f"{prefix}_{a}" for a in axes})


def lookup_next(samples, grid, k, t, v, width: float) -> DataFrame:
    """Categorical value of the first sample at or after each grid time, clamped to the last."""
    found = _bracket(samples, grid, k, t, v, None, width)
    return found.withColumn(v, F.coalesce(F.col(f"next_.{v}"), F.col(f"prev_.{v}"))).drop("prev_", "next_")
