"""Grouped statistics whose groups may be of any size."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks
from ..session import settle
from ..functions.scalars import haversine_m

SKETCH = 10_000
#: Values that are sorted for one quantile at most; a larger cell of the rank histogram is cut again.
CELL_ROWS = 1_000_000
CELLS = 4096


def quantiles(
    df: DataFrame, by: Sequence[str], v: str, ps: Sequence[float], names: Sequence[str] | None = None
) -> DataFrame:
    """Exact linear-interpolation quantiles of `v` per group (A2), without gathering a group of more than `CELL_ROWS` values.

    Short groups are sorted, each for itself. Long ones, distributed selection: cut points of a mergeable sketch part each group into cells, whose
    exact counts, lowest and highest values are one combinable aggregation. The cell that holds
    a rank is kept; while it has more than `CELL_ROWS` values that differ it is cut again into
    `CELLS` equal widths. Only the last cells are sorted, each for itself. Any cut points are
    right, so a sketch that errs costs a round at most. The values are written once, narrow.
    """
    by = list(by)
    names = list(names) if names else [f"q{str(p).replace('.', '_')}" for p in ps]
    margin = 4.0 / SKETCH
    sides = sorted({max(0.0, p - margin) for p in ps} | {min(1.0, p + margin) for p in ps})
    values = settle(df.select(*by, F.col(v).cast("double").alias("_v")).filter(F.col("_v").isNotNull()))
    sizes = settle(values.groupBy(*by).agg(F.count(F.lit(1)).alias("_total")))
    ends = [_interpolated(n, p).alias(name) for n, (p, name) in enumerate(zip(ps, names))]
    # a group of so few values is sorted as it is
    order = Window.partitionBy(*by, F.lit(0)).orderBy("_v")
    numbered = attach(values, sizes.filter(F.col("_total") <= CELL_ROWS), by).withColumn("_place", F.row_number().over(order) - 1)
    ranks = [end(F.lit(float(p)) * (F.col("_total") - 1)) for p in ps for end in (F.floor, F.ceil)]
    picks = [F.max(F.when(F.col("_place") == rank, F.col("_v"))).alias(f"_x{q}") for q, rank in enumerate(ranks)]
    short = numbered.groupBy(*by).agg(F.max("_total").alias("_total"), *picks).select(*by, *ends)
    if not sizes.filter(F.col("_total") > CELL_ROWS).limit(1).count():
        return short
    values = attach(values, sizes.filter(F.col("_total") > CELL_ROWS), by).drop("_total")
    cuts = values.groupBy(*by).agg(F.percentile_approx("_v", sides, SKETCH).alias("_cuts"))
    parted = attach(values, cuts, by).withColumn("_cell", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    ranks = []
    for n, p in enumerate(ps):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        ranks += [F.struct(F.lit(2 * n).alias("_q"), F.floor(at).alias("_rank")), F.struct(F.lit(2 * n + 1).alias("_q"), F.ceil(at).alias("_rank"))]
    cells = parted.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    total = F.sum("_n").over(Window.partitionBy(*by, F.lit(0)))
    # a few cells a group, each under every rank that is asked for
    held = cells.withColumn("_total", total).select("*", F.inline(F.array(*ranks)))
    cell = settle(_cell_of_rank(held, by))
    while cell.filter((F.col("_n") > CELL_ROWS) & (F.col("_least") < F.col("_most"))).limit(1).count():
        wide = (F.col("_n") > CELL_ROWS) & (F.col("_least") < F.col("_most"))
        share = (F.col("_v") / 2 - F.col("_least") / 2) / (F.col("_most") / 2 - F.col("_least") / 2)
        # infinite ends have cells of their own
        nth = F.when(F.col("_v") == F.col("_least"), 0).when(F.col("_v") == F.col("_most"), CELLS + 1).when(F.isnan(share), 1)
        part = nth.otherwise(F.floor(share * (CELLS - 1)) + 1).cast("int")
        inside = _inside(values, cell.filter(wide), by).withColumn("_cell", part)
        finer = inside.groupBy(*by, "_q", "_rank", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        cell = settle(cell.filter(~wide).unionByName(_cell_of_rank(finer, by)))
    single = cell.filter(F.col("_least") == F.col("_most")).select(*by, "_q", F.col("_least").alias("_x"))
    several = _inside(values, cell.filter(F.col("_least") < F.col("_most")), by)
    counted = several.groupBy(*by, "_q", "_rank", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by, "_q").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    here = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    found = single.unionByName(counted.withColumn("_upto", upto).filter(here).select(*by, "_q", F.col("_v").alias("_x")))
    picks = [F.max(F.when(F.col("_q") == q, F.col("_x"))).alias(f"_x{q}") for q in range(2 * len(ps))]
    long = attach(found.groupBy(*by).agg(*picks), sizes, by).select(*by, *ends)
    return short.unionByName(long) if by else long


def _interpolated(n: int, p: float) -> Column:
    """Quantile `p` from the values `_x` at the ranks below and above it."""
    at = F.lit(float(p)) * (F.col("_total") - 1)
    low, high = F.col(f"_x{2 * n}"), F.col(f"_x{2 * n + 1}")
    return F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at)))


def _cell_of_rank(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """For every rank the cell that holds it; `_rank` counts from the cell's first value then."""
    upto = F.sum("_n").over(Window.partitionBy(*by, "_q").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("_upto") - F.col("_n")
    held = cells.withColumn("_upto", upto).filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= before))
    return held.select(*by, "_q", (F.col("_rank") - before).alias("_rank"), "_n", "_least", "_most")


def _inside(values: DataFrame, cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values of each cell, once for every rank it is kept for."""
    one = cells.groupBy(*by).agg(F.collect_list(F.struct("_q", "_rank", "_least", "_most")).alias("_kept"))
    hit = F.filter("_kept", lambda c: (c["_least"] <= F.col("_v")) & (F.col("_v") <= c["_most"]))
    return attach(values, one, by).select(*by, "_v", F.inline(hit))


def medians(df: DataFrame, by: Sequence[str], v: str, name: str = "median") -> DataFrame:
    return quantiles(df, by, v, [0.5], [name])


def mad(df: DataFrame, by: Sequence[str], v: str, median: str = "median", name: str = "mad") -> DataFrame:
    """Median and median absolute deviation per group."""
    centre = medians(df, by, v, median)
    away = attach(df.select(*by, v), centre, by).withColumn("_away", F.abs(F.col(v) - F.col(median)))
    return attach(centre, medians(away, by, "_away", name), by)


def attach(df: DataFrame, per_group: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per-group results on the rows; with no grouping columns the result is one row."""
    return df.join(per_group, list(by)) if by else df.crossJoin(F.broadcast(per_group))


def summarise(df: DataFrame, by: Sequence[str], v: str) -> DataFrame:
    """Count, sum, mean, min and max (A1)."""
    return df.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.sum(v).alias("total"),
        F.avg(v).alias("mean"),
        F.min(v).alias("lowest"),
        F.max(v).alias("highest"),
    )


def fraction(cond: Column, present: Column) -> Column:
    """Percentage of the present values that satisfy `cond` (A3)."""
    return F.avg(F.when(present, F.coalesce(cond, F.lit(False)).cast("double"))) * 100


def pearson(df: DataFrame, by: Sequence[str], x: str, y: str, name: str = "r") -> DataFrame:
    """Pearson correlation over complete pairs (A4)."""
    return df.groupBy(*by).agg(F.corr(x, y).alias(name))


def ols(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of y on x."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def average_rank(df: DataFrame, by: Sequence[str], v: str, out: str, chunk: Column) -> DataFrame:
    """Rank from 1 with ties at their mean, from value counts cut into value chunks.

    `chunk` is a non-decreasing function of `v`, which keeps one group out of one task.
    """
    by = list(by)
    counts = df.groupBy(*by, v).agg(F.count(F.lit(1)).alias("_n")).withColumn("_c", chunk)
    summed = blocks.scan(counts, by, "_c", [v], running={"_upto": F.col("_n")})
    ranks = summed.select(*by, v, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(out))
    return df.join(ranks, [*by, v])


def spearman(
    df: DataFrame, by: Sequence[str], x: str, y: str, x_width: float, y_width: float, min_n: int = 2
) -> DataFrame:
    """Spearman correlation: Pearson of average ranks, groups of at least `min_n` (A5)."""
    pairs = df.select(*by, x, y).dropna()
    ranked = average_rank(pairs, by, x, "_rx", blocks.chunk_of(x, x_width))
    ranked = average_rank(ranked, by, y, "_ry", blocks.chunk_of(y, y_width))
    out = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.corr("_rx", "_ry").alias("rho"))
    return out.filter(F.col("n") >= min_n)


def distinct_having(df: DataFrame, by: Sequence[str], c: str, n: int) -> DataFrame:
    """Groups with at least `n` distinct values of `c`.

    Duplicates go first on (group, value), so a hot group is spread over its values.
    """
    return (
        df.select(*by, c).filter(F.col(c).isNotNull()).distinct()
        .groupBy(*by).agg(F.count(F.lit(1)).alias("n_distinct"))
        .filter(F.col("n_distinct") >= n)
    )


def grid_density(
    df: DataFrame, lat: str, lon: str, size: float, hit: Column, group: str, min_groups: int
) -> DataFrame:
    """Samples, share of hits and centroid per spatial cell seen by enough groups."""
    cells = df.withColumns(
        {"cell_lat": F.rint(F.col(lat) / size).cast("bigint"), "cell_lon": F.rint(F.col(lon) / size).cast("bigint")}
    )
    # one partial row per (cell, group): the distinct count needs no second pass over the samples
    partial = cells.groupBy("cell_lat", "cell_lon", group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.coalesce(hit, F.lit(False)).cast("bigint")).alias("_hits"),
        F.sum(lat).alias("_lat"),
        F.sum(lon).alias("_lon"),
    )
    return (
        partial.groupBy("cell_lat", "cell_lon")
        .agg(
            F.sum("_n").alias("n"),
            F.count(F.lit(1)).alias("n_groups"),
            (F.sum("_hits") / F.sum("_n")).alias("hit_fraction"),
            (F.sum("_lat") / F.sum("_n")).alias("mean_lat"),
            (F.sum("_lon") / F.sum("_n")).alias("mean_lon"),
        )
        .filter(F.col("n_groups") >= min_groups)
    )


def crosstab(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Counts of `b` values (a constant list) per value of `a` (A10)."""
    return df.groupBy(a).agg(
        *[F.count(F.when(F.col(b) == v, 1)).alias(f"{b}_{v}") for v in values]
    )


def weighted_mean(v: str, w: str) -> Column:
    """Weighted mean over rows where both are present."""
    both = F.col(v).isNotNull() & F.col(w).isNotNull()
    return F.try_divide(F.sum(F.col(v) * F.col(w)), F.sum(F.when(both, F.col(w))))


def arg_extreme(df: DataFrame, by: Sequence[str], v: str, out: str, kind: str = "max") -> DataFrame:
    """`out` on the row with the largest or smallest `v`; the smallest `out` breaks a tie."""
    if kind == "max":
        # order on the largest v, then on the smallest out
        best = F.min_by(F.struct(out, v), F.struct(-F.col(v), F.col(out)))
    else:
        best = F.min_by(F.struct(out, v), F.struct(F.col(v), F.col(out)))
    return df.filter(F.col(v).isNotNull()).groupBy(*by).agg(best.alias("_b")).select(
        *by, F.col(f"_b.{out}").alias(out), F.col(f"_b.{v}").alias(v)
    )


def kappa(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two raters on an ordinal scale: exact and within-one share, plain and
    quadratic Cohen's kappa (A13).

    Only the counts of category pairs leave the first aggregation. The quadratic distance
    expected by chance follows from the two raters' sums, so no pair of margins is formed.
    """
    cells = ratings.dropna(subset=[a, b]).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("o")
    )
    margins = cells.select(F.col("a").alias("c"), F.col("o").alias("ra"), F.lit(0.0).alias("cb")).unionByName(
        cells.select(F.col("b").alias("c"), F.lit(0.0).alias("ra"), F.col("o").alias("cb"))
    )
    chance = margins.groupBy("c").agg(F.sum("ra").alias("ra"), F.sum("cb").alias("cb")).agg(
        F.sum(F.col("ra") * F.col("cb")).alias("same_e")
    )

    def moment(x: Column) -> Column:
        return F.sum(F.col("o") * x)

    observed = cells.agg(
        F.sum("o").alias("n"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("o")).otherwise(0.0)).alias("same"),
        F.sum(F.when(F.abs(F.col("a") - F.col("b")) <= 1, F.col("o")).otherwise(0.0)).alias("near"),
        moment(F.pow(F.col("a") - F.col("b"), 2)).alias("sq"),
        moment(F.col("a")).alias("sa"), moment(F.col("b")).alias("sb"),
        moment(F.col("a") * F.col("a") + F.col("b") * F.col("b")).alias("sqs"),
    )
    n = F.col("n")
    po, pe = F.col("same") / n, F.col("same_e") / (n * n)
    sq_e = F.col("sqs") - F.col("sa") * F.col("sb") * 2 / n
    # both sides are one row
    return observed.crossJoin(F.broadcast(chance)).filter(n > 0).select(
        n.cast("bigint").alias("n"),
        (po * 100).alias("exact_pct"),
        (F.col("near") / n * 100).alias("within_one_pct"),
        F.try_divide(po - pe, 1 - pe).alias("kappa"),
        (1 - F.try_divide(F.col("sq"), sq_e)).alias("kappa_quadratic"),
    )


def rollup_stats(df: DataFrame, levels: Sequence[str], v: str) -> DataFrame:
    """Statistics per session, per driver and pooled (A14): the coarser levels are built from
    the finest one instead of expanding every row."""
    finest = df.groupBy(*levels).agg(
        F.count(v).alias("_n"), F.sum(v).alias("_s"), F.min(v).alias("_lo"), F.max(v).alias("_hi")
    )
    return finest.rollup(*levels).agg(
        F.sum("_n").alias("n"),
        (F.sum("_s") / F.sum("_n")).alias("mean"),
        F.min("_lo").alias("lowest"),
        F.max("_hi").alias("highest"),
    )


def route_consistency(df: DataFrame, k, lat: str, lon: str, speed: str, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Route length, bounding box and mean speed per session."""
    stepped = blocks.over_blocks(
        df,
        k,
        1,
        0,
        lambda w: [{"_m": haversine_m(F.lag(lat).over(w), F.lag(lon).over(w), lat, lon)}],
        i,
        block,
    )
    return stepped.groupBy(*k).agg(
        (F.coalesce(F.sum("_m"), F.lit(0.0)) / 1000).alias("route_km"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.avg(speed).alias("mean_speed"),
    )


def without_shortest(df: DataFrame, by: Sequence[str], size: str, tie: Sequence[str]) -> DataFrame:
    """All rows but the one with the smallest `size` per group."""
    shortest = df.groupBy(*by).agg(F.min_by(F.struct(*tie), F.struct(size, *tie)).alias("_s"))
    return attach(df, shortest, by).filter(F.struct(*tie) != F.col("_s")).drop("_s")


def lag_sums(
    df: DataFrame, k: Sequence[str], a: str, b: str, max_lag: int, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """For every lag the sums over the pairs (a at i, b at i + lag) with both sides present: n, sx, sy, sxx, syy, sxy.

    A block is one call: its values and those `max_lag` rows around lie in dense arrays, and a sum
    for all lags is one sliding product of the two. A row per block and lag leaves the call.
    Values are taken from the series' means, so sums of squares do not cancel.
    """
    k = list(k)
    means = df.groupBy(*k).agg(F.avg(a).alias("_ma"), F.avg(b).alias("_mb"))
    near = attach(df.select(*k, i, F.col(a).cast("double").alias(a), F.col(b).cast("double").alias(b)), means, k)
    near = near.select(*k, i, (F.col(a) - F.col("_ma")).alias("_x"), (F.col(b) - F.col("_mb")).alias("_y"))
    cut = blocks.with_halo(near, max_lag, max_lag, i, block)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in k)
    lags = np.arange(-max_lag, max_lag + 1)

    def sums(rows: pa.Table) -> pa.Table:
        at = rows[i].to_numpy()
        at = at - at.min() + max_lag
        own = rows["_home"].to_numpy()
        size = int(at.max()) + max_lag + 1
        x, y = (np.full(size, np.nan) for _ in range(2))
        x[at[own]] = rows["_x"].to_numpy()[own]
        y[at] = rows["_y"].to_numpy()
        x = x[max_lag : size - max_lag]
        seen_x, seen_y = np.isfinite(x).astype(float), np.isfinite(y).astype(float)
        x, y = np.where(seen_x > 0, x, 0.0), np.where(seen_y > 0, y, 0.0)
        slide = lambda b, a: np.correlate(b, a, "valid")
        parts = {"n": slide(seen_y, seen_x), "sx": slide(seen_y, x), "sy": slide(y, seen_x), "sxx": slide(seen_y, x * x), "syy": slide(y * y, seen_x), "sxy": slide(y, x)}
        keys = {c: pa.array(rows[c][:1].to_pylist() * len(lags), rows.schema.field(c).type) for c in k}
        return pa.table(keys | {"lag": pa.array(lags, pa.int64())} | {c: pa.array(v) for c, v in parts.items()})

    made = cut.groupBy(*k, "_b").applyInArrow(sums, f"{schema}, lag long, n double, sx double, sy double, sxx double, syy double, sxy double")
    return made.groupBy(*k, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def xcorr(
    df: DataFrame, k: Sequence[str], a: str, b: str, max_lag: int, min_pairs: int = 100, i="i",
    block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Correlation of `a` with shifted `b`: peak lag, r there and r at lag 0.

    Pairs with a missing side are skipped; a lag needs more than `min_pairs` of them.
    """
    n = F.col("n")
    xx, yy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    # what rounding leaves of a constant side is none
    varies = (xx > 1e-12 * F.col("sxx")) & (yy > 1e-12 * F.col("syy"))
    r = F.when(varies, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(xx * yy))
    per_lag = lag_sums(df, k, a, b, max_lag, i, block).filter(n > min_pairs).select(*k, "lag", r.alias("r")).filter("r IS NOT NULL")
    return per_lag.groupBy(*k).agg(
        F.min_by("lag", F.struct(-F.round("r", 9), F.col("lag"))).alias("peak_lag"),
        F.max("r").alias("peak_r"),
        F.max(F.when(F.col("lag") == 0, F.col("r"))).alias("r_at_zero"),
    )


def find_offset(
    raw: DataFrame, probe: DataFrame, k: Sequence[str], v: str, n_probe: int, max_off: int, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """First offset into `raw` with the smallest summed distance to the head of `probe`.

    Offsets run from 0 below min(rows - probe rows, max_off). A block of offsets is one call: it
    holds the raw values its windows cover, the head comes with it once, and partial sums over
    pieces of the head drop the offsets that are already further away than the best whole one. A
    distance with a missing value is over the values present. One row a block leaves the call.
    """
    k = list(k)
    head = probe.filter(F.col(i) < n_probe).groupBy(*k).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(i).alias("j"), F.col(v).cast("double").alias("p")))), lambda s: s["p"]).alias("_head"),
    )
    length = raw.groupBy(*k).agg(F.count(F.lit(1)).alias("_len"))
    span = head.join(length, k).withColumn("_stop", F.least(F.col("_len") - F.size("_head"), F.lit(max_off))).filter("_stop > 0")
    reach = raw.filter(F.col(i) < n_probe + max_off).select(*k, i, F.col(v).cast("double").alias("_x"))
    # a block of offsets is as wide as a head at least, so its windows end in the next block
    cut = blocks.with_halo(reach.join(span.select(*k), k, "left_semi"), 0, n_probe, i, max(block, n_probe))
    schema = ", ".join(f"`{c}` {raw.schema[c].dataType.simpleString()}" for c in k)
    # one head and stop a key, joined once a block
    heads = cut.filter("_home").select(*k, "_b").distinct().join(span, k)
    heads = heads.select(*[F.col(c).alias(f"_h_{c}") for c in k], F.col("_b").alias("_hb"), "_head", "_stop")

    def search(key, rows: pa.Table, heads: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or heads.num_rows == 0:
            return pa.table({c: pa.array([], raw_types[c]) for c in k} | {"_off": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        at, x = rows[i].to_numpy(), rows["_x"].to_numpy()
        own, low = rows["_home"].to_numpy(), int(at.min())
        p = heads["_head"].combine_chunks()[0].values.to_numpy(zero_copy_only=False).astype(float)
        stop = int(heads["_stop"][0].as_py())
        line = np.full(int(at.max()) - low + 1 + len(p), np.nan)
        line[at - low] = x
        offs = np.sort(at[own])
        # an offset without any pair of values has no distance
        pairs = np.correlate(np.isfinite(line).astype(float), np.isfinite(p).astype(float), "valid")
        offs = offs[(offs < stop) & (pairs[np.minimum(offs - low, len(pairs) - 1)] > 0)]
        sums, left = np.zeros(len(offs)), np.arange(len(offs))
        best, piece = np.inf, 64
        for lo in range(0, len(p) if len(left) else 0, piece):
            hi = min(lo + piece, len(p))
            if lo:
                if not np.isfinite(best):
                    first = left[np.argmin(sums[left])]
                    best = np.nansum(np.abs(line[offs[first] - low : offs[first] - low + len(p)] - p))
                # rounding must not drop the best
                left = left[sums[left] <= best * (1 + 1e-9) + 1e-9]
            windows = np.lib.stride_tricks.sliding_window_view(line, hi - lo)
            for some in np.array_split(left, max(1, len(left) // 4096)):
                sums[some] += np.nansum(np.abs(windows[offs[some] - low + lo] - p[lo:hi]), axis=1)
        if len(left) == 0:
            got = np.empty(0, np.int64)
        else:
            got = left[np.lexsort((offs[left], np.round(sums[left], 9)))[:1]]
        keys = {c: pa.array([w.as_py()] * len(got), raw_types[c]) for c, w in zip(k, key)}
        return pa.table(keys | {"_off": pa.array(offs[got], pa.int64()), "distance": pa.array(sums[got])})

    raw_types = {c: to_arrow_type(raw.schema[c].dataType) for c in k}
    scored = cut.groupBy(*k, "_b").cogroup(heads.groupBy(*[f"_h_{c}" for c in k], "_hb")).applyInArrow(search, f"{schema}, _off long, distance double")
    return scored.groupBy(*k).agg(
        F.min_by("_off", F.struct(F.round("distance", 9), F.col("_off"))).alias("offset"),
        F.min("distance").alias("distance"),
    )


def histogram(df: DataFrame, by: Sequence[str], v: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts in equal bins over [lo, hi]; the top edge belongs to the last bin."""
    place = F.least(F.floor((F.col(v) - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(v).between(lo, hi))
        .groupBy(*by, place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_stats(df: DataFrame, by: Sequence[str], v: str) -> DataFrame:
    """Box-plot numbers per group: quartiles and the 5th / 95th percentile."""
    return quantiles(df, by, v, [0.05, 0.25, 0.5, 0.75, 0.95], ["p5", "q1", "median", "q3", "p95"])


def expect(metrics: DataFrame, expectations: DataFrame) -> DataFrame:
    """PASS / FAIL per quantity (A19): within a tolerance, or equal text when there is none.

    metrics: quantity, value (text); expectations: quantity, expected (text), tol (double).
    """
    close = F.abs(F.col("value").try_cast("double") - F.col("expected").try_cast("double")) <= F.col("tol")
    ok = F.when(F.col("tol").isNull(), F.col("value") == F.col("expected")).otherwise(close)
    return expectations.join(metrics, "quantity", "left").withColumn(
        "status", F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL")
    )


def provenance_fit(
    df: DataFrame, k: Sequence[str], accel: str, speed: str, fs: float, min_speed: float, min_n: int = 100,
    i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Correlation and slope of a measured acceleration against the derivative of speed,
    over moving samples, sessions of at least `min_n` pairs (A20)."""
    from .frames import derivative

    fitted = derivative(df, k, speed, "_a", fs=fs, i=i, block=block).filter(
        (F.col(speed) > min_speed) & F.col("_a").isNotNull() & F.col(accel).isNotNull()
    )
    return (
        fitted.groupBy(*k)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.corr(accel, "_a").alias("r"),
            F.regr_slope(accel, F.col("_a")).alias("slope"),
        )
        .filter(F.col("n") >= min_n)
    )


def event_lag_profiles(
    df: DataFrame, starts: DataFrame, k: Sequence[str], a: str, b: str, half: int, max_lag: int, width: float, i="i"
) -> DataFrame:
    """Normalised cross-correlation around every event, as an array over lags.

    starts: k, e (event number in its session), i0. Each event gathers only the samples within
    half + max_lag of its start; events are left out unless a further sample lies beyond that at both ends of the series.
    """
    from .intervals import point_in_interval

    reach = half + max_lag
    spans = starts.select(
        *k, "e", F.col("i0").alias("_at"), (F.col("i0") - reach - 1).alias("_w0"), (F.col("i0") + reach).alias("_w1")
    )
    points = df.select(*k, F.col(i).alias("_j"), F.coalesce(F.col(a), F.lit(0.0)).alias("_x"), F.coalesce(F.col(b), F.lit(0.0)).alias("_y"))
    inside = point_in_interval(points, spans, k, "_j", "_w0", "_w1", width)
    packed = (
        inside.groupBy(*k, "e")
        .agg(F.sort_array(F.collect_list(F.struct("_j", "_x", "_y"))).alias("_s"))
        .filter(F.size("_s") == 2 * reach + 2)
        .withColumn("_s", F.slice("_s", 2, 2 * reach))
    )

    @F.pandas_udf("array<double>")
    def profile(x: pd.Series, y: pd.Series) -> pd.Series:
        def unit(m):
            return (m - m.mean(axis=-1, keepdims=True)) / (m.std(axis=-1, keepdims=True) + 1e-9)

        left = unit(np.stack(x.to_numpy())[:, max_lag : max_lag + 2 * half])
        right = unit(np.lib.stride_tricks.sliding_window_view(np.stack(y.to_numpy()), 2 * half, axis=1))
        return pd.Series(list(np.einsum("nj,nlj->nl", left, right) / (2 * half)))

    return packed.select(
        *k, "e", profile(F.transform("_s", lambda s: s["_x"]), F.transform("_s", lambda s: s["_y"])).alias("r")
    )


def event_xcorr(profiles: DataFrame, k: Sequence[str], max_lag: int, min_events: int = 8) -> DataFrame:
    """Mean profile over events: peak lag, peak and its z score among all lags."""
    lags = profiles.select(*k, F.posexplode("r").alias("_p", "_r")).groupBy(*k, "_p").agg(
        F.avg("_r").alias("_m"), F.count(F.lit(1)).alias("n_events")
    )
    return (
        lags.filter(F.col("n_events") >= min_events)
        .groupBy(*k)
        .agg(
            (F.min_by("_p", F.struct(-F.round("_m", 12), F.col("_p"))) - max_lag).alias("peak_lag"),
            F.max("_m").alias("peak_r"),
            ((F.max("_m") - F.avg("_m")) / (F.stddev_pop("_m") + 1e-9)).alias("peak_z"),
            F.max("n_events").alias("n_events"),
        )
    )


#: Events whose draws, and whose profiles, are one matrix.
EVENT_BLOCK = 4096


def bootstrap_peak(profiles: DataFrame, k: Sequence[str], max_lag: int, n_boot: int = 200, seed: int = 0, min_events: int = 8, block: int = EVENT_BLOCK) -> DataFrame:
    """95 % interval of the peak lag over resampled events.

    Every replicate draws as many events as the session has, with replacement; draws come from the MD5 of
    (seed, session, replicate, slot), so a rerun repeats them. A block of slots is one call that counts its draws by replicate and event and
    sends each block of events its counts as one packed row; there the matrix of draw counts times that of profiles gives sums by replicate
    and lag, one row a replicate, which partial sums reduce.
    """
    k = list(k)
    sizes = profiles.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_events)
    # profiles are numbered densely, so a draw names one
    numbered = settle(blocks.index_rows(profiles.select(*k, "e", "r"), k, ["e"], blocks.chunk_of("e", float(block)), "_at").join(sizes, k))
    home = F.floor(F.col("_at") / block).cast("long")
    schema = ", ".join(f"`{c}` {profiles.schema[c].dataType.simpleString()}" for c in k)
    name = F.concat_ws("|", F.lit(seed), *k)

    def draw(rows: pa.Table) -> pa.Table:
        start, slots, n = rows["_name"][0].as_py(), rows["e"].to_pylist(), rows["_n"][0].as_py()
        heads = [[int(hashlib.md5(f"{start}|{rep}|{e}".encode()).hexdigest()[:12], 16) % n for e in slots] for rep in range(1, n_boot + 1)]
        picks = np.array(heads, np.int64)
        cell, count = np.unique(np.arange(n_boot)[:, None] * n + picks, return_counts=True)
        rep, at = cell // n, cell % n
        order = np.lexsort((rep, at // block))
        rep, at, count = rep[order], at[order], count[order]
        to, first = np.unique(at // block, return_index=True)
        cut = [slice(a, b) for a, b in zip(first, np.append(first[1:], len(at)))]
        pack = lambda v, kind: pa.array([v[s].astype(kind).tobytes() for s in cut], pa.binary())
        keys = {c: pa.array(rows[c][:1].to_pylist() * len(to), rows.schema.field(c).type) for c in k}
        return pa.table(keys | {"_b": pa.array(to, pa.int64()), "_rep": pack(rep, "<i4"), "_pick": pack(at % block, "<i4"), "_count": pack(count, "<i4")})

    drawn = numbered.select(*k, "e", "_n", name.alias("_name"), home.alias("_b")).groupBy(*k, "_b").applyInArrow(draw, f"{schema}, _b long, _rep binary, _pick binary, _count binary")

    def weigh(key, counts: pa.Table, rows: pa.Table) -> pa.Table:
        read = lambda c: np.concatenate([np.frombuffer(b, "<i4") for b in counts[c].to_pylist()] or [np.empty(0, np.int32)])
        at = rows["_at"].to_numpy() % block
        profile = np.zeros((block, len(rows["r"][0]) if rows.num_rows else 0))
        profile[at] = np.array(rows["r"].to_pylist(), float).reshape(len(at), -1)
        weight = np.zeros((n_boot, block))
        np.add.at(weight, (read("_rep"), read("_pick")), read("_count"))
        sums = weight @ profile
        keys = {c: pa.array([v.as_py()] * n_boot, kinds[c]) for c, v in zip(k, key)}
        return pa.table(keys | {"rep": pa.array(np.arange(1, n_boot + 1)), "_w": pa.array(weight.sum(axis=1)), "_r": pa.array(list(sums), pa.list_(pa.float64()))})

    kinds = {c: to_arrow_type(profiles.schema[c].dataType) for c in k}
    events = numbered.select(*[F.col(c).alias(f"_h_{c}") for c in k], "_at", F.col("r").cast("array<double>").alias("r"), home.alias("_hb"))
    made = drawn.groupBy(*k, "_b").cogroup(events.groupBy(*[f"_h_{c}" for c in k], "_hb")).applyInArrow(weigh, f"{schema}, rep long, _w double, _r array<double>")
    means = made.select(*k, "rep", "_w", F.posexplode("_r").alias("_p", "_r")).groupBy(*k, "rep", "_p").agg((F.sum("_r") / F.sum("_w")).alias("_m"))
    peaks = means.groupBy(*k, "rep").agg((F.min_by("_p", F.struct(-F.round("_m", 12), F.col("_p"))) - max_lag).alias("lag"))
    ends = quantiles(peaks, k, "lag", [0.025, 0.975], ["lag_lo", "lag_hi"])
    return ends.withColumn("ci_width", F.col("lag_hi") - F.col("lag_lo"))
