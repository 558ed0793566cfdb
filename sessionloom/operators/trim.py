"""Trimming sessions: stationary ends, garage exits, windows, frame arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import haversine_m
from . import blocks, stats


def trim_stationary(df: DataFrame, k: Sequence[str], speed: str, elapsed: str, threshold: float = 5.0, i: str = "i") -> DataFrame:
    """Rows from the first to the last moving sample, elapsed time from 0.

    Stops in between stay; a session that never moves stays whole.
    """
    bounds = df.groupBy(*k).agg(
        F.min(F.when(F.col(speed) > threshold, F.col(i))).alias("_i0"),
        F.max(F.when(F.col(speed) > threshold, F.col(i))).alias("_i1"),
        F.min(F.when(F.col(speed) > threshold, F.struct(i, elapsed)))[elapsed].alias("_moving_e"),
        F.min_by(elapsed, i).alias("_first_e"),
    )
    whole = F.col("_i0").isNull()
    kept = stats.attach(df, bounds, k).filter(whole | F.col(i).between(F.col("_i0"), F.col("_i1")))
    return kept.withColumn(elapsed, F.col(elapsed) - F.coalesce("_moving_e", "_first_e")).drop("_i0", "_i1", "_moving_e", "_first_e")


def trim(df: DataFrame, points: DataFrame, k: Sequence[str], t: str) -> DataFrame:
    """Rows inside each session's [start_s, end_s], time from 0."""
    joined = df.join(points.select(*k, "start_s", "end_s"), list(k)).filter(F.col(t).between(F.col("start_s"), F.col("end_s")))
    first = joined.groupBy(*k).agg(F.min(t).alias("_t0"))
    return stats.attach(joined, first, k).withColumn(t, F.col(t) - F.col("_t0")).drop("start_s", "end_s", "_t0")


def sustained(
    df: DataFrame, k: Sequence[str], t_us: str, m: str, width_us: float, seconds: float = 8.0, frac: float = 0.8, edge: str = "start"
) -> DataFrame:
    """Time of the first (or last) true sample with more than `frac` true samples in the
    `seconds` after (before) it, its own end included (T19). `t_us` is in microseconds."""
    reach = int(seconds * 1e6)
    ahead = edge == "start"
    cut = blocks.with_time_halo(df, t_us, 0 if ahead else reach, reach if ahead else 0, width_us)
    w = Window.partitionBy(*k, "_b").orderBy(t_us)
    w = w.rangeBetween(0, reach) if ahead else w.rangeBetween(-reach, 0)
    ok = F.coalesce(F.col(m), F.lit(False))
    held = blocks.home(cut.withColumn("_share", F.avg(ok.cast("double")).over(w))).filter(ok & (F.col("_share") > frac))
    return held.groupBy(*k).agg((F.min(t_us) if ahead else F.max(t_us)).alias(f"{edge}_us"))


def base_location(df: DataFrame, k: Sequence[str], t: str, lat: str, lon: str) -> DataFrame:
    """Median of all sessions' first and last fixes (T20): one row."""
    point = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    ends = df.groupBy(*k).agg(F.min_by(point, t).alias("a"), F.max_by(point, t).alias("z"))
    points = ends.select(F.inline(F.array("a", "z")))
    return stats.medians(points, [], "lat", "base_lat").crossJoin(stats.medians(points, [], "lon", "base_lon"))


def detect_trim(
    df: DataFrame, k: Sequence[str], t_us: str, lat: str, lon: str, speed: str, width_us: float, min_speed: float,
    min_dist_m: float, seconds: float = 8.0,
) -> DataFrame:
    """Trim report per session (T20): leaving and reaching the base at speed, sustained.

    status is `ok`, or FAILED_DETECTION where either end is missing or they cross.
    """
    base = base_location(df, k, t_us, lat, lon)
    away = df.crossJoin(F.broadcast(base)).withColumn("_dist", haversine_m(lat, lon, "base_lat", "base_lon")).withColumn(
        "_ok", (F.col(speed) >= min_speed) & (F.col("_dist") >= min_dist_m)
    )
    span = df.groupBy(*k).agg(F.min(t_us).alias("_t0"), F.max(t_us).alias("_t1"))
    slim = away.select(*k, t_us, "_ok")
    start = sustained(slim, k, t_us, "_ok", width_us, seconds, edge="start")
    end = sustained(slim, k, t_us, "_ok", width_us, seconds, edge="end")
    both = span.join(start, list(k), "left").join(end, list(k), "left")
    good = F.coalesce(F.col("start_us") < F.col("end_us"), F.lit(False))

    def secs(c: Column) -> Column:
        return F.when(good, c / 1e6)

    return both.select(
        *k,
        F.when(good, "ok").otherwise("FAILED_DETECTION").alias("status"),
        ((F.col("_t1") - F.col("_t0")) / 1e6).alias("orig_duration_s"),
        secs(F.col("start_us") - F.col("_t0")).alias("trim_start_s"),
        secs(F.col("_t1") - F.col("end_us")).alias("trim_end_s"),
        secs(F.col("end_us") - F.col("start_us")).alias("new_duration_s"),
    )


def trim_outliers(report: DataFrame, large: float = 90.0, small: float = 5.0) -> DataFrame:
    """Sessions with unusually large or near-zero trims."""
    big = (F.col("trim_start_s") > large) | (F.col("trim_end_s") > large)
    tiny = (F.col("trim_start_s") < small) | (F.col("trim_end_s") < small)
    marked = report.filter("status = 'ok'").withColumn("kind", F.when(big, "large").when(tiny, "near_zero"))
    return marked.filter(F.col("kind").isNotNull())


def shift_frames(
    df: DataFrame, lead: DataFrame, k: Sequence[str], frame: str, fps: float, last: str | None = None
) -> DataFrame:
    """Drop the lead-in frames, renumber from 0 and recompute the timestamp.

    lead: k, lead_s and, with `last`, the last source frame to keep.
    """
    joined = df.join(lead.select(*k, "lead_s", *([last] if last else [])), list(k))
    skip = F.rint(F.col("lead_s") * fps).cast("bigint")
    kept = joined.filter(F.col(frame) >= skip)
    if last:
        kept = kept.filter(F.col(frame) <= F.col(last))
    moved = kept.withColumn(frame, F.col(frame) - skip)
    return moved.withColumn("timestamp_s", F.bround(F.col(frame) / F.lit(float(fps)), 4)).drop("lead_s", *([last] if last else []))


def endpoint_audit(df: DataFrame, k: Sequence[str], speed: str, elapsed: str, n: int = 25, moving: float = 5.0, i: str = "i") -> DataFrame:
    """Mean speed of the first and last `n` samples, stationary seconds at both ends."""
    size = df.groupBy(*k).agg(
        F.max(i).alias("_last"),
        F.max_by(elapsed, i).alias("_end"),
        F.min(F.when(F.col(speed) > moving, F.col(elapsed))).alias("_m0"),
        F.max(F.when(F.col(speed) > moving, F.col(elapsed))).alias("_m1"),
    )
    joined = stats.attach(df.select(*k, i, speed), size, k).filter((F.col(i) < n) | (F.col(i) > F.col("_last") - n))
    return joined.groupBy(*k).agg(
        F.avg(F.when(F.col(i) < n, F.col(speed))).alias("start_v"),
        F.avg(F.when(F.col(i) > F.col("_last") - n, F.col(speed))).alias("end_v"),
        F.max("_m0").alias("stationary_head_s"),
        F.max(F.col("_end") - F.col("_m1")).alias("stationary_tail_s"),
    )


def duration_diff(a: DataFrame, b: DataFrame, k: Sequence[str]) -> DataFrame:
    """Difference of two streams' durations per session (T29): each side is k, duration_s."""
    left = a.select(*k, F.col("duration_s").alias("_a"))
    right = b.select(*k, F.col("duration_s").alias("_b"))
    return left.join(right, list(k)).select(*k, (F.col("_a") - F.col("_b")).alias("diff_s"))


def duration_tally(diffs: DataFrame, limits: Sequence[float] = (5.0, 30.0)) -> DataFrame:
    """Sessions whose durations differ by more than each limit."""
    return diffs.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.abs("diff_s") > x, 1)).alias(f"n_gt_{x:g}s") for x in limits],
        F.avg(F.abs("diff_s")).alias("mean_abs_diff_s"),
    )
