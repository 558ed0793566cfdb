"""Data-quality checks, channel quality, saturation and release audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, runs, stats


def check_coverage(reference: DataFrame, device: DataFrame, k: Sequence[str], t: str, min_s: float = 60.0) -> DataFrame:
    """Overlap of the reference stream with the device channels, and its share of each (Q1)."""
    a = reference.groupBy(*k).agg(F.min(t).alias("_a0"), F.max(t).alias("_a1"))
    b = device.groupBy(*k).agg(F.min(t).alias("_b0"), F.max(t).alias("_b1"))
    overlap = F.greatest(F.least("_a1", "_b1") - F.greatest("_a0", "_b0"), F.lit(0.0))
    joined = a.join(b, list(k), "left").withColumn("overlap_s", F.coalesce(overlap, F.lit(0.0)))

    def share(x0: str, x1: str) -> Column:
        span = F.col(x1) - F.col(x0)
        return F.when(span > 0, F.round(F.col("overlap_s") / span * 100, 1)).otherwise(0.0)

    return joined.select(
        *k, "overlap_s", share("_a0", "_a1").alias("overlap_pct_reference"),
        F.when(F.col("_b0").isNotNull(), share("_b0", "_b1")).alias("overlap_pct_device"),
        (F.col("overlap_s") > min_s).alias("ok"),
    )


def check_alignment(reference: DataFrame, series: DataFrame, k: Sequence[str], t: str, max_offset: float = 300.0, max_spread: float = 5.0) -> DataFrame:
    """Start offsets of the channels against the reference: median and spread (Q2)."""
    first = reference.groupBy(*k).agg(F.min(t).alias("_r0"))
    starts = series.groupBy(*k, "channel").agg(F.min(t).alias("_s0")).join(first, list(k)).withColumn("_o", F.col("_s0") - F.col("_r0"))
    spread = starts.groupBy(*k).agg((F.max("_o") - F.min("_o")).alias("spread_s"))
    return spread.join(stats.medians(starts, k, "_o", "median_offset_s"), list(k)).withColumn(
        "ok", (F.abs("median_offset_s") < max_offset) & (F.col("spread_s") < max_spread)
    )


def rate_of(rates: Mapping[str, float]) -> Column:
    """Nominal rate of the row's channel from a constant map (25 Hz where it is not named)."""
    pairs = F.create_map(*[F.lit(x) for item in rates.items() for x in item])
    return F.coalesce(pairs[F.col("channel")], F.lit(25.0))


def check_counts(series: DataFrame, rates: Mapping[str, float], overlap: DataFrame, k: Sequence[str]) -> DataFrame:
    """Samples per channel against overlap times rate: fine between 80 % and 120 % (Q3)."""
    counts = series.groupBy(*k, "channel").agg(F.count(F.lit(1)).alias("actual"))
    expected = F.floor(F.col("overlap_s") * rate_of(rates)).cast("bigint")
    ratio = F.when(F.col("expected") > 0, F.col("actual") / F.col("expected")).otherwise(0.0)
    return (
        counts.join(overlap.select(*k, "overlap_s"), list(k))
        .withColumn("expected", expected)
        .select(*k, "channel", "expected", "actual", F.round(ratio * 100, 1).alias("completeness_pct"), ratio.between(0.8, 1.2).alias("ok"))
    )


def check_gaps(series: DataFrame, rates: Mapping[str, float], k: Sequence[str], t: str, x: float = 3.0, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Gaps of more than `x` nominal periods: count, total beyond the period, largest (Q4).

    `i` numbers the samples inside (session, channel).
    """
    keys = [*k, "channel"]
    framed = blocks.over_blocks(
        series.select(*keys, t, i), keys, 1, 0, lambda w: [{"_d": F.col(t) - F.lag(t).over(w)}], i, block
    ).withColumn("_dt", 1.0 / rate_of(rates))
    gap = F.col("_d") > F.col("_dt") * x
    return framed.groupBy(*keys).agg(
        F.count(F.when(gap, 1)).alias("n_gaps"),
        F.coalesce(F.sum(F.when(gap, F.col("_d") - F.col("_dt"))), F.lit(0.0)).alias("total_gap_s"),
        F.coalesce(F.max(F.when(gap, F.col("_d"))), F.lit(0.0)).alias("largest_gap_s"),
    ).withColumn("ok", F.col("n_gaps") == 0)


def check_ranges(series: DataFrame, ranges: Mapping[str, tuple[float, float]], k: Sequence[str], v: str = "value", limit: float = 5.0) -> DataFrame:
    """Share of present values outside the channel's plausible range (Q5).

    The ranges are a constant table; channels without one pass. All-null channels fail.
    """
    lo = F.create_map(*[F.lit(x) for c, (a, _) in ranges.items() for x in (c, float(a))])[F.col("channel")]
    hi = F.create_map(*[F.lit(x) for c, (_, b) in ranges.items() for x in (c, float(b))])[F.col("channel")]
    outside = F.when(F.col(v).isNotNull(), (~F.col(v).between(lo, hi)).cast("double"))
    return series.groupBy(*k, "channel").agg(
        F.min(v).alias("lowest"), F.max(v).alias("highest"), (F.avg(outside) * 100).alias("pct_out")
    ).withColumn(
        "ok", F.when(F.col("channel").isin(list(ranges)), F.coalesce(F.col("pct_out") < limit, F.lit(False))).otherwise(True)
    )


def quality_score(checks: Sequence[DataFrame], k: Sequence[str]) -> DataFrame:
    """Share of passed checks per session, in percent (Q6).

    Each check is (k, ok); one with several rows per session passes when all of them do.
    """
    stacked = [
        c.groupBy(*k).agg(F.min(F.coalesce(F.col("ok"), F.lit(False)).cast("int")).alias("_ok")) for c in checks
    ]
    sessions = reduce(DataFrame.unionByName, [c.select(*k, "_ok") for c in stacked])
    return sessions.groupBy(*k).agg(F.rint(F.sum("_ok") / len(checks) * 100).cast("int").alias("score"))


def channel_quality(
    series: DataFrame, ranges: Mapping[str, tuple[float, float]], rates: Mapping[str, float], k: Sequence[str], t: str,
    width: float, v: str = "value", present: str = "present", gap_x: float = 3.0, flat_n: int = 10, fs: float = 25.0,
    i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Missing share, gaps, out-of-range share and flatlines per session and channel (Q7).

    `i` numbers all samples of a channel; gaps are read between present ones only, which get
    their own numbers.
    """
    keys = [*k, "channel"]
    lo = F.create_map(*[F.lit(x) for c, (a, _) in ranges.items() for x in (c, float(a))])[F.col("channel")]
    hi = F.create_map(*[F.lit(x) for c, (_, b) in ranges.items() for x in (c, float(b))])[F.col("channel")]
    outside = F.when(F.col(present) & lo.isNotNull(), (~F.col(v).between(lo, hi)).cast("double"))
    facts = series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg((~F.col(present)).cast("double")) * 100).alias("missing_pct"),
        F.count(F.when(F.col(present), 1)).alias("_present"),
        (F.avg(outside) * 100).alias("oor_pct"),
    )
    seen = blocks.index_rows(series.filter(present).select(*keys, t), keys, [t], blocks.chunk_of(t, width), "_j")
    stepped = blocks.over_blocks(seen, keys, 1, 0, lambda w: [{"_d": F.col(t) - F.lag(t).over(w)}], "_j", block)
    gap = F.col("_d") > gap_x / rate_of(rates)
    gaps = stepped.groupBy(*keys).agg(
        F.max(F.when(gap, F.col("_d"))).alias("longest_gap_s"), F.sum(F.when(gap, F.col("_d"))).alias("total_gap_s")
    )
    value = F.when(F.col(present), F.col(v))
    marked = runs.mark_runs(series.select(*keys, i, value.alias("_v")), keys, "_v", i, block=block)
    length = F.col("run_i1") - F.col("run_i0") + 1
    heads = marked.filter((F.col(i) == F.col("run_i0")) & F.col("_v").isNotNull() & (length > 1)).withColumn("_len", length)
    flats = heads.groupBy(*keys).agg(
        (F.max("_len") / fs).alias("longest_flatline_s"), F.sum(F.when(F.col("_len") >= flat_n, F.col("_len"))).alias("_flat")
    )
    return (
        facts.join(gaps, keys, "left").join(flats, keys, "left")
        .fillna(0.0, ["longest_gap_s", "total_gap_s", "longest_flatline_s"])
        .withColumn("pct_in_flatline", F.coalesce(F.col("_flat"), F.lit(0)) * 100.0 / F.greatest(F.col("_present"), F.lit(1)))
        .drop("_present", "_flat")
    )


def channel_summary(quality: DataFrame, limit: float = 30.0) -> DataFrame:
    """Channel quality over all sessions (Q7)."""
    return quality.groupBy("channel").agg(
        F.avg("missing_pct").alias("mean_missing_pct"), F.max("missing_pct").alias("max_missing_pct"),
        F.max("longest_gap_s").alias("max_longest_gap_s"), F.avg("oor_pct").alias("mean_oor_pct"), F.max("oor_pct").alias("max_oor_pct"),
        F.count(F.when(F.col("pct_in_flatline") > limit, 1)).alias("n_sessions_flat"), F.max("longest_flatline_s").alias("max_longest_flatline_s"),
    )


def session_screens(quality: DataFrame, meta: DataFrame, k: Sequence[str], eda: str, scr: str, beat: str, limit: float = 30.0) -> DataFrame:
    """Screens per session from channel quality, and availability of the beat channel (Q8).

    meta: k, drive_s.
    """

    def of(channel: str, field: str, name: str) -> Column:
        return F.max(F.when(F.col("channel") == channel, F.col(field))).alias(name)

    wide = quality.groupBy(*k).agg(
        of(eda, "oor_pct", "eda_oor"), of(eda, "pct_in_flatline", "eda_flat"), of(scr, "pct_in_flatline", "scr_flat"),
        of(beat, "missing_pct", "beat_drop"), of(beat, "oor_pct", "beat_oor"), of(beat, "longest_gap_s", "beat_gap"),
    )
    available = (1 - F.col("beat_drop") / 100) * (1 - F.col("beat_oor") / 100) * 100
    return wide.join(meta.select(*k, "drive_s"), list(k), "left").withColumns(
        {
            "eda_ok": F.col("eda_flat") < limit, "scr_ok": F.col("scr_flat") < limit, "beat_ok": F.col("beat_drop") < limit,
            "beat_avail_pct": available, "beat_avail_min": available / 100 * F.col("drive_s") / 60,
        }
    ).drop("drive_s")


def saturation(series: DataFrame, k: Sequence[str], v: str = "value", tol: float = 0.001, min_run: int = 25, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Samples within `tol` of the channel's overall maximum, and the longest run of them (Q9).

    One maximum per channel joins back; adaptive execution broadcasts that table.
    """
    keys = [*k, "channel"]
    tops = series.groupBy("channel").agg(F.greatest(F.max(v), F.lit(0.0)).alias("_top"))
    at = series.join(tops, "channel").withColumn("_at", F.coalesce(F.col(v) >= F.col("_top") * (1 - tol), F.lit(False)))
    facts = at.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_at"), 1)).alias("n_at_ceiling"))
    marked = runs.mark_runs(at.select(*keys, i, "_at"), keys, "_at", i, block=block).filter("_at")
    longest = marked.groupBy(*keys).agg(F.max(F.col("run_i1") - F.col("run_i0") + 1).alias("longest_run"))
    return facts.join(longest, keys, "left").fillna(0, ["longest_run"]).withColumn("sustained", F.col("longest_run") >= min_run)


def frame_audit(frames: DataFrame, k: Sequence[str], pts: str, meta: DataFrame, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Frame times in file order: non-monotonic and duplicate ones, rate, completeness (Q10).

    meta: k, duration_s, nominal_fps.
    """
    framed = blocks.over_blocks(frames.select(*k, i, pts), k, 1, 0, lambda w: [{"_d": F.col(pts) - F.lag(pts).over(w)}], i, block)
    up = F.when(F.col("_d") > 0, F.col("_d"))
    facts = framed.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n_frames"), F.count(F.when(F.col("_d") < 0, 1)).alias("n_nonmonotonic"),
        F.count(F.when(F.col("_d") == 0, 1)).alias("n_duplicate"), F.try_divide(F.lit(1.0), F.avg(up)).alias("actual_fps"),
        F.stddev_pop(up).alias("interval_sd_s"),
    )
    expected = F.col("duration_s") * F.col("nominal_fps")
    return facts.join(meta, list(k), "left").select(
        *k, "n_frames", "n_nonmonotonic", "n_duplicate", "actual_fps", "interval_sd_s", (F.col("n_frames") - expected).alias("frame_count_diff"),
        F.try_divide(F.col("n_frames"), expected).alias("completeness_ratio"),
    )


def feature_audit(frames: DataFrame, k: Sequence[str], frame: str, scores: Sequence[str], detected: Column, box: Column | None = None) -> DataFrame:
    """Rows, detections, scores that sum to 100 +- 1, frame range and boxes outside the picture (Q11)."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in scores])
    aggs = [
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(detected, 1)).alias("n_detections"),
        F.count(F.when(detected & (F.abs(total - 100) <= 1), 1)).alias("n_sum_ok"), F.min(frame).alias("frame_min"), F.max(frame).alias("frame_max"),
    ]
    if box is not None:
        aggs.append((F.count(F.when(detected & box, 1)) * 100.0 / F.nullif(F.count(F.when(detected, 1)), F.lit(0))).alias("outside_pct"))
    return frames.groupBy(*k).agg(*aggs)


def reproducibility(native: DataFrame, released: DataFrame, k: Sequence[str], t: str, width: float, tol: float = 0.06, classes: Sequence[str] = ()) -> DataFrame:
    """Labels recomputed on native samples against the released rows (Q13).

    native and released: k, t, label. Each released row takes the nearest native label within
    `tol`; reported are agreement and events per class on both sides.
    """
    from . import asof

    other = native.select(*k, t, F.col("label").alias("native_label"))
    matched = asof.asof_nearest(released.select(*k, t, "label"), other, k, t, width, tol, "")
    indexed = blocks.index_rows(matched, k, [t], blocks.chunk_of(t, width))
    same = F.col("label").eqNullSafe(F.col("native_label"))

    def starts(w):
        return [
            {f"_s_{c}": ~F.lag(c).over(w).eqNullSafe(F.col(c)) for c in ("label", "native_label")}
        ]

    framed = blocks.over_blocks(indexed, k, 1, 0, starts)
    counts = [
        F.count(F.when(F.col(f"_s_{c}") & (F.col(c) == cls), 1)).alias(f"{side}_{n}")
        for c, side in (("label", "released"), ("native_label", "native"))
        for n, cls in enumerate(classes)
    ]
    out = framed.groupBy(*k).agg(F.count(F.lit(1)).alias("n_rows"), (F.avg(same.cast("double")) * 100).alias("agreement_pct"), *counts)
    equal = reduce(lambda a, b: a & b, [F.col(f"released_{n}") == F.col(f"native_{n}") for n in range(len(classes))], F.lit(True))
    return out.withColumn("status", F.when(equal, "reproduced").otherwise("differs"))


def availability(meta: DataFrame, manifest: DataFrame, k: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Which kinds of file each session has (Q14). manifest: k, kind."""
    has = manifest.groupBy(*k).agg(*[F.max((F.col("kind") == x).cast("int")).alias(f"_{x}") for x in kinds])
    return meta.join(has, list(k), "left").withColumns({f"has_{x}": F.coalesce(F.col(f"_{x}") == 1, F.lit(False)) for x in kinds}).drop(*[f"_{x}" for x in kinds])


def availability_totals(available: DataFrame, kinds: Sequence[str], rates: Mapping[str, str], duration_s: str) -> DataFrame:
    """One row: sessions, those with each kind of file, the mean rate of a kind where it is there, and hours in all (Q14). `available`: has_<kind> columns;
    rates: a kind's rate column."""
    return available.agg(
        F.count(F.lit(1)).alias("n_sessions"),
        *[F.count(F.when(F.col(f"has_{x}"), 1)).alias(f"n_{x}") for x in kinds],
        *[F.avg(F.when(F.col(f"has_{x}"), F.col(c))).alias(f"mean_rate_{x}") for x, c in rates.items()],
        (F.sum(duration_s) / 3600).alias("hours"),
    )


def session_metadata(fused: DataFrame, features: Mapping[str, tuple[DataFrame, Column]], k: Sequence[str], t: str) -> DataFrame:
    """Per session: duration, rows, and rows and detection rate of each feature table (Q15)."""
    out = fused.groupBy(*k).agg((F.max(t) - F.min(t)).alias("duration_s"), F.count(F.lit(1)).alias("n_rows"))
    for name, (table, detected) in features.items():
        part = table.groupBy(*k).agg(
            F.count(F.lit(1)).alias(f"{name}_rows"), (F.avg(F.coalesce(detected, F.lit(False)).cast("double")) * 100).alias(f"{name}_detected_pct")
        )
        out = out.join(part, list(k), "left").fillna(0, [f"{name}_rows"])
    return out


def metadata_totals(meta: DataFrame) -> DataFrame:
    """Sessions, hours and rows over the whole release (Q15)."""
    return meta.agg(F.count(F.lit(1)).alias("n_sessions"), (F.sum("duration_s") / 3600).alias("hours"), F.sum("n_rows").alias("n_rows"))


def add_provenance(meta: DataFrame, sync: DataFrame, exceptions: DataFrame, on: Sequence[str]) -> DataFrame:
    """A nested `sync` record and the list of exceptions per session (Q16)."""
    from .relations import attach_tags

    record = sync.select(*on, F.struct(*[c for c in sync.columns if c not in on]).alias("sync"))
    return attach_tags(meta.join(record, list(on), "left"), exceptions, on, "tag", "exceptions")


def residual_summary(detections: DataFrame, frames: DataFrame, k: Sequence[str], min_conf: float = 0.90, min_sharp: float = 300.0) -> DataFrame:
    """Sharp, confident detections per file and their share of the checked frames (Q17).

    A detection whose sharpness could not be computed (null) counts as flagged.
    """
    flagged = (F.col("conf") >= min_conf) & F.coalesce(F.col("sharpness") >= min_sharp, F.lit(True))
    hits = detections.groupBy(*k).agg(F.count(F.when(flagged, 1)).alias("n_flagged"))
    checked = frames.groupBy(*k).agg(F.count(F.lit(1)).alias("n_checked"))
    return checked.join(hits, list(k), "left").fillna(0, ["n_flagged"]).withColumn("pct_flagged", F.col("n_flagged") * 100.0 / F.col("n_checked"))


def fill_boxes(boxes: DataFrame, k: Sequence[str], box: str, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Carry the last box over frames without one, and back over a leading gap (Q18).

    Adds `carried`, and `gap` = frames since the last own box (null in a leading gap).
    """
    cut = boxes.withColumn("_b", F.floor(F.col(i) / block).cast("bigint"))
    own = F.when(F.col(box).isNotNull(), F.struct(F.col(i).alias("_i"), F.col(box).alias("_x")))
    seen = blocks.scan(cut, k, "_b", [i], prev={"_p": own}, following={"_n": own})
    filled = F.coalesce(F.col(box), F.col("_p._x"), F.col("_n._x"))
    return seen.withColumns(
        {
            "carried": F.col(box).isNull() & filled.isNotNull(),
            "gap": F.when(F.col(box).isNull(), F.col(i) - F.col("_p._i")),
            "filled": filled,
        }
    ).withColumn(box, F.col("filled")).drop("filled", "_p", "_n", "_b")


def fill_summary(filled: DataFrame, k: Sequence[str]) -> DataFrame:
    """Carried frames and the longest carry per file (Q18)."""
    return filled.groupBy(*k).agg(
        F.count(F.when(F.col("carried"), 1)).alias("n_carried"), F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap")
    )
