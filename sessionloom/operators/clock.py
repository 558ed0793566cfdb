"""Clock calibration from sync pings, cadence and continuity audits.

Pings carry device_ms (device clock), sent_s (reference clock, epoch seconds) and rtt_ms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from . import blocks, expanding, stats


def clean_pings(pings: DataFrame, k: Sequence[str], min_pings: int = 5) -> DataFrame:
    """Pings with a plausible round trip, as offsets from the session's first clean ping.

    Adds x (device seconds), y (reference seconds) and off = y - x, all from that first ping,
    so later fits work on small numbers. A calibration reads the pings several times, so they are
    written once after cleaning; they are few next to the samples.
    """
    ready = settle(pings.dropna(subset=["device_ms", "sent_s", "rtt_ms"]))
    facts = ready.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_pings)
    middle = stats.medians(ready, k, "rtt_ms", "_rtt")
    clean = (
        stats.attach(stats.attach(ready, facts, k), middle, k)
        .filter(F.col("rtt_ms") <= F.greatest(F.col("_rtt") * 3, F.col("_rtt") + 20))
        .withColumn("ref_s", F.col("sent_s") + F.col("rtt_ms") / 2000.0)
        .drop("_n", "_rtt")
    )
    origin = clean.groupBy(*k).agg(F.min("device_ms").alias("x0_ms"), F.min_by("ref_s", "device_ms").alias("y0_s"))
    return settle(
        stats.attach(clean, origin, k)
        .withColumns({"x": (F.col("device_ms") - F.col("x0_ms")) / 1000.0, "y": F.col("ref_s") - F.col("y0_s")})
        .withColumn("off", F.col("y") - F.col("x"))
    )


def anchor_only(clean: DataFrame, k: Sequence[str]) -> DataFrame:
    """Calibration of slope 1: the median offset, its MAD and the largest residual."""
    spread = stats.mad(clean, k, "off", "intercept", "_mad")
    residual = stats.attach(clean, spread, k).groupBy(*k).agg(
        F.max(F.abs(F.col("off") - F.col("intercept"))).alias("_worst"),
        F.count(F.lit(1)).alias("n_used"),
        F.max("x").alias("span_s"),
        F.max("x0_ms").alias("x0_ms"),
        F.max("y0_s").alias("y0_s"),
    )
    return spread.join(residual, list(k)).select(
        *k, F.lit(1.0).alias("slope"), "intercept", "x0_ms", "y0_s", "n_used", "span_s",
        (F.col("_mad") * 1000).alias("mad_ms"), (F.col("_worst") * 1000).alias("max_resid_ms"),
    )


def robust_linear(clean: DataFrame, k: Sequence[str], rounds: int = 3, n_mad: float = 5.0) -> DataFrame:
    """Least squares refitted without outliers.

    Each round fits the kept pings, then keeps all pings within n_mad robust deviations of the
    kept residuals' median; a session stops when the number of kept pings stops changing. The
    pings are written between rounds, so a round reads them instead of replaying the ones before.
    """
    k = list(k)
    state = clean.select(*k, "x", "y").withColumns(
        {"keep": F.lit(True), "done": F.lit(False), "slope": F.lit(None).cast("double"), "intercept": F.lit(None).cast("double")}
    )
    for _ in range(rounds):
        state = settle(state)
        active = state.filter(~F.col("done"))
        fit = active.filter("keep").groupBy(*k).agg(
            F.regr_slope("y", "x").alias("_s"), F.regr_intercept("y", "x").alias("_i"), F.count(F.lit(1)).alias("_kept")
        )
        resid = active.join(fit, k).withColumn("_r", F.col("y") - (F.col("_s") * F.col("x") + F.col("_i")))
        spread = stats.mad(resid.filter("keep"), k, "_r", "_med", "_mad")
        scale = F.when(F.col("_mad") == 0, 1e-6).otherwise(F.col("_mad"))
        judged = resid.join(spread, k).withColumn("_new", F.abs(F.col("_r") - F.col("_med")) <= n_mad * 1.4826 * scale)
        counted = judged.groupBy(*k).agg(F.count(F.when(F.col("_new"), 1)).alias("_now"))
        moved = judged.join(counted, k).select(
            *k, "x", "y", F.col("_new").alias("keep"), (F.col("_now") == F.col("_kept")).alias("done"),
            F.col("_s").alias("slope"), F.col("_i").alias("intercept"),
        )
        state = state.filter("done").unionByName(moved)
    resid = F.abs(F.col("y") - (F.col("slope") * F.col("x") + F.col("intercept")))
    return state.groupBy(*k).agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.count(F.when(F.col("keep"), 1)).alias("n_used"),
        F.count(F.when(~F.col("keep"), 1)).alias("n_outliers"),
        (F.coalesce(F.max(F.when(F.col("keep"), resid)), F.max(resid)) * 1000).alias("max_resid_ms"),
    ).withColumn("ppm", (F.col("slope") - 1) * 1e6)


def largest_step(clean: DataFrame, k: Sequence[str], min_side: int = 5, i: str = "i", block: int = expanding.ROWS) -> DataFrame:
    """Largest sustained change of the offset (C4): median after minus median before a split with
    at least `min_side` pings on each side; the first such split wins. `i` numbers the pings.

    The two medians of every split are running medians from either end of the log, found in one
    call. Pings and medians are written once each, so no plan holds the steps before them again.
    """
    k = list(k)
    base = settle(clean.select(*k, i, "x", "off"))
    sizes = base.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
    backwards = base.join(sizes, k).select(*k, F.lit(True).alias("_back"), (F.col("_n") - 1 - F.col(i)).alias(i), "off")
    both = base.select(*k, F.lit(False).alias("_back"), i, "off").unionByName(backwards)
    medians = settle(expanding.prefix_medians(both, [*k, "_back"], "off", "_median", i, block))
    at = F.when(F.col("_back"), F.col("_n") - 1 - F.col(i)).otherwise(F.col(i) + 1)
    split = (
        medians.join(sizes, k).withColumn(i, at)
        .filter((F.col(i) >= min_side) & (F.col(i) <= F.col("_n") - min_side))
        .groupBy(*k, i)
        .agg((F.max(F.when(F.col("_back"), F.col("_median"))) - F.max(F.when(~F.col("_back"), F.col("_median")))).alias("step"))
        .filter(F.col("step") != 0)
    )
    best = split.groupBy(*k).agg(F.min_by(F.struct("step", i), F.struct(-F.abs("step"), F.col(i))).alias("_b"))
    found = best.select(*k, F.col(f"_b.{i}").alias(i), F.col("_b.step").alias("_step")).join(base.select(*k, i, "x"), [*k, i])
    return sizes.join(found, k, "left").select(
        *k, F.coalesce(F.col("_step"), F.lit(0.0)).alias("max_step_s"), F.col("x").alias("step_at_s")
    )


def two_point_map(cal: DataFrame, k: Sequence[str], span_ms: float = 1e7) -> DataFrame:
    """A calibration as two points of its line (C5): device TE0, TE1 and reference TL0, TL1."""

    def at(ms: float):
        return F.col("y0_s") + F.col("intercept") + F.col("slope") * (F.lit(ms) - F.col("x0_ms")) / 1000.0

    return cal.select(
        *k, F.lit(0.0).alias("TE0"), F.lit(span_ms).alias("TE1"), at(0.0).alias("TL0"), at(span_ms).alias("TL1")
    )


def choose_sync(cal: DataFrame, fallback: DataFrame, k: Sequence[str]) -> DataFrame:
    """The calibrated map where there is one, else the file-name anchor, with the method.

    fallback: k, start_ms, start_s (device and reference time of the recording's start).
    """
    return fallback.join(cal, list(k), "left").select(
        *k,
        F.coalesce("TE0", "start_ms").alias("TE0"),
        F.coalesce(F.col("TE1"), F.col("start_ms") + 1000.0).alias("TE1"),
        F.coalesce("TL0", "start_s").alias("TL0"),
        F.coalesce(F.col("TL1"), F.col("start_s") + 1.0).alias("TL1"),
        F.when(F.col("TE0").isNotNull(), "timesync").otherwise("filename_anchor").alias("sync_method"),
    )


def device_to_unix(df: DataFrame, maps: DataFrame, k: Sequence[str], ts_ms: str, out: str = "unix_time") -> DataFrame:
    """Device milliseconds on the reference clock by each session's two-point map.

    One row per session on the right side; adaptive execution broadcasts it when small.
    """
    rate = F.try_divide(F.col("TL1") - F.col("TL0"), F.col("TE1") - F.col("TE0"))
    joined = df.join(maps.select(*k, "TE0", "TE1", "TL0", "TL1"), list(k))
    return joined.withColumn(out, F.col("TL0") + (F.col(ts_ms) - F.col("TE0")) * rate).drop("TE0", "TE1", "TL0", "TL1")


def anchor_shift(old: DataFrame, new: DataFrame, k: Sequence[str]) -> DataFrame:
    """Shift of each session's anchor between two calibrations (C7); `largest` lists the worst."""
    a = old.select(*k, F.col("anchor_s").alias("_old"))
    b = new.select(*k, F.col("anchor_s").alias("_new"))
    return a.join(b, list(k)).select(*k, (F.col("_new") - F.col("_old")).alias("shift_s"))


def largest(df: DataFrame, k: Sequence[str], c: str, n: int) -> DataFrame:
    """The `n` sessions with the largest size of `c`, worst first, with their rank."""
    order = [F.round(F.abs(c), 6).desc(), *k]
    few = df.filter(F.col(c).isNotNull()).orderBy(*order).limit(n)
    # n rows
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def shift_summary(shifts: DataFrame) -> DataFrame:
    """How many anchors moved by more than 0.5, 1 and 2 seconds."""
    size = F.abs("shift_s")
    return shifts.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(size > s, 1)).alias(f"n_gt_{str(s).replace('.', 'p')}s") for s in (0.5, 1, 2)],
        F.max(size).alias("largest_s"),
    )


def map_drift(maps: DataFrame, k: Sequence[str], drive_s: str) -> DataFrame:
    """Rate error of two-point maps in ppm, and the drift it implies over the drive."""
    rate = F.try_divide(F.col("TL1") - F.col("TL0"), (F.col("TE1") - F.col("TE0")) / 1000.0)
    return maps.select(*k, ((rate - 1) * 1e6).alias("ppm"), ((rate - 1) * F.col(drive_s)).alias("drift_s"))


def ping_cadence(pings: DataFrame, k: Sequence[str], t: str, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    """Pings, span, median / p90 / longest interval and pings per minute."""
    framed = blocks.over_blocks(
        pings.select(*k, i, t), k, 1, 0, lambda w: [{"_gap": F.col(t) - F.lag(t).over(w)}], i, block
    )
    span = F.max(t) - F.min(t)
    facts = framed.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n_pings"), span.alias("span_s"), F.max("_gap").alias("longest_gap_s"),
        (F.count(F.lit(1)) / F.greatest(span, F.lit(1.0)) * 60).alias("pings_per_min"),
    )
    spread = stats.quantiles(framed, k, "_gap", [0.5, 0.9], ["median_interval_s", "p90_interval_s"])
    return facts.join(spread, list(k), "left")


def timing_quality(cal: DataFrame, cadence: DataFrame, meta: DataFrame, k: Sequence[str]) -> DataFrame:
    """Coverage of the drive, scatter, step and the observed variability per session.

    cal: n_used, span_s, mad_ms, max_step_s; cadence: longest_gap_s; meta: drive_s, note.
    """
    joined = meta.join(cal, list(k), "left").join(cadence.select(*k, "longest_gap_s"), list(k), "left")
    coverage = F.least(F.try_divide(F.col("span_s"), F.col("drive_s")) * 100, F.lit(100.0))
    partial = F.when(
        F.col("coverage_pct") < 50,
        F.format_string("ping span covers %s%% of drive", F.rint("coverage_pct").cast("bigint").cast("string")),
    )
    return (
        joined.withColumns({"coverage_pct": coverage, "step_s": F.abs("max_step_s")})
        .withColumn("variability_s", F.greatest(F.col("step_s"), F.col("mad_ms") * 2 / 1000, F.lit(0.10)))
        .select(
            *k, (F.col("drive_s") / 60).alias("dur_min"), F.col("n_used").alias("pings"), "coverage_pct", "mad_ms", "step_s",
            "variability_s", "longest_gap_s", F.concat_ws("; ", partial, F.col("note")).alias("notes"),
        )
    )


def wrap_midnight(df: DataFrame, k: Sequence[str], tod: str, i: str = "i") -> DataFrame:
    """Times of day after midnight continue the day of the session's first sample."""
    first = df.groupBy(*k).agg(F.min_by(tod, i).alias("_t0"))
    wrapped = F.when(F.col(tod) < F.col("_t0"), F.col(tod) + 86_400).otherwise(F.col(tod))
    return stats.attach(df, first, k).withColumn(tod, wrapped).drop("_t0")


def anchor_time(df: DataFrame, k: Sequence[str], tod: str, elapsed: str, date: str, i: str = "i", out: str = "unix_time") -> DataFrame:
    """Absolute time from one anchor per session: date, first time of day, elapsed.

    The time of day may stall while elapsed time runs on, so it is read on the first row only.
    """
    day = F.unix_date(F.col(date)) * 86_400
    first = df.groupBy(*k).agg(F.min_by(F.struct(day.alias("day"), F.col(tod).alias("tod")), i).alias("_a"))
    return stats.attach(df, first, k).withColumn(out, F.col("_a.day") + F.col("_a.tod") + F.col(elapsed)).drop("_a")


def clock_jumps(df: DataFrame, k: Sequence[str], tod: str, elapsed: str, jump: float = 0.5, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Samples with the clock residual (tod - tod0) - elapsed, its change and a jump flag.

    The residual's change needs no origin; the origin is added from one row per session.
    """
    first = df.groupBy(*k).agg(F.min_by(tod, i).alias("_t0"))
    resid = stats.attach(df, first, k).withColumn("residual", F.col(tod) - F.col("_t0") - F.col(elapsed)).drop("_t0")

    def layer(w):
        return [
            {
                "jump_s": F.col("residual") - F.lag("residual").over(w),
                "before_jump_s": F.lag(elapsed).over(w),
            }
        ]

    framed = blocks.over_blocks(resid, k, 1, 0, layer, i, block)
    return framed.withColumn("is_jump", F.coalesce(F.abs("jump_s") > jump, F.lit(False)))


def clock_continuity(df, k, tod: str, elapsed: str, jump: float = 0.5, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Per session: rows, spans, residual at the end and at its largest, and clock jumps."""
    marked = clock_jumps(df, k, tod, elapsed, jump, i, block)
    facts = marked.groupBy(*k).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max_by(elapsed, i).alias("elapsed_end_s"),
        (F.max_by(tod, i) - F.min_by(tod, i)).alias("utc_span_s"),
        F.max_by("residual", i).alias("residual_end_s"),
        F.max(F.abs("residual")).alias("max_abs_residual_s"),
        F.count(F.when(F.col("is_jump"), 1)).alias("n_jumps"),
        F.min(F.when(F.col("is_jump"), F.col("before_jump_s"))).alias("first_jump_at_s"),
    )
    sizes = marked.filter("is_jump").groupBy(*k).agg(F.sort_array(F.collect_list(F.struct(i, "jump_s"))).alias("_j")).select(
        *k, F.transform("_j", lambda s: F.round(s["jump_s"], 2)).alias("jump_sizes_s")
    )
    return facts.join(sizes, list(k), "left").withColumn(
        "jump_sizes_s", F.coalesce("jump_sizes_s", F.array().cast("array<double>"))
    )


def clock_health(df: DataFrame, k: Sequence[str], segment: str, satellites: str) -> DataFrame:
    """Video segments and the fewest satellites of each session."""
    return df.groupBy(*k).agg(F.count_distinct(segment).alias("n_segments"), F.min(satellites).alias("min_satellites"))


def clock_segments(df: DataFrame, k: Sequence[str], segment: str, video: str, elapsed: str, jump: float = 0.5, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Per video segment: rows, the range of video time minus elapsed time, and its jumps.

    Rows are numbered inside their segment, so a segment may be of any length and need not be in one piece.
    """
    rows = df.select(*k, segment, i, elapsed, (F.col(video) - F.col(elapsed)).alias("_gap"))
    own = [*k, segment]
    numbered = blocks.index_rows(rows, own, [i], blocks.chunk_of(i, float(block)), "_s")
    framed = blocks.over_blocks(numbered, own, 1, 0, lambda w: [{"_j": F.col("_gap") - F.lag("_gap").over(w), "_at": F.lag(elapsed).over(w)}], "_s", block)
    jumps = F.abs("_j") > jump
    return framed.groupBy(*own).agg(
        F.count(F.lit(1)).alias("n"), (F.max("_gap") - F.min("_gap")).alias("residual_range_s"), F.count(F.when(jumps, 1)).alias("n_jumps"),
        F.min(F.when(jumps, F.col("_at"))).alias("first_jump_at_s"), F.max(F.when(jumps, F.abs("_j"))).alias("largest_jump_s"),
    )


def first_jumps(df, k, tod: str, elapsed: str, jump: float = 0.5, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Cut table for T25: the last elapsed time before each session's first clock jump."""
    marked = clock_jumps(df, k, tod, elapsed, jump, i, block)
    return marked.filter("is_jump").groupBy(*k).agg(F.min("before_jump_s").alias("cut_s"))


def truncate_at_jump(tier: DataFrame, cuts: DataFrame, k: Sequence[str], at) -> DataFrame:
    """Rows of a tier up to its session's cut (T25); `at` is the row's elapsed time, from a time
    column or from frame / fps. Sessions without a jump stay whole."""
    joined = tier.join(cuts.select(*k, "cut_s"), list(k), "left")
    return joined.filter(F.col("cut_s").isNull() | (at <= F.col("cut_s"))).drop("cut_s")


def lead_in(df: DataFrame, k: Sequence[str], sync: str, elapsed: str, segment: str, i: str = "i") -> DataFrame:
    """Video lead-in per session: first offset, and median and spread in the first segment."""
    first = df.groupBy(*k).agg(
        F.min_by(F.struct(F.col(sync).alias("a"), F.col(segment).alias("s")), i).alias("_f"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max_by(elapsed, i).alias("telemetry_s"),
    )
    segments = df.select(*k, segment).distinct().groupBy(*k).agg(F.count(F.lit(1)).alias("n_segments"))
    inside = stats.attach(df, first.select(*k, F.col("_f.s").alias("_s0")), k).filter(F.col(segment) == F.col("_s0"))
    resid = inside.withColumn("_r", F.col(sync) - F.col(elapsed))
    spread = resid.groupBy(*k).agg(((F.max("_r") - F.min("_r")) * 1000).alias("lead_in_spread_ms"))
    middle = stats.medians(resid, k, "_r", "lead_in_median_s")
    return first.join(middle, list(k)).join(spread, list(k)).join(segments, list(k)).select(
        *k, F.col("_f.a").alias("lead_in_s"), "lead_in_median_s", "lead_in_spread_ms", "n_segments", "n_rows", "telemetry_s"
    )


def anchors_at_first_ping(cal: DataFrame, starts: DataFrame, k: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Reference time of the first clean ping by the file-name anchor and by a calibration, as the
    two inputs of `anchor_shift` (C7). starts: k, start_ms (first sample), start_s (file name)."""
    old = cal.join(starts.select(*k, "start_ms", "start_s"), list(k)).select(
        *k, (F.col("start_s") + (F.col("x0_ms") - F.col("start_ms")) / 1000.0).alias("anchor_s")
    )
    return old, cal.select(*k, (F.col("y0_s") + F.col("intercept")).alias("anchor_s"))


def first_gap_anomalies(df: DataFrame, k: Sequence[str], tod: str, nominal: float = 0.04, tol: float = 0.02, i: str = "i") -> DataFrame:
    """Sessions whose first two samples are not one period apart, so their anchor is doubtful."""
    gap = F.max(F.when(F.col(i) == 1, F.col(tod))) - F.max(F.when(F.col(i) == 0, F.col(tod)))
    first = df.filter(F.col(i) <= 1).groupBy(*k).agg(gap.alias("first_gap_s"))
    return first.filter((F.abs(F.col("first_gap_s") - nominal) > tol) | (F.col("first_gap_s") <= 0))


def suffix_coverage(files: DataFrame, name: str) -> DataFrame:
    """How many recording names carry a fraction of a second after the time."""
    whole, full = r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}", r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}-\d+"
    return files.agg(
        F.count(F.when(F.col(name).rlike(whole), 1)).alias("n_stamped"),
        F.count(F.when(F.col(name).rlike(full), 1)).alias("n_with_fraction"),
    )
