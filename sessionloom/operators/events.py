"""Event analytics: diagnostics, matching of event sets, completeness, responses, spacing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..functions.scalars import wrapped_diff
from ..session import settle
from . import asof, blocks, groups, intervals, rules, runs, stats


def diagnose_events(
    samples: DataFrame, k: Sequence[str], label: str, p: rules.Rule = rules.ADOPTED, i="i", t="t",
    block=blocks.BLOCK_ROWS, other_label: str | None = None,
) -> DataFrame:
    """One row per event with its dynamics.

    What an event needs from its surroundings (smoothed signals, the preceding second of vehicle
    acceleration, headings a margin outside) is put on every sample by bounded frames; the
    event is then one combinable aggregation keyed by its first index.
    """
    trailing = round(p.fs)

    def layers(w):
        chain = rules._smoothed(w, p, "d")
        chain[0] = chain[0] | {
            "_can": (F.col("speed_kph") - F.lag("speed_kph").over(w)) / 3.6 * p.fs,
            "_speed_before": F.coalesce(F.lag("speed_kph").over(w), F.col("speed_kph")),
            "_gnss_before": F.coalesce(F.lag("gps_speed_kmh").over(w), F.col("gps_speed_kmh")),
        } | rules.heading_ends(w, "heading_deg", p.heading_margin)
        around = w.rowsBetween(-trailing, 0)
        return [*chain, {"_can_lo": F.min("_can").over(around), "_can_hi": F.max("_can").over(around)}]

    reach = p.median_n + p.smooth_n + trailing + 2
    framed = blocks.over_blocks(samples, k, reach, reach, layers, i, block)
    marked = runs.mark_runs(framed, k, label, i, block=block).filter(F.col(label) != rules.NORMAL)
    turning = F.col(label) == rules.TURN
    limit = (
        F.when(turning, p.turn_g).when(F.col(label) == rules.BRAKE, p.brake_g).otherwise(p.accel_g)
    )
    raw = F.when(turning, F.col("lat_acc_g")).otherwise(F.col("lon_acc_g"))
    smooth = F.when(turning, F.col("_lat_d")).otherwise(F.abs("_lon_d"))
    big = (F.abs("lat_acc_g") > 1.2) | (F.abs("lon_acc_g") > 1.2)
    rate = F.col("_lat_d") * rules.G_MS2 / (F.greatest(F.col("gps_speed_kmh"), F.lit(1.0)) / 3.6) / p.fs
    aggs = [
        F.max(i).alias("i1"),
        F.min(t).alias("start_s"),
        F.max(t).alias("end_s"),
        F.count(F.lit(1)).alias("n_samples"),
        F.max(smooth).alias("peak_smoothed_g"),
        F.avg("gps_speed_kmh").alias("mean_speed_kmh"),
        F.least(F.min("_can"), F.min_by("_can_lo", i)).alias("can_accel_min_ms2"),
        F.greatest(F.max("_can"), F.min_by("_can_hi", i)).alias("can_accel_max_ms2"),
        F.avg("_can").alias("can_accel_mean_ms2_event"),
        (F.max_by("speed_kph", i) - F.min_by("_speed_before", i)).alias("can_speed_change_kmh"),
        (F.max_by("gps_speed_kmh", i) - F.min_by("_gnss_before", i)).alias("gnss_speed_change_kmh"),
        F.max("throttle_pct").alias("throttle_max_pct"),
        F.count(F.when(F.abs(raw) >= limit, 1)).alias("n_raw_above_thr"),
        F.avg((F.abs(raw) >= limit / 2).cast("double")).alias("frac_raw_above_half_thr"),
        F.max(F.abs(raw)).alias("max_raw_g"),
        F.count(F.when(big, 1)).alias("n_raw_gt_1p2g"),
        (F.abs(F.avg(raw)) / F.greatest(F.avg(F.abs(raw)), F.lit(1e-9))).alias("rectification_ratio"),
        F.min_by("_h_before", i).alias("_h0"),
        F.max_by("_h_after", i).alias("_h1"),
        F.degrees(F.sum(rate)).alias("heading_change_expected_deg"),
    ]
    if other_label:
        aggs.append(F.max((F.col(other_label) != rules.NORMAL).cast("int")).alias("_other"))
    out = (
        marked.groupBy(*k, F.col("run_i0").alias("i0"), F.col(label).alias("label"))
        .agg(*aggs)
        .withColumn("duration_s", F.col("n_samples") / p.fs)
        .withColumn("heading_change_deg", wrapped_diff("_h0", "_h1"))
        .drop("_h0", "_h1")
    )
    if other_label:
        out = out.withColumn("overlaps_other", F.col("_other") == 1).drop("_other")
    return out


def clip_outcome(base: DataFrame, clipped: DataFrame, k: Sequence[str], width: float) -> DataFrame:
    """What becomes of each event when the source is clipped.

    Both event sets are (k, i0, i1, label); `width` is a chunk width in samples.
    """
    b = clipped.select(*k, F.col("i0").alias("c0"), F.col("i1").alias("c1"), F.col("label").alias("cl"))
    pairs = intervals.overlap_join(base.select(*k, "i0", "i1", "label"), b, k, ("i0", "i1"), ("c0", "c1"), width)
    same = F.col("cl") == F.col("label")
    per_clip = pairs.groupBy(*k, "c0").agg(F.count(F.lit(1)).alias("n_base"))
    per_base = (
        pairs.join(per_clip, [*k, "c0"])
        .groupBy(*k, "i0")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(same, 1)).alias("n_same"),
            F.min(F.when(same, F.struct("c0", "c1", "n_base"))).alias("m"),
        )
    )
    moved = F.abs(F.col("m.c0") - F.col("i0")) + F.abs(F.col("m.c1") - F.col("i1"))
    outcome = (
        F.when(F.col("n").isNull(), "disappears")
        .when(F.col("n_same") == 0, "class change")
        .when(F.col("n") > 1, "split")
        .when(F.col("m.n_base") > 1, "merge")
        .when(moved == 0, "unchanged")
        .otherwise(F.concat(F.lit("boundary "), moved.cast("string"), F.lit(" samples")))
    )
    kept = base.join(per_base, [*k, "i0"], "left").select(*k, "i0", "i1", "label", outcome.alias("outcome"))
    fresh = clipped.join(per_clip, (clipped["i0"] == per_clip["c0"]) & reduce(lambda x, y: x & y, [clipped[c] == per_clip[c] for c in k]), "left_anti")
    appears = fresh.select(*k, "i0", "i1", "label", F.lit("appears only after clipping").alias("outcome"))
    return kept.unionByName(appears)


def implausible(limit: float) -> Column:
    return F.coalesce((F.abs("lat_acc_g") > limit) | (F.abs("lon_acc_g") > limit), F.lit(False))


def artefact_classes(samples: DataFrame, k: Sequence[str], label: str, limit: float = 1.2, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Events of each class per session, and how many of them hold an implausible acceleration."""
    marked = runs.mark_runs(samples.select(*k, i, label, implausible(limit).alias("_bad")), k, label, i, block=block).filter(F.col(label) != rules.NORMAL)
    each = marked.groupBy(*k, "run_i0", label).agg(F.max(F.col("_bad").cast("bigint")).alias("_hit"))
    return each.groupBy(*k, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n_events"), F.sum("_hit").alias("n_affected"))


def artefact_run_details(samples: DataFrame, k: Sequence[str], label: str, t: str, speed: str, limit: float = 1.2, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Runs of implausible accelerations with where they start, how fast, and the labels they touch."""
    flagged = samples.select(*k, i, t, speed, label, implausible(limit).alias("_bad"))
    marked = runs.mark_runs(flagged, k, "_bad", i, {"start_t": F.col(t), "start_speed": F.col(speed)}, block=block).filter("_bad")
    # a set of classes, of which there are few
    return marked.groupBy(*k, F.col("run_i0").alias("i0"), F.col("run_i1").alias("i1")).agg(
        F.first("start_t").alias("start_t"), F.first("start_speed").alias("start_speed"), F.sort_array(F.collect_set(label)).alias("labels_in_run")
    )


def artefact_overlap(
    samples: DataFrame, k: Sequence[str], label: str, limit: float = 1.2, brief: int = 3, ctx: int = 5,
    i="i", block=blocks.BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Implausible accelerations and the events they touch (E4): (per session, per run).

    Sign alternations around a run count the changes of the non-zero sign inside the run and
    `ctx` samples to either side. Running counts of changes turn that into a difference of two
    values read a margin outside the run.
    """
    lat, lon = F.col("lat_acc_g"), F.col("lon_acc_g")
    flagged = samples.withColumn("_bad", F.coalesce((F.abs(lat) > limit) | (F.abs(lon) > limit), F.lit(False)))
    signed = flagged.withColumns(
        {
            "_slat": F.when(lat != 0, F.signum(lat)),
            "_slon": F.when(lon != 0, F.signum(lon)),
            "_b": F.floor(F.col(i) / block).cast("bigint"),
        }
    )
    # sign of the latest non-zero sample up to and including each row, and the change it makes
    seen = blocks.scan(
        signed, k, "_b", [i], prev={"_plat": F.col("_slat"), "_plon": F.col("_slon")}
    ).drop("_b")

    def flips(w):
        return [
            {f"_f{a}": F.when(F.col(f"_s{a}").isNotNull() & (F.lag(f"_p{a}").over(w) != F.col(f"_s{a}")), 1).otherwise(0) for a in ("lat", "lon")}
        ]

    flipped = blocks.over_blocks(seen, k, 1, 0, flips, i, block).withColumn(
        "_b", F.floor(F.col(i) / block).cast("bigint")
    )
    counted = blocks.scan(
        flipped, k, "_b", [i], running={"_nlat": F.col("_flat"), "_nlon": F.col("_flon")}
    ).drop("_b")

    def ends(w):
        # the first non-zero sample of the context has no partner inside it, so its own change
        # is left out: the count starts after that sample
        first = {
            f"_c{a}": F.first(F.when(F.col(f"_s{a}").isNotNull(), F.col(f"_n{a}")), True).over(w.rowsBetween(-ctx, ctx))
            for a in ("lat", "lon")
        }
        last = {f"_d{a}": F.last(f"_n{a}").over(w.rowsBetween(0, ctx)) for a in ("lat", "lon")}
        return [first | last]

    framed = blocks.over_blocks(counted, k, ctx, ctx, ends, i, block)
    marked = runs.mark_runs(
        framed, k, "_bad", i, {"_a0": F.col("_clat"), "_a1": F.col("_clon")}, {"_z0": F.col("_dlat"), "_z1": F.col("_dlon")}, block
    )
    bad_runs = (
        marked.filter("_bad")
        .groupBy(*k, F.col("run_i0").alias("i0"))
        .agg(
            F.count(F.lit(1)).alias("run_len"),
            F.max(F.greatest(F.abs(lat), F.abs(lon))).alias("peak_g"),
            F.first("_a0").alias("_a0"), F.first("_a1").alias("_a1"), F.first("_z0").alias("_z0"), F.first("_z1").alias("_z1"),
        )
        .select(
            *k, "i0", "run_len", "peak_g",
            F.greatest(
                F.coalesce(F.col("_z0") - F.col("_a0"), F.lit(0)), F.coalesce(F.col("_z1") - F.col("_a1"), F.lit(0))
            ).alias("sign_alternations"),
        )
    )
    events = runs.mark_runs(flagged.select(*k, i, label, "_bad"), k, label, i, block=block).filter(
        F.col(label) != rules.NORMAL
    )
    touched = (
        events.groupBy(*k, "run_i0", label).agg(F.max(F.col("_bad").cast("int")).alias("_hit"))
        .groupBy(*k)
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("_hit").alias("n_events_affected"))
    )
    per_session = (
        flagged.groupBy(*k)
        .agg(F.count(F.when(F.col("_bad"), 1)).alias("n_flagged"), F.max(F.abs(lat)).alias("max_abs_lat"), F.max(F.abs(lon)).alias("max_abs_lon"))
        .join(
            bad_runs.groupBy(*k).agg(F.count(F.lit(1)).alias("n_runs"), F.count(F.when(F.col("run_len") <= brief, 1)).alias("n_brief_runs")),
            list(k), "left",
        )
        .join(touched, list(k), "left")
        .fillna(0, ["n_runs", "n_brief_runs", "n_events", "n_events_affected"])
    )
    return per_session, bad_runs


def longest_run_in_event(
    df: DataFrame, k: Sequence[str], label: str, m: str, normal: str = rules.NORMAL, i="i", block=blocks.BLOCK_ROWS
) -> DataFrame:
    """Longest stretch of true `m` inside each event (E5).

    The stretches are runs of (event, mask) as one value, so they end where the event ends.
    """
    marked = runs.mark_runs(df.select(*k, i, label, m), k, label, i, block=block).withColumnRenamed("run_i0", "i0").drop("run_i1")
    inner = marked.withColumn("_v", F.struct("i0", runs.true_(m).alias("m")))
    nested = runs.mark_runs(inner, k, "_v", i, block=block)
    length = F.when(F.col("_v.m"), F.col("run_i1") - F.col("run_i0") + 1).otherwise(0)
    return (
        nested.filter(F.col(label) != normal)
        .groupBy(*k, "i0", label)
        .agg(F.count(F.lit(1)).alias("n_samples"), F.max(length).alias("longest_run"))
    )


def modality_completeness(
    events: DataFrame, samples: DataFrame, ok: Column, frames: dict[str, tuple[DataFrame, Column]], k, t: str, width: float
) -> DataFrame:
    """Per event: share of samples with valid physiology, and whether any valid frame of each
    feature table falls inside [start_t, end_t] (E6)."""
    base = events.select(*k, "i0", "label", "start_t", "end_t")
    inside = intervals.point_in_interval(samples.select(*k, t, ok.alias("_ok")), base, k, t, "start_t", "end_t", width)
    share = inside.groupBy(*k, "i0").agg(F.avg(F.col("_ok").cast("double")).alias("phys_valid_frac"))
    out = base.join(share, [*k, "i0"], "left")
    for name, (table, valid) in frames.items():
        hits = intervals.point_in_interval(
            table.select(*k, t, valid.alias("_v")), base, k, t, "start_t", "end_t", width
        ).groupBy(*k, "i0").agg(F.max(F.col("_v").cast("int")).alias("_any"))
        out = out.join(hits, [*k, "i0"], "left").withColumn(f"{name}_any_valid", F.coalesce(F.col("_any") == 1, F.lit(False))).drop("_any")
    return out.withColumn("phys_majority_valid", F.coalesce(F.col("phys_valid_frac") >= 0.5, F.lit(False)))


def completeness_by_class(events: DataFrame, modalities: Sequence[str]) -> DataFrame:
    """Share of complete events per class and over all classes."""
    flags = [F.col("phys_majority_valid"), *[F.col(f"{m}_any_valid") for m in modalities]]
    everything = reduce(lambda a, b: a & b, flags)
    pct = [(F.avg(f.cast("double")) * 100).alias(n) for f, n in zip(flags, ["phys_pct", *[f"{m}_pct" for m in modalities]])]
    return events.rollup("label").agg(F.count(F.lit(1)).alias("n_events"), *pct, (F.avg(everything.cast("double")) * 100).alias("all_pct"))


def class_stats(samples: DataFrame, events: DataFrame, label: str, duration: Column) -> DataFrame:
    """Per class: samples and their share, events, median and quartiles of duration."""
    rows = samples.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = rows.agg(F.sum("n_rows").alias("_all"))
    timed = events.withColumn("_d", duration)
    counted = timed.groupBy(label).agg(F.count(F.lit(1)).alias("n_events"))
    spread = stats.quantiles(timed, [label], "_d", [0.25, 0.5, 0.75], ["q1_s", "median_s", "q3_s"])
    return (
        rows.crossJoin(F.broadcast(total))
        .select(label, "n_rows", (F.col("n_rows") * 100.0 / F.col("_all")).alias("pct_rows"))
        .join(counted, label, "left")
        .join(spread, label, "left")
        .fillna(0, ["n_events"])
    )


def events_per_group(events: DataFrame, sessions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Median and range of events per group, and groups without any."""
    counts = events.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    filled = sessions.select(*by).distinct().join(counts, list(by), "left").fillna(0, ["n"])
    middle = stats.medians(filled, [], "n", "median_events")
    return filled.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min("n").alias("fewest"),
        F.max("n").alias("most"),
        F.count(F.when(F.col("n") == 0, 1)).alias("n_without_events"),
    ).crossJoin(F.broadcast(middle))


def label_distribution(df: DataFrame, by: Sequence[str], label: str, fs: float = 25.0) -> DataFrame:
    """Rows, seconds and share per label, and whether it is the group's most frequent one."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy(*by).agg(
        F.sum("n").alias("_all"), F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("_top")
    )
    return stats.attach(counts, whole, by).select(
        *by, label, "n", (F.col("n") / fs).alias("duration_s"),
        (F.col("n") * 100.0 / F.col("_all")).alias("pct"), (F.col(label) == F.col("_top")).alias("dominant"),
    )


def windows_with_all(
    events: DataFrame, k: Sequence[str], duration: float, classes: Sequence[str], centre_class: str, width: float
) -> DataFrame:
    """Windows around each `centre_class` event that hold whole events of every class.

    A window starts half its length before the event, not before 0.
    """
    base = events.filter(F.col("label") == centre_class).select(
        *k, F.col("i0").alias("c_i0"), F.greatest(F.col("start_t") - duration / 2, F.lit(0.0)).alias("w0")
    ).withColumn("w1", F.col("w0") + duration)
    inside = intervals.point_in_interval(
        events.select(*k, "label", "start_t", "end_t"), base, k, "start_t", "w0", "w1", width
    ).filter(F.col("end_t") <= F.col("w1"))
    flags = [F.max((F.col("label") == c).cast("int")).alias(f"_{n}") for n, c in enumerate(classes)]
    held = inside.groupBy(*k, "c_i0", "w0").agg(F.count(F.lit(1)).alias("n_events"), *flags)
    everything = reduce(lambda a, b: a & b, [F.col(f"_{n}") == 1 for n in range(len(classes))])
    return held.filter(everything).select(*k, "c_i0", "w0", "n_events")


def native_candidates(df: DataFrame, k: Sequence[str], v: str, present: str, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Samples at the ends of present stretches, and kinks of the interpolated value inside.

    A kink is a second difference above 1e-7 of the stretch's largest value (at least 1).
    """
    marked = runs.mark_runs(df.withColumn(present, runs.true_(present)), k, present, i, block=block).filter(present)
    stretch = marked.groupBy(*k, "run_i0").agg(F.max(F.abs(v)).alias("_peak"))
    scaled = marked.join(stretch, [*k, "run_i0"])

    def bend(w):
        # neighbours one row away in the index belong to the same stretch unless at its ends
        return [{"_bend": F.abs(F.lead(v).over(w) - F.col(v) * 2 + F.lag(v).over(w))}]

    bent = blocks.over_blocks(scaled, k, 1, 1, bend, i, block)
    edge = F.col(i).isin(F.col("run_i0"), F.col("run_i1"))
    # fixed value: a second difference below this part of the peak is rounding
    kink = F.col("_bend") > 1e-7 * F.greatest(F.lit(1.0), F.col("_peak"))
    return bent.filter(edge | kink).drop("_bend", "_peak", "run_i0", "run_i1")


def recover_events(df, k, t: str, v: str, present: str, width: float, min_sep: float = 0.2, i="i", block=blocks.BLOCK_ROWS):
    """Native events behind an interpolated column: candidates at least `min_sep` apart."""
    return greedy_spacing(native_candidates(df, k, v, present, i, block), k, t, min_sep, width)


#: Neighbouring summaries that are composed in one call.
FAN = 64


def greedy_spacing(df: DataFrame, k: Sequence[str], t: str, sep: float, width: float, strict: bool = True) -> DataFrame:
    """Rows kept when each must come more than `sep` after the last kept one.

    Greedy choice is sequential, but a time chunk only needs the last time kept before it. A
    chunk is a step function from the last time kept before it to the last one kept after it.
    Such functions compose, so they are reduced in a tree, `FAN` neighbours a call, and what
    enters each chunk comes back down the tree: the rounds are a logarithm of the chunks of the
    longest series. The chunks are then filtered in parallel. `strict` false keeps rows exactly
    `sep` apart too.
    """
    k = list(k)
    chunked = settle(df.filter(F.col(t).isNotNull()).withColumn("_c", blocks.chunk_of(t, max(width, sep))))
    side = "right" if strict else "left"
    keys = [df.schema[c] for c in k]
    node = StructType([*keys, StructField("_c", LongType()), StructField("origin", DoubleType()), *(StructField(c, ArrayType(DoubleType())) for c in ("first", "leave"))])
    placed = StructType([*keys, StructField("_c", LongType()), StructField("entry", DoubleType())])

    def reduced(first: np.ndarray, leave: np.ndarray, origin: float) -> tuple[np.ndarray, np.ndarray]:
        """The step function's steps: entries come before `origin`, so times beyond the first one later than origin + sep don't matter."""
        stop = np.searchsorted(first, origin + sep, side) + 1
        first, leave = first[:stop], leave[:stop]
        last = np.append(leave[1:] != leave[:-1], True)
        return first[last], leave[last]

    def after(first: np.ndarray, leave: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """The last time kept, for each entry."""
        at = np.searchsorted(first, entry + sep, side)
        return np.where(at < len(first), leave[np.minimum(at, len(first) - 1)], entry)

    def jumps(times: np.ndarray) -> np.ndarray:
        """The place of the next time kept, if this one is."""
        return np.maximum(np.searchsorted(times, times + sep, side), np.arange(1, len(times) + 1))

    def nodes(heads: pa.Table, origin: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
        first, leave = (groups.lists([s[n] for s in steps]) for n in (0, 1))
        return heads.append_column("origin", pa.array(origin)).append_column("first", first).append_column("leave", leave)

    def summarise(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        every, steps = rows[t].to_numpy(), []
        for a, b in zip(starts[:-1], starts[1:]):
            times = every[a:b]
            jump = jumps(times)
            jump = np.where(jump < len(times), jump, np.arange(len(times)))
            while not np.array_equal(further := jump[jump], jump):
                jump = further
            steps.append(reduced(times, times[jump], times[0]))
        return nodes(rows.select([*k, "_c"]).take(starts[:-1]), every[starts[:-1]], steps)

    def compose(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        firsts, leaves, origin, steps = groups.rows_of(rows["first"]), groups.rows_of(rows["leave"]), rows["origin"].to_numpy(), []
        for a, b in zip(starts[:-1], starts[1:]):
            first, leave = firsts[a], leaves[a]
            for f, v in zip(firsts[a + 1 : b], leaves[a + 1 : b]):
                first, leave = reduced(np.append(first, f), np.append(after(f, v, leave), v), origin[a])
            steps.append((first, leave))
        heads = rows.select([*k, "_up"]).rename_columns([*k, "_c"]).take(starts[:-1])
        return nodes(heads, origin[starts[:-1]], steps)

    def spread(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        firsts, leaves, entry = groups.rows_of(rows["first"]), groups.rows_of(rows["leave"]), rows["entry"].to_numpy().copy()
        for a, b in zip(starts[:-1], starts[1:]):
            for n in range(a, b - 1):
                entry[n + 1] = after(firsts[n], leaves[n], entry[n])
        return rows.select([*k, "_c"]).append_column("entry", pa.array(entry))

    def choose(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        every, entry = rows["_t"].to_numpy(), rows["_entry"].to_numpy()
        keep = np.zeros(len(every), bool)
        for a, b in zip(starts[:-1], starts[1:]):
            times = every[a:b]
            jump, at, kept = jumps(times).tolist(), int(np.searchsorted(times, entry[a] + sep, side)), []
            while at < len(jump):
                kept.append(at)
                at = jump[at]
            keep[a + np.array(kept, int)] = True
        return rows.filter(pa.array(keep))

    start = chunked.groupBy(*k).agg(F.min("_c").alias("_c0"))
    summary = groups.over_groups(chunked.select(*k, "_c", F.col(t).cast("double").alias(t)), [*k, "_c"], [t], summarise, node)
    levels = [settle(stats.attach(summary, start, k).withColumn("_c", F.col("_c") - F.col("_c0")).drop("_c0"))]
    left = levels[0].agg(F.max("_c")).first()[0] or 0
    while left:
        left //= FAN
        levels.append(settle(groups.over_groups(levels[-1].withColumn("_up", F.floor(F.col("_c") / FAN)), [*k, "_up"], ["_c"], compose, node)))
    entries = levels.pop().select(*k, "_c", F.lit(float("-inf")).alias("entry"))
    while levels:
        below = levels.pop().withColumn("_up", F.floor(F.col("_c") / FAN))
        entered = below.join(entries.withColumnRenamed("_c", "_up"), [*k, "_up"])
        entries = groups.over_groups(entered, [*k, "_up"], ["_c"], spread, placed)
    entries = stats.attach(entries, start, k).select(*k, (F.col("_c") + F.col("_c0")).alias("_c"), F.col("entry").alias("_entry"))
    inside = chunked.join(entries, [*k, "_c"]).withColumn("_t", F.col(t).cast("double"))
    return groups.over_groups(inside, [*k, "_c"], ["_t"], choose, df.schema)


def response_window(
    events: DataFrame, series: DataFrame, k: Sequence[str], t: str, v: str, rise: str, event_id: str, width: float,
    pre: float = 3.0, post: float = 2.0, control: float = 30.0, least: int = 5,
) -> DataFrame:
    """Rise of a signal after each event, and at a control time before it.

    rise = max over [t, t + rise + post] - min over [t - pre, t]; at least `least` samples in each.
    The event and its control are two intervals joined to the samples in one pass.
    """
    points = series.select(*k, F.col(t).alias("_st"), F.col(v).alias("_sv"))
    moments = events.select(
        *k, event_id, rise,
        F.inline(F.array(F.struct(F.lit("event").alias("_kind"), F.col(t).alias("_at")), F.struct(F.lit("control").alias("_kind"), (F.col(t) - control).alias("_at")))),
    ).withColumns({"_w0": F.col("_at") - pre, "_w1": F.col("_at") + F.col(rise) + post})
    inside = intervals.point_in_interval(points, moments, k, "_st", "_w0", "_w1", width)
    before, after = F.col("_st") <= F.col("_at"), F.col("_st") >= F.col("_at")
    found = inside.groupBy(*k, event_id, "_kind").agg(
        F.count(F.when(before, 1)).alias("_n0"),
        F.count(F.when(after, 1)).alias("_n1"),
        (F.max(F.when(after, F.col("_sv"))) - F.min(F.when(before, F.col("_sv")))).alias("_rise"),
    )
    enough = F.when((F.col("_n0") >= least) & (F.col("_n1") >= least), F.col("_rise"))
    wide = found.groupBy(*k, event_id).agg(
        F.max(F.when(F.col("_kind") == "event", enough)).alias("response"),
        F.max(F.when(F.col("_kind") == "control", enough)).alias("control_response"),
    )
    return events.join(wide, [*k, event_id], "left")


def native_event_table(
    amplitude: DataFrame, rise: DataFrame, series: DataFrame, windows: DataFrame, k: Sequence[str], t: str, v: str,
    width: float, tol: float = 0.01, control: float = 30.0,
) -> DataFrame:
    """Native response events: amplitude with the rise time nearest within `tol`, inside the
    session window, and the signal's rise over that time at the event and at a control (E12).

    amplitude: k, t, amplitude; rise: k, t, rise_time; series: k, t, v. The four lookups of the
    series at or after a time (clamped to the last) are one as-of pass over stacked probes.
    """
    matched = asof.asof_nearest(amplitude, rise, k, t, width, tol, "")
    inside = matched.join(windows.select(*k, "w_start", "w_end"), list(k)).filter(F.col(t).between(F.col("w_start"), F.col("w_end")))
    at = {"_v0": F.col(t), "_v1": F.col(t) + F.col("rise_time"), "_c0": F.col(t) - control, "_c1": F.col(t) - control + F.col("rise_time")}
    probes = inside.select(
        *k, F.col(t).alias("_event_t"), F.inline(F.array(*[F.struct(F.lit(n).alias("_probe"), e.alias(t)) for n, e in at.items()]))
    ).filter(F.col(t).isNotNull())
    points = series.select(*k, t, F.col(v).alias("_x"))
    last = points.groupBy(*k).agg(F.max_by("_x", t).alias("_end"))
    found = asof.asof_next(probes, points, k, t, width, "").join(last, list(k)).withColumn("_x", F.coalesce("_x", "_end"))
    values = found.groupBy(*k, "_event_t").agg(*[F.max(F.when(F.col("_probe") == n, F.col("_x"))).alias(n) for n in at])
    return (
        inside.join(values.withColumnRenamed("_event_t", t), [*k, t], "left")
        .withColumns(
            {
                "elapsed_s": F.col(t) - F.col("w_start"),
                "signal_rise": F.col("_v1") - F.col("_v0"),
                "control_rise": F.when(F.col(t) - control > F.col("w_start"), F.col("_c1") - F.col("_c0")),
            }
        )
        .drop("_v0", "_v1", "_c0", "_c1", "w_start", "w_end")
    )


def beat_consistency(beats: DataFrame, k: Sequence[str], t: str, ibi_ms: str, i="i", tol_s: float = 0.05, block=blocks.BLOCK_ROWS) -> DataFrame:
    """Share of beats whose interval in time agrees with the reported one."""
    framed = blocks.over_blocks(beats, k, 1, 0, lambda w: [{"_dt": F.col(t) - F.lag(t).over(w)}], i, block)
    close = F.abs(F.col("_dt") - F.col(ibi_ms) / 1000.0) < tol_s
    return framed.groupBy(*k).agg(F.avg(F.when(F.col("_dt").isNotNull(), close.cast("double"))).alias("per_beat_frac"))


def stop_instants(
    df: DataFrame, k: Sequence[str], t: str, speed: str, lead_n: int, width: float, still_n: int = 75, still: float = 1.0,
    moving: float = 30.0, min_sep: float = 60.0, tail: float = 0.0, i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Instants of standing still that follow, a lead-in earlier, fast driving (E13): the vehicle
    stands for `still_n` samples on both sides, instants are at least `min_sep` apart, and the
    session goes on for more than `tail` after each."""

    def layers(w):
        frame = w.rowsBetween(-still_n, still_n - 1)
        return [
            {
                "_top": F.max(speed).over(frame),
                "_whole": F.count(F.lit(1)).over(frame) == 2 * still_n,
                "_early": F.lag(speed, lead_n).over(w),
            }
        ]

    reach = max(still_n, lead_n)
    framed = blocks.over_blocks(df, k, reach, still_n, layers, i, block)
    ends = df.groupBy(*k).agg(F.max(t).alias("_end"))
    framed = stats.attach(framed, ends, k).filter(F.col(t) + tail < F.col("_end"))
    stopped = framed.filter(F.col("_whole") & (F.col("_top") < still) & (F.col("_early") > moving) & (F.col(i) >= lead_n + still_n))
    return greedy_spacing(stopped.select(*df.columns), k, t, min_sep, width, strict=False)


def stop_verdict(at: Column, later: Column, control: Column) -> Column:
    """Whether the scene stands still at the stop instant, from change ratios."""
    base = F.greatest(control, F.lit(1e-6))
    now, then = at / base, later / base
    # fixed values: below 0.35 of the control the scene stands, above 0.5 it moves
    return (
        F.when((now < 0.35) & (then > 0.5), "aligned, moving after the lead")
        .when(now < 0.35, "aligned")
        .when((now > 0.5) & (then < 0.35), "offset")
        .otherwise("inconclusive")
    )


def attempted_turns(df: DataFrame, k: Sequence[str], lateral: str, speed: str, label: str, least_g: float = 0.20, moving: float = 30.0) -> DataFrame:
    """Per drive the largest smoothed lateral acceleration of `least_g` or more, at speed, outside labelled turns; 0 where there is none."""
    outside = (F.col(lateral) >= least_g) & (F.col(speed) > moving) & (F.col(label) != rules.TURN)
    return df.groupBy(*k).agg(F.coalesce(F.max(F.when(outside, F.col(lateral))), F.lit(0.0)).alias("max_lateral_outside_turns_g"))


def manoeuvre_table(df: DataFrame, k: Sequence[str], p: rules.Rule = rules.ADOPTED, substitutions: dict[str, Column] | None = None, i="i", t="t") -> DataFrame:
    """Events of a calibration drive: channels it lacks are substituted, then labelled and
    described (E9)."""
    ready = df.withColumns(substitutions or {})
    labelled = rules.label_v2(ready, k, p, i)
    return diagnose_events(labelled, k, "label", p, i, t).select(
        *k, "i0", "i1", "label", "start_s", "end_s", "duration_s", "peak_smoothed_g", "mean_speed_kmh"
    )
