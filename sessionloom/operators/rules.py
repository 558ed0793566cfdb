"""Rule-based labelling of driving manoeuvres.

A rule is a chain of bounded frames (smoothing, rolling extrema, mask cleaning), so a whole
rule, or many variants of it, runs in one pass over blocks of a session. Only the heading gate
needs the bounds of whole runs.

Samples carry a dense index `i` and the columns gps_speed_kmh, speed_kph, throttle_pct,
lat_acc_g, lon_acc_g and, for the gate, heading_deg.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip, resolve_priority, wrapped_diff
from ..session import settle
from . import blocks, frames, runs, stats

# Class names and gravity.
NORMAL = "Normal"
ACCEL = "Harsh Acceleration"
BRAKE = "Harsh Braking"
TURN = "Harsh Turning"
CLASSES = (ACCEL, BRAKE, TURN)
G_MS2 = 9.81


@dataclass(frozen=True)
class Rule:
    """Parameters of the smoothed rule; lengths in samples, accelerations in g."""

    # fixed values: the adopted rule's
    smooth_n: int = 13
    median_n: int = 5
    close_n: int = 5
    min_n: int = 13
    rectify_first: bool = False
    brake_g: float = 0.35
    accel_g: float = 0.20
    turn_g: float = 0.45
    min_speed: float = 15.0
    min_turn_speed: float = 30.0
    min_throttle: float = 25.0
    max_can_ms2: float = -0.3
    can_n: int = 25
    min_heading_deg: float = 5.0
    heading_margin: int = 3
    fs: float = 25.0

    def scaled(self, factor: float) -> "Rule":
        return replace(
            self, brake_g=self.brake_g * factor, accel_g=self.accel_g * factor, turn_g=self.turn_g * factor
        )

    @property
    def reach(self) -> int:
        return self.median_n + self.smooth_n + self.can_n + self.close_n + self.min_n + self.heading_margin + 2


ADOPTED = Rule()

# The seven published formulations.
VARIANTS = {
    "V0": Rule(12, 0, 5, 12, True, min_heading_deg=0.0),
    "V1": Rule(13, 0, 5, 13, True, min_heading_deg=0.0),
    "V2": Rule(13, 0, 5, 13, False, min_heading_deg=0.0),
    "V3": Rule(13, 0, 5, 15, False, min_heading_deg=0.0),
    "V4": Rule(13, 5, 5, 13, False, min_heading_deg=0.0),
    "V5": Rule(13, 5, 5, 15, False, min_heading_deg=0.0),
    "V6": ADOPTED,
}


def _merge(*chains: Sequence[Mapping[str, Column]]) -> list[dict[str, Column]]:
    """Zip chains of layers, so that independent columns share a step."""
    return [reduce(lambda a, b: a | b, step) for step in zip_longest(*chains, fillvalue={})]


def _smoothed(w, p: Rule, tag: str) -> list[dict[str, Column]]:
    """Smoothed longitudinal and (absolute) lateral acceleration."""
    lon, lat = f"_lon_{tag}", f"_lat_{tag}"
    med_lon = frames.rolling(w, "lon_acc_g", p.median_n, "median", f"{lon}_m", True)
    med_lat = frames.rolling(w, "lat_acc_g", p.median_n, "median", f"{lat}_m", True)
    flat = F.abs(f"{lat}_m") if p.rectify_first else F.col(f"{lat}_m")
    mean = [
        {
            lon: frames.rolling(w, f"{lon}_m", p.smooth_n, "avg", lon, True)[0][lon],
            lat: F.abs(frames.rolling(w, flat, p.smooth_n, "avg", lat, True)[0][lat]),
        }
    ]
    return _merge(med_lon, med_lat) + mean


def mask_layers(w, p: Rule, tag: str, smoothed: bool = False) -> list[dict[str, Column]]:
    """Cleaned masks `brake_<tag>`, `accel_<tag>`, `turn_<tag>` before gate and priority.

    With `smoothed`, the columns _lon_<tag> and _lat_<tag> are taken as given.
    """
    can, throttle = f"_can_{tag}", f"_thr_{tag}"
    support = [
        {can: (F.col("speed_kph") - F.lag("speed_kph").over(w)) / 3.6 * p.fs},
        {
            can: F.min(can).over(w.rowsBetween(-(p.can_n - 1), 0)),
            throttle: frames.rolling(w, "throttle_pct", p.smooth_n, "max", throttle, True)[0][throttle],
        },
    ]
    lon, lat, speed = F.col(f"_lon_{tag}"), F.col(f"_lat_{tag}"), F.col("gps_speed_kmh")
    raw = {
        "brake": (lon <= -p.brake_g) & (speed > p.min_speed) & (F.col(can) <= p.max_can_ms2),
        "accel": (lon >= p.accel_g) & (speed > p.min_speed) & (F.col(throttle) > p.min_throttle),
        "turn": (lat >= p.turn_g) & (speed > p.min_turn_speed),
    }
    cleaned = [runs.close_then_keep(w, m, p.close_n, p.min_n, f"{n}_{tag}") for n, m in raw.items()]
    before = support if smoothed else _merge(_smoothed(w, p, tag), support)
    return before + _merge(*cleaned)


def heading_gate(
    df: DataFrame, k: Sequence[str], m: str, before: str, after: str, min_deg: float, i="i",
    block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Drop runs of `m` whose net heading change is finite and below `min_deg`.

    `before` / `after` hold, per row, the heading a margin earlier / later (`heading_ends`).
    """
    marked = runs.mark_runs(
        df, k, m, i, {"_h0": F.col(before)}, {"_h1": F.col(after)}, block
    )
    turned = F.abs(wrapped_diff("_h0", "_h1"))
    return marked.withColumn(m, F.col(m) & ~F.coalesce(turned < min_deg, F.lit(False))).drop(
        "_h0", "_h1", "run_i0", "run_i1"
    )


def heading_ends(w, heading: str, margin: int) -> dict[str, Column]:
    """Heading `margin` rows earlier and later, held at the ends of the series."""
    return {
        "_h_before": F.first(heading).over(w.rowsBetween(-margin, 0)),
        "_h_after": F.last(heading).over(w.rowsBetween(0, margin)),
    }


def label_variants(
    df: DataFrame,
    k: Sequence[str],
    rules: Mapping[str, Rule],
    i="i",
    block=blocks.BLOCK_ROWS,
    keep_masks: bool = False,
) -> DataFrame:
    """A column `label_<name>` per rule, all from one shuffle of the samples."""
    has_heading = "heading_deg" in df.columns
    reach = max(p.reach for p in rules.values())
    def layers(w):
        chain = _merge(*[mask_layers(w, p, n) for n, p in rules.items()])
        if has_heading:
            margins = max(p.heading_margin for p in rules.values())
            chain[-1] = chain[-1] | heading_ends(w, "heading_deg", margins)
        return chain

    out = blocks.over_blocks(df, k, reach, reach, layers, i, block)
    kept = [f"{m}_{n}" for n in rules for m in ("brake", "accel", "turn")]
    ends = ["_h_before", "_h_after"] if has_heading else []
    out = out.select(*df.columns, *kept, *ends)
    gated = [n for n, p in rules.items() if p.min_heading_deg > 0 and has_heading]
    if gated:
        # every gate reads the masks twice, once per level of its scan
        out = settle(out)
    for n, p in rules.items():
        if n in gated:
            out = heading_gate(out, k, f"turn_{n}", *ends, p.min_heading_deg, i, block)
    labels = {
        f"label_{n}": resolve_priority([(TURN, f"turn_{n}"), (BRAKE, f"brake_{n}"), (ACCEL, f"accel_{n}")], NORMAL)
        for n in rules
    }
    out = out.withColumns(labels).drop(*ends)
    return out if keep_masks else out.drop(*kept)


def label_v2(
    df: DataFrame, k: Sequence[str], p: Rule = ADOPTED, i="i", block=blocks.BLOCK_ROWS,
    smoother: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Column `label` by the smoothed rule.

    `smoother` may add `lon_smooth` and `lat_smooth` (signed) in place of median and mean.
    """
    if smoother is None:
        return label_variants(df, k, {"v": p}, i, block).withColumnRenamed("label_v", "label")
    given = smoother(df)
    kept = given.columns
    given = given.withColumns({"_lon_v": F.col("lon_smooth"), "_lat_v": F.abs("lat_smooth")})
    has_heading = "heading_deg" in kept and p.min_heading_deg > 0

    def layers(w):
        chain = mask_layers(w, p, "v", smoothed=True)
        if has_heading:
            chain[-1] = chain[-1] | heading_ends(w, "heading_deg", p.heading_margin)
        return chain

    out = blocks.over_blocks(given, k, p.reach, p.reach, layers, i, block)
    if has_heading:
        out = heading_gate(out, k, "turn_v", "_h_before", "_h_after", p.min_heading_deg, i, block)
    label = resolve_priority([(TURN, "turn_v"), (BRAKE, "brake_v"), (ACCEL, "accel_v")], NORMAL)
    return out.withColumn("label", label).select(*kept, "label")


def count_starts(df: DataFrame, k: Sequence[str], labels: Sequence[str], i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Events per class for several label columns at once: an event starts where the class
    differs from the row before, so counting needs no run table (D13, D14)."""

    def layer(w):
        return [
            {f"_s_{c}": (F.col(c) != NORMAL) & ~F.lag(c).over(w).eqNullSafe(F.col(c)) for c in labels}
        ]

    started = blocks.over_blocks(df.select(*k, i, *labels), k, 1, 0, layer, i, block)
    counts = started.agg(
        *[
            F.count(F.when(F.col(f"_s_{c}") & (F.col(c) == cls), 1)).alias(f"{c}:{cls}")
            for c in labels
            for cls in CLASSES
        ],
        *[F.count(F.when(F.col(c) != NORMAL, 1)).alias(f"{c}:rows") for c in labels],
    )
    packed = F.array(
        *[
            F.struct(
                F.lit(c.removeprefix("label_")).alias("variant"),
                *[F.col(f"`{c}:{cls}`").alias(n) for cls, n in zip(CLASSES, ("n_accel", "n_brake", "n_turn"))],
                F.col(f"`{c}:rows`").alias("nonnormal_rows"),
            )
            for c in labels
        ]
    )
    return counts.select(F.inline(packed)).withColumn(
        "total", F.col("n_accel") + F.col("n_brake") + F.col("n_turn")
    )


def variant_totals(df, k, rules: Mapping[str, Rule] = VARIANTS, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Event totals per rule variant."""
    labelled = label_variants(df, k, rules, i, block)
    return count_starts(labelled, k, [f"label_{n}" for n in rules], i, block)


def sensitivity(df, k, p: Rule = ADOPTED, scales: Mapping[str, float] | None = None, i="i", block=blocks.BLOCK_ROWS):
    """Event totals with all thresholds scaled."""
    scales = scales or {"minus10": 0.9, "primary": 1.0, "plus10": 1.1}
    return variant_totals(df, k, {n: p.scaled(f) for n, f in scales.items()}, i, block)


def label_sets(df, k, p: Rule, limit: float, i="i", block=blocks.BLOCK_ROWS) -> DataFrame:
    """Labels of the rule itself, of clipped accelerations, and at -10 % / +10 % thresholds.

    The clipped run reads its own copies of the two accelerations in the same pass.
    """
    base = label_variants(
        df, k, {"base": p, "minus10": p.scaled(0.9), "plus10": p.scaled(1.1)}, i, block
    )
    clipped = label_v2(
        base.select(
            *k, i, "gps_speed_kmh", "speed_kph", "throttle_pct",
            clip("lat_acc_g", limit).alias("lat_acc_g"), clip("lon_acc_g", limit).alias("lon_acc_g"),
            *(["heading_deg"] if "heading_deg" in df.columns else []),
        ),
        k, p, i, block,
    ).select(*k, i, F.col("label").alias("label_clip"))
    return base.join(clipped, [*k, i])


# The earlier rule: rolling peaks, closing, dilation.


@dataclass(frozen=True)
class PeakRule:
    """Parameters of the peak rule; the lengths follow from the sampling period `dt`."""

    # Published thresholds and durations.
    brake_g: float = -0.35
    accel_g: float = 0.38
    turn_g: float = 0.55
    min_throttle: float = 25.0
    min_speed: float = 15.0
    min_turn_speed: float = 30.0
    window_s: float = 1.0
    min_s: float = 0.40
    expand_s: float = 1.0
    max_speed_ms2: float = -0.3
    dt: float = 0.04

    def samples(self, seconds: float, least: int) -> int:
        return max(least, round(seconds / self.dt))


# Quantiles, caps and anchors of the adaptive thresholds.
ADAPTIVE = {
    "brake": {"q": 0.025, "lo": -0.60, "hi": -0.35, "anchor": -0.38},
    "accel": {"q": 0.975, "lo": 0.25, "hi": 0.55, "anchor": 0.40},
    "turn": {"q": 0.98, "lo": 0.30, "hi": 0.55, "anchor": 0.45},
}


def thresholds(df: DataFrame, k: Sequence[str], cfg: PeakRule, adaptive: bool = False) -> DataFrame:
    """Thresholds per session: fixed, or quantiles held within caps and then anchored."""
    sessions = df.select(*k).distinct()
    fixed = {"brake": cfg.brake_g, "accel": cfg.accel_g, "turn": cfg.turn_g}
    if not adaptive:
        return sessions.withColumns({f"thr_{n}_g": F.lit(v) for n, v in fixed.items()})
    # three selections read the two accelerations
    df = settle(df.select(*k, "lon_acc_g", "lat_acc_g"))
    sessions = df.select(*k).distinct()
    pos = df.filter(F.col("lon_acc_g") > 0)
    lon = stats.quantiles(
        df, k, "lon_acc_g", [ADAPTIVE["brake"]["q"], ADAPTIVE["accel"]["q"]], ["_brake", "_accel_all"]
    )
    up = stats.quantiles(pos, k, "lon_acc_g", [ADAPTIVE["accel"]["q"]], ["_accel"])
    lat = stats.quantiles(
        df.withColumn("_a", F.abs("lat_acc_g")), k, "_a", [ADAPTIVE["turn"]["q"]], ["_turn"]
    )
    joined = reduce(lambda a, b: a.join(b, list(k), "left"), [lon, up, lat], sessions)
    raw = {"brake": F.col("_brake"), "accel": F.coalesce("_accel", "_accel_all"), "turn": F.col("_turn")}
    held = {
        n: F.when(c.isNull(), F.lit(fixed[n])).otherwise(
            F.greatest(F.least(c, F.lit(ADAPTIVE[n]["hi"])), F.lit(ADAPTIVE[n]["lo"]))
        )
        for n, c in raw.items()
    }
    return joined.select(
        *k,
        F.greatest(held["brake"], F.lit(ADAPTIVE["brake"]["anchor"])).alias("thr_brake_g"),
        F.least(held["accel"], F.lit(ADAPTIVE["accel"]["anchor"])).alias("thr_accel_g"),
        F.least(held["turn"], F.lit(ADAPTIVE["turn"]["anchor"])).alias("thr_turn_g"),
    )


def braking_layers(
    w, name: str, n: int, min_speed: float, brake_g: Column, max_speed_ms2: float, dt: float | Column, gradient: bool = False
) -> list[dict[str, Column]]:
    """Braking mask: moving, slowing down and decelerating within the last `n` samples."""
    accel = F.col("lon_acc_g") * G_MS2
    if gradient:
        slope = F.atan(F.coalesce(F.col("gradient_pct"), F.lit(0.0)) / 100)
        accel = accel - F.sin(slope) * G_MS2
    trailing = w.rowsBetween(-(n - 1), 0)
    period = F.coalesce(F.nullif(F.col("sampleperiod_s"), F.lit(0.0)), dt if isinstance(dt, Column) else F.lit(dt))
    slow = (F.col("speed_kph") - F.lag("speed_kph").over(w)) * (1000.0 / 3600.0) / period
    return [
        {f"_{name}_dv": slow, f"_{name}_a": accel},
        {f"_{name}_dv": F.min(f"_{name}_dv").over(trailing), f"_{name}_a": F.min(f"_{name}_a").over(trailing)},
        {
            name: runs.true_(
                (F.col("speed_kph") > min_speed)
                & (F.col(f"_{name}_dv") <= max_speed_ms2)
                & (F.col(f"_{name}_a") <= brake_g * G_MS2)
            )
        },
    ]


def label_v1(
    df: DataFrame, k: Sequence[str], cfg: PeakRule = PeakRule(), adaptive: bool = False, i="i",
    block=blocks.BLOCK_ROWS, gradient: bool = False,
) -> DataFrame:
    """Column `label` by the peak rule (D9): close, drop short, dilate, drop short, priority.

    The speed gates read speed_kph. The weak braking path holds the same gates at a threshold
    0.05 g weaker (at most -0.15 g), so it contains the strong one. Lengths follow from `cfg.dt`
    for all sessions; `gradient` takes the road's slope (gradient_pct) out of the braking (D8).
    """
    lengths = cfg.samples(cfg.window_s, 1), cfg.samples(cfg.min_s, 1), cfg.samples(cfg.expand_s, 0)
    return _label_peaks(df, k, cfg, lengths, F.lit(cfg.dt), adaptive, i, block, gradient)


def label_v1_sessions(
    df: DataFrame, k: Sequence[str], cfg: PeakRule = PeakRule(), adaptive: bool = False, period: str = "sampleperiod_s", i="i",
    block=blocks.BLOCK_ROWS, gradient: bool = False,
) -> DataFrame:
    """The peak rule with each session's own sampling period (D9): its median, `cfg.dt` where it has none.

    Window lengths in samples are rounded, so sessions of one recorder share them; the sessions of one set of lengths
    are labelled in one pass with their own periods, and the passes are as many as there are different lengths.
    """
    dt = sample_period(df, k, period, cfg.dt)
    length = lambda seconds, least: F.greatest(F.lit(least), F.bround(F.lit(seconds) / F.col("dt"))).cast("int")
    own = settle(dt.select(*k, F.col("dt").alias("_dt"), F.struct(length(cfg.window_s, 1).alias("n"), length(cfg.min_s, 1).alias("least"), length(cfg.expand_s, 0).alias("wide")).alias("_lengths")))
    # a handful of rates
    kinds = [tuple(r["_lengths"]) for r in own.select("_lengths").distinct().collect()]
    if not kinds:
        return label_v1(df, k, cfg, adaptive, i, block, gradient)
    parts = []
    for n, least, wide in sorted(kinds):
        some = own.filter((F.col("_lengths.n") == n) & (F.col("_lengths.least") == least) & (F.col("_lengths.wide") == wide)).select(*k, "_dt")
        labelled = _label_peaks(df.join(some, list(k)), k, cfg, (n, least, wide), F.col("_dt"), adaptive, i, block, gradient)
        parts.append(labelled.drop("_dt"))
    return reduce(DataFrame.unionByName, parts)


def _label_peaks(df, k, cfg: PeakRule, lengths: tuple[int, int, int], dt: Column, adaptive: bool, i: str, block: int, gradient: bool) -> DataFrame:
    n, least, wide = lengths
    if "sampleperiod_s" not in df.columns:
        df = df.withColumn("sampleperiod_s", dt)
        given = [c for c in df.columns if c != "sampleperiod_s"]
    else:
        given = df.columns
    joined = df.join(thresholds(df, k, cfg, adaptive), list(k))
    weak = F.least(F.col("thr_brake_g") + 0.05, F.lit(-0.15))
    trailing_n = -(n - 1)

    def layers(w):
        trailing = w.rowsBetween(trailing_n, 0)
        brake = braking_layers(
            w, "_brake", n, cfg.min_speed, F.greatest(F.col("thr_brake_g"), weak), cfg.max_speed_ms2, dt, gradient
        )
        peaks = {
            "_lon_peak": F.max("lon_acc_g").over(trailing),
            "_lat_peak": F.max(F.abs("lat_acc_g")).over(trailing),
            "_thr_peak": F.max("throttle_pct").over(trailing),
        }
        raw = {
            "_accel": (F.col("speed_kph") > cfg.min_speed)
            & (F.col("_lon_peak") >= F.col("thr_accel_g"))
            & (F.col("_thr_peak") > cfg.min_throttle)
            & ~F.col("_brake"),
            "_turn": (F.col("speed_kph") > cfg.min_turn_speed) & (F.col("_lat_peak") >= F.col("thr_turn_g")),
        }
        chains = []
        for m, grow in (("_brake", round(wide * 0.5)), ("_accel", round(wide * 0.5)), ("_turn", wide)):
            chains.append(
                runs.closed(w, F.col(m), least, f"{m}1")
                + runs.keep_long(w, F.col(f"{m}1"), least, f"{m}2")
                + runs.dilated(w, F.col(f"{m}2"), grow, f"{m}3")
                + runs.keep_long(w, F.col(f"{m}3"), least, f"{m}4")
            )
        return [*brake, peaks, raw, *_merge(*chains)]

    reach = n + 1 + 4 * least + wide
    out = blocks.over_blocks(joined, k, reach, reach, layers, i, block)
    label = resolve_priority([(TURN, "_turn4"), (BRAKE, "_brake4"), (ACCEL, "_accel4")], NORMAL)
    return out.withColumn("label", label).select(*given, "label", "thr_brake_g", "thr_accel_g", "thr_turn_g")


def sample_period(df: DataFrame, k: Sequence[str], c: str, default: float = 0.04) -> DataFrame:
    """Median sampling period per session, `default` where it is missing or not positive."""
    found = df.select(*k).distinct().join(stats.medians(df, k, c, "_dt"), list(k), "left")
    return found.select(*k, F.when(F.col("_dt") > 0, F.col("_dt")).otherwise(F.lit(default)).alias("dt"))


def mask_suspect_fix(
    df: DataFrame, k: Sequence[str], heading: str, speed: str, columns: Sequence[str], satellites: str, solution: str,
    min_sats: int = 6, max_dpsi: float = 10.0, max_dv: float = 3.0, i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Null the given columns where the position fix is suspect."""

    def layer(w):
        jump = F.abs(wrapped_diff(F.lag(heading).over(w), heading)) > max_dpsi
        surge = F.abs(F.col(speed) - F.lag(speed).over(w)) > max_dv
        poor = (F.col(solution) == 0) | (F.col(satellites) < min_sats)
        bad = runs.true_(poor) | runs.true_(jump) | runs.true_(surge)
        return [{"suspect": bad}]

    marked = blocks.over_blocks(df, k, 1, 0, layer, i, block)
    return marked.withColumns({c: F.when(~F.col("suspect"), F.col(c)) for c in columns})


def priority_overlap(df: DataFrame, names: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Rows where pairs of masks coincide before priority, and the share of the lower one."""
    aggs = []
    for a, b in names:
        both = F.count(F.when(F.col(a) & F.col(b), 1))
        aggs += [
            both.alias(f"{a}_and_{b}"),
            F.try_divide(both * 100.0, F.count(F.when(F.col(b), 1))).alias(f"{b}_share_taken_pct"),
        ]
    return df.groupBy(*by).agg(*aggs)


def relabel(df: DataFrame, labelled: DataFrame, k: Sequence[str], keep_as: str, i="i") -> DataFrame:
    """Put a recomputed label in place and keep the previous one under another name."""
    new = labelled.select(*k, i, F.col("label").alias("_new"))
    return df.withColumnRenamed("label", keep_as).join(new, [*k, i]).withColumnRenamed("_new", "label")


def label_delta(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rows per pair of old and new label."""
    return df.groupBy(F.col(old).alias("before"), F.col(new).alias("after")).agg(F.count(F.lit(1)).alias("n_rows"))


# Smoothing, minimum run, and acceleration / braking / turning thresholds.
CANDIDATES = {
    "A": (13, 13, 0.38, 0.35, 0.55),
    "B": (13, 13, 0.30, 0.30, 0.40),
    "C": (25, 13, 0.25, 0.25, 0.35),
}


def candidate_rules(
    df: DataFrame, k: Sequence[str], configs: Mapping[str, tuple] = CANDIDATES, p: Rule = ADOPTED,
    confirm_ms2: float = -0.2 * G_MS2, look_back: int = 13, i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Event counts of candidate definitions, and braking runs confirmed by the vehicle speed:
    its gradient, averaged over a second, falls to `confirm_ms2` in the run or just before (D17).
    """
    second = round(p.fs)

    def layers(w):
        vehicle = F.col("speed_kph") / 3.6
        prev, nxt = F.lag("speed_kph").over(w) / 3.6, F.lead("speed_kph").over(w) / 3.6
        step = F.when(prev.isNull(), nxt - vehicle).when(nxt.isNull(), vehicle - prev).otherwise((nxt - prev) / 2)
        before, after = frames.reach(second)
        around = w.rowsBetween(-before, after)
        chains = []
        for n, (smooth, least, accel, brake, turn) in configs.items():
            made = {
                f"_lon_{n}": frames.rolling(w, "lon_acc_g", smooth, "avg", "x", True)[0]["x"],
                f"_lat_{n}": frames.rolling(w, F.abs("lat_acc_g"), smooth, "avg", "x", True)[0]["x"],
                f"_thr_{n}": frames.rolling(w, "throttle_pct", smooth, "max", "x", True)[0]["x"],
            }
            speed = F.col("gps_speed_kmh")
            raw = {
                "brake": (F.col(f"_lon_{n}") <= -brake) & (speed > p.min_speed),
                "accel": (F.col(f"_lon_{n}") >= accel) & (speed > p.min_speed) & (F.col(f"_thr_{n}") > p.min_throttle),
                "turn": (F.col(f"_lat_{n}") >= turn) & (speed > p.min_turn_speed),
            }
            chains.append([made] + _merge(*[runs.keep_long(w, m, least, f"{c}_{n}") for c, m in raw.items()]))
        confirm = [
            {"_slope": step * p.fs},
            {"_mean": F.when(F.count("_slope").over(around) >= 5, F.avg("_slope").over(around))},
            {"_near": F.min("_mean").over(w.rowsBetween(-look_back, 0))},
        ]
        starts = {
            f"_s_{c}_{n}": F.col(f"{c}_{n}") & ~F.coalesce(F.lag(f"{c}_{n}").over(w), F.lit(False))
            for n in configs
            for c in ("brake", "accel", "turn")
        }
        return [*_merge(confirm, *chains), starts]

    reach = max(c[0] + c[1] for c in configs.values()) + look_back + second + 2
    base = blocks.over_blocks(df, k, reach, reach, layers, i, block)
    counts = base.agg(
        *[F.count(F.when(F.col(f"_s_{c}_{n}"), 1)).alias(f"{n}:{c}") for n in configs for c in ("accel", "brake", "turn")]
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("config"), *[F.col(f"`{n}:{c}`").alias(f"n_{c}") for c in ("accel", "brake", "turn")])
                    for n in configs
                ]
            )
        )
    )
    confirmed = []
    for n in configs:
        marked = runs.mark_runs(base.select(*k, i, "_near", "_mean", f"brake_{n}"), k, f"brake_{n}", i, block=block)
        # the first row's look-back reaches before the run; the other rows add the run itself
        lowest = F.least(F.min("_mean"), F.min_by("_near", i))
        confirmed.append(
            marked.filter(f"brake_{n}").groupBy(*k, "run_i0").agg(lowest.alias("_low"))
            .agg(F.count(F.when(F.col("_low") <= confirm_ms2, 1)).alias("n_brake_confirmed"))
            .withColumn("config", F.lit(n))
        )
    return counts.join(reduce(DataFrame.unionByName, confirmed), "config")


def treatment_effect(
    df: DataFrame, k: Sequence[str], treatments: Mapping[str, Callable[[DataFrame], DataFrame]],
    labeller: Callable[[DataFrame], DataFrame], i="i", block=blocks.BLOCK_ROWS,
) -> DataFrame:
    """Effect of treating the source channels before labelling (D16): events per class before and
    after, lost and new ones, and the share of rows whose label changed.

    An event is lost when none of its samples keeps its class, so both directions are one
    aggregation over the runs of the two label columns.
    """
    base = labeller(df).select(*k, i, F.col("label").alias("_base"))
    reports = []
    for name, treat in treatments.items():
        other = labeller(treat(df)).select(*k, i, F.col("label").alias("_new"))
        both = base.join(other, [*k, i])
        sides = []
        for mine, yours, kind in (("_base", "_new", "lost"), ("_new", "_base", "new")):
            marked = runs.mark_runs(both, k, mine, i, block=block).filter(F.col(mine) != NORMAL)
            per_run = marked.groupBy(*k, "run_i0", F.col(mine).alias("cls")).agg(
                F.max((F.col(yours) == F.col(mine)).cast("int")).alias("_kept")
            )
            sides.append(
                per_run.groupBy("cls").agg(
                    F.count(F.lit(1)).alias(f"n_{'before' if kind == 'lost' else 'after'}"),
                    F.count(F.when(F.col("_kept") == 0, 1)).alias(f"n_{kind}"),
                )
            )
        changed = both.agg((F.avg((F.col("_base") != F.col("_new")).cast("double")) * 100).alias("changed_rows_pct"))
        reports.append(
            sides[0].join(sides[1], "cls", "full_outer").crossJoin(F.broadcast(changed)).withColumn("treatment", F.lit(name))
        )
    return reduce(DataFrame.unionByName, reports).fillna(0, ["n_before", "n_lost", "n_after", "n_new"])
