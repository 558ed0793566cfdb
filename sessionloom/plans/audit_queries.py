"""Queries on clocks, trimming, quality checks and release audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, clock, events as E, quality, trim
from ..sources import device, sessions, sinks
from .registry import EV, SER, events, query, series, table, width
from .series_queries import K, r6, streams
from .stat_queries import placed, rounded, GEO

W = "(PARTITION BY user_id ORDER BY i"

# Pings: every event is one. The device clock runs with the event time, the reference adds a
# jitter of up to 0.6 s and, for every ninth event, an outlier; the value is the round trip.

PING = SER + """, pg AS (SELECT user_id, i, (t - 1704067200) * 1000 AS device_ms, t + (event_id % 7) / 10.0::DOUBLE + CASE WHEN event_id % 9 = 0 THEN 40.0 ELSE 0.0 END - value / 2000.0::DOUBLE AS sent_s, value AS rtt_ms FROM ser),
    med AS (SELECT user_id, median(rtt_ms) AS m, count(*) AS n FROM pg GROUP BY user_id),
    c0 AS (SELECT pg.*, sent_s + rtt_ms / 2000.0::DOUBLE AS ref_s FROM pg JOIN med USING (user_id) WHERE n >= 5 AND rtt_ms <= greatest(3 * m, m + 20)),
    o AS (SELECT user_id, min(device_ms) AS x0_ms, arg_min(ref_s, device_ms) AS y0_s FROM c0 GROUP BY user_id),
    cl AS (SELECT c0.*, x0_ms, y0_s, (device_ms - x0_ms) / 1000.0::DOUBLE AS x, ref_s - y0_s AS y, ref_s - y0_s - (device_ms - x0_ms) / 1000.0::DOUBLE AS off FROM c0 JOIN o USING (user_id)),
    an AS (SELECT user_id, median(off) AS intercept FROM cl GROUP BY user_id),
    cal AS (SELECT user_id, any_value(intercept) AS intercept, median(abs(off - intercept)) AS mad, max(abs(off - intercept)) AS worst, count(*) AS n_used, max(x) AS span_s, any_value(x0_ms) AS x0_ms, any_value(y0_s) AS y0_s FROM cl JOIN an USING (user_id) GROUP BY user_id)"""


def pings(spark, sf_dir):
    ev = series(spark, sf_dir)
    jitter = F.pmod("event_id", F.lit(7)) / 10.0 + F.when(F.pmod("event_id", F.lit(9)) == 0, 40.0).otherwise(0.0)
    return ev.select(
        *K, "i", ((F.col("t") - 1_704_067_200) * 1000).alias("device_ms"), (F.col("t") + jitter - F.col("value") / 2000.0).alias("sent_s"), F.col("value").alias("rtt_ms")
    )


@query("ping_clean", f"WITH {PING} SELECT user_id, i, round(x, 4) AS x, round(off, 4) AS off FROM cl")
def ping_clean(spark, sf_dir):
    out = clock.clean_pings(pings(spark, sf_dir), K)
    return out.select(*K, "i", F.round("x", 4).alias("x"), F.round("off", 4).alias("off"))


@query(
    "ping_anchor",
    f"""WITH {PING} SELECT user_id, round(intercept, 4) AS intercept, n_used, round(span_s, 4) AS span_s, round(mad * 1000, 1) AS mad_ms, round(worst * 1000, 1) AS max_resid_ms FROM cal""",
)
def ping_anchor(spark, sf_dir):
    out = clock.anchor_only(clock.clean_pings(pings(spark, sf_dir), K), K)
    return out.select(
        *K, F.round("intercept", 4).alias("intercept"), "n_used", F.round("span_s", 4).alias("span_s"), F.round("mad_ms", 1).alias("mad_ms"), F.round("max_resid_ms", 1).alias("max_resid_ms")
    )


def _round_sql(n: int, src: str) -> str:
    return f"""
    f{n} AS (SELECT user_id, regr_slope(y, x) AS s, regr_intercept(y, x) AS b, count(*) AS kept FROM {src} WHERE keep AND NOT done GROUP BY user_id),
    r{n} AS (SELECT {src}.*, s, b, kept, y - (s * x + b) AS r FROM {src} JOIN f{n} USING (user_id) WHERE NOT done),
    m{n} AS (SELECT user_id, median(r) AS med FROM r{n} WHERE keep GROUP BY user_id),
    d{n} AS (SELECT user_id, median(abs(r - med)) AS mad FROM r{n} JOIN m{n} USING (user_id) WHERE keep GROUP BY user_id),
    j{n} AS (SELECT r{n}.*, abs(r - med) <= 5 * 1.4826 * CASE WHEN mad = 0 THEN 1e-6 ELSE mad END AS k2 FROM r{n} JOIN m{n} USING (user_id) JOIN d{n} USING (user_id)),
    q{n} AS (SELECT user_id, x, y, k2 AS keep, sum(CAST(k2 AS INT)) OVER (PARTITION BY user_id) = kept AS done, s AS slope, b AS intercept FROM j{n}
       UNION ALL SELECT user_id, x, y, keep, done, slope, intercept FROM {src} WHERE done)"""


@query(
    "ping_linear",
    f"""WITH {PING}, q0 AS (SELECT user_id, x, y, true AS keep, false AS done, NULL::DOUBLE AS slope, NULL::DOUBLE AS intercept FROM cl), {", ".join(_round_sql(n, f"q{n - 1}") for n in (1, 2, 3))}
    SELECT user_id, round(max(slope), 8) AS slope, round(max(intercept), 3) AS intercept, count(*) FILTER (keep) AS n_used, count(*) FILTER (NOT keep) AS n_outliers,
       round(max(abs(y - (slope * x + intercept))) FILTER (keep), 3) AS max_resid_s FROM q3 GROUP BY user_id""",
)
def ping_linear(spark, sf_dir):
    out = clock.robust_linear(clock.clean_pings(pings(spark, sf_dir), K), K)
    return out.select(
        *K, F.round("slope", 8).alias("slope"), F.round("intercept", 3).alias("intercept"), "n_used", "n_outliers", F.round(F.col("max_resid_ms") / 1000, 3).alias("max_resid_s")
    )


STEP = f"""{PING}, nb AS (SELECT * REPLACE (round(off, 3) AS off), row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS p, count(*) OVER (PARTITION BY user_id) AS n FROM cl),
    sp AS (SELECT a.user_id, a.p, a.x, median(b.off) FILTER (b.p >= a.p) - median(b.off) FILTER (b.p < a.p) AS step FROM nb a JOIN nb b USING (user_id) WHERE a.p >= 5 AND a.p <= a.n - 5 GROUP BY ALL),
    bs AS (SELECT user_id, arg_min(step, (-abs(step), p)) AS step, arg_min(x, (-abs(step), p)) AS x FROM sp WHERE step <> 0 GROUP BY user_id)"""


def numbered_pings(spark, sf_dir):
    # the jitter is kept to millimetre-clean numbers, so that equal steps are equal
    clean = clock.clean_pings(pings(spark, sf_dir), K).withColumn("off", F.round("off", 3))
    return blocks.index_rows(clean.drop("i"), K, ["device_ms"], blocks.chunk_of(F.col("device_ms") / 1000, width(sf_dir)), "i")


@query(
    "ping_step",
    "WITH " + STEP + " SELECT cal.user_id, round(coalesce(step, 0), 3) AS max_step_s, round(bs.x, 3) AS step_at_s FROM cal LEFT JOIN bs USING (user_id)",
)
def ping_step(spark, sf_dir):
    out = clock.largest_step(numbered_pings(spark, sf_dir), K)
    return rounded(out, "max_step_s", "step_at_s", digits=3)


def calibrated(spark, sf_dir):
    return clock.anchor_only(clock.clean_pings(pings(spark, sf_dir), K), K)


@query(
    "two_point_sync",
    f"""WITH {PING} SELECT user_id, 0.0::DOUBLE AS "TE0", 1e7::DOUBLE AS "TE1", round(y0_s + intercept + (0 - x0_ms) / 1000.0::DOUBLE, 4) AS "TL0", round(y0_s + intercept + (1e7 - x0_ms) / 1000.0::DOUBLE, 4) AS "TL1" FROM cal""",
)
def two_point_sync(spark, sf_dir):
    return rounded(clock.two_point_map(calibrated(spark, sf_dir), K), "TL0", "TL1", digits=4)


@query(
    "choose_sync",
    f"""WITH {PING}, st AS (SELECT user_id, min(device_ms) AS ms, min(sent_s) AS s FROM pg GROUP BY user_id)
    SELECT user_id, round(CASE WHEN n_used < 55 THEN s ELSE y0_s + intercept + (0 - x0_ms) / 1000.0::DOUBLE END, 4) AS "TL0", CASE WHEN n_used < 55 THEN 'filename_anchor' ELSE 'timesync' END AS sync_method FROM st JOIN cal USING (user_id)""",
)
def choose_sync(spark, sf_dir):
    start = pings(spark, sf_dir).groupBy(*K).agg(F.min("device_ms").alias("start_ms"), F.min("sent_s").alias("start_s"))
    # a session with few clean pings keeps its file-name anchor
    maps = clock.two_point_map(calibrated(spark, sf_dir).filter("n_used >= 55"), K)
    return clock.choose_sync(maps, start, K).select(*K, F.round("TL0", 4).alias("TL0"), "sync_method")


@query(
    "device_to_unix",
    f"""WITH {PING} SELECT user_id, i, round(y0_s + intercept + (device_ms - x0_ms) / 1000.0::DOUBLE, 3) AS unix_time FROM pg JOIN cal USING (user_id)""",
)
def device_to_unix(spark, sf_dir):
    maps = clock.two_point_map(calibrated(spark, sf_dir), K)
    out = clock.device_to_unix(pings(spark, sf_dir), maps, K, "device_ms")
    return out.select(*K, "i", F.round("unix_time", 3).alias("unix_time"))


@query(
    "anchor_shift",
    f"""WITH {PING}, st AS (SELECT user_id, min(sent_s) AS s FROM pg GROUP BY user_id), d AS (SELECT user_id, y0_s + intercept - s AS shift FROM cal JOIN st USING (user_id))
    SELECT count(*) AS n, count(*) FILTER (abs(shift) > 0.5) AS n_gt_0p5s, count(*) FILTER (abs(shift) > 1) AS n_gt_1s, count(*) FILTER (abs(shift) > 2) AS n_gt_2s, round(max(abs(shift)), 3) AS largest_s FROM d""",
)
def anchor_shift(spark, sf_dir):
    old = pings(spark, sf_dir).groupBy(*K).agg(F.min("sent_s").alias("anchor_s"))
    new = calibrated(spark, sf_dir).select(*K, (F.col("y0_s") + F.col("intercept")).alias("anchor_s"))
    return clock.shift_summary(clock.anchor_shift(old, new, K)).withColumn("largest_s", F.round("largest_s", 3))


@query(
    "largest_anchor_shifts",
    f"""WITH {PING}, st AS (SELECT user_id, min(sent_s) AS s FROM pg GROUP BY user_id), d AS (SELECT user_id, y0_s + intercept - s AS shift FROM cal JOIN st USING (user_id))
    SELECT user_id, round(shift, 3) AS shift_s, CAST(row_number() OVER (ORDER BY round(abs(shift), 6) DESC, user_id) AS INT) AS rank FROM d WHERE shift IS NOT NULL QUALIFY rank <= 10""",
)
def largest_anchor_shifts(spark, sf_dir):
    old = pings(spark, sf_dir).groupBy(*K).agg(F.min("sent_s").alias("anchor_s"))
    new = calibrated(spark, sf_dir).select(*K, (F.col("y0_s") + F.col("intercept")).alias("anchor_s"))
    return clock.largest(clock.anchor_shift(old, new, K), K, "shift_s", 10).withColumn("shift_s", F.round("shift_s", 3))


@query(
    "map_drift",
    f"""WITH {PING}, e AS (SELECT user_id, arg_min(device_ms, i) AS a0, arg_max(device_ms, i) AS a1, arg_min(sent_s, i) AS b0, arg_max(sent_s, i) AS b1 FROM pg GROUP BY user_id)
    SELECT user_id, round(((b1 - b0) / ((a1 - a0) / 1000) - 1) * 1e6, 2) AS ppm, round(((b1 - b0) / ((a1 - a0) / 1000) - 1) * 3600, 5) AS drift_s FROM e""",
)
def map_drift(spark, sf_dir):
    first, last = (lambda c: F.min_by(c, "i")), (lambda c: F.max_by(c, "i"))
    maps = pings(spark, sf_dir).groupBy(*K).agg(
        first("device_ms").alias("TE0"), last("device_ms").alias("TE1"), first("sent_s").alias("TL0"), last("sent_s").alias("TL1"), F.lit(3600.0).alias("drive_s")
    )
    return clock.map_drift(maps, K, "drive_s").select(*K, F.round("ppm", 2).alias("ppm"), F.round("drift_s", 5).alias("drift_s"))


CADENCE = """g AS (SELECT user_id, t, t - lag(t) OVER (PARTITION BY user_id ORDER BY i) AS gap FROM ser),
    cd AS (SELECT user_id, count(*) AS n_pings, max(t) - min(t) AS span, max(gap) AS longest, median(gap) AS med, quantile_cont(gap, 0.9) AS p90 FROM g GROUP BY user_id)"""


@query(
    "ping_cadence",
    f"""WITH {SER}, {CADENCE} SELECT user_id, n_pings, round(span, 4) AS span_s, round(longest, 4) AS longest_gap_s, round(n_pings / greatest(span, 1) * 60, 6) AS pings_per_min, round(med, 4) AS median_interval_s, round(p90, 4) AS p90_interval_s FROM cd""",
)
def ping_cadence(spark, sf_dir):
    out = clock.ping_cadence(series(spark, sf_dir), K, "t")
    return rounded(out.withColumn("pings_per_min", r6("pings_per_min")), "span_s", "longest_gap_s", "median_interval_s", "p90_interval_s", digits=4)


@query(
    "timing_quality",
    f"""WITH {PING}, {CADENCE}, x AS (SELECT cal.user_id, 2592000.0::DOUBLE AS drive_s, cal.n_used, least(span_s / 3000000.0::DOUBLE * 100, 100) AS cov, mad * 1000 AS mad_ms, longest FROM cal JOIN cd USING (user_id))
    SELECT user_id, round(3000000.0::DOUBLE / 60, 3) AS dur_min, n_used AS pings, round(cov, 4) AS coverage_pct, round(mad_ms, 1) AS mad_ms, 0.25::DOUBLE AS step_s, round(greatest(0.25, 2 * mad_ms / 1000, 0.1), 4) AS variability_s, round(longest, 4) AS longest_gap_s,
       concat_ws('; ', CASE WHEN cov < 50 THEN 'ping span covers ' || CAST(round_even(cov, 0) AS BIGINT) || '% of drive' END, CASE WHEN user_id % 10 = 0 THEN 'two recordings' END) AS notes FROM x""",
)
def timing_quality(spark, sf_dir):
    cal = calibrated(spark, sf_dir).withColumn("max_step_s", F.lit(-0.25))
    cadence = clock.ping_cadence(series(spark, sf_dir), K, "t")
    meta = events(spark, sf_dir).groupBy(*K).agg(F.lit(3_000_000.0).alias("drive_s")).withColumn("note", F.when(F.pmod("user_id", F.lit(10)) == 0, "two recordings"))
    out = clock.timing_quality(cal, cadence, meta, K)
    return rounded(out.withColumns({"dur_min": F.round("dur_min", 3), "mad_ms": F.round("mad_ms", 1)}), "coverage_pct", "variability_s", "longest_gap_s", digits=4)


# A logger's clock: elapsed time, and a time of day that jumps after every fortieth event.

CLOCK = SER + """, ck0 AS (SELECT user_id, i, t - min(t) OVER (PARTITION BY user_id) AS elapsed, event_id, value FROM ser),
    ck AS (SELECT *, elapsed + 1000.0 + sum(CASE WHEN event_id % 40 = 0 AND i > 0 THEN 2.5 ELSE 0.0 END) OVER (PARTITION BY user_id ORDER BY i) AS tod FROM ck0),
    rs AS (SELECT *, tod - first_value(tod) OVER (PARTITION BY user_id ORDER BY i) - elapsed AS residual FROM ck),
    jp AS (SELECT *, residual - lag(residual) OVER (PARTITION BY user_id ORDER BY i) AS jump, lag(elapsed) OVER (PARTITION BY user_id ORDER BY i) AS before FROM rs)"""


def logger(spark, sf_dir):
    ev = series(spark, sf_dir)
    first = ev.groupBy(*K).agg(F.min("t").alias("_t0"))
    slip = F.when((F.pmod("event_id", F.lit(40)) == 0) & (F.col("i") > 0), 2.5).otherwise(0.0)
    cut = ev.join(first, K).withColumns({"elapsed": F.col("t") - F.col("_t0"), "_b": F.floor(F.col("i") / blocks.BLOCK_ROWS).cast("bigint"), "_slip": slip})
    slipped = blocks.scan(cut, K, "_b", ["i"], running={"_sum": F.col("_slip")})
    return slipped.select(*K, "i", "event_id", "event_type", "value", "t", "elapsed", (F.col("elapsed") + 1000.0 + F.col("_sum")).alias("tod"))


@query(
    "clock_continuity",
    f"""WITH {CLOCK} SELECT user_id, count(*) AS rows, round(arg_max(elapsed, i), 4) AS elapsed_end_s, round(arg_max(tod, i) - arg_min(tod, i), 4) AS utc_span_s, round(arg_max(residual, i), 4) AS residual_end_s,
       round(max(abs(residual)), 4) AS max_abs_residual_s, count(*) FILTER (abs(jump) > 0.5) AS n_jumps, round(min(before) FILTER (abs(jump) > 0.5), 4) AS first_jump_at_s,
       coalesce((list(round(jump, 2) ORDER BY i) FILTER (abs(jump) > 0.5)), []) AS jump_sizes_s FROM jp GROUP BY user_id""",
)
def clock_continuity(spark, sf_dir):
    out = clock.clock_continuity(logger(spark, sf_dir), K, "tod", "elapsed")
    return rounded(out, "elapsed_end_s", "utc_span_s", "residual_end_s", "max_abs_residual_s", "first_jump_at_s", digits=4)


@query("clock_health", f"WITH {CLOCK} SELECT user_id, count(DISTINCT i // 25) AS n_segments, min(event_id % 12) AS min_satellites FROM jp GROUP BY user_id")
def clock_health(spark, sf_dir):
    log = logger(spark, sf_dir).withColumns({"segment": F.floor(F.col("i") / 25), "satellites": F.pmod("event_id", F.lit(12))})
    return clock.clock_health(log, K, "segment", "satellites")


@query(
    "clock_segments",
    f"""WITH {CLOCK}, sg AS (SELECT *, i // 25 AS segment, tod - elapsed AS r FROM ck), sj AS (SELECT *, r - lag(r) OVER w AS j, lag(elapsed) OVER w AS was FROM sg WINDOW w AS (PARTITION BY user_id, segment ORDER BY i))
    SELECT user_id, segment, count(*) AS n, round(max(r) - min(r), 4) AS residual_range_s, count(*) FILTER (abs(j) > 0.5) AS n_jumps, round(min(was) FILTER (abs(j) > 0.5), 4) AS first_jump_at_s,
       round(max(abs(j)) FILTER (abs(j) > 0.5), 4) AS largest_jump_s FROM sj GROUP BY user_id, segment""",
)
def clock_segments(spark, sf_dir):
    log = logger(spark, sf_dir).withColumn("segment", F.floor(F.col("i") / 25))
    out = clock.clock_segments(log, K, "segment", "tod", "elapsed", block=40)
    return rounded(out, "residual_range_s", "first_jump_at_s", "largest_jump_s", digits=4)


@query(
    "truncate_at_jump",
    f"""WITH {CLOCK}, c AS (SELECT user_id, min(before) FILTER (abs(jump) > 0.5) AS cut FROM jp GROUP BY user_id) SELECT user_id, i FROM jp JOIN c USING (user_id) WHERE cut IS NULL OR elapsed <= cut""",
)
def truncate_at_jump(spark, sf_dir):
    log = logger(spark, sf_dir)
    cuts = clock.first_jumps(log, K, "tod", "elapsed")
    return clock.truncate_at_jump(log, cuts, K, F.col("elapsed")).select(*K, "i")


@query(
    "video_lead_in",
    f"""WITH {CLOCK}, v AS (SELECT *, elapsed + 3 + (event_id % 5) / 100.0::DOUBLE AS sync, CAST(floor(i / 30) AS BIGINT) AS seg FROM ck), f AS (SELECT user_id, arg_min(sync, i) AS lead, arg_min(seg, i) AS s0, count(*) AS n, count(DISTINCT seg) AS ns, arg_max(elapsed, i) AS e FROM v GROUP BY user_id)
    SELECT user_id, round(any_value(lead), 4) AS lead_in_s, round(median(sync - elapsed), 4) AS lead_in_median_s, round((max(sync - elapsed) - min(sync - elapsed)) * 1000, 2) AS lead_in_spread_ms, any_value(ns) AS n_segments, any_value(n) AS n_rows, round(any_value(e), 4) AS telemetry_s
    FROM v JOIN f USING (user_id) WHERE seg = s0 GROUP BY user_id""",
)
def video_lead_in(spark, sf_dir):
    v = logger(spark, sf_dir).withColumns({"sync": F.col("elapsed") + 3 + F.pmod("event_id", F.lit(5)) / 100.0, "seg": F.floor(F.col("i") / 30)})
    out = clock.lead_in(v, K, "sync", "elapsed", "seg")
    return rounded(out.withColumn("lead_in_spread_ms", F.round("lead_in_spread_ms", 2)), "lead_in_s", "lead_in_median_s", "telemetry_s", digits=4)


@query(
    "wrap_midnight",
    f"""WITH {SER}, d AS (SELECT user_id, i, hour(ts) * 3600.0 + minute(ts) * 60 + floor(second(ts)) AS tod FROM ser)
    SELECT user_id, i, CAST(CASE WHEN tod < first_value(tod) OVER {W}) THEN tod + 86400 ELSE tod END AS DOUBLE) AS tod FROM d""",
)
def wrap_midnight(spark, sf_dir):
    clockish = series(spark, sf_dir).withColumn("tod", (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("double"))
    return clock.wrap_midnight(clockish, K, "tod").select(*K, "i", "tod")


@query(
    "anchored_time",
    f"""WITH {CLOCK} SELECT ck.user_id, ck.i, round(1704067200 + first_value(tod) OVER (PARTITION BY user_id ORDER BY i) + elapsed, 3) AS unix_time FROM ck""",
)
def anchored_time(spark, sf_dir):
    dated = logger(spark, sf_dir).withColumn("date", F.lit("2024-01-01").cast("date"))
    out = clock.anchor_time(dated, K, "tod", "elapsed", "date")
    return out.select(*K, "i", F.round("unix_time", 3).alias("unix_time"))


# Trimming.


@query(
    "trim_stationary",
    f"""WITH {CLOCK}, b AS (SELECT user_id, min(i) FILTER (value > 60) AS i0, max(i) FILTER (value > 60) AS i1 FROM ck GROUP BY user_id),
    k AS (SELECT ck.* FROM ck JOIN b USING (user_id) WHERE i0 IS NULL OR i BETWEEN i0 AND i1) SELECT user_id, i, round(elapsed - min(elapsed) OVER (PARTITION BY user_id), 4) AS elapsed FROM k""",
)
def trim_stationary(spark, sf_dir):
    return trim.trim_stationary(logger(spark, sf_dir), K, "value", "elapsed", 60.0).select(*K, "i", F.round("elapsed", 4).alias("elapsed"))


@query(
    "trim_rebase",
    f"""WITH {CLOCK}, k AS (SELECT * FROM ck WHERE elapsed BETWEEN 200000 AND 1500000) SELECT user_id, i, round(elapsed - min(elapsed) OVER (PARTITION BY user_id), 4) AS elapsed FROM k""",
)
def trim_rebase(spark, sf_dir):
    log = logger(spark, sf_dir)
    points = log.select(*K).distinct().withColumns({"start_s": F.lit(200_000.0), "end_s": F.lit(1_500_000.0)})
    return trim.trim(log, points, K, "elapsed").select(*K, "i", F.round("elapsed", 4).alias("elapsed"))


@query(
    "sustained_edges",
    f"""WITH {EV}, o AS (SELECT user_id, t_us, value > 15 AS ok FROM ev),
    w AS (SELECT *, avg(CAST(ok AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY t_us RANGE BETWEEN CURRENT ROW AND 172800000000 FOLLOWING) AS a, avg(CAST(ok AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY t_us RANGE BETWEEN 172800000000 PRECEDING AND CURRENT ROW) AS b FROM o)
    SELECT user_id, min(t_us) FILTER (ok AND a > 0.8) AS start_us, max(t_us) FILTER (ok AND b > 0.8) AS end_us FROM w GROUP BY user_id""",
)
def sustained_edges(spark, sf_dir):
    ok = events(spark, sf_dir).select(*K, "t_us", (F.col("value") > 15).alias("ok"))
    w_us = width(sf_dir) * 1e6
    start = trim.sustained(ok, K, "t_us", "ok", w_us, 172_800.0, 0.8, "start")
    end = trim.sustained(ok, K, "t_us", "ok", w_us, 172_800.0, 0.8, "end")
    return ok.select(*K).distinct().join(start, K, "left").join(end, K, "left")


DETECT = f"""WITH {SER}, {GEO}, e AS (SELECT user_id, arg_min(lat, t_us) AS a, arg_min(lon, t_us) AS b, arg_max(lat, t_us) AS c, arg_max(lon, t_us) AS d, min(t_us) AS t0, max(t_us) AS t1 FROM geo GROUP BY user_id),
    bs AS (SELECT median(la) AS la, median(lo) AS lo FROM (SELECT a AS la, b AS lo FROM e UNION ALL SELECT c, d FROM e)),
    o AS (SELECT user_id, t_us, value >= 10 AND 2 * 6371000.0 * asin(sqrt(sin(radians(la - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(la)) * sin(radians(lo - lon) / 2) ** 2)) >= 1500 AS ok FROM geo, bs),
    w AS (SELECT *, avg(CAST(ok AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY t_us RANGE BETWEEN CURRENT ROW AND 86400000000 FOLLOWING) AS f, avg(CAST(ok AS DOUBLE)) OVER (PARTITION BY user_id ORDER BY t_us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS g FROM o),
    s AS (SELECT user_id, min(t_us) FILTER (ok AND f > 0.8) AS s0, max(t_us) FILTER (ok AND g > 0.8) AS s1 FROM w GROUP BY user_id),
    rp AS (SELECT user_id, CASE WHEN coalesce(s0 < s1, false) THEN 'ok' ELSE 'FAILED_DETECTION' END AS status, round((t1 - t0) / 1e6, 6) AS orig_duration_s, CASE WHEN s0 < s1 THEN round((s0 - t0) / 1e6, 6) END AS trim_start_s,
       CASE WHEN s0 < s1 THEN round((t1 - s1) / 1e6, 6) END AS trim_end_s, CASE WHEN s0 < s1 THEN round((s1 - s0) / 1e6, 6) END AS new_duration_s FROM e JOIN s USING (user_id))"""


def trim_report(spark, sf_dir):
    out = trim.detect_trim(placed(spark, sf_dir), K, "t_us", "lat", "lon", "value", width(sf_dir) * 1e6, 10.0, 1500.0, 86_400.0)
    return rounded(out, "orig_duration_s", "trim_start_s", "trim_end_s", "new_duration_s")


@query("detect_trim", DETECT + " SELECT * FROM rp")
def detect_trim(spark, sf_dir):
    return trim_report(spark, sf_dir)


@query(
    "trim_outliers",
    DETECT + """ SELECT *, CASE WHEN trim_start_s > 600000 OR trim_end_s > 600000 THEN 'large' ELSE 'near_zero' END AS kind FROM rp WHERE status = 'ok' AND (trim_start_s > 600000 OR trim_end_s > 600000 OR trim_start_s < 20000 OR trim_end_s < 20000)""",
)
def trim_outliers(spark, sf_dir):
    return trim.trim_outliers(trim_report(spark, sf_dir), 600_000.0, 20_000.0)


@query(
    "shift_frames",
    f"""WITH {SER}, l AS (SELECT user_id, CAST(round_even((user_id % 7) / 10.0::DOUBLE * 30, 0) AS BIGINT) AS s FROM (SELECT DISTINCT user_id FROM events))
    SELECT user_id, event_id, i - s AS frame, round_even((i - s) / 30.0::DOUBLE, 4) AS timestamp_s FROM ser JOIN l USING (user_id) WHERE i >= s AND i <= 50""",
)
def shift_frames(spark, sf_dir):
    frames = series(spark, sf_dir).select(*K, "event_id", F.col("i").alias("frame"))
    lead = frames.select(*K).distinct().withColumns({"lead_s": F.pmod("user_id", F.lit(7)) / 10.0, "last_frame": F.lit(50)})
    return trim.shift_frames(frames, lead, K, "frame", 30.0, "last_frame").select(*K, "event_id", "frame", "timestamp_s")


@query(
    "endpoint_audit",
    f"""WITH {CLOCK}, n AS (SELECT *, max(i) OVER (PARTITION BY user_id) AS m FROM ck) SELECT user_id, round(avg(value) FILTER (i < 25), 6) AS start_v, round(avg(value) FILTER (i > m - 25), 6) AS end_v,
       round(min(elapsed) FILTER (value > 60), 4) AS stationary_head_s, round(arg_max(elapsed, i) - max(elapsed) FILTER (value > 60), 4) AS stationary_tail_s FROM n GROUP BY user_id""",
)
def endpoint_audit(spark, sf_dir):
    out = trim.endpoint_audit(logger(spark, sf_dir), K, "value", "elapsed", 25, 60.0)
    return rounded(out.withColumns({"start_v": r6("start_v"), "end_v": r6("end_v")}), "stationary_head_s", "stationary_tail_s", digits=4)


@query(
    "duration_differences",
    f"""WITH {EV}, a AS (SELECT user_id, max(t) - min(t) AS d FROM ev WHERE event_type IN ('view', 'click') GROUP BY user_id), b AS (SELECT user_id, max(t) - min(t) AS d FROM ev WHERE event_type NOT IN ('view', 'click') GROUP BY user_id), x AS (SELECT a.d - b.d AS diff FROM a JOIN b USING (user_id))
    SELECT count(*) AS n, count(*) FILTER (abs(diff) > 86400) AS "n_gt_86400s", count(*) FILTER (abs(diff) > 300000) AS "n_gt_300000s", round(avg(abs(diff)), 3) AS mean_abs_diff_s FROM x""",
)
def duration_differences(spark, sf_dir):
    ev = events(spark, sf_dir)
    first = F.col("event_type").isin("view", "click")
    a, b = (ev.filter(e).groupBy(*K).agg((F.max("t") - F.min("t")).alias("duration_s")) for e in (first, ~first))
    return rounded(trim.duration_tally(trim.duration_diff(a, b, K), (86_400, 300_000)), "mean_abs_diff_s", digits=3)


@query(
    "largest_duration_differences",
    f"""WITH {EV}, a AS (SELECT user_id, max(t) - min(t) AS d FROM ev WHERE event_type IN ('view', 'click') GROUP BY user_id), b AS (SELECT user_id, max(t) - min(t) AS d FROM ev WHERE event_type NOT IN ('view', 'click') GROUP BY user_id),
    x AS (SELECT user_id, a.d - b.d AS diff FROM a JOIN b USING (user_id))
    SELECT user_id, round(diff, 3) AS diff_s, CAST(row_number() OVER (ORDER BY round(abs(diff), 6) DESC, user_id) AS INT) AS rank FROM x WHERE diff IS NOT NULL QUALIFY rank <= 10""",
)
def largest_duration_differences(spark, sf_dir):
    ev = events(spark, sf_dir)
    first = F.col("event_type").isin("view", "click")
    a, b = (ev.filter(e).groupBy(*K).agg((F.max("t") - F.min("t")).alias("duration_s")) for e in (first, ~first))
    return clock.largest(trim.duration_diff(a, b, K), K, "diff_s", 10).withColumn("diff_s", F.round("diff_s", 3))


# Quality checks: two event types form the reference stream, the others are device channels.

RATES = {"purchase": 1 / 200_000, "error": 1 / 150_000, "signup": 1 / 100_000}
RANGES = {"purchase": (0.5, 150.0), "error": (1.0, 100.0), "signup": (0.0, 60.0)}
RATE_SQL = "CASE channel WHEN 'purchase' THEN 1.0::DOUBLE / 200000 WHEN 'error' THEN 1.0::DOUBLE / 150000 WHEN 'signup' THEN 1.0::DOUBLE / 100000 ELSE 25.0 END"
CHECKS = EV + f""", rf AS (SELECT * FROM ev WHERE event_type IN ('view', 'click')), dv AS (SELECT *, event_type AS channel FROM ev WHERE event_type NOT IN ('view', 'click')),
    ra AS (SELECT user_id, min(t) AS a0, max(t) AS a1 FROM rf GROUP BY user_id), rb AS (SELECT user_id, min(t) AS b0, max(t) AS b1 FROM dv GROUP BY user_id),
    q1 AS (SELECT user_id, coalesce(greatest(least(a1, b1) - greatest(a0, b0), 0), 0) AS ov, a1 - a0 AS ra, b1 - b0 AS rb FROM ra LEFT JOIN rb USING (user_id)),
    so AS (SELECT user_id, channel, min(t) - any_value(a0) AS o FROM dv JOIN ra USING (user_id) GROUP BY user_id, channel),
    q2 AS (SELECT user_id, max(o) - min(o) AS spread, median(o) AS med FROM so GROUP BY user_id),
    q3 AS (SELECT user_id, channel, count(*) AS actual, CAST(floor(any_value(ov) * {RATE_SQL}) AS BIGINT) AS expected FROM dv JOIN q1 USING (user_id) GROUP BY user_id, channel),
    gp AS (SELECT user_id, channel, t - lag(t) OVER (PARTITION BY user_id, channel ORDER BY t) AS d, 1.0::DOUBLE / {RATE_SQL} AS dt FROM dv),
    q4 AS (SELECT user_id, channel, count(*) FILTER (d > dt * 3) AS n_gaps, coalesce(sum(d - dt) FILTER (d > dt * 3), 0) AS total, coalesce(max(d) FILTER (d > dt * 3), 0) AS largest FROM gp GROUP BY user_id, channel),
    q5 AS (SELECT user_id, channel, min(value) AS lowest, max(value) AS highest, avg(CAST(NOT (value BETWEEN CASE channel WHEN 'purchase' THEN 0.5 WHEN 'error' THEN 1 ELSE 0 END AND CASE channel WHEN 'purchase' THEN 150 WHEN 'error' THEN 100 ELSE 60 END) AS DOUBLE)) * 100 AS pct FROM dv GROUP BY user_id, channel)"""


def checks(spark, sf_dir):
    reference, dev = streams(spark, sf_dir)
    dev = dev.withColumn("channel", F.col("event_type"))
    keys = [*K, "channel"]
    numbered = blocks.index_rows(dev, keys, ["t_us"], blocks.chunk_of("t", width(sf_dir)))
    coverage = quality.check_coverage(reference, dev, K, "t")
    return {
        "coverage": coverage,
        "alignment": quality.check_alignment(reference, dev, K, "t", 200_000.0, 200_000.0),
        "counts": quality.check_counts(dev, RATES, coverage, K),
        "gaps": quality.check_gaps(numbered, RATES, K, "t"),
        "ranges": quality.check_ranges(dev, RANGES, K, "value", 5.0),
    }


@query(
    "check_coverage",
    f"WITH {CHECKS} SELECT user_id, round(ov, 4) AS overlap_s, round(ov / ra * 100, 1) AS overlap_pct_reference, round(ov / rb * 100, 1) AS overlap_pct_device, ov > 60 AS ok FROM q1",
)
def check_coverage(spark, sf_dir):
    return rounded(checks(spark, sf_dir)["coverage"], "overlap_s", digits=4)


@query(
    "check_alignment",
    f"WITH {CHECKS} SELECT user_id, round(spread, 4) AS spread_s, round(med, 4) AS median_offset_s, abs(med) < 200000 AND spread < 200000 AS ok FROM q2",
)
def check_alignment(spark, sf_dir):
    return rounded(checks(spark, sf_dir)["alignment"], "spread_s", "median_offset_s", digits=4)


@query(
    "check_sample_counts",
    f"WITH {CHECKS} SELECT user_id, channel, expected, actual, round(CASE WHEN expected > 0 THEN actual / expected ELSE 0 END * 100, 1) AS completeness_pct, CASE WHEN expected > 0 THEN actual / expected ELSE 0 END BETWEEN 0.8 AND 1.2 AS ok FROM q3",
)
def check_sample_counts(spark, sf_dir):
    return checks(spark, sf_dir)["counts"]


@query(
    "check_gaps",
    f"WITH {CHECKS} SELECT user_id, channel, n_gaps, round(total, 3) AS total_gap_s, round(largest, 3) AS largest_gap_s, n_gaps = 0 AS ok FROM q4",
)
def check_gaps(spark, sf_dir):
    return rounded(checks(spark, sf_dir)["gaps"], "total_gap_s", "largest_gap_s", digits=3)


@query("check_ranges", f"WITH {CHECKS} SELECT user_id, channel, lowest, highest, round(pct, 6) AS pct_out, pct < 5 AS ok FROM q5")
def check_ranges(spark, sf_dir):
    return rounded(checks(spark, sf_dir)["ranges"], "pct_out")


@query(
    "quality_score",
    f"""WITH {CHECKS}, al AS (SELECT user_id, CAST(ov > 60 AS INT) AS ok FROM q1 UNION ALL SELECT user_id, CAST(abs(med) < 200000 AND spread < 200000 AS INT) FROM q2
       UNION ALL SELECT user_id, min(CAST(CASE WHEN expected > 0 THEN actual / expected ELSE 0 END BETWEEN 0.8 AND 1.2 AS INT)) FROM q3 GROUP BY user_id
       UNION ALL SELECT user_id, min(CAST(n_gaps = 0 AS INT)) FROM q4 GROUP BY user_id UNION ALL SELECT user_id, min(CAST(pct < 5 AS INT)) FROM q5 GROUP BY user_id)
    SELECT user_id, CAST(round_even(sum(ok) / 5 * 100, 0) AS INT) AS score FROM al GROUP BY user_id""",
)
def quality_score(spark, sf_dir):
    return quality.quality_score(list(checks(spark, sf_dir).values()), K)


# Channel quality: values are coarse, so equal neighbours occur; every eleventh sample is missing.

CHQ = EV + """, ch AS (SELECT user_id, event_type AS channel, t, floor(value / 15) AS v, event_id % 11 <> 0 AS present, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t_us) - 1 AS i FROM ev),
    f AS (SELECT user_id, channel, count(*) AS n, avg(CAST(NOT present AS DOUBLE)) * 100 AS miss, count(*) FILTER (present) AS np,
       avg(CASE WHEN present AND channel IN ('purchase', 'error', 'signup') THEN CAST(NOT (v BETWEEN 0 AND CASE channel WHEN 'purchase' THEN 5 WHEN 'error' THEN 3 ELSE 2 END) AS DOUBLE) END) * 100 AS oor FROM ch GROUP BY ALL),
    g0 AS (SELECT user_id, channel, t - lag(t) OVER (PARTITION BY user_id, channel ORDER BY t) AS d FROM ch WHERE present), g AS (SELECT user_id, channel, max(d) FILTER (d > 3 * 100000) AS lg, sum(d) FILTER (d > 3 * 100000) AS tg FROM g0 GROUP BY ALL),
    r0 AS (SELECT *, CASE WHEN present AND lag(CASE WHEN present THEN v END) OVER (PARTITION BY user_id, channel ORDER BY i) = v THEN 0 ELSE 1 END AS c FROM ch), r1 AS (SELECT *, sum(c) OVER (PARTITION BY user_id, channel ORDER BY i) AS q FROM r0),
    r2 AS (SELECT user_id, channel, q, count(*) AS len FROM r1 GROUP BY ALL HAVING count(*) > 1), r AS (SELECT user_id, channel, max(len) / 25.0::DOUBLE AS lf, sum(len) FILTER (len >= 3) AS fl FROM r2 GROUP BY ALL),
    cq AS (SELECT user_id, channel, n, miss, oor, coalesce(lg, 0) AS lg, coalesce(tg, 0) AS tg, coalesce(lf, 0) AS lf, coalesce(fl, 0) * 100.0::DOUBLE / greatest(np, 1) AS pf FROM f LEFT JOIN g USING (user_id, channel) LEFT JOIN r USING (user_id, channel))"""

COARSE = {"purchase": (0.0, 5.0), "error": (0.0, 3.0), "signup": (0.0, 2.0)}


def channel_table(spark, sf_dir):
    keys = [*K, "channel"]
    ch = events(spark, sf_dir).select(
        *K, F.col("event_type").alias("channel"), "t", "t_us", F.floor(F.col("value") / 15).cast("double").alias("value"), (F.pmod("event_id", F.lit(11)) != 0).alias("present")
    )
    numbered = blocks.index_rows(ch, keys, ["t_us"], blocks.chunk_of("t", width(sf_dir)))
    rates = {c: 1 / 100_000 for c in ("view", "click", "purchase", "error", "signup")}
    return quality.channel_quality(numbered, COARSE, rates, K, "t", width(sf_dir), flat_n=3)


@query(
    "channel_quality",
    f"WITH {CHQ} SELECT user_id, channel, n, round(miss, 6) AS missing_pct, round(oor, 6) AS oor_pct, round(lg, 3) AS longest_gap_s, round(tg, 3) AS total_gap_s, round(lf, 6) AS longest_flatline_s, round(pf, 6) AS pct_in_flatline FROM cq",
)
def channel_quality(spark, sf_dir):
    out = rounded(channel_table(spark, sf_dir), "missing_pct", "oor_pct", "longest_flatline_s", "pct_in_flatline")
    return rounded(out, "longest_gap_s", "total_gap_s", digits=3)


@query(
    "channel_summary",
    f"""WITH {CHQ} SELECT channel, round(avg(miss), 6) AS mean_missing_pct, round(max(miss), 6) AS max_missing_pct, round(max(lg), 3) AS max_longest_gap_s, round(avg(oor), 6) AS mean_oor_pct, round(max(oor), 6) AS max_oor_pct,
       count(*) FILTER (pf > 30) AS n_sessions_flat, round(max(lf), 6) AS max_longest_flatline_s FROM cq GROUP BY channel""",
)
def channel_summary(spark, sf_dir):
    out = quality.channel_summary(channel_table(spark, sf_dir))
    return rounded(rounded(out, "mean_missing_pct", "max_missing_pct", "mean_oor_pct", "max_oor_pct", "max_longest_flatline_s"), "max_longest_gap_s", digits=3)


@query(
    "session_screens",
    f"""WITH {CHQ}, w AS (SELECT user_id, max(oor) FILTER (channel = 'error') AS eo, max(pf) FILTER (channel = 'error') AS ef, max(pf) FILTER (channel = 'signup') AS sf, max(miss) FILTER (channel = 'purchase') AS bd, max(oor) FILTER (channel = 'purchase') AS bo, max(lg) FILTER (channel = 'purchase') AS bg FROM cq GROUP BY user_id)
    SELECT user_id, round(eo, 6) AS eda_oor, round(ef, 6) AS eda_flat, round(sf, 6) AS scr_flat, round(bd, 6) AS beat_drop, round(bo, 6) AS beat_oor, round(bg, 3) AS beat_gap, ef < 30 AS eda_ok, sf < 30 AS scr_ok, bd < 10 OR bd < 30 AS beat_ok,
       round((1 - bd / 100) * (1 - bo / 100) * 100, 6) AS beat_avail_pct, round((1 - bd / 100) * (1 - bo / 100) * 2592000 / 60, 3) AS beat_avail_min FROM w""",
)
def session_screens(spark, sf_dir):
    meta = events(spark, sf_dir).select(*K).distinct().withColumn("drive_s", F.lit(2_592_000.0))
    out = quality.session_screens(channel_table(spark, sf_dir), meta, K, "error", "signup", "purchase")
    return rounded(rounded(out, "eda_oor", "eda_flat", "scr_flat", "beat_drop", "beat_oor", "beat_avail_pct"), "beat_gap", "beat_avail_min", digits=3)


@query(
    "saturation",
    f"""WITH {EV}, ch AS (SELECT user_id, event_type AS channel, least(value, 60) AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t_us) - 1 AS i FROM ev),
    a AS (SELECT *, v >= max(v) OVER (PARTITION BY channel) * (1 - 0.001) AS hi FROM ch), b AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, channel, hi ORDER BY i) AS g FROM a), c AS (SELECT user_id, channel, g, count(*) AS n FROM b WHERE hi GROUP BY ALL)
    SELECT a.user_id, a.channel, count(*) AS n, count(*) FILTER (hi) AS n_at_ceiling, coalesce((SELECT max(c.n) FROM c WHERE c.user_id = a.user_id AND c.channel = a.channel), 0) AS longest_run,
       coalesce((SELECT max(c.n) FROM c WHERE c.user_id = a.user_id AND c.channel = a.channel), 0) >= 3 AS sustained FROM a GROUP BY a.user_id, a.channel""",
)
def saturation(spark, sf_dir):
    ch = events(spark, sf_dir).select(*K, F.col("event_type").alias("channel"), "t", "t_us", F.least("value", F.lit(60.0)).alias("value"))
    numbered = blocks.index_rows(ch, [*K, "channel"], ["t_us"], blocks.chunk_of("t", width(sf_dir)))
    return quality.saturation(numbered, K, min_run=3)


@query(
    "frame_audit",
    f"""WITH {SER}, p AS (SELECT user_id, i, floor((t - CASE WHEN event_id % 19 = 0 THEN 200000 ELSE 0 END) / 40000) AS pts FROM ser), d AS (SELECT user_id, i, pts - lag(pts) OVER {W}) AS d FROM p)
    SELECT user_id, count(*) AS n_frames, count(*) FILTER (d < 0) AS n_nonmonotonic, count(*) FILTER (d = 0) AS n_duplicate, round(1.0 / avg(d) FILTER (d > 0), 6) AS actual_fps, round(stddev_pop(d) FILTER (d > 0), 6) AS interval_sd_s,
       count(*) - 70.0::DOUBLE AS frame_count_diff, round(count(*) / 70.0::DOUBLE, 6) AS completeness_ratio FROM d GROUP BY user_id""",
)
def frame_audit(spark, sf_dir):
    back = F.when(F.pmod("event_id", F.lit(19)) == 0, 200_000).otherwise(0)
    frames = series(spark, sf_dir).withColumn("pts", F.floor((F.col("t") - back) / 40_000).cast("double"))
    meta = frames.select(*K).distinct().withColumns({"duration_s": F.lit(35.0), "nominal_fps": F.lit(2.0)})
    return rounded(quality.frame_audit(frames, K, "pts", meta), "actual_fps", "interval_sd_s", "completeness_ratio")


@query(
    "feature_audit",
    """WITH f AS (SELECT vec_id, label, embedding[1] * 100 + 40 AS a, embedding[2] * 100 + 60 AS b, vec_id % 6 <> 0 AS det, embedding[3] < 0 OR embedding[3] > 0.2 AS o FROM embeddings)
    SELECT label, count(*) AS n_rows, count(*) FILTER (det) AS n_detections, count(*) FILTER (det AND abs(a + b - 100) <= 1) AS n_sum_ok, min(vec_id) AS frame_min, max(vec_id) AS frame_max, round(count(*) FILTER (det AND o) * 100.0::DOUBLE / count(*) FILTER (det), 6) AS outside_pct FROM f GROUP BY label""",
)
def feature_audit(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    f = e.select("vec_id", "label", (F.col("embedding")[0] * 100 + 40).alias("a"), (F.col("embedding")[1] * 100 + 60).alias("b"), (F.col("embedding")[2] < 0).alias("low"), (F.col("embedding")[2] > F.lit(0.2)).alias("high"))
    out = quality.feature_audit(f, ["label"], "vec_id", ["a", "b"], F.pmod("vec_id", F.lit(6)) != 0, F.col("low") | F.col("high"))
    return rounded(out, "outside_pct")


@query(
    "label_reproducibility",
    f"""WITH {EV}, n AS (SELECT user_id, t AS nt, CASE WHEN value > 60 THEN 'High' ELSE 'Normal' END AS nl FROM ev WHERE event_type <> 'signup'), r AS (SELECT user_id, t, CASE WHEN value > 55 THEN 'High' ELSE 'Normal' END AS l FROM ev),
    j AS (SELECT r.*, p.nt AS pt, p.nl AS pl, q.nt AS qt, q.nl AS ql FROM r ASOF LEFT JOIN n p ON r.user_id = p.user_id AND r.t >= p.nt ASOF LEFT JOIN n q ON r.user_id = q.user_id AND r.t <= q.nt),
    k AS (SELECT *, CASE WHEN pt IS NOT NULL AND (qt IS NULL OR t - pt <= qt - t) THEN t - pt ELSE qt - t END AS d, CASE WHEN pt IS NOT NULL AND (qt IS NULL OR t - pt <= qt - t) THEN pl ELSE ql END AS x FROM j),
    m AS (SELECT user_id, t, l, CASE WHEN d <= 43200 THEN x END AS x FROM k),
    s AS (SELECT *, l IS DISTINCT FROM lag(l) OVER (PARTITION BY user_id ORDER BY t) AS sl, x IS DISTINCT FROM lag(x) OVER (PARTITION BY user_id ORDER BY t) AS sx FROM m),
    a AS (SELECT user_id, count(*) AS n_rows, round(avg(CAST(l IS NOT DISTINCT FROM x AS DOUBLE)) * 100, 6) AS agreement_pct, count(*) FILTER (sl AND l = 'High') AS released_0, count(*) FILTER (sx AND x = 'High') AS native_0 FROM s GROUP BY user_id)
    SELECT *, CASE WHEN released_0 = native_0 THEN 'reproduced' ELSE 'differs' END AS status FROM a""",
)
def label_reproducibility(spark, sf_dir):
    ev = events(spark, sf_dir)
    native = ev.filter("event_type <> 'signup'").select(*K, "t", F.when(F.col("value") > 60, "High").otherwise("Normal").alias("label"))
    released = ev.select(*K, "t", F.when(F.col("value") > 55, "High").otherwise("Normal").alias("label"))
    return rounded(quality.reproducibility(native, released, K, "t", width(sf_dir), 43_200.0, ["High"]), "agreement_pct")


@query(
    "availability",
    """SELECT c_custkey, coalesce(bool_or(o_orderstatus = 'O'), false) AS "has_O", coalesce(bool_or(o_orderstatus = 'F'), false) AS "has_F", coalesce(bool_or(o_orderstatus = 'P'), false) AS "has_P" FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def availability(spark, sf_dir):
    manifest = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("kind"))
    return quality.availability(table(spark, sf_dir, "customer").select("c_custkey"), manifest, ["c_custkey"], ["O", "F", "P"])


@query(
    "availability_totals",
    """WITH h AS (SELECT c_custkey, any_value(c_acctbal) AS bal, coalesce(bool_or(o_orderstatus = 'O'), false) AS o, coalesce(bool_or(o_orderstatus = 'F'), false) AS f, coalesce(bool_or(o_orderstatus = 'P'), false) AS p FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
    SELECT count(*) AS n_sessions, count(*) FILTER (o) AS "n_O", count(*) FILTER (f) AS "n_F", count(*) FILTER (p) AS "n_P", round(avg(bal) FILTER (p), 4) AS "mean_rate_P", round(sum(bal) / 3600, 4) AS hours FROM h""",
)
def availability_totals(spark, sf_dir):
    manifest = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("kind"))
    has = quality.availability(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), manifest, ["c_custkey"], ["O", "F", "P"])
    return rounded(quality.availability_totals(has, ["O", "F", "P"], {"P": "c_acctbal"}, "c_acctbal"), "mean_rate_P", "hours", digits=4)


META = EV + """, b AS (SELECT user_id, max(t) - min(t) AS d, count(*) AS n FROM ev GROUP BY user_id), f AS (SELECT user_id, count(*) AS fn, avg(CAST(value > 10 AS DOUBLE)) * 100 AS fp FROM ev WHERE event_type = 'view' GROUP BY user_id)"""


def metadata(spark, sf_dir):
    ev = events(spark, sf_dir)
    return quality.session_metadata(ev, {"face": (ev.filter("event_type = 'view'"), F.col("value") > 10)}, K, "t")


@query(
    "session_metadata",
    f"WITH {META} SELECT user_id, round(d, 4) AS duration_s, n AS n_rows, coalesce(fn, 0) AS face_rows, round(fp, 6) AS face_detected_pct FROM b LEFT JOIN f USING (user_id)",
)
def session_metadata(spark, sf_dir):
    return rounded(metadata(spark, sf_dir).withColumn("duration_s", F.round("duration_s", 4)), "face_detected_pct")


@query("metadata_totals", f"WITH {META} SELECT count(*) AS n_sessions, round(sum(d) / 3600, 4) AS hours, CAST(sum(n) AS BIGINT) AS n_rows FROM b")
def metadata_totals(spark, sf_dir):
    return rounded(quality.metadata_totals(metadata(spark, sf_dir)), "hours", digits=4)


@query(
    "session_provenance",
    f"""WITH {PING}, t AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS x FROM events WHERE value > 100 GROUP BY user_id)
    SELECT u.user_id, 'anchor' AS sync_method, round(intercept, 4) AS sync_offset_s, coalesce(t.x, []) AS exceptions FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN cal USING (user_id) LEFT JOIN t ON t.user_id = u.user_id""",
)
def session_provenance(spark, sf_dir):
    ev = events(spark, sf_dir)
    sync = calibrated(spark, sf_dir).select(*K, F.lit("anchor").alias("method"), F.round("intercept", 4).alias("offset_s"))
    tags = ev.filter("value > 100").select(*K, F.col("event_type").alias("tag"))
    out = quality.add_provenance(ev.select(*K).distinct(), sync, tags, K)
    return out.select(*K, F.col("sync.method").alias("sync_method"), F.col("sync.offset_s").alias("sync_offset_s"), "exceptions")


@query(
    "residual_detections",
    """WITH d AS (SELECT user_id, value / 100.0::DOUBLE AS conf, CASE WHEN event_id % 4 <> 0 THEN (event_id % 600)::DOUBLE END AS sharp FROM events WHERE event_type <> 'view')
    SELECT u.user_id, (SELECT count(*) FROM events e WHERE e.user_id = u.user_id) AS n_checked, coalesce(x.n, 0) AS n_flagged, round(coalesce(x.n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM events e WHERE e.user_id = u.user_id), 6) AS pct_flagged
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id, count(*) FILTER (conf >= 0.9 AND coalesce(sharp >= 300, true)) AS n FROM d GROUP BY user_id) x USING (user_id)""",
)
def residual_detections(spark, sf_dir):
    ev = events(spark, sf_dir)
    found = ev.filter("event_type <> 'view'").select(
        *K, (F.col("value") / 100.0).alias("conf"), F.when(F.pmod("event_id", F.lit(4)) != 0, F.pmod("event_id", F.lit(600)).cast("double")).alias("sharpness")
    )
    return rounded(quality.residual_summary(found, ev, K), "pct_flagged")


BOX = f"""{SER}, bx AS (SELECT user_id, i, CASE WHEN event_type = 'error' THEN value END AS box FROM ser),
    fb AS (SELECT *, last_value(box IGNORE NULLS) OVER {W}) AS p, max(CASE WHEN box IS NOT NULL THEN i END) OVER {W}) AS pi, first_value(box IGNORE NULLS) OVER {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM bx)"""


def boxes(spark, sf_dir):
    b = series(spark, sf_dir).select(*K, "i", F.when(F.col("event_type") == "error", F.col("value")).alias("box"))
    return quality.fill_boxes(b, K, "box")


@query(
    "fill_boxes",
    f"WITH {BOX} SELECT user_id, i, coalesce(box, p, nx) AS box, box IS NULL AND coalesce(p, nx) IS NOT NULL AS carried, CASE WHEN box IS NULL THEN i - pi END AS gap FROM fb",
)
def fill_boxes(spark, sf_dir):
    return boxes(spark, sf_dir)


@query(
    "fill_summary",
    f"WITH {BOX} SELECT user_id, count(*) FILTER (box IS NULL AND coalesce(p, nx) IS NOT NULL) AS n_carried, coalesce(max(CASE WHEN box IS NULL THEN i - pi END), 0) AS max_gap FROM fb GROUP BY user_id",
)
def fill_summary(spark, sf_dir):
    return quality.fill_summary(boxes(spark, sf_dir), K)


# Native events, responses and spacing.


@query(
    "native_candidates",
    f"""WITH {SER}, v AS (SELECT *, floor(value / 20) AS x, event_id % 6 <> 0 AS m FROM ser), r0 AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, m ORDER BY i) AS g FROM v),
    r AS (SELECT user_id, g, min(i) AS i0, max(i) AS i1, max(abs(x)) AS pk FROM r0 WHERE m GROUP BY user_id, g),
    b AS (SELECT a.user_id, a.i, r.i0, r.i1, pk, abs(lead(x) OVER (PARTITION BY a.user_id, a.g ORDER BY i) - 2 * x + lag(x) OVER (PARTITION BY a.user_id, a.g ORDER BY i)) AS bend FROM r0 a JOIN r ON r.user_id = a.user_id AND r.g = a.g WHERE m)
    SELECT user_id, i FROM b WHERE i IN (i0, i1) OR bend > 1e-7 * greatest(1, pk)""",
)
def native_candidates(spark, sf_dir):
    v = series(spark, sf_dir).withColumns({"x": F.floor(F.col("value") / 20).cast("double"), "m": F.pmod("event_id", F.lit(6)) != 0})
    return E.native_candidates(v, K, "x", "m").select(*K, "i")


@query(
    "greedy_spacing",
    f"""WITH RECURSIVE {EV}, s AS (SELECT user_id, event_id, t FROM ev),
    g AS (SELECT user_id, min(t) AS t FROM s GROUP BY user_id UNION ALL SELECT g.user_id, (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t > g.t + 172800) FROM g WHERE (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t > g.t + 172800) IS NOT NULL)
    SELECT s.user_id, s.event_id FROM s JOIN g ON g.user_id = s.user_id AND g.t = s.t""",
)
def greedy_spacing(spark, sf_dir):
    every = events(spark, sf_dir).select(*K, "event_id", "t")
    return E.greedy_spacing(every, K, "t", 172_800.0, width(sf_dir)).select(*K, "event_id")


@query(
    "recover_native_events",
    f"""WITH RECURSIVE {SER}, v AS (SELECT *, floor(value / 20) AS x, event_id % 6 <> 0 AS m FROM ser), r0 AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, m ORDER BY i) AS g FROM v),
    r AS (SELECT user_id, g, min(i) AS i0, max(i) AS i1, max(abs(x)) AS pk FROM r0 WHERE m GROUP BY user_id, g),
    b AS (SELECT a.user_id, a.i, a.t, a.x, r.i0, r.i1, pk, abs(lead(x) OVER (PARTITION BY a.user_id, a.g ORDER BY i) - 2 * x + lag(x) OVER (PARTITION BY a.user_id, a.g ORDER BY i)) AS bend FROM r0 a JOIN r ON r.user_id = a.user_id AND r.g = a.g WHERE m),
    s AS MATERIALIZED (SELECT user_id, i, t, x FROM b WHERE i IN (i0, i1) OR bend > 1e-7 * greatest(1, pk)),
    g AS (SELECT user_id, min(t) AS t FROM s GROUP BY user_id UNION ALL SELECT g.user_id, (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t > g.t + 43200) FROM g WHERE (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t > g.t + 43200) IS NOT NULL)
    SELECT s.user_id, s.i, s.x FROM s JOIN g ON g.user_id = s.user_id AND g.t = s.t""",
)
def recover_native_events(spark, sf_dir):
    v = series(spark, sf_dir).withColumns({"x": F.floor(F.col("value") / 20).cast("double"), "m": F.pmod("event_id", F.lit(6)) != 0})
    return E.recover_events(v, K, "t", "x", "m", width(sf_dir), 43_200.0).select(*K, "i", "x")


@query(
    "response_window",
    f"""WITH {EV}, e AS (SELECT user_id, event_id, t, value * 1000 AS r FROM ev WHERE event_type = 'purchase'),
    x AS (SELECT e.user_id, e.event_id, k.kind, count(*) FILTER (s.t <= e.t - k.c) AS n0, count(*) FILTER (s.t >= e.t - k.c) AS n1, max(s.value) FILTER (s.t >= e.t - k.c) - min(s.value) FILTER (s.t <= e.t - k.c) AS rise
      FROM e CROSS JOIN (VALUES ('event', 0), ('control', 259200)) k(kind, c) JOIN ev s ON s.user_id = e.user_id AND s.t >= e.t - k.c - 200000 AND s.t <= e.t - k.c + e.r + 200000 GROUP BY ALL)
    SELECT e.user_id, e.event_id, round(max(rise) FILTER (kind = 'event' AND n0 >= 3 AND n1 >= 3), 6) AS response, round(max(rise) FILTER (kind = 'control' AND n0 >= 3 AND n1 >= 3), 6) AS control_response FROM e LEFT JOIN x USING (user_id, event_id) GROUP BY ALL""",
)
def response_window(spark, sf_dir):
    ev = events(spark, sf_dir)
    moments = ev.filter("event_type = 'purchase'").select(*K, "event_id", "t", (F.col("value") * 1000).alias("r"))
    out = E.response_window(moments, ev.select(*K, "t", "value"), K, "t", "value", "r", "event_id", 400_000.0, 200_000.0, 200_000.0, 259_200.0, 3)
    return rounded(out.select(*K, "event_id", "response", "control_response"), "response", "control_response")


@query(
    "native_event_table",
    f"""WITH {EV}, a AS (SELECT user_id, event_id, t, value AS amp FROM ev WHERE event_type IN ('purchase', 'signup')), r AS (SELECT user_id, t AS rt, value * 100 AS rise FROM ev WHERE event_type = 'error'), s AS (SELECT user_id, t AS st, value AS sv FROM ev WHERE event_type IN ('view', 'click')),
    w AS (SELECT user_id, min(st) AS w0, max(st) AS w1, arg_max(sv, st) AS vend FROM s GROUP BY user_id),
    j AS (SELECT a.*, p.rt AS pt, p.rise AS pr, n.rt AS nt, n.rise AS nr FROM a ASOF LEFT JOIN r p ON a.user_id = p.user_id AND a.t >= p.rt ASOF LEFT JOIN r n ON a.user_id = n.user_id AND a.t <= n.rt),
    k AS (SELECT user_id, event_id, t, amp, CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t - pt <= nt - t) THEN CASE WHEN t - pt <= 86400 THEN pr END ELSE CASE WHEN nt - t <= 86400 THEN nr END END AS rise FROM j),
    m AS (SELECT k.*, w0, vend FROM k JOIN w USING (user_id) WHERE t BETWEEN w0 AND w1),
    z AS (SELECT m.*, coalesce(b.sv, vend) AS v0, coalesce(c.sv, vend) AS v1, coalesce(d.sv, vend) AS c0, coalesce(e.sv, vend) AS c1 FROM m ASOF LEFT JOIN s b ON m.user_id = b.user_id AND m.t <= b.st ASOF LEFT JOIN s c ON m.user_id = c.user_id AND m.t + m.rise <= c.st
       ASOF LEFT JOIN s d ON m.user_id = d.user_id AND m.t - 86400 <= d.st ASOF LEFT JOIN s e ON m.user_id = e.user_id AND m.t - 86400 + m.rise <= e.st)
    SELECT user_id, event_id, round(t - w0, 3) AS elapsed_s, rise AS rise_time, CASE WHEN rise IS NOT NULL THEN round(v1 - v0, 6) END AS signal_rise, CASE WHEN rise IS NOT NULL AND t - 86400 > w0 THEN round(c1 - c0, 6) END AS control_rise FROM z""",
)
def native_event_table(spark, sf_dir):
    ev = events(spark, sf_dir)
    amplitude = ev.filter(F.col("event_type").isin("purchase", "signup")).select(*K, "event_id", "t", F.col("value").alias("amplitude"))
    rise = ev.filter("event_type = 'error'").select(*K, "t", (F.col("value") * 100).alias("rise_time"))
    signal = ev.filter(F.col("event_type").isin("view", "click")).select(*K, "t", "value")
    windows = signal.groupBy(*K).agg(F.min("t").alias("w_start"), F.max("t").alias("w_end"))
    out = E.native_event_table(amplitude, rise, signal, windows, K, "t", "value", width(sf_dir), 86_400.0, 86_400.0)
    return rounded(out.select(*K, "event_id", F.round("elapsed_s", 3).alias("elapsed_s"), "rise_time", "signal_rise", "control_rise"), "signal_rise", "control_rise")


@query(
    "beat_consistency",
    f"""WITH {SER}, d AS (SELECT user_id, t - lag(t) OVER {W}) AS d, value FROM ser) SELECT user_id, round(avg(CAST(abs(d - value * 1000000 / 1000.0::DOUBLE) < 20000 AS DOUBLE)) FILTER (d IS NOT NULL), 6) AS per_beat_frac FROM d GROUP BY user_id""",
)
def beat_consistency(spark, sf_dir):
    beats = series(spark, sf_dir).withColumn("ibi", F.col("value") * 1_000_000)
    return rounded(E.beat_consistency(beats, K, "t", "ibi", tol_s=20_000.0), "per_beat_frac")


@query(
    "stop_instants",
    f"""WITH RECURSIVE {SER}, f AS (SELECT user_id, i, t, max(value) OVER {W} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS top, lag(value, 3) OVER {W}) AS early, max(t) OVER (PARTITION BY user_id) AS fin FROM ser),
    s AS (SELECT user_id, i, t FROM f WHERE i >= 4 AND top < 25 AND early > 30 AND t + 100000 < fin),
    g AS (SELECT user_id, min(t) AS t FROM s GROUP BY user_id UNION ALL SELECT g.user_id, (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t >= g.t + 259200) FROM g WHERE (SELECT min(s.t) FROM s WHERE s.user_id = g.user_id AND s.t >= g.t + 259200) IS NOT NULL)
    SELECT s.user_id, s.i FROM s JOIN g ON g.user_id = s.user_id AND g.t = s.t""",
)
def stop_instants(spark, sf_dir):
    found = E.stop_instants(series(spark, sf_dir).select(*K, "i", "t", "value"), K, "t", "value", 3, width(sf_dir), 1, 25.0, 30.0, 259_200.0, 100_000.0)
    return found.select(*K, "i")


@query(
    "stop_verdicts",
    """WITH r AS (SELECT event_id, value / greatest(50.0, 1e-6) AS a, (event_id % 100) / 50.0::DOUBLE AS l FROM events)
    SELECT event_id, CASE WHEN a < 0.35 AND l > 0.5 THEN 'aligned, moving after the lead' WHEN a < 0.35 THEN 'aligned' WHEN a > 0.5 AND l < 0.35 THEN 'offset' ELSE 'inconclusive' END AS verdict FROM r""",
)
def stop_verdicts(spark, sf_dir):
    ev = events(spark, sf_dir)
    return ev.select("event_id", E.stop_verdict(F.col("value"), F.pmod("event_id", F.lit(100)).cast("double"), F.lit(50.0)).alias("verdict"))


# Native formats written out as text by Spark and read back.


@query(
    "parse_packets",
    f"""WITH {EV}, p AS (SELECT user_id, event_id, t, CASE event_type WHEN 'view' THEN 'EA' WHEN 'click' THEN 'HR' WHEN 'error' THEN 'AX' WHEN 'signup' THEN 'RB' ELSE 'T1' END AS tag, CAST(event_id % 3 + 1 AS INT) AS n, value FROM ev),
    k AS (SELECT *, CASE tag WHEN 'EA' THEN 15.0::DOUBLE WHEN 'HR' THEN 1 WHEN 'AX' THEN 25 ELSE 7.5 END AS fs FROM p WHERE tag <> 'RB' AND event_id % 10 <> 0)
    SELECT user_id, CASE tag WHEN 'EA' THEN 'EDA' WHEN 'HR' THEN 'HR' WHEN 'AX' THEN 'ACC_x' ELSE 'TEMP_CONTACT' END AS channel, round(floor(t) + j * (1000.0 / fs), 4) AS ts_ms, round(value + j, 4) AS value FROM k, LATERAL (SELECT unnest(generate_series(0, n - 1)) AS j)""",
)
def parse_packets(spark, sf_dir):
    ev = events(spark, sf_dir)
    kinds = {"view": "EA", "click": "HR", "error": "AX", "signup": "RB", "purchase": "T1"}
    tag = device.constant_map(kinds)[F.col("event_type")]
    n = (F.pmod("event_id", F.lit(3)) + 1).cast("int")
    payload = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.round(F.col("value") + j, 4).cast("string"))
    # every tenth packet claims one value more than it carries
    claimed = n + F.when(F.pmod("event_id", F.lit(10)) == 0, 1).otherwise(0)
    line = F.concat_ws(",", F.floor("t").cast("string"), F.col("event_id").cast("string"), claimed.cast("string"), tag, F.lit("1"), F.lit("100"), F.concat_ws(",", payload))
    samples = device.parse_packets(ev.select(*K, line.alias("value")), K)
    return device.name_channels(samples).select(*K, "channel", F.round("ts_ms", 4).alias("ts_ms"), F.round("value", 4).alias("value"))


@query(
    "main_recording",
    """WITH f AS (SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'r' || o_orderkey || '.csv' WHEN '2-HIGH' THEN 'r' || o_orderkey || '.csv' WHEN '3-MEDIUM' THEN 'r' || o_orderkey || '_EA.csv' ELSE 'r' || (o_orderkey - 1) || '_timesyncs.csv' END AS name, CAST(o_totalprice AS BIGINT) AS length FROM orders),
    m AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY length DESC, name DESC) AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM f WHERE NOT contains(name, '_'))
    SELECT m.o_custkey, m.name, m.length, m.n AS n_candidates, s.name AS sync_name FROM m LEFT JOIN f s ON s.o_custkey = m.o_custkey AND s.name = replace(m.name, '.csv', '_timesyncs.csv') WHERE r = 1""",
)
def main_recording(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey").cast("string")
    name = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.concat(F.lit("r"), number, F.lit(".csv")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("r"), number, F.lit("_EA.csv")))
        .otherwise(F.concat(F.lit("r"), (F.col("o_orderkey") - 1).cast("string"), F.lit("_timesyncs.csv")))
    )
    files = o.select("o_custkey", name.alias("name"), F.rint("o_totalprice").cast("bigint").alias("length"))
    return device.pick_main_recording(files, ["o_custkey"])


@query(
    "parse_native_telemetry",
    f"""WITH {CLOCK}, f AS (SELECT user_id, i, elapsed, value, first_value(tod % 60) OVER {W}) AS s0 FROM ck WHERE event_id % 12 <> 0 OR i = 0)
    SELECT user_id, round(1704067200 + 3600 + floor(s0) + elapsed, 3) AS unix_time, round(24 + value / 100.0::DOUBLE / 60, 6) AS lat, round(-(46 + 30.0::DOUBLE / 60), 6) AS lon, value AS gps_speed_kmh, CAST(NULL AS DOUBLE) AS throttle_pct, 'Normal' AS label FROM f""",
)
def parse_native_telemetry(spark, sf_dir):
    log = logger(spark, sf_dir)
    second = F.floor(F.pmod("tod", F.lit(60.0))).cast("string")
    bad = (F.pmod("event_id", F.lit(12)) == 0) & (F.col("i") > 0)
    raw = log.select(
        *K, "i",
        F.concat(F.lit("100"), F.lpad(second, 2, "0")).alias("UTC time"),
        F.when(bad, "?").otherwise(F.col("elapsed").cast("string")).alias(" Elapsed time (s) "),
        F.concat(F.lit("24°"), F.format_string("%.4f", F.col("value") / 100.0), F.lit(" N")).alias("Latitude"),
        F.lit("46°30.0 W").alias("Longitude"),
        F.col("value").cast("string").alias("Speed (km/h)"),
        F.lit("n/a").alias("Accelerator_Pedal_Position (%)"),
        F.lit("Normal").alias("Label"),
    )
    out = sessions.parse_native(raw, K, "2024-01-01", "i")
    return out.select(*K, F.round("unix_time", 3).alias("unix_time"), r6("lat").alias("lat"), r6("lon").alias("lon"), "gps_speed_kmh", "throttle_pct", "label")


@query(
    "raw_tier",
    f"""WITH {EV}, w AS (SELECT user_id, min(t) + 100000 AS w0, max(t) - 100000 AS w1 FROM ev GROUP BY user_id), k AS (SELECT ev.user_id, event_id, t, w0 FROM ev JOIN w USING (user_id) WHERE t BETWEEN w0 AND w1)
    SELECT user_id, event_id, round(t - min(t) OVER (PARTITION BY user_id), 4) AS elapsed_s, round(t - w0, 4) AS window_elapsed_s FROM k""",
)
def raw_tier(spark, sf_dir):
    ev = events(spark, sf_dir).select(*K, "event_id", "t", "event_type")
    windows = ev.groupBy(*K).agg((F.min("t") + 100_000).alias("w_start"), (F.max("t") - 100_000).alias("w_end"))
    first = sinks.build_raw_tier(ev, windows, K, "t", ("event_type",))
    other = sinks.build_raw_tier(ev, windows, K, "t", ("event_type",), "window").select("event_id", F.col("elapsed_s").alias("window_elapsed_s"))
    return rounded(first.join(other, "event_id").select(*K, "event_id", "elapsed_s", "window_elapsed_s"), "elapsed_s", "window_elapsed_s", digits=4)


@query(
    "required_files",
    """WITH m AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS kind FROM orders), s AS (SELECT c_custkey AS k FROM customer)
    SELECT k AS c_custkey, NULL AS kind, 'missing session' AS problem FROM s WHERE k NOT IN (SELECT k FROM m) UNION ALL SELECT s.k, r.kind, 'missing required' FROM s CROSS JOIN (VALUES ('O'), ('F')) r(kind)
    WHERE s.k IN (SELECT k FROM m) AND NOT EXISTS (SELECT 1 FROM m WHERE m.k = s.k AND m.kind = r.kind)
    UNION ALL SELECT k, kind, 'size mismatch' FROM (SELECT o_custkey AS k, o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY ALL) WHERE n > 5""",
)
def required_files(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("kind")).agg(F.count(F.lit(1)).alias("size"))
    source = counts.withColumn("size", F.least("size", F.lit(5)))
    return sinks.check_required_files(counts, table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], {"O": True, "F": True, "P": False}, source)


@query(
    "fixed_decimals",
    "SELECT o_orderkey, printf('%.6f', o_totalprice) AS o_totalprice FROM orders",
)
def fixed_decimals(spark, sf_dir):
    return sinks.fixed_decimals(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))


@query("append_column", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_acctbal > 0 AS positive FROM supplier")
def append_column(spark, sf_dir):
    return sinks.append_column(table(spark, sf_dir, "supplier"), "positive", F.col("s_acctbal") > 0)


@query("file_manifest")
def file_manifest(spark, sf_dir):
    return sinks.build_manifest(spark, sf_dir)


@query(
    "anchor_shift_at_first_ping",
    f"""WITH {PING}, st AS (SELECT user_id, min(device_ms) AS ms, min(floor(sent_s)) AS s FROM pg GROUP BY user_id)
    SELECT user_id, round(y0_s + intercept - (s + (x0_ms - ms) / 1000.0::DOUBLE), 3) AS shift_s FROM cal JOIN st USING (user_id)""",
)
def anchor_shift_at_first_ping(spark, sf_dir):
    starts = pings(spark, sf_dir).groupBy(*K).agg(F.min("device_ms").alias("start_ms"), F.min(F.floor("sent_s")).cast("double").alias("start_s"))
    old, new = clock.anchors_at_first_ping(calibrated(spark, sf_dir), starts, K)
    return rounded(clock.anchor_shift(old, new, K), "shift_s", digits=3)


@query(
    "first_gap_anomalies",
    f"""WITH {CLOCK}, g AS (SELECT user_id, max(tod) FILTER (i = 1) - max(tod) FILTER (i = 0) AS gap FROM ck GROUP BY user_id) SELECT user_id, round(gap, 4) AS first_gap_s FROM g WHERE abs(gap - 30000) > 25000 OR gap <= 0""",
)
def first_gap_anomalies(spark, sf_dir):
    return rounded(clock.first_gap_anomalies(logger(spark, sf_dir), K, "tod", 30_000.0, 25_000.0), "first_gap_s", digits=4)


@query(
    "suffix_coverage",
    "SELECT count(*) AS n_stamped, count(*) FILTER (value > 40) AS n_with_fraction FROM events",
)
def suffix_coverage(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd_HH-mm-ss")
    names = events(spark, sf_dir).select(F.when(F.col("value") > 40, F.concat(stamp, F.lit("-985608.csv"))).otherwise(F.concat(stamp, F.lit(".csv"))).alias("name"))
    return clock.suffix_coverage(names, "name")
