"""Queries on spectra, smoothers and landmark tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import blocks, expanding, frames, posture, rules, spectral
from .registry import SER, query, series, table
from .rule_queries import DRIVE, DRIVE_RULE, PLAIN, drive
from .series_queries import K, r6
from .stat_queries import rounded

W = "(PARTITION BY user_id ORDER BY i"
TYPE = ["event_type"]


def typed(spark, sf_dir):
    """One long series per event type."""
    return series(spark, sf_dir, "event_type").select("event_type", "i", "value")


def dft_sql(src: str, size: int, step: int, nfft: int, window: str, key: str) -> str:
    """CTE `pw`: windowed transforms of {src}({key}, i, x), as re and im per window and bin."""
    return f"""sg AS (SELECT {key}, unnest(generate_series(0, CAST(floor((count(*) - {size}) / {step}.0) AS BIGINT))) AS seg FROM {src} GROUP BY {key} HAVING count(*) >= {size}),
    sw AS (SELECT {src}.{key}, seg, i - seg * {step} AS j, x * ({window}) AS xw FROM {src} JOIN sg ON sg.{key} = {src}.{key} AND i BETWEEN seg * {step} AND seg * {step} + {size - 1}),
    pw AS (SELECT {key}, seg, bin, sum(xw * cos(2 * pi() * bin * j / {nfft})) AS re, sum(xw * sin(2 * pi() * bin * j / {nfft})) AS im FROM sw CROSS JOIN (SELECT unnest(generate_series(0, {nfft // 2})) AS bin) GROUP BY ALL)"""


HANN64 = "0.5 - 0.5 * cos(2 * pi() * (i - seg * 32) / 64)"
U64 = sum((0.5 - 0.5 * math.cos(2 * math.pi * j / 64)) ** 2 for j in range(64))
WELCH = f"""WITH ty AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts), event_id) - 1 AS i, value - avg(value) OVER (PARTITION BY event_type) AS x FROM events),
    {dft_sql("ty", 64, 32, 64, HANN64, "event_type")},
    ps AS (SELECT bin, count(*) AS n_segments, avg((re * re + im * im) / (25 * {U64!r}) * CASE WHEN bin IN (0, 32) THEN 1 ELSE 2 END) AS psd, bin * 25 / 64.0::DOUBLE AS freq_hz FROM pw GROUP BY bin)"""


@query("welch_psd", WELCH + " SELECT bin, n_segments, round(psd, 4) AS psd, freq_hz FROM ps")
def welch_psd(spark, sf_dir):
    return rounded(spectral.welch_psd(typed(spark, sf_dir), TYPE, "value", 64), "psd", digits=4)


@query(
    "band_energy",
    WELCH + " SELECT lo_hz, hi_hz, round(sum(psd) FILTER (freq_hz >= lo_hz AND freq_hz < hi_hz) * 100 / sum(psd), 6) AS pct_power FROM ps CROSS JOIN (VALUES "
    + ", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in zip(spectral.BAND_EDGES, spectral.BAND_EDGES[1:])) + ") b(lo_hz, hi_hz) GROUP BY ALL",
)
def band_energy(spark, sf_dir):
    return rounded(spectral.band_energy(spectral.welch_psd(typed(spark, sf_dir), TYPE, "value", 64)), "pct_power")


@query("cumulative_power", WELCH + " SELECT bin, freq_hz, round(sum(psd) OVER (ORDER BY bin) * 100 / sum(psd) OVER (), 6) AS cum_pct FROM ps")
def cumulative_power(spark, sf_dir):
    return rounded(spectral.cumulative_power(spectral.welch_psd(typed(spark, sf_dir), TYPE, "value", 64)), "cum_pct")


U16 = sum((0.5 - 0.5 * math.cos(2 * math.pi * j / 15)) ** 2 for j in range(16))


@query(
    "spectrogram",
    f"""WITH {SER}, us AS (SELECT user_id, i, value - avg(value) OVER (PARTITION BY user_id) AS x FROM ser), {dft_sql("us", 16, 4, 32, "0.5 - 0.5 * cos(2 * pi() * (i - seg * 4) / 15)", "user_id")}
    SELECT user_id, seg, (seg * 4 + 8) / 25.0::DOUBLE AS t_s, CAST(bin AS INT) AS bin, round((re * re + im * im) / (25 * {U16!r}) * CASE WHEN bin IN (0, 16) THEN 1 ELSE 2 END, 5) AS power, bin * 25 / 32.0::DOUBLE AS freq_hz FROM pw""",
)
def spectrogram(spark, sf_dir):
    return rounded(spectral.spectrogram(series(spark, sf_dir), K, "value", 16, 0.75, 32), "power", digits=5)


@query(
    "segment_spectrum",
    f"""WITH {SER}, st AS (SELECT user_id, i - 8 AS i, value - avg(value) OVER (PARTITION BY user_id) AS x FROM ser WHERE i BETWEEN 8 AND 39), {dft_sql("st", 32, 32, 32, "1", "user_id")}
    SELECT user_id, CAST(bin AS INT) AS bin, round(sqrt(re * re + im * im), 5) AS magnitude, bin * 25 / 32.0::DOUBLE AS freq_hz FROM pw""",
)
def segment_spectrum(spark, sf_dir):
    return rounded(spectral.spectrum(series(spark, sf_dir), K, "value", 8, 32), "magnitude", digits=5)


LOWPASS = f"""{SER}, nn AS (SELECT user_id, count(*) AS n, floor(3.0 * count(*) / 25) AS m0 FROM ser GROUP BY user_id),
    lp AS (SELECT a.user_id, a.i, any_value(a.value) AS value, sum(b.value * CASE WHEN a.i = b.i THEN (2 * m0 + 1) / n ELSE sin(pi() * (a.i - b.i) * (2 * m0 + 1) / n) / (n * sin(pi() * (a.i - b.i) / n)) END) AS smooth
       FROM ser a JOIN ser b ON a.user_id = b.user_id JOIN nn ON nn.user_id = a.user_id GROUP BY a.user_id, a.i)"""


@query("fft_lowpass", f"WITH {LOWPASS} SELECT user_id, i, round(smooth, 5) AS smooth FROM lp")
def fft_lowpass(spark, sf_dir):
    out = spectral.fft_lowpass(series(spark, sf_dir).select(*K, "i", "value"), K, "value", 3.0, "smooth")
    return out.select(*K, "i", F.round("smooth", 5).alias("smooth"))


HAAR = f"""{SER}, hn AS (SELECT user_id, count(*) AS n, arg_max(value, i) AS last, CAST(ceil(count(*) / 4.0) * 4 AS BIGINT) AS p FROM ser GROUP BY user_id),
    hp AS (SELECT user_id, i, value FROM ser UNION ALL SELECT user_id, unnest(generate_series(n, p - 1)), last FROM hn),
    h4 AS (SELECT user_id, CAST(floor(i / 4) AS BIGINT) AS g, max(value) FILTER (i % 4 = 0) AS a, max(value) FILTER (i % 4 = 1) AS b, max(value) FILTER (i % 4 = 2) AS c, max(value) FILTER (i % 4 = 3) AS d FROM hp GROUP BY ALL),
    hd AS (SELECT user_id, (a - b) / sqrt(2) AS d FROM h4 UNION ALL SELECT user_id, (c - d) / sqrt(2) FROM h4), hm AS (SELECT user_id, median(d) AS m FROM hd GROUP BY user_id),
    ht AS (SELECT hd.user_id, median(abs(d - m)) / 0.6745 * sqrt(2 * ln(greatest(any_value(p), 2))) AS thr FROM hd JOIN hm USING (user_id) JOIN hn USING (user_id) GROUP BY hd.user_id),
    hc AS (SELECT h4.*, (a + b + c + d) / 2 AS s2, (a + b - c - d) / 2 AS e, (a - b) / sqrt(2) AS d1, (c - d) / sqrt(2) AS d2, thr FROM h4 JOIN ht USING (user_id)),
    hs AS (SELECT user_id, g, s2, sign(e) * greatest(abs(e) - thr, 0) AS e, sign(d1) * greatest(abs(d1) - thr, 0) AS d1, sign(d2) * greatest(abs(d2) - thr, 0) AS d2 FROM hc),
    hr AS (SELECT user_id, g * 4 + k AS i, CASE k WHEN 0 THEN ((s2 + e) / sqrt(2) + d1) / sqrt(2) WHEN 1 THEN ((s2 + e) / sqrt(2) - d1) / sqrt(2) WHEN 2 THEN ((s2 - e) / sqrt(2) + d2) / sqrt(2) ELSE ((s2 - e) / sqrt(2) - d2) / sqrt(2) END AS y
       FROM hs CROSS JOIN (VALUES (0), (1), (2), (3)) q(k))"""


@query("haar_denoise", f"WITH {HAAR} SELECT hr.user_id, hr.i, round(y, 5) AS smooth FROM hr JOIN ser ON ser.user_id = hr.user_id AND ser.i = hr.i")
def haar_denoise(spark, sf_dir):
    out = spectral.haar_denoise(series(spark, sf_dir).select(*K, "i", "value"), K, "value", "smooth", 2)
    return out.select(*K, "i", F.round("smooth", 5).alias("smooth"))


@query(
    "filter_metrics",
    f"""WITH {LOWPASS}, m AS (SELECT *, avg(value) OVER {W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mean5 FROM lp),
    a AS (SELECT user_id, stddev_samp(value) FILTER (i BETWEEN 5 AND 24) AS s, max(abs(value)) FILTER (i BETWEEN 25 AND 39) AS p, stddev_samp(smooth) FILTER (i BETWEEN 5 AND 24) AS s1, max(abs(smooth)) FILTER (i BETWEEN 25 AND 39) AS p1, corr(smooth, mean5) AS r1,
       stddev_samp(mean5) FILTER (i BETWEEN 5 AND 24) AS s2, max(abs(mean5)) FILTER (i BETWEEN 25 AND 39) AS p2 FROM m GROUP BY user_id)
    SELECT user_id, 'smooth' AS filter, round(s1, 4) AS noise_sd, round((1 - s1 / s) * 100, 4) AS noise_reduction_pct, round(p1 / p * 100, 4) AS peak_retained_pct, round(r1, 5) AS r_adopted FROM a
    UNION ALL SELECT user_id, 'mean5', round(s2, 4), round((1 - s2 / s) * 100, 4), round(p2 / p * 100, 4), 1.0::DOUBLE FROM a""",
)
def filter_metrics(spark, sf_dir):
    base = series(spark, sf_dir).select(*K, "i", "value")
    both = frames.rolling_centred(spectral.fft_lowpass(base, K, "value", 3.0, "smooth"), K, "value", 5, "avg", "mean5")
    out = spectral.filter_metrics(both, K, "value", ["smooth", "mean5"], "mean5", F.col("i").between(5, 24), F.col("i").between(25, 39))
    return rounded(out.withColumn("r_adopted", F.round("r_adopted", 5)), "noise_sd", "noise_reduction_pct", "peak_retained_pct", digits=4)


@query(
    "fill_linear",
    f"""WITH {SER}, v AS (SELECT user_id, i, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM ser),
    b AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER {W}) AS pi, last_value(v IGNORE NULLS) OVER {W}) AS pv, min(CASE WHEN v IS NOT NULL THEN i END) OVER {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
       first_value(v IGNORE NULLS) OVER {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv FROM v)
    SELECT user_id, i, round(CASE WHEN v IS NOT NULL THEN v WHEN pi IS NULL THEN nv WHEN ni IS NULL THEN pv ELSE pv + (nv - pv) / (ni - pi) * (i - pi) END, 6) AS value FROM b""",
)
def fill_linear(spark, sf_dir):
    holes = series(spark, sf_dir).select(*K, "i", F.when(F.pmod("event_id", F.lit(4)) != 0, F.col("value")).alias("value"))
    return rounded(spectral.fill_linear(holes, K, "value"), "value")


@query("smoothed_rule_labels")
def smoothed_rule_labels(spark, sf_dir):
    """The rule with its median and mean replaced by wavelet denoising."""
    out = rules.label_v2(drive(spark, sf_dir), K, PLAIN, smoother=spectral.smoother("haar", K))
    return out.select(*K, "i", "label")


@query(
    "candidate_rules",
    f"""WITH {DRIVE}, n AS (SELECT user_id, max(i) AS m FROM dr GROUP BY user_id), cg AS (SELECT dr.*, CASE WHEN i = 0 THEN lead(speed_kph) OVER {W}) / 3.6 - speed_kph / 3.6 WHEN i = m THEN speed_kph / 3.6 - lag(speed_kph) OVER {W}) / 3.6
       ELSE (lead(speed_kph) OVER {W}) / 3.6 - lag(speed_kph) OVER {W}) / 3.6) / 2 END * 25 AS sl FROM dr JOIN n USING (user_id)),
    cm AS (SELECT *, CASE WHEN count(sl) OVER {W} ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) >= 5 THEN avg(sl) OVER {W} ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) END AS mn,
       avg(lon_acc_g) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS lon, avg(abs(lat_acc_g)) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS lat, max(throttle_pct) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS thr FROM cg),
    fl AS (SELECT *, lon <= -0.25 AND gps_speed_kmh > 15 AS b, lon >= 0.25 AND gps_speed_kmh > 15 AND thr > 25 AS a, lat >= 0.6 AND gps_speed_kmh > 30 AS tt FROM cm),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, b ORDER BY i) AS gb, i - row_number() OVER (PARTITION BY user_id, a ORDER BY i) AS ga, i - row_number() OVER (PARTITION BY user_id, tt ORDER BY i) AS gt FROM fl),
    rb AS (SELECT user_id, min(i) AS i0, max(i) AS i1 FROM g WHERE b GROUP BY user_id, gb HAVING count(*) >= 2), ra AS (SELECT user_id FROM g WHERE a GROUP BY user_id, ga HAVING count(*) >= 2), rt AS (SELECT user_id FROM g WHERE tt GROUP BY user_id, gt HAVING count(*) >= 2),
    cf AS (SELECT rb.user_id, rb.i0, min(mn) AS lo FROM rb JOIN g ON g.user_id = rb.user_id AND g.i BETWEEN rb.i0 - 13 AND rb.i1 GROUP BY ALL)
    SELECT 'A' AS config, (SELECT count(*) FROM ra) AS n_accel, (SELECT count(*) FROM rb) AS n_brake, (SELECT count(*) FROM rt) AS n_turn, (SELECT count(*) FROM cf WHERE lo <= -0.2 * 9.81) AS n_brake_confirmed""",
)
def candidate_rules(spark, sf_dir):
    return rules.candidate_rules(drive(spark, sf_dir), K, {"A": (3, 2, 0.25, 0.25, 0.6)}, DRIVE_RULE)


# Landmarks: an embedding is 32 points; `label` is the session and `vec_id` the frame.


def landmarks(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    points = F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda j: F.struct(F.get("embedding", j * 2).cast("double").alias("x"), F.get("embedding", j * 2 + 1).cast("double").alias("y")),
    )
    flat = e.select("label", "vec_id", points.alias("points"), *[F.col("embedding")[n].cast("double").alias(c) for n, c in enumerate(("x", "y", "x2", "y2"))])
    return blocks.index_rows(flat, ["label"], ["vec_id"], blocks.chunk_of("vec_id", 1_000_000.0))


LM = """lm AS (SELECT label, vec_id, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS x2, embedding[4]::DOUBLE AS y2 FROM embeddings)"""


@query(
    "motion_energy",
    f"""WITH {LM}, p AS (SELECT *, lag(embedding) OVER (PARTITION BY label ORDER BY i) AS pe FROM lm)
    SELECT label, vec_id, round(CASE WHEN pe IS NOT NULL THEN list_sum(list_transform(generate_series(1, 32), lambda j: sqrt((embedding[2 * j - 1]::DOUBLE - pe[2 * j - 1]::DOUBLE) ** 2 + (embedding[2 * j]::DOUBLE - pe[2 * j]::DOUBLE) ** 2))) END, 6) AS motion_energy FROM p""",
)
def motion_energy(spark, sf_dir):
    return rounded(posture.motion_energy(landmarks(spark, sf_dir), ["label"], "points").select("label", "vec_id", "motion_energy"), "motion_energy")


@query(
    "posture_deviation",
    f"""WITH {LM}, m AS (SELECT *, median(x) OVER (PARTITION BY label ORDER BY i) AS mx, median(y) OVER (PARTITION BY label ORDER BY i) AS my FROM lm)
    SELECT label, vec_id, round(CASE WHEN i >= 4 THEN sqrt((x - mx) ** 2 + (y - my) ** 2) END, 6) AS posture_deviation FROM m""",
)
def posture_deviation(spark, sf_dir):
    out = posture.posture_deviation(landmarks(spark, sf_dir).select("label", "vec_id", "i", "x", "y"), ["label"], "x", "y")
    return rounded(out.select("label", "vec_id", "posture_deviation"), "posture_deviation")


@query(
    "expanding_median",
    f"WITH {SER} SELECT user_id, i, round(median(value) OVER {W}), 6) AS med FROM ser",
)
def expanding_median(spark, sf_dir):
    out = expanding.expanding_median(series(spark, sf_dir).select(*K, "i", "value"), K, "value", "med")
    return out.select(*K, "i", r6("med").alias("med"))


@query(
    "point_displacement",
    f"""WITH {LM}, p AS (SELECT *, lag(x) OVER w AS a, lag(y) OVER w AS b, lag(x2) OVER w AS c, lag(y2) OVER w AS d, vec_id - lag(vec_id) OVER w AS dt FROM lm WINDOW w AS (PARTITION BY label ORDER BY i))
    SELECT label, vec_id, round(CASE WHEN dt < 12 THEN sqrt((x - a) ** 2 + (y - b) ** 2 + (x2 - c) ** 2 + (y2 - d) ** 2) END, 6) AS displacement FROM p""",
)
def point_displacement(spark, sf_dir):
    out = posture.displacement(landmarks(spark, sf_dir), ["label"], "vec_id", [("x", "y"), ("x2", "y2")], 12)
    return rounded(out.select("label", "vec_id", "displacement"), "displacement")


@query("frame_subsample", "SELECT vec_id, label FROM embeddings WHERE vec_id % 6 = 0")
def frame_subsample(spark, sf_dir):
    # the operator itself: keep every sixth frame
    return posture.subsample(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", 6)


GRID = {"x0": (-0.3, -0.2, -0.1), "x1": (0.1, 0.2, 0.3), "y0": (-0.3, -0.2, -0.1), "y1": (0.1, 0.2, 0.3)}
SCORES = f"""{LM}, bx AS (SELECT x0, x1, y0, y1 FROM (VALUES (-0.3), (-0.2), (-0.1)) a(x0), (VALUES (0.1), (0.2), (0.3)) b(x1), (VALUES (-0.3), (-0.2), (-0.1)) c(y0), (VALUES (0.1), (0.2), (0.3)) d(y1)),
    sc AS (SELECT x0::DOUBLE AS x0, x1::DOUBLE AS x1, y0::DOUBLE AS y0, y1::DOUBLE AS y1, CAST(sum(CAST((CAST(x BETWEEN x0::DOUBLE AND x1::DOUBLE AND y BETWEEN y0::DOUBLE AND y1::DOUBLE AS INT) + CAST(x2 BETWEEN x0::DOUBLE AND x1::DOUBLE AND y2 BETWEEN y0::DOUBLE AND y1::DOUBLE AS INT)) / 2 = (label % 3) / 2 AS INT)) AS BIGINT) AS n_agree, count(*) AS n FROM lm, bx GROUP BY ALL)"""


def region_scores(spark, sf_dir):
    points = [F.col(c).alias(f"p{c}") for c in ("x", "y", "x2", "y2")]
    truth = landmarks(spark, sf_dir).select(*points, (F.pmod("label", F.lit(3)) / 2.0).alias("truth"))
    return posture.score_regions(truth, [("px", "py"), ("px2", "py2")], "truth", GRID)


@query("region_scores", f"WITH {SCORES} SELECT * FROM sc")
def region_score_table(spark, sf_dir):
    return region_scores(spark, sf_dir)


@query(
    "best_region",
    f"WITH {SCORES} SELECT x0, x1, y0, y1, n_agree FROM sc ORDER BY n_agree DESC, round((x1 - x0) * (y1 - y0), 9), x0, y0, x1 LIMIT 1",
)
def best_region(spark, sf_dir):
    return posture.best_region(region_scores(spark, sf_dir))


@query(
    "recomputed_proxy",
    f"""WITH {LM}, p AS (SELECT label, vec_id % 8 <> 0 AS det, CASE WHEN vec_id % 8 <> 0 THEN (CAST(x BETWEEN -0.1 AND 0.1 AND y BETWEEN -0.1 AND 0.1 AS INT) + CAST(x2 BETWEEN -0.1 AND 0.1 AND y2 BETWEEN -0.1 AND 0.1 AS INT)) / 2 END AS new, (vec_id % 3) / 2 AS old FROM lm)
    SELECT label, round(avg(old), 6) AS mean_old, round(avg(new), 6) AS mean_new, round(avg(CAST(new = 1 AS DOUBLE)), 6) AS frac_new_1, round(avg(CAST(new = 0 AS DOUBLE)), 6) AS frac_new_0 FROM p WHERE det GROUP BY label""",
)
def recomputed_proxy(spark, sf_dir):
    pose = landmarks(spark, sf_dir).withColumns({"det": F.pmod("vec_id", F.lit(8)) != 0, "proxy": F.pmod("vec_id", F.lit(3)) / 2.0})
    new = posture.recompute_proxy(pose, [("x", "y"), ("x2", "y2")], (-0.1, 0.1, -0.1, 0.1), "det", "proxy", "proxy_before")
    return rounded(posture.proxy_stats(new, ["label"], "proxy", "proxy_before", "det"), "mean_old", "mean_new", "frac_new_1", "frac_new_0")


def grip_table(spark, sf_dir):
    pose = landmarks(spark, sf_dir).withColumn("det", F.pmod("vec_id", F.lit(8)) != 0)
    points = pose.filter("det").select(
        "label", F.inline(F.array(*[F.struct((F.col("vec_id") * 2 + n).alias("pid"), (F.col(x) + 0.5).alias("x"), (F.col(y) + 0.5).alias("y")) for n, (x, y) in enumerate((("x", "y"), ("x2", "y2")))]))
    ).filter((F.col("x") > 0) & (F.col("x") < 1) & (F.col("y") > 0) & (F.col("y") < 1))
    return pose, posture.grip_clusters(points, ["label"], (0.3, 0.7, 0.3, 0.7), min_points=20)


def _grip_sql(n: int = 3, rounds: int = 60, ridge: float = 0.01, tolerance: float = 1e-6) -> str:
    """The mixture as a recursion that goes on until no cluster of a label moves, or `rounds` are made; `cl` has the clusters as rows."""
    own = [c + str(j) for j in range(n) for c in ("w", "cx", "cy", "a", "b", "d")]
    sums = ", ".join(f"sum(r{j}) AS m{j}, sum(r{j} * x) AS x{j}, sum(r{j} * y) AS y{j}, sum(r{j} * x * x) AS xx{j}, sum(r{j} * x * y) AS xy{j}, sum(r{j} * y * y) AS yy{j}" for j in range(n))
    found = ", ".join(
        f"m{j} / n AS w{j}, CASE WHEN m{j} > 0 THEN x{j} / m{j} END AS cx{j}, CASE WHEN m{j} > 0 THEN y{j} / m{j} END AS cy{j}, "
        f"CASE WHEN m{j} > 0 THEN (xx{j} / m{j} - (x{j} / m{j}) * (x{j} / m{j})) * {1 - ridge} + vx * {ridge} END AS a{j}, "
        f"CASE WHEN m{j} > 0 THEN (xy{j} / m{j} - (x{j} / m{j}) * (y{j} / m{j})) * {1 - ridge} + vxy * {ridge} END AS b{j}, "
        f"CASE WHEN m{j} > 0 THEN (yy{j} / m{j} - (y{j} / m{j}) * (y{j} / m{j})) * {1 - ridge} + vy * {ridge} END AS d{j}"
        for j in range(n)
    )
    parts = [
        f"{LM}, gp AS (SELECT label, unnest([x, x2]) + 0.5 AS x, unnest([y, y2]) + 0.5 AS y FROM lm WHERE vec_id % 8 <> 0)",
        "pts AS MATERIALIZED (SELECT * FROM gp WHERE x > 0 AND x < 1 AND y > 0 AND y < 1)",
        "own AS (SELECT label, count(*) AS n, min(x) AS lo, max(x) AS hi, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS vxy FROM pts GROUP BY label HAVING count(*) >= 20)",
        f"q0 AS (SELECT label, x, y, least(floor((x - lo) / greatest(hi - lo, 1e-12) * {n}), {n - 1}) AS part FROM pts JOIN own USING (label))",
        "s0 AS (SELECT label, x, y, " + ", ".join(f"CAST(part = {j} AS DOUBLE) AS r{j}" for j in range(n)) + " FROM q0)",
    ]
    dens = ", ".join(
        f"coalesce(w{j} * exp((d{j} * (x - cx{j}) * (x - cx{j}) - b{j} * (x - cx{j}) * (y - cy{j}) * 2 + a{j} * (y - cy{j}) * (y - cy{j})) / (a{j} * d{j} - b{j} * b{j}) / -2) / sqrt(a{j} * d{j} - b{j} * b{j}), 0) AS p{j}"
        for j in range(n)
    )
    total = " + ".join(f"p{j}" for j in range(n))
    shares = ", ".join(f"CASE WHEN {total} > 0 THEN p{j} / ({total}) ELSE {1.0 / n} END AS r{j}" for j in range(n))
    was, now = ", ".join(f"any_value({c}) AS was_{c}" for c in own), ", ".join(own)
    moved = " OR ".join(f"coalesce(abs({c} - was_{c}) > {tolerance}, false)" for c in own)
    parts.append(f"""c AS (
        SELECT label, 0 AS t, {found}, true AS moves FROM (SELECT label, {sums} FROM s0 GROUP BY label) JOIN own USING (label)
        UNION ALL
        SELECT label, t, {now}, {moved} AS moves FROM (
            SELECT label, t, {", ".join("was_" + c for c in own)}, {found} FROM (
                SELECT label, any_value(t) + 1 AS t, {was}, {sums} FROM (
                    SELECT *, {shares} FROM (SELECT label, x, y, t, {now}, {dens} FROM pts JOIN c USING (label) WHERE moves AND t < {rounds}))
                GROUP BY label) JOIN own USING (label)))""")
    parts.append("fin AS (SELECT * FROM c QUALIFY t = max(t) OVER (PARTITION BY label))")
    rows = " UNION ALL ".join(f"SELECT label, w{j} AS w, cx{j} AS cx, cy{j} AS cy, a{j} AS a, b{j} AS b, d{j} AS d FROM fin" for j in range(n))
    parts.append(f"comps AS (SELECT *, a * d - b * b AS det, sqrt((a + d) / 2 + sqrt(pow((a - d) / 2, 2) + b * b)) AS major, sqrt(greatest((a + d) / 2 - sqrt(pow((a - d) / 2, 2) + b * b), 0)) AS minor FROM ({rows}) WHERE w > 0)")
    parts.append(
        "cl AS (SELECT label, w AS weight, cx, cy, major AS sd_major, minor AS sd_minor, d / det AS ixx, -b / det AS ixy, a / det AS iyy, "
        "cx BETWEEN 0.3 AND 0.7 AND cy BETWEEN 0.3 AND 0.7 AND w >= 0.15 AND major < 0.12 AS kept FROM comps)"
    )
    return "WITH RECURSIVE " + ", ".join(parts)


_FIELDS = ("weight", "cx", "cy", "sd_major", "sd_minor", "ixx", "ixy", "iyy")


@query("grip_clusters", _grip_sql() + " SELECT label, " + ", ".join(f"round({c}, 5) AS {c}" for c in _FIELDS) + ", kept FROM cl")
def grip_clusters(spark, sf_dir):
    clusters = grip_table(spark, sf_dir)[1]
    return rounded(clusters.select("label", F.inline("clusters")), *_FIELDS, digits=5)


@query(
    "grip_proxy",
    _grip_sql() + """, pose AS (SELECT label, vec_id, i, vec_id % 8 <> 0 AS det, unnest([0, 1]) AS pt, unnest([x, x2]) + 0.5 AS x, unnest([y, y2]) + 0.5 AS y FROM lm),
    touch AS (SELECT pose.label, vec_id, i, det, (x BETWEEN 0.4 AND 0.6 AND y BETWEEN 0.4 AND 0.6)
        OR coalesce(bool_or(kept AND ixx * (x - cx) * (x - cx) + ixy * (x - cx) * (y - cy) * 2 + iyy * (y - cy) * (y - cy) <= 6.25), false) AS hit
        FROM pose LEFT JOIN cl ON cl.label = pose.label GROUP BY pose.label, vec_id, i, det, pt, x, y),
    sh AS (SELECT label, vec_id, i, det, CASE WHEN det THEN avg(CAST(hit AS DOUBLE)) END AS share FROM touch GROUP BY label, vec_id, i, det)
    SELECT label, vec_id, CASE WHEN det THEN round_even(median(share) OVER (PARTITION BY label ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 1) END AS grip_proxy FROM sh""",
)
def grip_proxy(spark, sf_dir):
    pose, clusters = grip_table(spark, sf_dir)
    moved = pose.withColumns({c: F.col(c) + 0.5 for c in ("x", "y", "x2", "y2")})
    return posture.grip_proxy(moved, clusters, ["label"], [("x", "y"), ("x2", "y2")], (0.4, 0.6, 0.4, 0.6), "det").select("label", "vec_id", "grip_proxy")
