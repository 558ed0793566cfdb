"""Queries on the labelling rules and on events.

The events table becomes a drive per user: `k` of the JSON properties, the value and the event
number supply speed, throttle, accelerations and heading. Windows are short, because a user has
some seventy events; the rule is otherwise the adopted one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import blocks, events as E, frames, intervals, rules, runs
from .registry import SER, query, series
from .series_queries import K, clean_sql, r6

DRIVE_RULE = rules.Rule(3, 3, 1, 2, False, 0.10, 0.10, 0.25, 15.0, 30.0, 25.0, -0.3, 3, 40.0, 1, 25.0)
PEAK_RULE = rules.PeakRule(brake_g=-0.35, accel_g=0.38, turn_g=0.75, window_s=0.08, min_s=0.08, expand_s=0.16, dt=0.04)


def drive(spark, sf_dir):
    ev = series(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        *K, "event_id", "i", "t",
        (k + 10.0).alias("speed_kph"),
        (k + 10.0 + F.pmod("event_id", F.lit(7)) / 10.0).alias("gps_speed_kmh"),
        F.least(F.col("value") * 2, F.lit(100.0)).alias("throttle_pct"),
        ((F.pmod(F.col("event_id") * 37, F.lit(200)) - 100) / 100.0).alias("lon_acc_g"),
        ((F.pmod(F.col("event_id") * 53, F.lit(260)) - 130) / 100.0).alias("lat_acc_g"),
        F.pmod(F.col("value") * 7, F.lit(360.0)).alias("heading_deg"),
    )


DRIVE = SER + """, dr AS (SELECT user_id, event_id, i, t, CAST(json_extract_string(props, '$.k') AS INT) + 10.0::DOUBLE AS speed_kph,
    CAST(json_extract_string(props, '$.k') AS INT) + 10.0::DOUBLE + (event_id % 7) / 10.0::DOUBLE AS gps_speed_kmh,
    least(value * 2, 100.0) AS throttle_pct, ((event_id * 37) % 200 - 100) / 100.0::DOUBLE AS lon_acc_g,
    ((event_id * 53) % 260 - 130) / 100.0::DOUBLE AS lat_acc_g, (value * 7) % 360.0 AS heading_deg FROM ser)"""

W = "(PARTITION BY user_id ORDER BY i"


def rule_sql(p: rules.Rule, tag: str, src: str = "dr", lon: str = "lon_acc_g", lat: str = "lat_acc_g") -> str:
    """CTEs ending in {tag}lab: the source rows with `label_{tag}`, for rules with odd windows."""
    h, m = p.smooth_n // 2, p.median_n // 2
    med = lambda c: f"median({c}) OVER {W} ROWS BETWEEN {m} PRECEDING AND {m} FOLLOWING)" if p.median_n > 1 else c
    around = f"{W} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    lateral = f"avg(abs({tag}mlat)) OVER {around}" if p.rectify_first else f"abs(avg({tag}mlat) OVER {around})"
    parts = f"""
    {tag}m AS (SELECT *, {med(lon)} AS {tag}mlon, {med(lat)} AS {tag}mlat,
       (speed_kph - lag(speed_kph) OVER {W})) / 3.6 * 25 AS {tag}dv FROM {src}),
    {tag}s AS (SELECT *, avg({tag}mlon) OVER {around} AS {tag}lon, {lateral} AS {tag}lat,
       max(throttle_pct) OVER {around} AS {tag}thr,
       min({tag}dv) OVER {W} ROWS BETWEEN {p.can_n - 1} PRECEDING AND CURRENT ROW) AS {tag}can FROM {tag}m),
    {tag}r AS (SELECT *, coalesce({tag}lon <= {-p.brake_g} AND gps_speed_kmh > {p.min_speed} AND {tag}can <= {p.max_can_ms2}, false) AS {tag}b,
       coalesce({tag}lon >= {p.accel_g} AND gps_speed_kmh > {p.min_speed} AND {tag}thr > {p.min_throttle}, false) AS {tag}a,
       coalesce({tag}lat >= {p.turn_g} AND gps_speed_kmh > {p.min_turn_speed}, false) AS {tag}t FROM {tag}s),
    {clean_sql(tag + 'r', tag + 'b', p.close_n, p.min_n, tag + 'x')},
    {clean_sql(tag + 'xout', tag + 'a', p.close_n, p.min_n, tag + 'y')},
    {clean_sql(tag + 'yout', tag + 't', p.close_n, p.min_n, tag + 'z')},"""
    if p.min_heading_deg > 0:
        g = p.heading_margin
        parts += f"""
    {tag}q AS (SELECT *, CASE WHEN {tag}zk = lag({tag}zk) OVER {W}) THEN 0 ELSE 1 END AS {tag}qc,
       first_value(heading_deg) OVER {W} ROWS BETWEEN {g} PRECEDING AND CURRENT ROW) AS {tag}hb,
       last_value(heading_deg) OVER {W} ROWS BETWEEN CURRENT ROW AND {g} FOLLOWING) AS {tag}ha FROM {tag}zout),
    {tag}qq AS (SELECT *, sum({tag}qc) OVER {W}) AS {tag}qg FROM {tag}q),
    {tag}qr AS (SELECT user_id, {tag}qg, arg_max({tag}ha, i) - arg_min({tag}hb, i) + 180 AS {tag}d FROM {tag}qq GROUP BY ALL),
    {tag}qz AS (SELECT *, {tag}zk AND NOT coalesce(abs({tag}d - floor({tag}d / 360) * 360 - 180) < {p.min_heading_deg}, false) AS {tag}tk
       FROM {tag}qq JOIN {tag}qr USING (user_id, {tag}qg)),"""
        last, turn = f"{tag}qz", f"{tag}tk"
    else:
        last, turn = f"{tag}zout", f"{tag}zk"
    return parts + f"""
    {tag}lab AS (SELECT *, {turn} AS turn_{tag}, {tag}xk AS brake_{tag}, {tag}yk AS accel_{tag},
       CASE WHEN {turn} THEN 'Harsh Turning' WHEN {tag}xk THEN 'Harsh Braking' WHEN {tag}yk THEN 'Harsh Acceleration' ELSE 'Normal' END AS label_{tag} FROM {last})"""


def event_sql(src: str, label: str, out: str) -> str:
    return f"""{out}1 AS (SELECT *, CASE WHEN {label} = lag({label}) OVER {W}) THEN 0 ELSE 1 END AS {out}c FROM {src}),
    {out}2 AS (SELECT *, sum({out}c) OVER {W}) AS {out}g FROM {out}1),
    {out} AS (SELECT user_id, {label} AS label, min(i) AS i0, max(i) AS i1, min(t) AS start_t, max(t) AS end_t, count(*) AS n_samples
       FROM {out}2 WHERE {label} <> 'Normal' GROUP BY user_id, {label}, {out}g)"""


@query("rule_v2_labels", f"WITH {DRIVE}, {rule_sql(DRIVE_RULE, 'p')} SELECT user_id, i, label_p AS label FROM plab")
def rule_v2_labels(spark, sf_dir):
    return rules.label_v2(drive(spark, sf_dir), K, DRIVE_RULE).select(*K, "i", "label")


ODD_VARIANTS = {
    "V1": replace(DRIVE_RULE, median_n=0, rectify_first=True, min_heading_deg=0.0),
    "V2": replace(DRIVE_RULE, median_n=0, min_heading_deg=0.0),
    "V3": replace(DRIVE_RULE, median_n=0, min_n=3, min_heading_deg=0.0),
    "V4": replace(DRIVE_RULE, min_heading_deg=0.0),
    "V6": DRIVE_RULE,
}


def totals_sql(variants) -> str:
    """Chain of rule CTEs over one source, and one counted row per variant."""
    ctes, selects = [DRIVE], []
    for n, p in variants.items():
        tag = n.lower() + "_"
        ctes += [rule_sql(p, tag), event_sql(f"{tag}lab", f"label_{tag}", f"{tag}ev")]
        count = lambda c: f"(SELECT count(*) FROM {tag}ev WHERE label = '{c}')"
        selects.append(
            f"SELECT '{n}' AS variant, {count('Harsh Acceleration')} AS n_accel, {count('Harsh Braking')} AS n_brake, "
            f"{count('Harsh Turning')} AS n_turn, (SELECT count(*) FROM {tag}lab WHERE label_{tag} <> 'Normal') AS nonnormal_rows, "
            f"(SELECT count(*) FROM {tag}ev) AS total"
        )
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(selects)


@query("rule_variant_totals", totals_sql(ODD_VARIANTS))
def rule_variant_totals(spark, sf_dir):
    return rules.variant_totals(drive(spark, sf_dir), K, ODD_VARIANTS)


SCALES = {"minus10": 0.9, "primary": 1.0, "plus10": 1.1}


@query("rule_sensitivity", totals_sql({n: DRIVE_RULE.scaled(f) for n, f in SCALES.items()}))
def rule_sensitivity(spark, sf_dir):
    return rules.sensitivity(drive(spark, sf_dir), K, DRIVE_RULE, SCALES)


@query(
    "rule_priority_overlap",
    f"""WITH {DRIVE}, {rule_sql(DRIVE_RULE, 'p')}
    SELECT count(*) FILTER (turn_p AND brake_p) AS turn_p_and_brake_p, round(count(*) FILTER (turn_p AND brake_p) * 100.0 / nullif(count(*) FILTER (brake_p), 0), 6) AS brake_p_share_taken_pct,
           count(*) FILTER (turn_p AND accel_p) AS turn_p_and_accel_p, round(count(*) FILTER (turn_p AND accel_p) * 100.0 / nullif(count(*) FILTER (accel_p), 0), 6) AS accel_p_share_taken_pct FROM plab""",
)
def rule_priority_overlap(spark, sf_dir):
    masks = rules.label_variants(drive(spark, sf_dir), K, {"p": DRIVE_RULE}, keep_masks=True)
    out = rules.priority_overlap(masks, [("turn_p", "brake_p"), ("turn_p", "accel_p")])
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_pct")})


# Peak rule: windows of 2 samples, closing 2, minimum run 2, dilation 4 and 2.
def _keep2(c, out):
    return f"coalesce(({c} AND (lag({c}) OVER {W}) OR lead({c}) OVER {W}))), false) AS {out}"


PEAK = f"""WITH {DRIVE}, pa AS (SELECT *, (speed_kph - lag(speed_kph) OVER {W})) * (1000.0 / 3600.0) / 0.04 AS dv FROM dr),
    pb AS (SELECT *, min(dv) OVER {W} ROWS 1 PRECEDING) AS dvm, min(lon_acc_g) OVER {W} ROWS 1 PRECEDING) AS lonm, max(lon_acc_g) OVER {W} ROWS 1 PRECEDING) AS lonx,
       max(abs(lat_acc_g)) OVER {W} ROWS 1 PRECEDING) AS latx, max(throttle_pct) OVER {W} ROWS 1 PRECEDING) AS thrx FROM pa),
    pc AS (SELECT *, coalesce(speed_kph > 15 AND dvm <= -0.3 AND lonm * 9.81 <= (-0.35::DOUBLE + 0.05::DOUBLE) * 9.81, false) AS b0 FROM pb),
    pd AS (SELECT *, speed_kph > 15 AND lonx >= 0.38 AND thrx > 25 AND NOT b0 AS a0, speed_kph > 30 AND latx >= 0.75 AS t0 FROM pc),
    """ + ", ".join(
    f"""{n}d AS (SELECT *, bool_or({c}) OVER {W} ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS {c}d FROM {src}),
    {n}e AS (SELECT *, {c}d AND coalesce(lag({c}d) OVER {W}), false) AS {c}e FROM {n}d),
    {n}f AS (SELECT *, {_keep2(c + 'e', c + 'f')} FROM {n}e),
    {n}g AS (SELECT *, bool_or({c}f) OVER {W} ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING) AS {c}g FROM {n}f),
    {n}h AS (SELECT *, {_keep2(c + 'g', c + 'h')} FROM {n}g)"""
    for n, c, src, back, ahead in (("qb", "b0", "pd", 0, 1), ("qa", "a0", "qbh", 0, 1), ("qt", "t0", "qah", 1, 2))
)


@query("rule_v1_labels", PEAK + " SELECT user_id, i, CASE WHEN t0h THEN 'Harsh Turning' WHEN b0h THEN 'Harsh Braking' WHEN a0h THEN 'Harsh Acceleration' ELSE 'Normal' END AS label FROM qth")
def rule_v1_labels(spark, sf_dir):
    return rules.label_v1(drive(spark, sf_dir), K, PEAK_RULE).select(*K, "i", "label")


# Sessions with an odd id are sampled half as often: windows, closing and runs of one sample, dilation by 2 and 1.
_SLOW = """, oa AS (SELECT *, (speed_kph - lag(speed_kph) OVER """ + W + """)) * (1000.0 / 3600.0) / 0.08 AS odv FROM dr WHERE user_id % 2 = 1),
    ob AS (SELECT *, coalesce(speed_kph > 15 AND odv <= -0.3 AND lon_acc_g * 9.81 <= (-0.35::DOUBLE + 0.05::DOUBLE) * 9.81, false) AS ob0 FROM oa),
    oc AS (SELECT *, coalesce(speed_kph > 15 AND lon_acc_g >= 0.38 AND throttle_pct > 25 AND NOT ob0, false) AS oa0, coalesce(speed_kph > 30 AND abs(lat_acc_g) >= 0.75, false) AS ot0 FROM ob),
    od AS (SELECT *, ot0 OR coalesce(lead(ot0) OVER """ + W + """), false) AS ot1 FROM oc)"""
_EVERY = """ SELECT user_id, i, CASE WHEN t0h THEN 'Harsh Turning' WHEN b0h THEN 'Harsh Braking' WHEN a0h THEN 'Harsh Acceleration' ELSE 'Normal' END AS label FROM qth WHERE user_id % 2 = 0
    UNION ALL SELECT user_id, i, CASE WHEN ot1 THEN 'Harsh Turning' WHEN ob0 THEN 'Harsh Braking' WHEN oa0 THEN 'Harsh Acceleration' ELSE 'Normal' END AS label FROM od"""


def two_rates(spark, sf_dir):
    # one period in five is missing, and the session's own stands for it
    own = F.when(F.pmod("user_id", F.lit(2)) == 1, 0.08).otherwise(0.04)
    return drive(spark, sf_dir).withColumn("sampleperiod_s", F.when(F.pmod("event_id", F.lit(5)) != 0, own))


@query("rule_v1_two_rates", PEAK + _SLOW + _EVERY)
def rule_v1_two_rates(spark, sf_dir):
    return rules.label_v1_sessions(two_rates(spark, sf_dir), K, PEAK_RULE).select(*K, "i", "label")


@query(
    "rule_v1_gradient",
    PEAK.replace("pa AS (SELECT *,", "pg AS (SELECT *, event_id % 21 - 10.0 AS gradient_pct FROM dr), pa AS (SELECT *, lon_acc_g * 9.81 - sin(atan(gradient_pct / 100)) * 9.81 AS flat,")
    .replace("AS dv FROM dr)", "AS dv FROM pg)").replace("min(lon_acc_g) OVER", "min(flat) OVER").replace("lonm * 9.81 <=", "lonm <=")
    + " SELECT user_id, i, CASE WHEN t0h THEN 'Harsh Turning' WHEN b0h THEN 'Harsh Braking' WHEN a0h THEN 'Harsh Acceleration' ELSE 'Normal' END AS label FROM qth",
)
def rule_v1_gradient(spark, sf_dir):
    sloped = drive(spark, sf_dir).withColumn("gradient_pct", F.pmod("event_id", F.lit(21)) - F.lit(10.0))
    return rules.label_v1(sloped, K, PEAK_RULE, gradient=True).select(*K, "i", "label")


@query(
    "rule_thresholds_adaptive",
    f"""WITH {DRIVE}, q AS (SELECT user_id, quantile_cont(lon_acc_g, 0.025) AS b, quantile_cont(lon_acc_g, 0.975) FILTER (lon_acc_g > 0) AS a,
       quantile_cont(lon_acc_g, 0.975) AS a2, quantile_cont(abs(lat_acc_g), 0.98) AS tt FROM dr GROUP BY user_id)
    SELECT user_id, round(greatest(greatest(least(b, -0.35), -0.6), -0.38), 6) AS thr_brake_g,
       round(least(greatest(least(coalesce(a, a2), 0.55), 0.25), 0.40), 6) AS thr_accel_g, round(least(greatest(least(tt, 0.55), 0.30), 0.45), 6) AS thr_turn_g FROM q""",
)
def rule_thresholds_adaptive(spark, sf_dir):
    found = rules.thresholds(drive(spark, sf_dir), K, PEAK_RULE, adaptive=True)
    return found.select(*K, *[r6(c).alias(c) for c in ("thr_brake_g", "thr_accel_g", "thr_turn_g")])


@query(
    "sample_period",
    f"""WITH {SER}, d AS (SELECT user_id, t - lag(t) OVER {W}) AS d FROM ser)
    SELECT user_id, round(coalesce(CASE WHEN median(d) > 0 THEN median(d) END, 0.04), 6) AS dt FROM d GROUP BY user_id""",
)
def sample_period(spark, sf_dir):
    stepped = blocks.over_blocks(series(spark, sf_dir), K, 1, 0, lambda w: [{"d": F.col("t") - F.lag("t").over(w)}])
    return rules.sample_period(stepped, K, "d").select(*K, r6("dt").alias("dt"))


@query(
    "mask_suspect_fix",
    f"""WITH {DRIVE}, j AS (SELECT *, heading_deg - lag(heading_deg) OVER {W}) + 180 AS dh, abs(gps_speed_kmh - lag(gps_speed_kmh) OVER {W})) AS dv FROM dr),
    s AS (SELECT *, coalesce(event_id % 11 = 0 OR event_id % 13 < 3 OR abs(dh - floor(dh / 360) * 360 - 180) > 100 OR dv > 50, false) OR coalesce(event_id % 13 < 3, false) AS bad FROM j)
    SELECT user_id, i, bad AS suspect, CASE WHEN NOT bad THEN lat_acc_g END AS lat_acc_g FROM s""",
)
def mask_suspect_fix(spark, sf_dir):
    d = drive(spark, sf_dir).withColumns(
        {"sats": F.pmod("event_id", F.lit(13)) + 3, "sol": F.pmod("event_id", F.lit(11))}
    )
    out = rules.mask_suspect_fix(
        d, K, "heading_deg", "gps_speed_kmh", ["lat_acc_g"], "sats", "sol", min_sats=6, max_dpsi=100.0, max_dv=50.0
    )
    return out.select(*K, "i", "suspect", "lat_acc_g")


@query(
    "relabel_delta",
    f"""WITH {DRIVE}, {rule_sql(DRIVE_RULE, 'p')}, {rule_sql(DRIVE_RULE.scaled(1.5), 'h', 'plab')}
    SELECT label_p AS before, label_h AS after, count(*) AS n_rows FROM hlab GROUP BY ALL""",
)
def relabel_delta(spark, sf_dir):
    d = drive(spark, sf_dir)
    old = rules.label_v2(d, K, DRIVE_RULE)
    new = rules.label_v2(d, K, DRIVE_RULE.scaled(1.5))
    return rules.label_delta(rules.relabel(old, new, K, "label_before"), "label_before", "label")


def median3(df):
    return frames.rolling_centred(
        frames.rolling_centred(df, K, "lat_acc_g", 3, "median", "_y"), K, "lon_acc_g", 3, "median", "_x"
    ).withColumns({"lat_acc_g": F.col("_y"), "lon_acc_g": F.col("_x")}).drop("_x", "_y")


PLAIN = replace(DRIVE_RULE, median_n=0, min_heading_deg=0.0)
MED3 = f"median({{c}}) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"


@query(
    "treatment_effect",
    f"""WITH {DRIVE}, dm AS (SELECT *, {MED3.format(c='lon_acc_g')} AS lon3, {MED3.format(c='lat_acc_g')} AS lat3 FROM dr),
    {rule_sql(PLAIN, 'p', 'dm')}, {rule_sql(PLAIN, 'h', 'plab', 'lon3', 'lat3')},
    {event_sql('hlab', 'label_p', 'ea')}, {event_sql('hlab', 'label_h', 'eb')},
    la AS (SELECT ea.user_id, ea.label, ea.i0, bool_or(x.label_h = ea.label) AS kept FROM ea JOIN hlab x ON x.user_id = ea.user_id AND x.i BETWEEN ea.i0 AND ea.i1 GROUP BY ALL),
    lb AS (SELECT eb.user_id, eb.label, eb.i0, bool_or(x.label_p = eb.label) AS kept FROM eb JOIN hlab x ON x.user_id = eb.user_id AND x.i BETWEEN eb.i0 AND eb.i1 GROUP BY ALL),
    ca AS (SELECT label AS cls, count(*) AS n_before, count(*) FILTER (NOT kept) AS n_lost FROM la GROUP BY label),
    cb AS (SELECT label AS cls, count(*) AS n_after, count(*) FILTER (NOT kept) AS n_new FROM lb GROUP BY label)
    SELECT cls, coalesce(n_before, 0) AS n_before, coalesce(n_lost, 0) AS n_lost, coalesce(n_after, 0) AS n_after, coalesce(n_new, 0) AS n_new,
       (SELECT round(avg(CAST(label_p <> label_h AS DOUBLE)) * 100, 6) FROM hlab) AS changed_rows_pct, 'median3' AS treatment FROM ca FULL JOIN cb USING (cls)""",
)
def treatment_effect(spark, sf_dir):
    out = rules.treatment_effect(
        drive(spark, sf_dir), K, {"median3": median3}, lambda d: rules.label_v2(d, K, PLAIN)
    )
    return out.withColumn("changed_rows_pct", r6("changed_rows_pct"))


# Two event sets: the plain rule, and the plain rule on clipped accelerations.
PAIR = f"""WITH {DRIVE}, dc AS (SELECT *, greatest(least(lon_acc_g, 0.45), -0.45) AS lonc, greatest(least(lat_acc_g, 0.45), -0.45) AS latc FROM dr),
    {rule_sql(PLAIN, 'p', 'dc')}, {rule_sql(PLAIN, 'h', 'plab', 'lonc', 'latc')}, {event_sql('hlab', 'label_p', 'ea')}, {event_sql('hlab', 'label_h', 'eb')}"""


def event_pair(spark, sf_dir):
    d = drive(spark, sf_dir)
    clipped = d.withColumns({"lon_acc_g": S.clip("lon_acc_g", 0.45), "lat_acc_g": S.clip("lat_acc_g", 0.45)})
    return tuple(
        runs.event_table(rules.label_v2(x, K, PLAIN), K, "t", "label") for x in (d, clipped)
    )


@query(
    "match_events",
    PAIR + """ SELECT ea.user_id, ea.i0, ea.label, count(eb.i0) AS n_any, count(eb.i0) FILTER (eb.label = ea.label) AS n_same
    FROM ea LEFT JOIN eb ON ea.user_id = eb.user_id AND ea.i0 <= eb.i1 AND eb.i0 <= ea.i1 GROUP BY ALL""",
)
def match_events(spark, sf_dir):
    a, b = event_pair(spark, sf_dir)
    return intervals.match_events(a, b, K, 4096.0).select(*K, "i0", "label", "n_any", "n_same")


@query(
    "lost_new_events",
    PAIR + """ , ma AS (SELECT ea.user_id, ea.i0, ea.label, count(eb.i0) AS n_any, count(eb.i0) FILTER (eb.label = ea.label) AS n_same
      FROM ea LEFT JOIN eb ON ea.user_id = eb.user_id AND ea.i0 <= eb.i1 AND eb.i0 <= ea.i1 GROUP BY ALL),
    mb AS (SELECT eb.user_id, eb.i0, eb.label, count(ea.i0) AS n_any, count(ea.i0) FILTER (eb.label = ea.label) AS n_same
      FROM eb LEFT JOIN ea ON ea.user_id = eb.user_id AND ea.i0 <= eb.i1 AND eb.i0 <= ea.i1 GROUP BY ALL)
    SELECT user_id, i0, label, CASE WHEN n_any > 0 THEN 'lost_class_changed' ELSE 'lost' END AS kind FROM ma WHERE n_same = 0
    UNION ALL SELECT user_id, i0, label, CASE WHEN n_any > 0 THEN 'new_class_changed' ELSE 'new' END FROM mb WHERE n_same = 0""",
)
def lost_new_events(spark, sf_dir):
    a, b = event_pair(spark, sf_dir)
    return intervals.lost_new(a, b, K, 4096.0).select(*K, "i0", "label", "kind")


@query(
    "clip_outcome",
    PAIR + """ , prx AS (SELECT ea.user_id, ea.i0, ea.i1, ea.label, eb.i0 AS c0, eb.i1 AS c1, eb.label AS cl,
         count(*) OVER (PARTITION BY eb.user_id, eb.i0) AS nb FROM ea JOIN eb ON ea.user_id = eb.user_id AND ea.i0 <= eb.i1 AND eb.i0 <= ea.i1),
    pax AS (SELECT user_id, i0, count(*) AS n, count(*) FILTER (cl = label) AS ns, min(c0) FILTER (cl = label) AS c0, arg_min(c1, c0) FILTER (cl = label) AS c1, arg_min(nb, c0) FILTER (cl = label) AS nb FROM prx GROUP BY ALL)
    SELECT user_id, i0, i1, label, CASE WHEN n IS NULL THEN 'disappears' WHEN ns = 0 THEN 'class change' WHEN n > 1 THEN 'split' WHEN nb > 1 THEN 'merge'
       WHEN c0 = i0 AND c1 = i1 THEN 'unchanged' ELSE 'boundary ' || (abs(c0 - i0) + abs(c1 - i1)) || ' samples' END AS outcome FROM ea LEFT JOIN pax USING (user_id, i0)
    UNION ALL SELECT user_id, i0, i1, label, 'appears only after clipping' FROM eb WHERE NOT EXISTS (SELECT 1 FROM prx WHERE prx.user_id = eb.user_id AND prx.c0 = eb.i0)""",
)
def clip_outcome(spark, sf_dir):
    return E.clip_outcome(*event_pair(spark, sf_dir), K, 4096.0)


DIAG = replace(PLAIN, can_n=3, fs=25.0)


@query(
    "event_diagnostics",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    x AS (SELECT *, plon AS slon, plat AS slat, lag(speed_kph) OVER {W}) AS sb, lag(gps_speed_kmh) OVER {W}) AS gb,
       first_value(heading_deg) OVER {W} ROWS 1 PRECEDING) AS hb, last_value(heading_deg) OVER {W} ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS ha,
       CASE WHEN label_p = 'Harsh Turning' THEN lat_acc_g ELSE lon_acc_g END AS raw,
       CASE label_p WHEN 'Harsh Turning' THEN {PLAIN.turn_g} WHEN 'Harsh Braking' THEN {PLAIN.brake_g} ELSE {PLAIN.accel_g} END AS lim FROM plab),
    z AS (SELECT ea.user_id, ea.i0, ea.label, ea.i1, ea.n_samples, max(CASE WHEN ea.label = 'Harsh Turning' THEN slat ELSE abs(slon) END) AS peak, avg(gps_speed_kmh) AS ms,
       avg(pdv) AS cm, arg_max(speed_kph, i) - coalesce(arg_min(sb, i), arg_min(speed_kph, i)) AS csc, arg_max(gps_speed_kmh, i) - coalesce(arg_min(gb, i), arg_min(gps_speed_kmh, i)) AS gsc,
       max(throttle_pct) AS thr, count(*) FILTER (abs(raw) >= lim) AS nab, avg(CAST(abs(raw) >= lim / 2 AS DOUBLE)) AS half, max(abs(raw)) AS mx,
       count(*) FILTER (abs(lat_acc_g) > 1.2 OR abs(lon_acc_g) > 1.2) AS nb, abs(avg(raw)) / greatest(avg(abs(raw)), 1e-9) AS rect,
       arg_max(ha, i) - arg_min(hb, i) + 180 AS dh, degrees(sum(slat * 9.81 / (greatest(gps_speed_kmh, 1) / 3.6) / 25)) AS hexp
       FROM ea JOIN x ON x.user_id = ea.user_id AND x.i BETWEEN ea.i0 AND ea.i1 GROUP BY ALL),
    c AS (SELECT ea.user_id, ea.i0, min(pdv) AS clo, max(pdv) AS chi FROM ea JOIN x ON x.user_id = ea.user_id AND x.i BETWEEN ea.i0 - 25 AND ea.i1 GROUP BY ALL)
    SELECT user_id, i0, i1, label, n_samples, round(peak, 5) AS peak_smoothed_g, round(ms, 5) AS mean_speed_kmh, round(clo, 5) AS can_accel_min_ms2, round(chi, 5) AS can_accel_max_ms2,
       round(cm, 5) AS can_accel_mean_ms2_event, round(csc, 5) AS can_speed_change_kmh, round(gsc, 5) AS gnss_speed_change_kmh, round(thr, 5) AS throttle_max_pct, nab AS n_raw_above_thr,
       round(half, 5) AS frac_raw_above_half_thr, round(mx, 5) AS max_raw_g, nb AS n_raw_gt_1p2g, round(rect, 5) AS rectification_ratio, round(dh - floor(dh / 360) * 360 - 180, 5) AS heading_change_deg,
       round(hexp, 4) AS heading_change_expected_deg FROM z JOIN c USING (user_id, i0)""",
)
def event_diagnostics(spark, sf_dir):
    labelled = rules.label_v2(drive(spark, sf_dir), K, PLAIN)
    out = E.diagnose_events(labelled, K, "label", DIAG)
    five = [
        "peak_smoothed_g", "mean_speed_kmh", "can_accel_min_ms2", "can_accel_max_ms2", "can_accel_mean_ms2_event", "can_speed_change_kmh",
        "gnss_speed_change_kmh", "throttle_max_pct", "frac_raw_above_half_thr", "max_raw_g", "rectification_ratio", "heading_change_deg",
    ]
    return out.select(
        *K, "i0", "i1", "label", "n_samples", "n_raw_above_thr", "n_raw_gt_1p2g", *[F.round(c, 5).alias(c) for c in five],
        F.round("heading_change_expected_deg", 4).alias("heading_change_expected_deg"),
    )


@query(
    "longest_run_in_event",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    x AS (SELECT ea.user_id, ea.i0, ea.label, ea.n_samples, p.i, abs(lat_acc_g) > 0.5 AS m FROM ea JOIN plab p ON p.user_id = ea.user_id AND p.i BETWEEN ea.i0 AND ea.i1),
    y AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, i0, m ORDER BY i) AS g FROM x),
    r AS (SELECT user_id, i0, g, count(*) AS n FROM y WHERE m GROUP BY ALL)
    SELECT ea.user_id, ea.i0, ea.label, ea.n_samples, coalesce(max(r.n), 0) AS longest_run FROM ea LEFT JOIN r ON r.user_id = ea.user_id AND r.i0 = ea.i0 GROUP BY ALL""",
)
def longest_run_in_event(spark, sf_dir):
    labelled = rules.label_v2(drive(spark, sf_dir), K, PLAIN).withColumn("m", F.abs("lat_acc_g") > 0.5)
    return E.longest_run_in_event(labelled, K, "label", "m")


@query(
    "artefact_sessions",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    b AS (SELECT *, abs(lat_acc_g) > 1.0 OR abs(lon_acc_g) > 1.0 AS bad FROM plab),
    b1 AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, bad ORDER BY i) AS g FROM b),
    r AS (SELECT user_id, g, count(*) AS n FROM b1 WHERE bad GROUP BY ALL),
    e AS (SELECT ea.user_id, ea.i0, bool_or(bad) AS hit FROM ea JOIN b ON b.user_id = ea.user_id AND b.i BETWEEN ea.i0 AND ea.i1 GROUP BY ALL),
    s AS (SELECT user_id, count(*) FILTER (bad) AS n_flagged, max(abs(lat_acc_g)) AS max_abs_lat, max(abs(lon_acc_g)) AS max_abs_lon FROM b GROUP BY user_id)
    SELECT s.*, coalesce((SELECT count(*) FROM r WHERE r.user_id = s.user_id), 0) AS n_runs, coalesce((SELECT count(*) FROM r WHERE r.user_id = s.user_id AND n <= 1), 0) AS n_brief_runs,
       coalesce((SELECT count(*) FROM e WHERE e.user_id = s.user_id), 0) AS n_events, coalesce((SELECT count(*) FILTER (hit) FROM e WHERE e.user_id = s.user_id), 0) AS n_events_affected FROM s""",
)
def artefact_sessions(spark, sf_dir):
    labelled = rules.label_v2(drive(spark, sf_dir), K, PLAIN)
    return E.artefact_overlap(labelled, K, "label", 1.0, 1, 2)[0]


@query(
    "artefact_classes",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')}, b AS (SELECT *, abs(lat_acc_g) > 1.0 OR abs(lon_acc_g) > 1.0 AS bad FROM plab),
    e AS (SELECT ea.user_id, ea.label, ea.i0, bool_or(bad) AS hit FROM ea JOIN b ON b.user_id = ea.user_id AND b.i BETWEEN ea.i0 AND ea.i1 GROUP BY ALL)
    SELECT user_id, label AS class, count(*) AS n_events, count(*) FILTER (hit) AS n_affected FROM e GROUP BY user_id, label""",
)
def artefact_classes(spark, sf_dir):
    return E.artefact_classes(rules.label_v2(drive(spark, sf_dir), K, PLAIN), K, "label", 1.0)


@query(
    "artefact_run_details",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, b AS (SELECT *, abs(lat_acc_g) > 1.0 OR abs(lon_acc_g) > 1.0 AS bad FROM plab), b1 AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, bad ORDER BY i) AS g FROM b)
    SELECT user_id, min(i) AS i0, max(i) AS i1, round(arg_min(t, i), 3) AS start_t, arg_min(speed_kph, i) AS start_speed, list_sort(list(DISTINCT label_p)) AS labels_in_run FROM b1 WHERE bad GROUP BY user_id, g""",
)
def artefact_run_details(spark, sf_dir):
    out = E.artefact_run_details(rules.label_v2(drive(spark, sf_dir), K, PLAIN), K, "label", "t", "speed_kph", 1.0)
    return out.withColumn("start_t", F.round("start_t", 3))


@query(
    "attempted_turns",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')} SELECT user_id, coalesce(max(abs(lat_acc_g)) FILTER (abs(lat_acc_g) >= 0.2 AND gps_speed_kmh > 30 AND label_p <> 'Harsh Turning'), 0) AS max_lateral_outside_turns_g FROM plab GROUP BY user_id""",
)
def attempted_turns(spark, sf_dir):
    labelled = rules.label_v2(drive(spark, sf_dir), K, PLAIN).withColumn("lateral", F.abs("lat_acc_g"))
    return E.attempted_turns(labelled, K, "lateral", "gps_speed_kmh", "label")


@query(
    "artefact_runs",
    f"""WITH {DRIVE}, b AS (SELECT *, abs(lat_acc_g) > 1.0 OR abs(lon_acc_g) > 1.0 AS bad FROM dr),
    b1 AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, bad ORDER BY i) AS g FROM b),
    r AS (SELECT user_id, min(i) AS i0, max(i) AS i1, count(*) AS run_len, max(greatest(abs(lat_acc_g), abs(lon_acc_g))) AS peak_g FROM b1 WHERE bad GROUP BY user_id, g),
    c AS (SELECT r.user_id, r.i0, b.i, 'lat' AS ax, sign(lat_acc_g) AS s FROM r JOIN b ON b.user_id = r.user_id AND b.i BETWEEN r.i0 - 2 AND r.i1 + 2 WHERE lat_acc_g <> 0
          UNION ALL SELECT r.user_id, r.i0, b.i, 'lon', sign(lon_acc_g) FROM r JOIN b ON b.user_id = r.user_id AND b.i BETWEEN r.i0 - 2 AND r.i1 + 2 WHERE lon_acc_g <> 0),
    d AS (SELECT *, s <> lag(s) OVER (PARTITION BY user_id, i0, ax ORDER BY i) AS f FROM c),
    n AS (SELECT user_id, i0, ax, count(*) FILTER (f) AS n FROM d GROUP BY ALL), m AS (SELECT user_id, i0, max(n) AS n FROM n GROUP BY ALL)
    SELECT r.user_id, r.i0, run_len, round(peak_g, 6) AS peak_g, coalesce(m.n, 0) AS sign_alternations FROM r LEFT JOIN m ON m.user_id = r.user_id AND m.i0 = r.i0""",
)
def artefact_runs(spark, sf_dir):
    d = drive(spark, sf_dir).withColumn("label", F.lit(rules.NORMAL))
    found = E.artefact_overlap(d, K, "label", 1.0, 1, 2)[1]
    return found.select(*K, "i0", "run_len", r6("peak_g").alias("peak_g"), "sign_alternations")


@query(
    "class_statistics",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    r AS (SELECT label_p AS label, count(*) AS n_rows FROM plab GROUP BY ALL), e AS (SELECT label, count(*) AS n_events, quantile_cont(n_samples / 25.0::DOUBLE, 0.25) AS q1, median(n_samples / 25.0::DOUBLE) AS q2, quantile_cont(n_samples / 25.0::DOUBLE, 0.75) AS q3 FROM ea GROUP BY label)
    SELECT label, n_rows, round(n_rows * 100.0 / (SELECT count(*) FROM plab), 6) AS pct_rows, coalesce(n_events, 0) AS n_events, round(q1, 6) AS q1_s, round(q2, 6) AS median_s, round(q3, 6) AS q3_s FROM r LEFT JOIN e USING (label)""",
)
def class_statistics(spark, sf_dir):
    labelled = rules.label_v2(drive(spark, sf_dir), K, PLAIN)
    table = runs.event_table(labelled, K, "t", "label")
    out = E.class_stats(labelled, table, "label", F.col("n_samples") / 25.0)
    return out.withColumns({c: r6(c) for c in ("pct_rows", "q1_s", "median_s", "q3_s")})


@query(
    "events_per_session",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    c AS (SELECT u.user_id, count(ea.i0) AS n FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN ea USING (user_id) GROUP BY ALL)
    SELECT count(*) AS n_groups, min(n) AS fewest, max(n) AS most, count(*) FILTER (n = 0) AS n_without_events, round(median(n), 6) AS median_events FROM c""",
)
def events_per_session(spark, sf_dir):
    d = drive(spark, sf_dir)
    table = runs.event_table(rules.label_v2(d, K, PLAIN), K, "t", "label")
    return E.events_per_group(table, d, K).withColumn("median_events", r6("median_events"))


@query(
    "label_distribution",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, event_type, n, round(n / 25.0, 6) AS duration_s, round(n * 100.0 / sum(n) OVER (PARTITION BY user_id), 6) AS pct,
       row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1 AS dominant FROM c""",
)
def label_distribution(spark, sf_dir):
    from .registry import events

    out = E.label_distribution(events(spark, sf_dir), K, "event_type")
    return out.withColumns({"duration_s": r6("duration_s"), "pct": r6("pct")})


@query(
    "windows_with_all_classes",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    w AS (SELECT user_id, i0 AS c_i0, greatest(start_t - 172800.0 / 2, 0) AS w0 FROM ea WHERE label = 'Harsh Turning')
    SELECT w.user_id, w.c_i0, round(w.w0, 6) AS w0, count(*) AS n_events FROM w JOIN ea ON ea.user_id = w.user_id AND ea.start_t >= w.w0 AND ea.start_t <= w.w0 + 172800.0 AND ea.end_t <= w.w0 + 172800.0
    GROUP BY ALL HAVING count(DISTINCT ea.label) = 3""",
)
def windows_with_all_classes(spark, sf_dir):
    table = runs.event_table(rules.label_v2(drive(spark, sf_dir), K, PLAIN), K, "t", "label")
    out = E.windows_with_all(table, K, 172_800.0, rules.CLASSES, rules.TURN, 172_800.0)
    return out.withColumn("w0", r6("w0"))


@query(
    "modality_completeness",
    f"""WITH {DRIVE}, {rule_sql(PLAIN, 'p')}, {event_sql('plab', 'label_p', 'ea')},
    x AS (SELECT ea.user_id, ea.i0, ea.label, avg(CAST(throttle_pct > 20 AS DOUBLE)) AS f, bool_or(event_type = 'view' AND value > 5) AS face, bool_or(event_type = 'click' AND value > 5) AS pose
          FROM ea JOIN (SELECT plab.*, e.event_type, e.value FROM plab JOIN events e USING (event_id)) p ON p.user_id = ea.user_id AND p.t BETWEEN ea.start_t AND ea.end_t GROUP BY ALL)
    SELECT label, count(*) AS n_events, round(avg(CAST(f >= 0.5 AS DOUBLE)) * 100, 6) AS phys_pct, round(avg(CAST(face AS DOUBLE)) * 100, 6) AS face_pct,
       round(avg(CAST(pose AS DOUBLE)) * 100, 6) AS pose_pct, round(avg(CAST(f >= 0.5 AND face AND pose AS DOUBLE)) * 100, 6) AS all_pct FROM x GROUP BY ROLLUP (label)""",
)
def modality_completeness(spark, sf_dir):
    from .registry import events

    d = drive(spark, sf_dir)
    table = runs.event_table(rules.label_v2(d, K, PLAIN), K, "t", "label")
    ev = events(spark, sf_dir)
    frames_of = {
        "face": (ev.filter("event_type = 'view'"), F.col("value") > 5),
        "pose": (ev.filter("event_type = 'click'"), F.col("value") > 5),
    }
    found = E.modality_completeness(table, d, F.col("throttle_pct") > 20, frames_of, K, "t", 86_400.0)
    out = E.completeness_by_class(found, ["face", "pose"])
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("_pct")})
