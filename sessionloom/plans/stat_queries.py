"""Queries on grouped statistics, tables and folds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import blocks, intervals, relations, stats
from .registry import EV, SER, events, query, series, table, width
from .series_queries import K, r6

W = "(PARTITION BY user_id ORDER BY i"


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "grouped_summary",
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS n, round(sum(l_quantity), 2) AS total, round(avg(l_quantity), 6) AS mean,
       min(l_quantity) AS lowest, max(l_quantity) AS highest FROM lineitem GROUP BY ALL""",
)
def grouped_summary(spark, sf_dir):
    out = stats.summarise(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return rounded(out.withColumn("total", F.round("total", 2)), "mean")


@query(
    "exact_quantiles",
    """SELECT l_returnflag, """
    + ", ".join(
        f"round(quantile_cont(l_extendedprice, {p}), 4) AS {n}"
        for p, n in ((0.05, "p5"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99"))
    )
    + " FROM lineitem GROUP BY ALL",
)
def exact_quantiles(spark, sf_dir):
    names = ["p5", "q1", "median", "q3", "p90", "p95", "p99"]
    out = stats.quantiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99], names
    )
    return rounded(out, *names, digits=4)


@query("overall_median", "SELECT round(median(o_totalprice), 4) AS median FROM orders")
def overall_median(spark, sf_dir):
    return rounded(stats.medians(table(spark, sf_dir, "orders"), [], "o_totalprice"), "median", digits=4)


@query(
    "median_abs_deviation",
    "SELECT event_type, round(median(value), 6) AS median, round(mad(value), 6) AS mad FROM events GROUP BY event_type",
)
def median_abs_deviation(spark, sf_dir):
    return rounded(stats.mad(events(spark, sf_dir), ["event_type"], "value"), "median", "mad")


@query(
    "conditional_fraction",
    """SELECT event_type, round(avg(CASE WHEN value < 100 THEN CAST(value > 20 AS DOUBLE) END) * 100, 6) AS pct FROM events GROUP BY event_type""",
)
def conditional_fraction(spark, sf_dir):
    pct = stats.fraction(F.col("value") > 20, F.col("value") < 100)
    return events(spark, sf_dir).groupBy("event_type").agg(F.round(pct, 6).alias("pct"))


@query("pearson", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY ALL")
def pearson(spark, sf_dir):
    return rounded(stats.pearson(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice"), "r")


@query(
    "spearman",
    """WITH r AS (SELECT event_type, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0::DOUBLE AS rx,
       rank() OVER (PARTITION BY event_type ORDER BY user_id) + (count(*) OVER (PARTITION BY event_type, user_id) - 1) / 2.0::DOUBLE AS ry FROM events)
    SELECT event_type, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY event_type HAVING count(*) >= 20""",
)
def spearman(spark, sf_dir):
    out = stats.spearman(events(spark, sf_dir), ["event_type"], "value", "user_id", 5.0, 50.0, 20)
    return rounded(out, "rho")


@query(
    "spearman_per_session",
    """WITH r AS (SELECT user_id, rank() OVER (PARTITION BY user_id ORDER BY value) + (count(*) OVER (PARTITION BY user_id, value) - 1) / 2.0::DOUBLE AS rx,
       rank() OVER (PARTITION BY user_id ORDER BY event_id) + 0.0::DOUBLE AS ry FROM events)
    SELECT user_id, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY user_id HAVING count(*) >= 60""",
)
def spearman_per_session(spark, sf_dir):
    return rounded(stats.spearman(events(spark, sf_dir), K, "value", "event_id", 50.0, 5000.0, 60), "rho")


@query(
    "least_squares",
    """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY ALL""",
)
def least_squares(spark, sf_dir):
    out = stats.ols(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(
    "distinct_having",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey) >= 10",
)
def distinct_having(spark, sf_dir):
    return stats.distinct_having(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_partkey", 10)


GEO = "geo AS (SELECT *, 24 + CAST(json_extract_string(props, '$.k') AS INT) / 1000.0::DOUBLE AS lat, 46 + (value % 50.0) / 1000.0::DOUBLE AS lon FROM ser)"


def placed(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    return series(spark, sf_dir).withColumns(
        {"lat": F.lit(24) + k / F.lit(1000.0), "lon": F.lit(46) + F.pmod("value", F.lit(50.0)) / F.lit(1000.0)}
    )


@query(
    "grid_density",
    f"""WITH {SER}, {GEO}, c AS (SELECT *, CAST(round_even(lat / 0.005, 0) AS BIGINT) AS cell_lat, CAST(round_even(lon / 0.005, 0) AS BIGINT) AS cell_lon FROM geo)
    SELECT cell_lat, cell_lon, CAST(count(*) AS BIGINT) AS n, count(DISTINCT user_id) AS n_groups, round(avg(CAST(event_type = 'error' AS DOUBLE)), 6) AS hit_fraction,
       round(avg(lat) + 1e-9, 6) AS mean_lat, round(avg(lon) + 1e-9, 6) AS mean_lon FROM c GROUP BY ALL HAVING count(DISTINCT user_id) >= 10""",
)
def grid_density(spark, sf_dir):
    out = stats.grid_density(placed(spark, sf_dir), "lat", "lon", 0.005, F.col("event_type") == "error", "user_id", 10)
    # means of short decimals end in exact halves; the nudge makes both engines round them alike
    nudged = out.withColumns({c: F.col(c) + 1e-9 for c in ("mean_lat", "mean_lon")})
    return rounded(nudged, "hit_fraction", "mean_lat", "mean_lon")


@query(
    "crosstab",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'O') AS "l_linestatus_O", count(*) FILTER (l_linestatus = 'F') AS "l_linestatus_F" FROM lineitem GROUP BY ALL""",
)
def crosstab(spark, sf_dir):
    return stats.crosstab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["O", "F"])


@query(
    "weighted_mean",
    "SELECT l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean FROM lineitem GROUP BY ALL",
)
def weighted_mean(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.round(stats.weighted_mean("l_discount", "l_quantity"), 6).alias("mean")
    )


@query(
    "arg_extremes",
    """WITH r AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS b FROM events)
    SELECT user_id, event_id, value, 'max' AS kind FROM r WHERE a = 1 UNION ALL SELECT user_id, event_id, value, 'min' FROM r WHERE b = 1""",
)
def arg_extremes(spark, sf_dir):
    ev = events(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [stats.arg_extreme(ev, K, "value", "event_id", kind).withColumn("kind", F.lit(kind)) for kind in ("max", "min")],
    )


@query(
    "rater_kappa",
    """WITH c AS (SELECT quality AS a, toxic AS b, count(*)::DOUBLE AS o FROM labels GROUP BY ALL), n AS (SELECT sum(o) AS n FROM c),
    r AS (SELECT a, sum(o) AS ra FROM c GROUP BY a), l AS (SELECT b, sum(o) AS cb FROM c GROUP BY b),
    e AS (SELECT a, b, ra * cb / n AS e FROM r, l, n), s AS (SELECT sum(o) FILTER (a = b) AS same, sum(o) FILTER (abs(a - b) <= 1) AS near, sum(o * (a - b) ** 2) AS sq FROM c),
    x AS (SELECT sum(e) FILTER (a = b) AS same_e, sum(e * (a - b) ** 2) AS sq_e FROM e)
    SELECT CAST(n AS BIGINT) AS n, round(same / n * 100, 6) AS exact_pct, round(near / n * 100, 6) AS within_one_pct, round((same / n - same_e / n) / (1 - same_e / n), 6) AS kappa,
       round(1 - sq / sq_e, 6) AS kappa_quadratic FROM s, x, n""",
)
def rater_kappa(spark, sf_dir):
    out = stats.kappa(table(spark, sf_dir, "labels"), "quality", "toxic")
    return rounded(out, "exact_pct", "within_one_pct", "kappa", "kappa_quadratic")


@query(
    "rollup_statistics",
    """SELECT n_regionkey, c_nationkey, count(c_acctbal) AS n, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS lowest, max(c_acctbal) AS highest
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, c_nationkey)""",
)
def rollup_statistics(spark, sf_dir):
    # a nation table has one row per country: adaptive execution broadcasts it by its size
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey"
    )
    return stats.rollup_stats(joined, ["n_regionkey", "c_nationkey"], "c_acctbal").withColumn("mean", F.round("mean", 4))


@query(
    "route_consistency",
    f"""WITH {SER}, {GEO}, s AS (SELECT *, lag(lat) OVER {W}) AS plat, lag(lon) OVER {W}) AS plon FROM geo),
    h AS (SELECT *, 2 * 6371000.0 * asin(sqrt(sin(radians(lat - plat) / 2) ** 2 + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) ** 2)) AS m FROM s)
    SELECT user_id, round(coalesce(sum(m), 0) / 1000, 5) AS route_km, min(lat) AS lat_min, max(lat) AS lat_max, round(min(lon), 6) AS lon_min, round(max(lon), 6) AS lon_max, round(avg(value), 6) AS mean_speed FROM h GROUP BY user_id""",
)
def route_consistency(spark, sf_dir):
    out = stats.route_consistency(placed(spark, sf_dir), K, "lat", "lon", "value")
    return rounded(out.withColumn("route_km", F.round("route_km", 5)), "lon_min", "lon_max", "mean_speed")


@query(
    "without_shortest_session",
    """WITH c AS (SELECT user_id % 10 AS driver, user_id, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY driver ORDER BY n, user_id) AS r FROM c)
    SELECT driver, user_id, n FROM r WHERE r > 1""",
)
def without_shortest_session(spark, sf_dir):
    counts = events(spark, sf_dir).groupBy(F.pmod("user_id", F.lit(10)).alias("driver"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return stats.without_shortest(counts, ["driver"], "n", ["user_id"])


@query(
    "xcorr_peak",
    f"""WITH {SER}, p AS (SELECT a.user_id, g.lag, count(*) AS n, corr(a.value, CAST(b.event_id % 17 AS DOUBLE)) AS r FROM ser a CROSS JOIN (SELECT unnest(generate_series(-6, 6)) AS lag) g
       JOIN ser b ON b.user_id = a.user_id AND b.i = a.i + g.lag GROUP BY a.user_id, g.lag HAVING count(*) > 20)
    SELECT user_id, arg_min(lag, (-round(r, 9), lag)) AS peak_lag, round(max(r), 6) AS peak_r, round(max(r) FILTER (lag = 0), 6) AS r_at_zero FROM p GROUP BY user_id""",
)
def xcorr_peak(spark, sf_dir):
    pair = series(spark, sf_dir).withColumn("other", F.pmod("event_id", F.lit(17)).cast("double"))
    return rounded(stats.xcorr(pair, K, "value", "other", 6, 20), "peak_r", "r_at_zero")


@query(
    "find_offset",
    f"""WITH {SER}, pr AS (SELECT user_id, i - 10 AS j, value FROM ser WHERE i BETWEEN 10 AND 29),
    n AS (SELECT user_id, count(*) AS len FROM ser GROUP BY user_id), m AS (SELECT user_id, count(*) AS m FROM pr GROUP BY user_id),
    d AS (SELECT s.user_id, s.i - pr.j AS off, sum(abs(s.value - pr.value)) AS d FROM ser s JOIN pr USING (user_id) JOIN n USING (user_id) JOIN m USING (user_id)
       WHERE s.i - pr.j >= 0 AND s.i - pr.j < least(len - m, 40) GROUP BY ALL)
    SELECT user_id, arg_min(off, (round(d, 9), off)) AS "offset", round(min(d), 6) AS distance FROM d GROUP BY user_id""",
)
def find_offset(spark, sf_dir):
    raw = series(spark, sf_dir).select(*K, "i", "value")
    probe = raw.filter(F.col("i") >= 10).withColumn("i", F.col("i") - 10)
    return rounded(stats.find_offset(raw, probe, K, "value", 20, 40), "distance")


PROFILE = f"""WITH {SER}, st AS (SELECT user_id, i AS i0, row_number() OVER {W}) - 1 AS e FROM ser WHERE event_type = 'error'),
    w AS (SELECT st.user_id, st.e, s.i - st.i0 AS d, s.value AS x, CAST(s.event_id % 17 AS DOUBLE) AS y, count(*) OVER (PARTITION BY st.user_id, st.e) AS n
       FROM st JOIN ser s ON s.user_id = st.user_id AND s.i BETWEEN st.i0 - 8 AND st.i0 + 7),
    a AS (SELECT user_id, e, d, (x - avg(x) OVER (PARTITION BY user_id, e)) / (stddev_pop(x) OVER (PARTITION BY user_id, e) + 1e-9) AS a FROM w WHERE n = 16 AND d BETWEEN -4 AND 3),
    b0 AS (SELECT user_id, e, lag, d - lag AS d, y FROM w CROSS JOIN (SELECT unnest(generate_series(-3, 3)) AS lag) WHERE n = 16 AND d - lag BETWEEN -4 AND 3),
    b AS (SELECT user_id, e, lag, d, (y - avg(y) OVER (PARTITION BY user_id, e, lag)) / (stddev_pop(y) OVER (PARTITION BY user_id, e, lag) + 1e-9) AS b FROM b0),
    r AS (SELECT user_id, e, lag, sum(a * b) / 8 AS r FROM a JOIN b USING (user_id, e, d) GROUP BY ALL),
    m AS (SELECT user_id, lag, avg(r) AS m, count(*) AS n FROM r GROUP BY ALL HAVING count(*) >= 4)"""


def profiles(spark, sf_dir):
    pair = series(spark, sf_dir).withColumn("other", F.pmod("event_id", F.lit(17)).cast("double"))
    starts = blocks.index_rows(
        pair.filter("event_type = 'error'").select(*K, F.col("i").alias("i0")), K, ["i0"], blocks.chunk_of("i0", 65_536.0), "e"
    )
    return stats.event_lag_profiles(pair, starts, K, "value", "other", 4, 3, 4096.0)


@query(
    "event_xcorr",
    PROFILE + """ SELECT user_id, arg_min(lag, (-round(m, 12), lag)) AS peak_lag, round(max(m), 6) AS peak_r, round((max(m) - avg(m)) / (stddev_pop(m) + 1e-9), 5) AS peak_z, max(n) AS n_events FROM m GROUP BY user_id""",
)
def event_xcorr(spark, sf_dir):
    out = stats.event_xcorr(profiles(spark, sf_dir), K, 3, 4)
    return rounded(out.withColumn("peak_z", F.round("peak_z", 5)), "peak_r")


@query(
    "event_xcorr_bootstrap",
    PROFILE
    + """, num AS (SELECT user_id, e, row_number() OVER (PARTITION BY user_id ORDER BY e) - 1 AS pick, count(*) OVER (PARTITION BY user_id) AS n FROM (SELECT DISTINCT user_id, e FROM r)),
    dr AS (SELECT user_id, rep, CAST('0x' || substr(md5(concat_ws('|', 0, user_id, rep, e)), 1, 12) AS BIGINT) % n AS pick FROM (SELECT *, unnest(range(1, 51)) AS rep FROM num WHERE n >= 4)),
    mean AS (SELECT user_id, rep, lag, avg(r.r) AS v FROM dr JOIN num USING (user_id, pick) JOIN r USING (user_id, e) GROUP BY ALL),
    peak AS (SELECT user_id, rep, arg_min(lag, (-round(v, 12), lag)) AS lag FROM mean GROUP BY ALL)
    SELECT user_id, round(quantile_cont(lag, 0.025), 6) AS lag_lo, round(quantile_cont(lag, 0.975), 6) AS lag_hi, round(quantile_cont(lag, 0.975) - quantile_cont(lag, 0.025), 6) AS ci_width FROM peak GROUP BY user_id""",
)
def event_xcorr_bootstrap(spark, sf_dir):
    return rounded(stats.bootstrap_peak(profiles(spark, sf_dir), K, 3, 50, 0, 4), "lag_lo", "lag_hi", "ci_width")


@query(
    "histogram",
    """SELECT event_type, CAST(least(floor((value - 0) / (100.0::DOUBLE / 20)), 19) AS INT) AS bin, count(*) AS n FROM events WHERE value BETWEEN 0 AND 100 GROUP BY ALL""",
)
def histogram(spark, sf_dir):
    return stats.histogram(events(spark, sf_dir), ["event_type"], "value", 0.0, 100.0, 20)


@query(
    "box_statistics",
    "SELECT user_id, "
    + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for p, n in ((0.05, "p5"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (0.95, "p95")))
    + " FROM events WHERE value BETWEEN 1 AND 200 GROUP BY user_id",
)
def box_statistics(spark, sf_dir):
    valid = events(spark, sf_dir).filter(F.col("value").between(1, 200))
    return rounded(stats.box_stats(valid, K, "value"), "p5", "q1", "median", "q3", "p95")


@query(
    "expectation_check",
    """WITH m AS (SELECT 'rows' AS quantity, CAST(count(*) AS VARCHAR) AS value FROM lineitem UNION ALL SELECT 'mean_quantity', CAST(round(avg(l_quantity), 3) AS VARCHAR) FROM lineitem
       UNION ALL SELECT 'flags', string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FROM lineitem),
    e AS (SELECT * FROM (VALUES ('rows', '60000', 100.0::DOUBLE), ('mean_quantity', '25.5', 0.2), ('flags', 'A,N,R', NULL), ('absent', '1', 0.0)) t(quantity, expected, tol))
    SELECT quantity, expected, tol, value, CASE WHEN coalesce(CASE WHEN tol IS NULL THEN value = expected ELSE abs(TRY_CAST(value AS DOUBLE) - TRY_CAST(expected AS DOUBLE)) <= tol END, false) THEN 'PASS' ELSE 'FAIL' END AS status
    FROM e LEFT JOIN m USING (quantity)""",
)
def expectation_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    facts = li.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 3).alias("q"), F.sort_array(F.collect_set("l_returnflag")).alias("f"))
    metrics = facts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("quantity"), c.alias("value"))
                    for n, c in (("rows", F.col("n").cast("string")), ("mean_quantity", F.col("q").cast("string")), ("flags", F.concat_ws(",", "f")))
                ]
            )
        )
    )
    wanted = spark.createDataFrame(
        [("rows", "60000", 100.0), ("mean_quantity", "25.5", 0.2), ("flags", "A,N,R", None), ("absent", "1", 0.0)],
        "quantity string, expected string, tol double",
    )
    return stats.expect(metrics, wanted)


@query(
    "provenance_fit",
    f"""WITH {SER}, d AS (SELECT *, (value - lag(value) OVER {W})) * 25 AS a, CAST(event_id % 23 AS DOUBLE) AS acc FROM ser)
    SELECT user_id, count(*) AS n, round(corr(acc, a), 6) AS r, round(regr_slope(acc, a), 6) AS slope FROM d WHERE value > 5 AND a IS NOT NULL GROUP BY user_id HAVING count(*) >= 40""",
)
def provenance_fit(spark, sf_dir):
    d = series(spark, sf_dir).withColumn("acc", F.pmod("event_id", F.lit(23)).cast("double"))
    return rounded(stats.provenance_fit(d, K, "acc", "value", 25.0, 5.0, 40), "r", "slope")


# Intervals and tables.


@query(
    "point_in_interval",
    f"""WITH {EV} SELECT e.user_id, e.event_id AS at_id, p.event_id, p.value FROM ev e JOIN ev p ON p.user_id = e.user_id AND p.t BETWEEN e.t - 7200 AND e.t + 7200 WHERE e.event_type = 'purchase'""",
)
def point_in_interval(spark, sf_dir):
    ev = events(spark, sf_dir)
    spans = ev.filter("event_type = 'purchase'").select(*K, F.col("event_id").alias("at_id"), (F.col("t") - 7200).alias("w0"), (F.col("t") + 7200).alias("w1"))
    found = intervals.point_in_interval(ev.select(*K, "event_id", "t", "value"), spans, K, "t", "w0", "w1", 14_400.0)
    return found.select(*K, "at_id", "event_id", "value")


@query(
    "overlap_join",
    f"""WITH {EV}, a AS (SELECT user_id, event_id AS a_id, t AS a0, t + 3600 + value * 100 AS a1 FROM ev WHERE event_type IN ('view', 'click')), b AS (SELECT user_id, event_id AS b_id, t AS b0, t + 5400 AS b1 FROM ev WHERE event_type NOT IN ('view', 'click'))
    SELECT user_id, a_id, b_id FROM a JOIN b USING (user_id) WHERE a0 <= b1 AND b0 <= a1""",
)
def overlap_join(spark, sf_dir):
    ev = events(spark, sf_dir)
    first = F.col("event_type").isin("view", "click")
    a = ev.filter(first).select(*K, F.col("event_id").alias("a_id"), F.col("t").alias("a0"), (F.col("t") + 3600 + F.col("value") * 100).alias("a1"))
    b = ev.filter(~first).select(*K, F.col("event_id").alias("b_id"), F.col("t").alias("b0"), (F.col("t") + 5400).alias("b1"))
    return intervals.overlap_join(a, b, K, ("a0", "a1"), ("b0", "b1"), 14_400.0).select(*K, "a_id", "b_id")


@query(
    "upsert_rows",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus = 'F'""",
)
def upsert_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.select("o_orderkey", "o_totalprice")
    new = orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"))
    return relations.upsert(old, new, ["o_orderkey"])


@query("dedupe_first", "SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def dedupe_first(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "event_type", "event_id", "value")
    return relations.dedupe(ev, ["user_id", "event_type"], ["event_id"])


@query(
    "key_difference",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer)
    SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both, count(*) FILTER (b.k IS NULL) AS only_first, count(*) FILTER (a.k IS NULL) AS only_second FROM a FULL JOIN b ON a.k = b.k""",
)
def key_difference(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return relations.key_diff(a, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), ["k"])


@query(
    "table_identity",
    """SELECT 'missing_rows' AS "column", (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS n_changed
    UNION ALL SELECT 'o_custkey', 0 UNION ALL SELECT 'o_orderstatus', 0
    UNION ALL SELECT 'o_totalprice', (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice <> least(o_totalprice, 300000)) UNION ALL SELECT 'o_orderdate', 0""",
)
def table_identity(spark, sf_dir):
    a = table(spark, sf_dir, "orders")
    b = a.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", F.least("o_totalprice", F.lit(300_000.0)))
    return relations.identical_except(a, b, ["o_orderkey"], ["o_orderpriority"])


@query(
    "compare_results",
    """WITH b AS (SELECT user_id, event_type, round(avg(value), 6) AS mean, avg(value) > 30 AS flag FROM events WHERE event_type <> 'signup' AND value > 2 GROUP BY ALL),
    a AS (SELECT user_id, event_type, round(avg(value), 6) AS mean, avg(value) > 30 AS flag FROM events GROUP BY ALL)
    SELECT user_id, event_type, b.mean AS mean_before, a.mean AS mean_after, b.flag AS flag_before, a.flag AS flag_after, b.flag IS DISTINCT FROM a.flag AS flipped FROM b FULL JOIN a USING (user_id, event_type)""",
)
def compare_results(spark, sf_dir):
    # the earlier analysis left out sign-ups and very small values, the later one reads everything
    def means(df):
        return df.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("mean"), (F.avg("value") > 30).alias("flag"))

    ev = events(spark, sf_dir)
    return relations.compare_results(means(ev.filter("event_type <> 'signup' AND value > 2")), means(ev), ["user_id", "event_type"], "flag")


@query(
    "join_reports",
    """SELECT c.c_custkey, o.n_orders, o.spend FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
)
def join_reports(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    counts = orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    spend = orders.groupBy("c_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    return relations.join_reports(base, counts, spend, on=["c_custkey"])


@query(
    "constant_cross",
    "SELECT s_suppkey, camera FROM supplier CROSS JOIN (VALUES ('front'), ('side')) c(camera)",
)
def constant_cross(spark, sf_dir):
    return relations.cross(table(spark, sf_dir, "supplier").select("s_suppkey"), ["front", "side"], "camera")


@query(
    "attach_overrides",
    """SELECT o.o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderpriority = '1-URGENT' AS overridden FROM orders o""",
)
def attach_overrides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    manual = orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit(0.0).alias("o_totalprice"))
    return relations.attach_overrides(orders.select("o_orderkey", "o_totalprice"), manual, ["o_orderkey"], ["o_totalprice"])


@query(
    "exception_tags",
    """SELECT c_custkey, coalesce(t.tags, []) AS tags FROM customer LEFT JOIN (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority)) AS tags FROM orders GROUP BY o_custkey) t ON o_custkey = c_custkey""",
)
def exception_tags(spark, sf_dir):
    tags = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    return relations.attach_tags(table(spark, sf_dir, "customer").select("c_custkey"), tags, ["c_custkey"], "o_orderpriority", "tags")


@query("skip_done", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def skip_done(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relations.skip_done(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query(
    "leave_one_group_out",
    """SELECT f.fold, CASE WHEN f.fold = e.event_type THEN 'test' ELSE 'train' END AS role, count(*) AS n, count(DISTINCT event_type) AS n_groups FROM events e
    CROSS JOIN (SELECT DISTINCT event_type AS fold FROM events) f GROUP BY ALL""",
)
def leave_one_group_out(spark, sf_dir):
    # The event types of the table.
    kinds = ["click", "error", "purchase", "signup", "view"]
    folds = relations.leave_one_group_out(events(spark, sf_dir), "event_type", kinds)
    per_group = folds.groupBy("fold", "role", "event_type").agg(F.count(F.lit(1)).alias("c"))
    return per_group.groupBy("fold", "role").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_groups"))


@query(
    "fold_sizes",
    """WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), s AS (SELECT CAST(sum(n) AS BIGINT) AS a, count(*) AS g FROM c) SELECT user_id AS fold, n AS n_test, a - n AS n_train, g - 1 AS train_groups FROM c, s""",
)
def fold_sizes(spark, sf_dir):
    return relations.fold_sizes(events(spark, sf_dir), "user_id")


@query(
    "leaking_groups",
    """SELECT 'f' || CAST(user_id % 3 AS VARCHAR) AS fold, user_id, count(DISTINCT event_id % 2) AS roles FROM events GROUP BY ALL HAVING count(DISTINCT event_id % 2) > 1""",
)
def leaking_groups(spark, sf_dir):
    """A split by row instead of by session leaks."""
    role = F.when(F.pmod("event_id", F.lit(2)) == 0, "train").otherwise("test")
    fold = F.concat(F.lit("f"), F.pmod("user_id", F.lit(3)).cast("string"))
    return relations.leaking_groups(events(spark, sf_dir).withColumns({"fold": fold, "role": role}), "user_id")


@query("sound_folds", "SELECT fold, event_type, roles FROM (SELECT '' AS fold, '' AS event_type, CAST(2 AS BIGINT) AS roles) WHERE false")
def sound_folds(spark, sf_dir):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return relations.leaking_groups(relations.leave_one_group_out(events(spark, sf_dir), "event_type", kinds), "event_type")


@query(
    "stratified_sample",
    """WITH h AS (SELECT user_id, event_type, event_id, md5(concat_ws('|', 7, user_id, event_type, event_id)) AS h FROM events),
    c AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY h, event_id) AS r FROM h),
    p AS (SELECT user_id, event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY r, h, event_id) AS INT) AS position FROM c WHERE r <= 2)
    SELECT * FROM p WHERE position <= 40""",
)
def stratified_sample(spark, sf_dir):
    return relations.stratified_sample(events(spark, sf_dir), K, "event_type", "event_id", 40, 2, 7)


@query(
    "shuffled_sample",
    """WITH h AS (SELECT user_id, event_type, event_id, md5(concat_ws('|', 7, user_id, event_type, event_id)) AS h FROM events),
    c AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY h, event_id) AS r FROM h),
    p AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY r, h, event_id) AS position FROM c WHERE r <= 2)
    SELECT user_id, event_type, event_id, 'F' || lpad(CAST(row_number() OVER (ORDER BY md5(concat_ws('|', 7, event_id))) AS VARCHAR), 3, '0') AS frame_id FROM p WHERE position <= 40""",
)
def shuffled_sample(spark, sf_dir):
    drawn = relations.stratified_sample(events(spark, sf_dir), K, "event_type", "event_id", 40, 2, 7)
    return relations.shuffled_ids(drawn, ["event_id"], 7).drop("position")


@query(
    "sorted_series",
    "SELECT user_id, event_id, value FROM events",
)
def sorted_series(spark, sf_dir):
    return relations.sort_series(events(spark, sf_dir), K, "t_us").select(*K, "event_id", "value")


# Column functions on the tables' own values.


@query(
    "scalar_functions",
    f"""WITH {EV}, x AS (SELECT event_id, value, event_id % 360 AS h0, (value * 7) % 360 AS h1, 24 + (event_id % 100) / 1000.0::DOUBLE AS lat, 46 + (event_id % 77) / 1000.0::DOUBLE AS lon FROM ev)
    SELECT event_id, round((h1 - h0 + 180) - floor((h1 - h0 + 180) / 360) * 360 - 180, 6) AS turn, round(sqrt(value * value + h0 * h0 + h1 * h1), 6) AS size, greatest(least(value, 50.0), -50.0) AS clipped,
       round(2 * 6371000.0 * asin(sqrt(sin(radians(lat - 24.05) / 2) ** 2 + cos(radians(24.05)) * cos(radians(lat)) * sin(radians(lon - 46.03) / 2) ** 2)), 4) AS metres,
       round(lon * (6378137.0 * pi() / 180), 3) AS mx, round(ln(tan((90 + lat) * pi() / 360)) * 6378137.0, 3) AS my, lat BETWEEN 24.02 AND 24.06 AND lon BETWEEN 46.01 AND 46.05 AS inside,
       CAST(greatest(0, round_even((value - 10) * 30, 0)) AS BIGINT) AS frame, CASE WHEN value > 50 THEN 'high' WHEN value > 20 THEN 'mid' ELSE 'Normal' END AS cls,
       CASE WHEN value > 1 THEN (CAST(value BETWEEN 10 AND 30 AND h0 BETWEEN 50 AND 200 AS DOUBLE) + CAST(h1 BETWEEN 10 AND 30 AND value BETWEEN 50 AND 200 AS DOUBLE)) / 2 END AS proxy, value BETWEEN 5 AND 80 AS value_valid FROM x""",
)
def scalar_functions(spark, sf_dir):
    x = events(spark, sf_dir).select(
        "event_id", "value", F.pmod("event_id", F.lit(360)).alias("h0"), F.pmod(F.col("value") * 7, F.lit(360.0)).alias("h1"),
        (F.lit(24) + F.pmod("event_id", F.lit(100)) / 1000.0).alias("lat"), (F.lit(46) + F.pmod("event_id", F.lit(77)) / 1000.0).alias("lon"),
    )
    xy = S.web_mercator("lon", "lat")
    return x.select(
        "event_id", r6(S.wrapped_diff("h0", "h1")).alias("turn"), r6(S.magnitude("value", "h0", "h1")).alias("size"), S.clip("value", 50).alias("clipped"),
        F.round(S.haversine_m(F.lit(24.05), F.lit(46.03), "lat", "lon"), 4).alias("metres"), F.round(xy["x"], 3).alias("mx"), F.round(xy["y"], 3).alias("my"),
        S.in_bbox("lat", "lon", {"lat0": 24.02, "lat1": 24.06, "lon0": 46.01, "lon1": 46.05}).alias("inside"), S.time_to_frame("value", F.lit(10.0), 30).alias("frame"),
        S.resolve_priority([("high", F.col("value") > 50), ("mid", F.col("value") > 20)]).alias("cls"),
        S.region_proxy([("value", "h0"), ("h1", "value")], (10, 30, 50, 200), F.col("value") > 1).alias("proxy"),
        S.validity({"value": (5, 80)}, {})["value_valid"].alias("value_valid"),
    )


@query(
    "parse_texts",
    f"""WITH {EV}, x AS (SELECT event_id, ts, t_us, value FROM ev)
    SELECT event_id, round(hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 0.25, 6) AS tod, round((CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) * (24 + (event_id % 60) / 60.0::DOUBLE), 6) AS degrees, 24.5::DOUBLE AS plain,
       CAST(floor(t_us / 1000000) - 10800 AS DOUBLE) AS stamp, round(floor(t_us / 1000000) - 10800 + 0.5, 6) AS stamp_micros, CAST(ts AS DATE) AS day, value AS number, CAST(NULL AS DOUBLE) AS junk FROM x""",
)
def parse_texts(spark, sf_dir):
    x = events(spark, sf_dir)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd_HH-mm-ss"))
    text = x.select(
        "event_id", "value",
        # leading zeros are lost, as when a logger writes the clock as a number
        F.concat(F.regexp_replace(F.date_format("ts", "HHmmss"), "^0+(?=.)", ""), F.lit(".25")).alias("clock"),
        F.concat(F.lit("24°"), F.pmod("event_id", F.lit(60)).cast("string"), F.lit(".0 "), F.when(F.pmod("event_id", F.lit(2)) == 0, "N").otherwise("S")).alias("dm"),
        stamp.alias("stamp"), F.concat(stamp, F.lit("-5")).alias("stamp5"),
    )
    return text.select(
        "event_id", r6(S.hhmmss_to_seconds("clock")).alias("tod"), r6(S.parse_degree_minutes("dm")).alias("degrees"), S.parse_degree_minutes(F.lit("24.5")).alias("plain"),
        S.stamp_to_epoch("stamp").alias("stamp"), r6(S.stamp_to_epoch("stamp5", micros=True)).alias("stamp_micros"), S.stamp_date("stamp").alias("day"),
        S.to_double(F.col("value").cast("string")).alias("number"), S.to_double(F.lit("n/a")).alias("junk"),
    )


@query(
    "load_aligned",
    f"""WITH {EV}, l AS (SELECT * FROM ev WHERE event_type IN ('view', 'click')), r AS (SELECT user_id, t AS rt, value AS rv FROM ev WHERE event_type NOT IN ('view', 'click')),
    j AS (SELECT l.user_id, l.event_id, l.t, l.value BETWEEN 1 AND 100 AS value_valid, p.rt AS pt, p.rv AS pv, n.rt AS nt, n.rv AS nv FROM l ASOF LEFT JOIN r p ON l.user_id = p.user_id AND l.t >= p.rt ASOF LEFT JOIN r n ON l.user_id = n.user_id AND l.t <= n.rt)
    SELECT user_id, event_id, value_valid, CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t - pt <= nt - t) THEN pv ELSE nv END AS face FROM j""",
)
def load_aligned(spark, sf_dir):
    from ..sources.sessions import align_modalities

    ev = events(spark, sf_dir)
    fused = ev.filter(F.col("event_type").isin("view", "click")).select(*K, "event_id", "t", "value")
    face = ev.filter(~F.col("event_type").isin("view", "click")).select(*K, "t", F.col("value").alias("face"))
    out = align_modalities(fused, {"face": face}, K, "t", width(sf_dir), {"value": (1, 100)}, {})
    return out.select(*K, "event_id", "value_valid", "face")
