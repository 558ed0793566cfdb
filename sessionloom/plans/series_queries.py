"""Queries on runs, frames, alignment and resampling (events as one series per user)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof, blocks, frames, relations, resample, runs, stats
from ..session import settle
from .registry import EV, SER, events, query, series, width

K = ["user_id"]


def r6(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def clean_sql(src: str, m: str, close_n: int, min_n: int, p: str) -> str:
    """CTEs that end in `{p}out`: `src` with the mask `m` cleaned into `{p}k`."""
    w = "(PARTITION BY user_id ORDER BY i)"
    return f"""
    {p}a AS (SELECT *, CASE WHEN {m} = lag({m}) OVER {w} THEN 0 ELSE 1 END AS {p}chg FROM {src}),
    {p}b AS (SELECT *, sum({p}chg) OVER {w} AS {p}g FROM {p}a),
    {p}c AS (SELECT user_id, {p}g, count(*) AS {p}n, max({p}g) OVER (PARTITION BY user_id) AS {p}last
             FROM {p}b GROUP BY user_id, {p}g),
    {p}d AS (SELECT {p}b.*, ({m} OR ({p}n <= {close_n} AND {p}g > 1 AND {p}g < {p}last)) AS {p}f
             FROM {p}b JOIN {p}c USING (user_id, {p}g)),
    {p}e AS (SELECT *, CASE WHEN {p}f = lag({p}f) OVER {w} THEN 0 ELSE 1 END AS {p}chg2 FROM {p}d),
    {p}h AS (SELECT *, sum({p}chg2) OVER {w} AS {p}g2 FROM {p}e),
    {p}out AS (SELECT *, {p}f AND count(*) OVER (PARTITION BY user_id, {p}g2) >= {min_n} AS {p}k FROM {p}h)"""


def label_sql(prefix: str = "") -> str:
    return f"""{SER}, base AS (SELECT *, value > 60 AS m1, value < 10 AS m2 FROM ser),
    {clean_sql('base', 'm1', 1, 2, 'x')}, {clean_sql('xout', 'm2', 1, 2, 'y')},
    lab AS (SELECT *, CASE WHEN xk THEN 'Surge' WHEN yk THEN 'Calm' ELSE 'Normal' END AS label FROM yout)"""


RUNS_OF_LABEL = """
    la AS (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS lchg FROM lab),
    lb AS (SELECT *, sum(lchg) OVER (PARTITION BY user_id ORDER BY i) AS lg FROM la),
    evt AS (SELECT user_id, label, min(i) AS i0, max(i) AS i1, min(t) AS start_t, max(t) AS end_t, count(*) AS n_samples
            FROM lb GROUP BY user_id, label, lg)"""


def labelled(spark, sf_dir):
    """Two cleaned masks resolved by priority; both masks share one pass over the blocks."""
    masked = series(spark, sf_dir).select(
        *K, "t", "i", "value", (F.col("value") > 60).alias("m1"), (F.col("value") < 10).alias("m2")
    )

    def layers(w):
        first = runs.close_then_keep(w, F.col("m1"), 1, 2, "surge")
        second = runs.close_then_keep(w, F.col("m2"), 1, 2, "calm")
        return [a | b for a, b in zip(first, second)]

    cleaned = blocks.over_blocks(masked, K, 4, 4, layers)
    return cleaned.select(
        *K, "t", "i", "value", S.resolve_priority([("Surge", "surge"), ("Calm", "calm")]).alias("label")
    )


@query(
    "flagship",
    f"""WITH {label_sql()}, {RUNS_OF_LABEL}
    SELECT label, count(*) AS n_events, count(DISTINCT user_id) AS n_sessions,
           CAST(sum(n_samples) AS BIGINT) AS n_samples,
           round(median(round(end_t - start_t, 6)), 6) AS median_duration_s
    FROM evt WHERE label <> 'Normal' GROUP BY label""",
)
def flagship(spark, sf_dir):
    # events are few next to samples, and three aggregations read them
    found = settle(
        runs.event_table(labelled(spark, sf_dir), K, "t", "label").withColumn(
            "duration", r6(F.col("end_t") - F.col("start_t"))
        )
    )
    per_session = found.groupBy("label", *K).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_samples").alias("s")
    )
    counts = per_session.groupBy("label").agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_sessions"), F.sum("s").alias("n_samples")
    )
    middle = stats.medians(found, ["label"], "duration", "median_duration_s")
    return counts.join(middle, "label").withColumn("median_duration_s", r6("median_duration_s"))


@query(
    "label_event_table",
    f"""WITH {label_sql()}, {RUNS_OF_LABEL}
    SELECT user_id, label, i0, i1, n_samples, round(start_t, 6) AS start_t, round(end_t, 6) AS end_t
    FROM evt WHERE label <> 'Normal'""",
)
def label_event_table(spark, sf_dir):
    found = runs.event_table(labelled(spark, sf_dir), K, "t", "label")
    return found.select(*K, "label", "i0", "i1", "n_samples", r6("start_t").alias("start_t"), r6("end_t").alias("end_t"))


@query(
    "event_counts_zero_filled",
    f"""WITH {label_sql()}, {RUNS_OF_LABEL}
    SELECT u.user_id, c.cls, count(evt.user_id) AS n_events
    FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES ('Surge'), ('Calm')) c(cls)
    LEFT JOIN evt ON evt.user_id = u.user_id AND evt.label = c.cls GROUP BY ALL""",
)
def event_counts_zero_filled(spark, sf_dir):
    # counted over all runs, so a session without events still has its zero rows
    return runs.event_counts(
        runs.run_table(labelled(spark, sf_dir), K, "t", "label"), K, "label", ["Surge", "Calm"]
    )


@query(
    "mask_runs",
    f"""WITH {SER}, base AS (SELECT *, value > 30 AS m FROM ser),
    a AS (SELECT *, CASE WHEN m = lag(m) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS chg FROM base),
    b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY i) AS g FROM a)
    SELECT user_id, min(i) AS i0, max(i) AS i1, count(*) AS n_samples FROM b WHERE m GROUP BY user_id, g""",
)
def mask_runs(spark, sf_dir):
    masked = series(spark, sf_dir).withColumn("m", F.col("value") > 30)
    return runs.runs(masked, K, "t", "m").select(*K, "i0", "i1", "n_samples")


@query(
    "value_runs",
    f"""WITH {SER},
    a AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY i) THEN 0 ELSE 1 END AS chg FROM ser),
    b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY i) AS g FROM a)
    SELECT user_id, event_type, min(i) AS i0, max(i) AS i1, count(*) AS n_samples FROM b GROUP BY user_id, event_type, g""",
)
def value_runs(spark, sf_dir):
    return runs.run_table(series(spark, sf_dir), K, "t", "event_type").select(
        *K, "event_type", "i0", "i1", "n_samples"
    )


@query(
    "turn_runs",
    """WITH a AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS chg FROM conversations),
    b AS (SELECT *, sum(chg) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM a)
    SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n_samples FROM b GROUP BY conv_id, role, g""",
)
def turn_runs(spark, sf_dir):
    from .registry import table

    turns = blocks.index_rows(
        table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"),
        ["conv_id"],
        ["turn"],
        blocks.chunk_of("turn", 10_000.0),
    )
    return runs.run_table(turns, ["conv_id"], "turn", "role").select(
        "conv_id", "role", F.col("start_t").alias("first_turn"), F.col("end_t").alias("last_turn"), "n_samples"
    )


def _mask_rows(name, sql_column):
    return f"""SELECT user_id, i, {sql_column} AS kept FROM {name}"""


@query(
    "drop_short_runs",
    f"""WITH {SER}, base AS (SELECT *, value > 20 AS m FROM ser), {clean_sql('base', 'm', 0, 3, 'x')}
    SELECT user_id, i, xk AS kept FROM xout""",
)
def drop_short_runs(spark, sf_dir):
    masked = series(spark, sf_dir).withColumn("m", F.col("value") > 20)
    return runs.drop_short(masked, K, "m", 3).select(*K, "i", F.col("m_kept").alias("kept"))


@query(
    "close_gaps_keep_long",
    f"""WITH {SER}, base AS (SELECT *, value > 30 AS m FROM ser), {clean_sql('base', 'm', 2, 4, 'x')}
    SELECT user_id, i, xk AS kept FROM xout""",
)
def close_gaps_keep_long(spark, sf_dir):
    masked = series(spark, sf_dir).withColumn("m", F.col("value") > 30)
    return runs.close_and_keep(masked, K, "m", 2, 4).select(*K, "i", F.col("m_clean").alias("kept"))


@query(
    "dilate_mask",
    f"""WITH {SER}, base AS (SELECT *, value > 90 AS m FROM ser)
    SELECT user_id, i, bool_or(m) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 3 FOLLOWING) AS even_n,
           bool_or(m) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS odd_n FROM base""",
)
def dilate_mask(spark, sf_dir):
    masked = series(spark, sf_dir).withColumn("m", F.col("value") > 90)
    return blocks.over_blocks(
        masked,
        K,
        6,
        6,
        lambda w: [runs.dilated(w, F.col("m"), 6, "even_n")[0] | runs.dilated(w, F.col("m"), 5, "odd_n")[0]],
    ).select(*K, "i", "even_n", "odd_n")


@query(
    "close_mask",
    f"""WITH {SER}, base AS (SELECT *, value > 40 AS m FROM ser),
    d AS (SELECT *, bool_or(m) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS d FROM base)
    SELECT user_id, i, CAST(sum(CAST(d AS INT)) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) = 4 AS closed FROM d""",
)
def close_mask(spark, sf_dir):
    masked = series(spark, sf_dir).withColumn("m", F.col("value") > 40)
    return runs.closing(masked, K, "m", 4).select(*K, "i", F.col("m_closed").alias("closed"))


def _frame(name, n, fn, centred, sql_fn):
    before, after = frames.reach(n, centred)
    sql = f"""WITH {SER} SELECT user_id, i, round({sql_fn}(value) OVER (PARTITION BY user_id ORDER BY i
        ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING), 6) AS rolled FROM ser"""

    @query(name, sql)
    def run(spark, sf_dir):
        roll = frames.rolling_centred if centred else frames.rolling_trailing
        return roll(series(spark, sf_dir), K, "value", n, fn, "rolled").select(*K, "i", r6("rolled").alias("rolled"))


_frame("rolling_min_trailing", 5, "min", False, "min")
_frame("rolling_max_trailing", 5, "max", False, "max")
_frame("rolling_mean_centred", 5, "avg", True, "avg")
_frame("rolling_mean_even", 12, "avg", True, "avg")
_frame("rolling_median_centred", 5, "median", True, "median")


@query(
    "derivative",
    f"""WITH {SER} SELECT user_id, i, round((value - lag(value) OVER w) * 25, 6) AS slope,
        round((value - lag(value) OVER w) / (t - lag(t) OVER w), 6) AS slope_dt FROM ser WINDOW w AS (PARTITION BY user_id ORDER BY i)""",
)
def derivative(spark, sf_dir):
    base = series(spark, sf_dir)
    done = blocks.over_blocks(
        base,
        K,
        1,
        0,
        lambda w: [
            {"dt": F.col("t") - F.lag("t").over(w), "dv": F.col("value") - F.lag("value").over(w)}
        ],
    )
    return done.select(*K, "i", r6(F.col("dv") * 25).alias("slope"), r6(F.try_divide("dv", "dt")).alias("slope_dt"))


@query(
    "central_gradient",
    f"""WITH {SER} SELECT user_id, i, round(CASE WHEN lag(i) OVER w IS NULL AND lead(i) OVER w IS NULL THEN NULL
        WHEN lag(i) OVER w IS NULL THEN lead(value) OVER w - value
        WHEN lead(i) OVER w IS NULL THEN value - lag(value) OVER w
        ELSE (lead(value) OVER w - lag(value) OVER w) / 2 END, 6) AS gradient FROM ser WINDOW w AS (PARTITION BY user_id ORDER BY i)""",
)
def central_gradient(spark, sf_dir):
    return frames.central_gradient(series(spark, sf_dir), K, "value", "gradient").select(*K, "i", r6("gradient").alias("gradient"))


@query(
    "detrend",
    f"""WITH {SER} SELECT user_id, i, round(value - avg(value) OVER (PARTITION BY user_id ORDER BY i
        ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING), 6) AS detrended FROM ser""",
)
def detrend(spark, sf_dir):
    return frames.detrend(series(spark, sf_dir), K, "value", 21, "detrended").select(*K, "i", r6("detrended").alias("detrended"))


@query(
    "time_bin_mean",
    f"""WITH {EV}, b AS (SELECT user_id, CAST(floor(t * (1.0 / 86400)) AS BIGINT) AS bin, avg(value) AS v FROM ev GROUP BY ALL),
    s AS (SELECT user_id, min(bin) AS b0, max(bin) AS b1 FROM b GROUP BY user_id),
    g AS (SELECT user_id, unnest(generate_series(b0, b1)) AS bin FROM s)
    SELECT user_id, bin, round(v, 6) AS value FROM g LEFT JOIN b USING (user_id, bin)""",
)
def time_bin_mean(spark, sf_dir):
    return frames.time_bin(events(spark, sf_dir), K, "t", "value", 1.0 / 86_400).select(*K, "bin", r6("value").alias("value"))


HAMPEL = f"""WITH {SER}, c AS (SELECT user_id, i, value, count(*) OVER (PARTITION BY user_id) AS n,
        list(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS l FROM ser),
    d AS (SELECT *, list_median(l) AS med FROM c),
    e AS (SELECT *, greatest(list_median(list_transform(l, lambda x: abs(x - med))) * 1.4826, 1e-6) AS mad FROM d)"""


@query(
    "hampel",
    HAMPEL + " SELECT user_id, i, round(CASE WHEN n >= 15 AND abs(value - med) > 3 * mad THEN med ELSE value END, 6) AS despiked FROM e",
)
def hampel(spark, sf_dir):
    return frames.hampel(series(spark, sf_dir), K, "value", "despiked").select(*K, "i", r6("despiked").alias("despiked"))


@query(
    "hampel_gated",
    HAMPEL
    + """ SELECT user_id, i, round(CASE WHEN n >= 15 AND abs(value - med) > 3 * mad AND abs(value) > 100
      THEN med ELSE value END, 6) AS despiked FROM e""",
)
def hampel_gated(spark, sf_dir):
    return frames.hampel(series(spark, sf_dir), K, "value", "despiked", abs_threshold=100.0).select(
        *K, "i", r6("despiked").alias("despiked")
    )


@query(
    "unwrap_heading",
    f"""WITH {SER}, h AS (SELECT *, value - floor(value / 360) * 360 AS h FROM ser),
    s AS (SELECT *, coalesce((h - lag(h) OVER w + 180) - floor((h - lag(h) OVER w + 180) / 360) * 360 - 180, h) AS step
          FROM h WINDOW w AS (PARTITION BY user_id ORDER BY i))
    SELECT user_id, i, round(radians(sum(step) OVER (PARTITION BY user_id ORDER BY i)), 6) AS unwrapped FROM s""",
)
def unwrap_heading(spark, sf_dir):
    headed = series(spark, sf_dir).withColumn("h", F.pmod("value", F.lit(360.0)))
    return frames.unwrap_angle(headed, K, "h", "unwrapped").select(*K, "i", r6("unwrapped").alias("unwrapped"))


# Alignment: views and clicks are looked up in the other events of the same user.

SIDES = EV + """, l AS (SELECT user_id, event_id, t FROM ev WHERE event_type IN ('view', 'click')),
    r AS (SELECT user_id, event_id AS r_id, t AS rt, value FROM ev WHERE event_type NOT IN ('view', 'click')),
    j AS (SELECT l.*, p.r_id AS p_id, p.rt AS p_t, p.value AS p_v, n.r_id AS n_id, n.rt AS n_t, n.value AS n_v
          FROM l ASOF LEFT JOIN r p ON l.user_id = p.user_id AND l.t >= p.rt
          ASOF LEFT JOIN r n ON l.user_id = n.user_id AND l.t <= n.rt),
    near AS (SELECT *, CASE WHEN p_id IS NOT NULL AND (n_id IS NULL OR t - p_t <= n_t - t) THEN p_id ELSE n_id END AS hit,
          CASE WHEN p_id IS NOT NULL AND (n_id IS NULL OR t - p_t <= n_t - t) THEN p_t ELSE n_t END AS hit_t,
          CASE WHEN p_id IS NOT NULL AND (n_id IS NULL OR t - p_t <= n_t - t) THEN p_v ELSE n_v END AS hit_v FROM j)"""


def sides(spark, sf_dir):
    left, right = streams(spark, sf_dir)
    left = left.select(*K, "event_id", "t")
    right = right.select(*K, F.col("event_id").alias("r_id"), "t", "value")
    return left, right


@query("asof_nearest_tol", f"WITH {SIDES} SELECT user_id, event_id, CASE WHEN abs(t - hit_t) <= 21600 THEN hit END AS r_id, CASE WHEN abs(t - hit_t) <= 21600 THEN hit_v END AS value FROM near")
def asof_nearest_tol(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return asof.asof_nearest(left, right, K, "t", width(sf_dir), 21_600.0, "", "r_id").select(*K, "event_id", "r_id", "value")


@query("asof_nearest", f"WITH {SIDES} SELECT user_id, event_id, hit AS r_id, hit_v AS value FROM near")
def asof_nearest(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return asof.asof_nearest(left, right, K, "t", width(sf_dir), None, "", "r_id").select(*K, "event_id", "r_id", "value")


@query("asof_next_prev", f"WITH {SIDES} SELECT user_id, event_id, p_id, n_id FROM j")
def asof_next_prev(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    ahead = asof.asof_next(left, right.select(*K, F.col("r_id").alias("n_id"), "t"), K, "t", width(sf_dir), "", "n_id")
    both = asof.asof_prev(ahead, right.select(*K, F.col("r_id").alias("p_id"), "t"), K, "t", width(sf_dir), "", "p_id")
    return both.select(*K, "event_id", "p_id", "n_id")


CHAIN = ("('view', 'click')", "('purchase', 'signup')", "('error')")


@query(
    "asof_chain",
    f"""WITH {EV}, {", ".join(f"s{n} AS (SELECT user_id, t AS t{n}, value AS v{n} FROM ev WHERE event_type IN {e})" for n, e in enumerate(CHAIN))},
    a AS (SELECT s0.*, p.t1 AS pt, p.v1 AS pv, n.t1 AS nt, n.v1 AS nv FROM s0
          ASOF LEFT JOIN s1 p ON s0.user_id = p.user_id AND s0.t0 >= p.t1
          ASOF LEFT JOIN s1 n ON s0.user_id = n.user_id AND s0.t0 <= n.t1),
    a2 AS (SELECT user_id, t0, v0, CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t0 - pt <= nt - t0) THEN pv ELSE nv END AS v1,
           CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t0 - pt <= nt - t0) THEN t0 - pt ELSE nt - t0 END AS d1 FROM a),
    b AS (SELECT a2.*, p.t2 AS pt, p.v2 AS pv, n.t2 AS nt, n.v2 AS nv FROM a2
          ASOF LEFT JOIN s2 p ON a2.user_id = p.user_id AND a2.t0 >= p.t2
          ASOF LEFT JOIN s2 n ON a2.user_id = n.user_id AND a2.t0 <= n.t2),
    b2 AS (SELECT *, CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t0 - pt <= nt - t0) THEN pv ELSE nv END AS v2,
           CASE WHEN pt IS NOT NULL AND (nt IS NULL OR t0 - pt <= nt - t0) THEN t0 - pt ELSE nt - t0 END AS d2 FROM b)
    SELECT user_id, round(t0, 6) AS t, v0 AS x, v1 AS y, v2 AS z FROM b2 WHERE d1 <= 43200 AND d2 <= 43200""",
)
def asof_chain(spark, sf_dir):
    ev = events(spark, sf_dir)
    parts = [
        ev.filter(f"event_type IN {e}").select(*K, "t", F.col("value").alias(n))
        for e, n in zip(CHAIN, "xyz")
    ]
    return asof.asof_chain(parts, K, "t", 43_200.0, width(sf_dir)).select(*K, r6("t").alias("t"), "x", "y", "z")


# Resampling: one grid step per six hours between a user's first and last event.

GRID_FS = 1.0 / 21_600
GRID = EV + """, win AS (SELECT user_id, min(t) AS w_start, max(t) AS w_end FROM ev GROUP BY user_id),
    gi AS (SELECT user_id, w_start, unnest(generate_series(0, CAST(ceil((w_end - w_start) / (1.0 / (1.0 / 21600))) AS BIGINT) - 1)) AS i FROM win),
    grid AS (SELECT user_id, i, w_start + i * (1.0 / (1.0 / 21600)) AS g FROM gi),
    smp AS (SELECT user_id, t AS st, value AS sv, event_type AS sl FROM ev),
    cnt AS (SELECT user_id, count(*) AS n FROM smp GROUP BY user_id),
    br AS (SELECT grid.*, p.st AS pt, p.sv AS pv, p.sl AS pl, n.st AS nt, n.sv AS nv, n.sl AS nl, coalesce(c.n, 0) AS n
           FROM grid ASOF LEFT JOIN smp p ON grid.user_id = p.user_id AND grid.g > p.st
           ASOF LEFT JOIN smp n ON grid.user_id = n.user_id AND grid.g <= n.st
           LEFT JOIN cnt c ON c.user_id = grid.user_id),
    lin AS (SELECT *, CASE WHEN n < 4 THEN NULL WHEN pt IS NULL THEN nv WHEN nt IS NULL THEN pv WHEN nt = g THEN nv
            ELSE pv + (nv - pv) / (nt - pt) * (g - pt) END AS v,
            pt IS NULL OR nt IS NULL OR nt - pt > 3 * 43200.0 AS gap FROM br)"""


def grid_of(spark, sf_dir):
    windows = events(spark, sf_dir).groupBy(*K).agg(F.min("t").alias("w_start"), F.max("t").alias("w_end"))
    return resample.uniform_grid(windows, K, GRID_FS)


def samples(spark, sf_dir):
    return events(spark, sf_dir).select(*K, "t", "value")


@query("uniform_grid", f"WITH {GRID} SELECT user_id, i, round(g, 6) AS t FROM grid")
def uniform_grid(spark, sf_dir):
    return grid_of(spark, sf_dir).select(*K, "i", r6("t").alias("t"))


@query("resample_linear", f"WITH {GRID} SELECT user_id, i, round(v, 6) AS value FROM lin")
def resample_linear(spark, sf_dir):
    done = resample.resample_linear(samples(spark, sf_dir), grid_of(spark, sf_dir), K, "t", "value", width(sf_dir))
    return done.select(*K, "i", r6("value").alias("value"))


@query("gap_mask", f"WITH {GRID} SELECT user_id, i, gap AS in_gap FROM lin")
def gap_mask(spark, sf_dir):
    done = resample.gap_mask(samples(spark, sf_dir), grid_of(spark, sf_dir), K, "t", "value", 3 * 43_200.0, width(sf_dir))
    return done.select(*K, "i", "in_gap")


@query(
    "resample_gap_aware",
    f"WITH {GRID} SELECT user_id, i, round(CASE WHEN NOT gap THEN v END, 6) AS value, (gap OR v IS NULL) AS dropout_flag FROM lin",
)
def resample_gap_aware(spark, sf_dir):
    done = resample.resample_gap_aware(
        samples(spark, sf_dir), grid_of(spark, sf_dir), K, "t", "value", 43_200.0, width(sf_dir)
    )
    return done.select(*K, "i", r6("value").alias("value"), F.col("value_dropout_flag").alias("dropout_flag"))


@query(
    "resample_circular",
    f"""WITH {GRID}, cs AS (SELECT user_id, i, n,
      CASE WHEN pt IS NULL THEN cos(radians(nv)) WHEN nt IS NULL THEN cos(radians(pv)) WHEN nt = g THEN cos(radians(nv))
           ELSE cos(radians(pv)) + (cos(radians(nv)) - cos(radians(pv))) / (nt - pt) * (g - pt) END AS c,
      CASE WHEN pt IS NULL THEN sin(radians(nv)) WHEN nt IS NULL THEN sin(radians(pv)) WHEN nt = g THEN sin(radians(nv))
           ELSE sin(radians(pv)) + (sin(radians(nv)) - sin(radians(pv))) / (nt - pt) * (g - pt) END AS s FROM br),
    a AS (SELECT *, degrees(atan2(s, c)) AS d FROM cs)
    SELECT user_id, i, round(CASE WHEN n >= 4 THEN CASE WHEN d < 0 THEN d + 360 ELSE d END END, 5) AS heading FROM a""",
)
def resample_circular(spark, sf_dir):
    done = resample.resample_circular(samples(spark, sf_dir), grid_of(spark, sf_dir), K, "t", "value", width(sf_dir))
    return done.select(*K, "i", F.round("value", 5).alias("heading"))


@query(
    "lookup_next",
    f"""WITH {GRID} SELECT user_id, i, coalesce(nl, pl) AS event_type FROM br""",
)
def lookup_next(spark, sf_dir):
    labels = events(spark, sf_dir).select(*K, "t", "event_type")
    done = resample.lookup_next(labels, grid_of(spark, sf_dir), K, "t", "event_type", width(sf_dir))
    return done.select(*K, "i", "event_type")


def _channel_sql(e):
    return f"""{e}_s AS (SELECT user_id, t AS st, value AS sv FROM ev WHERE event_type = '{e}' OR '{e}' = 'every'),
    {e}_c AS (SELECT user_id, count(*) AS n FROM {e}_s GROUP BY user_id),
    {e}_b AS (SELECT grid.user_id, grid.i, grid.g, p.st AS pt, p.sv AS pv, n.st AS nt, n.sv AS nv, coalesce(c.n, 0) AS n
        FROM grid ASOF LEFT JOIN {e}_s p ON grid.user_id = p.user_id AND grid.g > p.st
        ASOF LEFT JOIN {e}_s n ON grid.user_id = n.user_id AND grid.g <= n.st LEFT JOIN {e}_c c ON c.user_id = grid.user_id),
    {e}_v AS (SELECT user_id, i, CASE WHEN n < 4 THEN NULL WHEN pt IS NULL THEN nv WHEN nt IS NULL THEN pv WHEN nt = g THEN nv
        ELSE pv + (nv - pv) / (nt - pt) * (g - pt) END AS v, pt IS NULL OR nt IS NULL OR nt - pt > 3 * 43200.0 AS gap FROM {e}_b)"""


#: The event types of the table.
CHANNELS = ["view", "click", "purchase", "error", "signup"]


@query(
    "fuse_channels",
    f"""WITH {GRID}, {", ".join(_channel_sql(e) for e in CHANNELS)}
    SELECT a.user_id, a.i, round(a.v, 6) AS view, round(b.v, 6) AS click, round(d.v, 6) AS purchase, round(e.v, 6) AS error,
           round(CASE WHEN NOT c.gap THEN c.v END, 6) AS signup, (c.gap OR c.v IS NULL) AS signup_dropout_flag
    FROM view_v a JOIN click_v b USING (user_id, i) JOIN signup_v c USING (user_id, i) JOIN purchase_v d USING (user_id, i) JOIN error_v e USING (user_id, i)""",
)
def fuse_channels(spark, sf_dir):
    long = events(spark, sf_dir).select(*K, "t", F.col("event_type").alias("channel"), "value")
    done = resample.resample_channels(
        long, grid_of(spark, sf_dir), K, "t", "value", CHANNELS, width(sf_dir), {"signup": 43_200.0}
    )
    return done.select(*K, "i", *[r6(c).alias(c) for c in CHANNELS], "signup_dropout_flag")


@query(
    "resample_axes",
    f"""WITH {GRID}, {_channel_sql("every")}
    SELECT user_id, i, round(v, 6) AS acc_x, round(2 * v, 6) AS acc_y, round(sqrt(v * v + 4 * v * v), 6) AS acc_mag FROM every_v""",
)
def resample_axes(spark, sf_dir):
    axes = samples(spark, sf_dir).select(*K, "t", F.col("value").alias("x"), (F.col("value") * 2).alias("y"))
    done = resample.resample_axes(axes, grid_of(spark, sf_dir), K, "t", ["x", "y"], width(sf_dir), "acc")
    return done.select(*K, "i", *[r6(c).alias(c) for c in ("acc_x", "acc_y", "acc_mag")])


@query(
    "sample_at_times",
    f"""WITH {EV}, smp AS (SELECT user_id, t AS st, value AS sv FROM ev WHERE event_type IN ('view', 'click')),
    br AS (SELECT e.user_id, e.event_id, e.t AS g, p.st AS pt, p.sv AS pv, n.st AS nt, n.sv AS nv
           FROM (SELECT * FROM ev WHERE event_type NOT IN ('view', 'click')) e ASOF LEFT JOIN smp p ON e.user_id = p.user_id AND e.t > p.st
           ASOF LEFT JOIN smp n ON e.user_id = n.user_id AND e.t <= n.st)
    SELECT user_id, event_id, round(CASE WHEN pt IS NULL THEN nv WHEN nt IS NULL THEN pv WHEN nt = g THEN nv
            ELSE pv + (nv - pv) / (nt - pt) * (g - pt) END, 6) AS value FROM br""",
)
def sample_at_times(spark, sf_dir):
    series_, probes = streams(spark, sf_dir)
    probes = probes.select(*K, "event_id", "t")
    return asof.sample_at(series_.select(*K, "t", "value"), probes, K, "t", "value", width(sf_dir)).select(
        *K, "event_id", r6("value").alias("value")
    )


STREAMS = EV + """, a AS (SELECT user_id, min(t) AS a0, max(t) AS a1 FROM ev WHERE event_type IN ('view', 'click') GROUP BY user_id),
    b AS (SELECT user_id, min(t) AS b0, max(t) AS b1 FROM ev WHERE event_type NOT IN ('view', 'click') GROUP BY user_id),
    ow AS (SELECT user_id, greatest(a0, b0) AS w_start, least(a1, b1) AS w_end FROM a JOIN b USING (user_id)
           WHERE least(a1, b1) - greatest(a0, b0) >= 30)"""


def streams(spark, sf_dir):
    ev = events(spark, sf_dir)
    first = F.col("event_type").isin("view", "click")
    return ev.filter(first), ev.filter(~first)


@query("overlap_window", f"WITH {STREAMS} SELECT user_id, round(w_start, 6) AS w_start, round(w_end, 6) AS w_end FROM ow")
def overlap_window(spark, sf_dir):
    done = resample.overlap_window(*streams(spark, sf_dir), K, "t", 30.0)
    return done.select(*K, r6("w_start").alias("w_start"), r6("w_end").alias("w_end"))


@query("clip_to_window", f"WITH {STREAMS} SELECT user_id, event_id, value FROM ev JOIN ow USING (user_id) WHERE t BETWEEN w_start AND w_end")
def clip_to_window(spark, sf_dir):
    windows = resample.overlap_window(*streams(spark, sf_dir), K, "t", 30.0)
    return resample.clip_to_window(events(spark, sf_dir), windows, K, "t").select(*K, "event_id", "value")


@query(
    "top_k_values",
    "SELECT event_id, user_id, value FROM events ORDER BY abs(value - 50) DESC, event_id LIMIT 25",
)
def top_k_values(spark, sf_dir):
    ev = events(spark, sf_dir).select("event_id", "user_id", "value")
    return relations.top_k(ev, F.abs(F.col("value") - 50), 25, ["event_id"])
