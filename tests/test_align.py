"""As-of lookups, resampling, intervals, spacing, quantiles, spectra: brute force on small data."""

from __future__ import annotations

import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sessionloom.functions import names
from sessionloom.functions import scalars as S
from sessionloom.operators import asof, blocks, clock, events as E, intervals, posture, quality, relations, resample, spectral, stats


def test_ties_and_duplicates(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 2.5), ("a", 2.0), ("b", 9.0)], "s string, t double")
    right = spark.createDataFrame([("a", t, v, v) for v, t in enumerate([0.0, 2.0, 2.0, 3.0, 3.0])], "s string, t double, seq long, v long")
    for width in (0.5, 100.0):
        got = {(r["s"], r["t"]): r["v"] for r in asof.asof_nearest(left, right, ["s"], "t", width, None, "", "seq").collect()}
        assert got == {("a", 1.0): 0, ("a", 2.5): 2, ("a", 2.0): 2, ("b", 9.0): None}
        near = {r["t"]: r["v"] for r in asof.asof_nearest(left, right, ["s"], "t", width, 0.5, "", "seq").collect() if r["s"] == "a"}
        assert near == {1.0: None, 2.5: 2, 2.0: 2}


@pytest.mark.parametrize("width", [3.0, 40.0, 1e9])
def test_nearest_equals_pandas(spark, width):
    rng = np.random.default_rng(1)
    l = pd.DataFrame({"s": rng.choice(["a", "b"], 120), "t": np.round(rng.uniform(0, 100, 120), 2)}).sort_values("t")
    r = pd.DataFrame({"s": rng.choice(["a", "b", "c"], 60), "t": np.round(rng.uniform(0, 100, 60), 2)}).sort_values("t").drop_duplicates(["s", "t"])
    r["v"] = np.arange(len(r))
    want = pd.merge_asof(l, r, on="t", by="s", direction="nearest", tolerance=1.5)
    got = asof.asof_nearest(spark.createDataFrame(l), spark.createDataFrame(r), ["s"], "t", width, 1.5, "").toPandas()
    key = ["s", "t"]
    assert got.sort_values(key).v.fillna(-1).tolist() == want.sort_values(key).v.fillna(-1).tolist()


def test_gap_mask_edges(spark):
    samples = spark.createDataFrame([("a", t, 1.0) for t in (1.0, 2.0, 3.0, 8.0, 9.0)], "s string, t double, v double")
    grid = spark.createDataFrame([("a", n, t) for n, t in enumerate([0.5, 1.0, 1.5, 3.0, 4.0, 8.0, 8.5, 9.5])], "s string, i long, t double")
    for width in (1.0, 100.0):
        got = {r["t"]: r["in_gap"] for r in resample.gap_mask(samples, grid, ["s"], "t", "v", 3.0, width).collect()}
        # the first sample itself counts as a boundary, a later one does not
        assert got == {0.5: True, 1.0: True, 1.5: False, 3.0: False, 4.0: True, 8.0: True, 8.5: False, 9.5: True}


def test_circular_goes_the_short_way(spark):
    samples = spark.createDataFrame([("a", 0.0, 358.6), ("a", 1.0, 0.1), ("a", 2.0, 360.0), ("a", 3.0, 90.0)], "s string, t double, v double")
    grid = spark.createDataFrame([("a", n, t) for n, t in enumerate([0.5, 2.0])], "s string, i long, t double")
    got = {r["i"]: r["v"] for r in resample.resample_circular(samples, grid, ["s"], "t", "v", 10.0).collect()}
    assert abs(got[0] - 359.35) < 1e-3 and got[1] == pytest.approx(0.0, abs=1e-6)
    few = samples.limit(3)
    assert all(r["v"] is None for r in resample.resample_circular(few, grid, ["s"], "t", "v", 10.0).collect())


def test_grid_in_pieces(spark):
    windows = spark.createDataFrame([("a", 10.0, 14.01), ("b", 0.0, 0.0)], "s string, w_start double, w_end double")
    whole = windows.filter("s = 'a'")
    small = resample.spread_index(whole, F.lit(101), "i", 7).select("i").toPandas().i
    assert sorted(small) == list(range(101))
    grid = resample.uniform_grid(windows, ["s"], 25.0).toPandas()
    assert len(grid) == 101 and set(grid.s) == {"a"} and grid.t.max() < 14.01


def test_next_label_is_clamped(spark):
    samples = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y")], "s string, t double, v string")
    grid = spark.createDataFrame([("a", n, t) for n, t in enumerate([0.0, 1.0, 1.1, 5.0])], "s string, i long, t double")
    got = {r["t"]: r["v"] for r in resample.lookup_next(samples, grid, ["s"], "t", "v", 1.0).collect()}
    assert got == {0.0: "x", 1.0: "x", 1.1: "y", 5.0: "y"}


@pytest.mark.parametrize("width", [2.0, 7.0, 500.0])
def test_overlaps(spark, width):
    rng = np.random.default_rng(3)
    def some(n, p):
        a = rng.integers(0, 100, n)
        return pd.DataFrame({"s": rng.choice(["x", "y"], n), f"{p}0": a, f"{p}1": a + rng.integers(0, 30, n), f"{p}n": np.arange(n)})
    a, b = some(40, "a"), some(30, "b")
    got = intervals.overlap_join(spark.createDataFrame(a), spark.createDataFrame(b), ["s"], ("a0", "a1"), ("b0", "b1"), width).toPandas()
    m = a.merge(b, on="s")
    want = m[(m.a0 <= m.b1) & (m.b0 <= m.a1)]
    assert sorted(zip(got.an, got.bn)) == sorted(zip(want.an, want.bn))


@pytest.mark.parametrize("width", [1.0, 5.0, 1000.0])
@pytest.mark.parametrize("strict", [True, False])
def test_greedy_spacing(spark, width, strict):
    rng = np.random.default_rng(4)
    rows = [(s, float(t)) for s in "abc" for t in np.unique(np.round(rng.uniform(0, 60, {"a": 150, "b": 20, "c": 1}[s]), 1))]
    df = spark.createDataFrame(rows, "s string, t double")
    got = {(r["s"], r["t"]) for r in E.greedy_spacing(df, ["s"], "t", 0.75, width, strict).collect()}
    want = set()
    for s in "abc":
        last = None
        for t in sorted(t for k, t in rows if k == s):
            if last is None or (t > last + 0.75 if strict else t >= last + 0.75):
                want.add((s, t))
                last = t
    assert got == want


def test_quantiles_of_a_large_group(spark):
    rng = np.random.default_rng(6)
    big = np.concatenate([rng.normal(size=60_000), np.full(30_000, 0.25), [1e9]])
    df = spark.createDataFrame(pd.DataFrame({"g": ["big"] * len(big) + ["one"], "v": np.append(big, 7.0)})).repartition(8)
    ps = [0.0, 0.025, 0.5, 0.51, 0.9, 0.999, 1.0]
    out = {r["g"]: r for r in stats.quantiles(df, ["g"], "v", ps, [f"q{n}" for n in range(len(ps))]).collect()}
    for n, p in enumerate(ps):
        assert out["big"][f"q{n}"] == pytest.approx(np.quantile(big, p), abs=1e-12)
        assert out["one"][f"q{n}"] == 7.0


def test_kappa(spark):
    a, b = [0, 1, 2, 2, 1, 0, 2, 1], [0, 2, 2, 1, 1, 0, 2, 0]
    df = spark.createDataFrame(list(zip(a, b)), "a int, b int")
    row = stats.kappa(df, "a", "b").first()
    o = np.zeros((3, 3))
    for x, y in zip(a, b):
        o[x, y] += 1
    e = np.outer(o.sum(1), o.sum(0)) / len(a)
    q = np.subtract.outer(range(3), range(3)) ** 2
    assert row["kappa"] == pytest.approx(1 - ((1 - np.eye(3)) * o).sum() / ((1 - np.eye(3)) * e).sum())
    assert row["kappa_quadratic"] == pytest.approx(1 - (q * o).sum() / (q * e).sum())


def lowpass(x, cutoff, fs):
    f = np.fft.fftfreq(len(x), 1 / fs)
    return np.real(np.fft.ifft(np.where(np.abs(f) > cutoff, 0, np.fft.fft(x))))


@pytest.mark.parametrize("values", [16, 1 << 18])
@pytest.mark.parametrize("cutoff", [2.0, 12.5])
def test_lowpass_of_short_and_long_series(spark, cutoff, values, monkeypatch):
    monkeypatch.setattr(spectral, "FFT_VALUES", values)
    calls, many = [], spectral.groups.over_groups
    monkeypatch.setattr(spectral.groups, "over_groups", lambda *a: calls.append(a) or many(*a))
    rng = np.random.default_rng(4)
    x = {"a": rng.normal(size=33), "b": rng.normal(size=16), "c": rng.normal(size=1)}
    df = spark.createDataFrame([(s, n, float(v)) for s in x for n, v in enumerate(x[s])] + [("none", 0, None)], "s string, i long, v double")
    got = spectral.fft_lowpass(df, ["s"], "v", cutoff, "y").toPandas()
    assert len(calls) == 1 and got[got.s == "none"].y.isna().all() and len(got) == 51
    for s in x:
        assert np.allclose(got[got.s == s].sort_values("i").y, lowpass(x[s], cutoff, 25.0), atol=1e-9)


@pytest.mark.parametrize("cutoff", [2.0, 12.5])
def test_lowpass_equals_one_transform(spark, cutoff):
    rng = np.random.default_rng(8)
    x = {"a": rng.normal(size=97), "b": rng.normal(size=64), "c": rng.normal(size=10)}
    df = spark.createDataFrame([(s, n, float(v)) for s in x for n, v in enumerate(x[s])], "s string, i long, v double")
    got = spectral.fft_lowpass(df, ["s"], "v", cutoff, "y").toPandas()
    for s in x:
        y = got[got.s == s].sort_values("i").y.to_numpy()
        assert np.allclose(y, lowpass(x[s], cutoff, 25.0), atol=1e-9)


def test_mixture_is_fitted_until_it_stands(spark):
    """Clusters that part along y, where the start by x says little, against the same rounds in numpy; the plain session stands before."""
    draw = np.random.default_rng(6)
    sets = {"slow": np.vstack([draw.normal((0.5, 0.4 + 0.1 * j), 0.035, (200, 2)) for j in range(3)]), "plain": np.vstack([draw.normal((0.2 + 0.3 * j, 0.5), 0.01, (40, 2)) for j in range(3)])}
    rows = [(s, n, float(x), float(y)) for s, own in sets.items() for n, (x, y) in enumerate(own)]
    got = posture.grip_clusters(spark.createDataFrame(rows, "s string, pid long, x double, y double"), ["s"], (0.3, 0.7, 0.3, 0.7), rounds=7).collect()

    def fitted(x, rounds):
        r = np.eye(3)[np.minimum((x[:, 0] - x[:, 0].min()) / np.ptp(x[:, 0]) * 3, 2).astype(int)]
        for n in range(rounds + 1):
            m = r.sum(0)
            c = r.T @ x / m[:, None]
            v = np.array([(r[:, j, None] * (x - c[j])).T @ (x - c[j]) / m[j] * 0.99 + np.cov(x.T, bias=True) * 0.01 for j in range(3)])
            now = np.sort(np.column_stack([m / len(x), c]), axis=0)
            d = np.array([m[j] / len(x) / np.sqrt(np.linalg.det(v[j])) * np.exp(-np.einsum("ia,ab,ib->i", x - c[j], np.linalg.inv(v[j]), x - c[j]) / 2) for j in range(3)]).T
            r = d / d.sum(1, keepdims=True)
        return now

    for r in got:
        mine = np.sort([[c.weight, c.cx, c.cy] for c in r.clusters], axis=0)
        assert np.abs(mine - fitted(sets[r.s], 7)).max() < 1e-4
    # the cut of 12 rounds is not where the fit stands
    assert inspect.signature(posture.grip_clusters).parameters["rounds"].default >= 60
    assert len(got) == 2 and np.abs(fitted(sets["slow"], 12) - fitted(sets["slow"], 60)).max() > 1e-3


def test_haar_denoise(spark):
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=6), 13) + rng.normal(scale=0.05, size=78)
    df = spark.createDataFrame([("a", n, float(v)) for n, v in enumerate(x)], "s string, i long, v double")
    got = spectral.haar_denoise(df, ["s"], "v", "y").toPandas().sort_values("i").y.to_numpy()
    a = np.r_[x, np.full(-len(x) % 16, x[-1])]
    n0, kept = len(a), []
    for _ in range(4):
        kept.append((a[0::2] - a[1::2]) / 2**0.5)
        a = (a[0::2] + a[1::2]) / 2**0.5
    sigma = np.median(np.abs(kept[0] - np.median(kept[0]))) / 0.6745
    limit = sigma * np.sqrt(2 * np.log(n0))
    for d in reversed([np.sign(d) * np.maximum(np.abs(d) - limit, 0) for d in kept]):
        up = np.empty(2 * len(a))
        up[0::2], up[1::2] = (a + d) / 2**0.5, (a - d) / 2**0.5
        a = up
    assert np.allclose(got, a[: len(x)])


def test_clean_log_and_step(spark):
    def ping(s, n, offset, rtt=20.0):
        return (s, 1000.0 * n, 1_700_000_000.0 + n + offset, rtt)

    rows = [ping("clean", n, 0.0) for n in range(12)] + [ping("step", n, 0.3 if n >= 6 else 0.0) for n in range(12)]
    rows += [ping("few", n, 0.0) for n in range(4)] + [ping("slow", n, 0.0, 20.0 if n else 900.0) for n in range(10)]
    df = spark.createDataFrame(rows, "s string, device_ms double, sent_s double, rtt_ms double")
    clean = clock.clean_pings(df, ["s"])
    counts = {r["s"]: r["count"] for r in clean.groupBy("s").count().collect()}
    assert counts == {"clean": 12, "step": 12, "slow": 9}
    numbered = blocks.index_rows(clean, ["s"], ["device_ms"], blocks.chunk_of("device_ms", 3000.0))
    for block in (3, 65_536):
        steps = {r["s"]: (r["max_step_s"], r["step_at_s"]) for r in clock.largest_step(numbered, ["s"], block=block).collect()}
        # splits 5 to 7 have equal medians but for the last bits of an epoch in seconds
        assert steps["step"][0] == pytest.approx(0.3, abs=1e-5) and 4.9 < steps["step"][1] < 7.1
        assert abs(steps["clean"][0]) < 1e-5
    line = {r["s"]: r for r in clock.robust_linear(clean, ["s"]).collect()}
    assert line["clean"]["ppm"] == pytest.approx(0.0, abs=1.0)
    anchor = {r["s"]: r for r in clock.anchor_only(clean, ["s"]).collect()}
    assert anchor["step"]["mad_ms"] == pytest.approx(150.0, abs=0.1)


def test_texts(spark):
    row = spark.sql("SELECT '61500.5' AS a, '235959' AS b, '24°44.742936 N' AS c, '5°30 W' AS d, '1.5' AS e, 'x' AS f, '2025-03-01_08-30-00-250' AS g").select(
        S.hhmmss_to_seconds("a"), S.hhmmss_to_seconds("b"), S.parse_degree_minutes("c"), S.parse_degree_minutes("d"), S.parse_degree_minutes("e"),
        S.parse_degree_minutes("e", False), S.parse_degree_minutes("f"), S.stamp_to_epoch("g", micros=True), S.stamp_to_epoch("f"),
    ).first()
    assert row[0] == 6 * 3600 + 15 * 60 + 0.5 and row[1] == 86_399.0
    assert row[2] == pytest.approx(24 + 44.742936 / 60) and row[3] == -5.5 and row[4] == 1.5 and row[5] is None and row[6] is None
    assert row[7] == pytest.approx(pd.Timestamp("2025-03-01 05:30:00.25").timestamp()) and row[8] is None


def test_names(spark):
    df = spark.createDataFrame([(1, 2, "3")], ["Speed (km/h)", " Accelerator_Pedal_Position (%) ", "x"])
    assert names.standardise_names(df).columns == ["Speed_km_h", "Accelerator_Pedal_Position", "x"]
    assert names.first_existing(df, ["q", "x"]) == "x" and names.first_existing(df, ["q"]) is None
    assert names.keep_rename(df, {"x": "y", "Speed (km/h)": "v", "none": "n"}, ["v"]).columns == ["v", "y"]
    assert names.to_numeric(df, ["x"]).first()["x"] == 3.0


def test_identity_and_folds(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0)], "k int, s string, v double")
    b = spark.createDataFrame([(1, "x", None), (2, "z", 1.0), (3, "q", 2.0)], "k int, s string, v double")
    got = {r["column"]: r["n_changed"] for r in relations.identical_except(a, b, ["k"]).collect()}
    assert got == {"missing_rows": 1, "s": 1, "v": 0}
    folds = relations.leave_one_group_out(a, "s", ["x", "y"])
    assert relations.leaking_groups(folds, "s").count() == 0 and folds.filter("role = 'test'").count() == 2
    assert relations.column_diff(a, b.drop("v"))["only_first"] == ["v"]


def test_sample_is_bounded_and_repeats(spark):
    df = spark.range(5000).select(F.pmod("id", F.lit(3)).alias("s"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("c"), F.col("id").alias("item"))
    one = relations.stratified_sample(df, ["s"], "c", "item", 4, 2, 11).collect()
    two = relations.stratified_sample(df.repartition(7), ["s"], "c", "item", 4, 2, 11).collect()
    assert len(one) == 8 and sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert all(len({r["s"] for r in one if r["c"] == c}) == 3 for c in "xy")


def test_score_needs_every_row_of_a_check(spark):
    a = spark.createDataFrame([(1, True), (2, True)], "s int, ok boolean")
    b = spark.createDataFrame([(1, True), (1, False), (2, True)], "s int, ok boolean")
    assert {r["s"]: r["score"] for r in quality.quality_score([a, b], ["s"]).collect()} == {1: 50, 2: 100}
