"""Operators that meet in cells, trees and matrices of blocks: brute force on small data, with cuts as fine as they get."""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import pytest

from sessionloom.operators import events as E, intervals, posture, stats


@pytest.mark.parametrize("cell", [1, 50, 10**6])
def test_quantiles_by_cells(spark, cell, monkeypatch):
    monkeypatch.setattr(stats, "CELL_ROWS", cell)
    monkeypatch.setattr(stats, "CELLS", 8)
    rng = np.random.default_rng(2)
    groups = {
        "steep": 10.0 ** rng.uniform(-300, 300, 400),
        "ties": rng.integers(0, 3, 500).astype(float),
        "ends": np.append(rng.normal(size=200), [-math.inf, math.inf, math.inf]),
        "one": np.array([4.0]),
        "flat": np.full(300, -2.5),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    ps = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r["g"]: r for r in stats.quantiles(df, ["g"], "v", ps, [f"q{n}" for n in range(len(ps))]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        s = np.sort(vs)
        for n, p in enumerate(ps):
            at = p * (len(s) - 1)
            lo, hi = s[math.floor(at)], s[math.ceil(at)]
            want = lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))
            assert got[g][f"q{n}"] == pytest.approx(want, rel=1e-12) or (math.isnan(want) and math.isnan(got[g][f"q{n}"])), (g, p)
    whole = stats.quantiles(df.filter("g in ('steep', 'ties')"), [], "v", [0.5], ["m"]).collect()
    assert [r["m"] for r in whole] == [pytest.approx(np.median(np.append(groups["steep"], groups["ties"])))]
    assert stats.quantiles(df.filter("g = 'none'"), ["g"], "v", [0.5], ["m"]).collect() == []


@pytest.mark.parametrize("block", [7, 1000])
def test_lagged_correlation(spark, block):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for s, n in (("a", 60), ("b", 41), ("flat", 50)):
        x, y = 1e6 + rng.normal(size=n), rng.normal(size=n)
        y[3:] += x[:-3] - 1e6
        if s == "flat":
            x[:] = 0.1
        x[rng.integers(0, n, 5)] = np.nan
        y[rng.integers(0, n, 5)] = np.nan
        rows += [(s, i, None if np.isnan(a) else float(a), None if np.isnan(b) else float(b)) for i, (a, b) in enumerate(zip(x, y))]
        r = {}
        for lag in range(-5, 6):
            p = [(x[i], y[i + lag]) for i in range(n) if 0 <= i + lag < n and not np.isnan(x[i] + y[i + lag])]
            if len(p) > 20 and s != "flat":
                r[lag] = np.corrcoef(np.array(p).T)[0, 1]
        if r:
            best = max(r, key=lambda q: (round(r[q], 9), -q))
            want[s] = (best, r[best], r[0])
    df = spark.createDataFrame(rows, "s string, i long, x double, y double").repartition(3)
    got = {r["s"]: r for r in stats.xcorr(df, ["s"], "x", "y", 5, 20, block=block).collect()}
    assert set(got) == set(want) == {"a", "b"}
    for s, (lag, top, zero) in want.items():
        assert got[s]["peak_lag"] == lag == 3
        assert got[s]["peak_r"] == pytest.approx(top, abs=1e-7) and got[s]["r_at_zero"] == pytest.approx(zero, abs=1e-7)


@pytest.mark.parametrize("block", [1, 30, 1000])
def test_offset_by_blocks(spark, block):
    rng = np.random.default_rng(5)
    raw, probe, want = [], [], {}
    for s, at, n in (("a", 37, 150), ("b", 0, 90), ("gaps", 80, 150), ("short", 0, 10)):
        x = rng.normal(size=n)
        p = x[at : at + 70] + 0.01 * rng.normal(size=len(x[at : at + 70]))
        if s == "gaps":
            x[90:95] = np.nan
            p[3] = np.nan
        if s == "short":
            p = rng.normal(size=40)
        raw += [(s, i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
        probe += [(s, i, None if np.isnan(v) else float(v)) for i, v in enumerate(p)]
        stop = min(n - len(p), 85)
        d = {o: np.nansum(np.abs(x[o : o + len(p)] - p)) for o in range(stop) if np.isfinite(x[o : o + len(p)] - p).any()}
        if d:
            o = min(d, key=lambda q: (round(d[q], 9), q))
            want[s] = (o, d[o])
    got = stats.find_offset(spark.createDataFrame(raw, "s string, i long, v double"), spark.createDataFrame(probe, "s string, i long, v double"), ["s"], "v", 70, 85, block=block)
    assert {r["s"]: (r["offset"], pytest.approx(r["distance"])) for r in got.collect()} == want


@pytest.mark.parametrize("strict", [True, False])
def test_spacing_over_many_chunks(spark, strict, monkeypatch):
    monkeypatch.setattr(E, "FAN", 3)
    rng = np.random.default_rng(4)
    rows = [(s, float(t)) for s, n, top in (("a", 400, 300), ("b", 30, 90), ("c", 1, 5)) for t in np.unique(np.round(rng.uniform(-top, top, n), 1))]
    rows += [("sparse", t) for t in (-500.0, -1.0, 0.0, 1.0, 400.0, 401.0)]
    got = {(r["s"], r["t"]) for r in E.greedy_spacing(spark.createDataFrame(rows, "s string, t double"), ["s"], "t", 2.0, 2.0, strict).collect()}
    want = set()
    for s in {s for s, _ in rows}:
        last = None
        for t in sorted(t for k, t in rows if k == s):
            if last is None or (t > last + 2.0 if strict else t >= last + 2.0):
                want.add((s, t))
                last = t
    assert got == want


@pytest.mark.parametrize("width", [0.5, 3.0, 1e6])
def test_long_intervals_and_points(spark, width):
    rng = np.random.default_rng(6)
    points = [(s, n, float(t)) for n, (s, t) in enumerate(zip(rng.choice(["x", "y"], 300), np.round(rng.uniform(-100, 100, 300), 1)))]
    spans = [(s, n, float(a), float(a + d)) for n, (s, a, d) in enumerate(zip(rng.choice(["x", "y"], 40), np.round(rng.uniform(-100, 90, 40), 1), rng.choice([0.0, 0.3, 5.0, 200.0, -1.0], 40)))]
    got = intervals.point_in_interval(spark.createDataFrame(points, "s string, n long, t double"), spark.createDataFrame(spans, "s string, m long, a double, b double"), ["s"], "t", "a", "b", width)
    want = [(n, m) for s, n, t in points for q, m, a, b in spans if s == q and a <= t <= b]
    assert sorted((r["n"], r["m"]) for r in got.collect()) == sorted(want)


def test_short_groups_need_no_sketch(spark, monkeypatch):
    """Groups that one sort can hold are sorted as they are; nothing of the sessions is sketched, cut or broadcast for them."""

    def never(*_):
        raise AssertionError("short groups are cut into cells")

    monkeypatch.setattr(stats, "_cell_of_rank", never)
    df = spark.createDataFrame([(n % 7, float(n * n % 31)) for n in range(200)], "g long, v double")
    got = {r["g"]: r["m"] for r in stats.quantiles(df, ["g"], "v", [0.3], ["m"]).collect()}
    assert got == {g: pytest.approx(np.quantile([n * n % 31 for n in range(200) if n % 7 == g], 0.3)) for g in range(7)}
    assert [r["m"] for r in stats.quantiles(df.filter("v is null"), [], "v", [0.5], ["m"]).collect()] == [None]


@pytest.mark.parametrize("blocks", [1, 4])
def test_running_median_copies_only_for_long_series(spark, blocks, monkeypatch):
    from sessionloom.operators import expanding

    rng = np.random.default_rng(11)
    series = {"short": rng.normal(size=9), "long": rng.normal(size=10 * blocks)}
    df = spark.createDataFrame([(s, n, float(v)) for s, vs in series.items() for n, v in enumerate(vs)], "s string, i long, v double")
    seen = []
    monkeypatch.setattr(expanding, "_with_candidates", lambda values, k, i, f=expanding._with_candidates: seen.append(f(values, k, i)) or seen[-1])
    got = {(r["s"], r["i"]): r["m"] for r in expanding.expanding_median(df, ["s"], "v", "m", "i", 10).collect()}
    assert got == {(s, n): pytest.approx(np.median(vs[: n + 1])) for s, vs in series.items() for n in range(len(vs))}
    assert {r["s"] for r in seen[0].filter("not _own").collect()} == ({"long"} if blocks > 1 else set())


@pytest.mark.parametrize("size", ["1", "7", "10000"])
def test_groups_in_one_call(spark, size):
    import pyarrow as pa

    from sessionloom.operators import groups

    rng = np.random.default_rng(3)
    rows = [(None if g == 3 else int(g), None if n % 5 == 0 else "a", float(v)) for n, (g, v) in enumerate(zip(rng.integers(0, 40, 300) ** 2 // 300, rng.normal(size=300)))]
    df = spark.createDataFrame(rows, "k long, s string, v double")

    def first_and_number(whole, starts):
        return whole.take(starts[:-1]).append_column("n", pa.array(np.diff(starts))).append_column("calls", pa.array(np.full(len(starts) - 1, len(starts) - 1)))

    from pyspark.sql.types import LongType, StructType

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        schema = StructType(list(df.schema.fields)).add("n", LongType()).add("calls", LongType())
        got = groups.over_groups(df, ["k", "s"], ["v"], first_and_number, schema).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k, s, v in rows:
        least, n = want.get((k, s), (math.inf, 0))
        want[k, s] = min(least, v), n + 1
    assert len(got) == len(want) and {(r["k"], r["s"]): (r["v"], r["n"]) for r in got} == want
    # short groups share calls
    assert size != "10000" or max(r["calls"] for r in got) > 1


def test_own_columns_of_intervals_stay(spark):
    points = spark.createDataFrame([("x", 1, 5.0)], "s string, n long, t double")
    spans = spark.createDataFrame([("x", 4.5, 4.0, 6.0)], "s string, _at double, a double, b double")
    got = intervals.point_in_interval(points, spans, ["s"], "t", "a", "b", 1.0).filter("_at < t").collect()
    assert [(r["n"], r["_at"]) for r in got] == [(1, 4.5)]


@pytest.mark.parametrize("width", [2.0, 1e6])
def test_response_window(spark, width):
    rng = np.random.default_rng(8)
    series = [(s, float(t), float(v)) for s, t, v in zip(rng.choice(["x", "y"], 200), np.round(rng.uniform(0, 100, 200), 1), rng.normal(size=200))]
    moments = [(s, n, float(t), float(r)) for n, (s, t, r) in enumerate(zip(rng.choice(["x", "y", "none"], 30), np.round(rng.uniform(0, 100, 30), 1), rng.choice([0.5, 4.0], 30)))]
    got = E.response_window(
        spark.createDataFrame(moments, "s string, e long, t double, r double"), spark.createDataFrame(series, "s string, t double, v double"),
        ["s"], "t", "v", "r", "e", width, 3.0, 2.0, 30.0, 2,
    ).collect()

    def rise(s, at, r):
        before = [v for q, t, v in series if q == s and at - 3.0 <= t <= at]
        after = [v for q, t, v in series if q == s and at <= t <= at + r + 2.0]
        return max(after) - min(before) if len(before) >= 2 and len(after) >= 2 else None

    assert {r["e"]: (r["response"], r["control_response"]) for r in got} == {e: (rise(s, t, r), rise(s, t - 30.0, r)) for s, e, t, r in moments}


def test_nodes_of_an_interval(spark):
    from pyspark.sql import functions as F

    rows = [(a, b) for a, b in itertools.product(range(-20, 20, 3), range(-20, 40)) if a <= b] + [(0, 10**9), (-(10**12), 10**12 + 5)]
    made = spark.createDataFrame(rows, "a long, b long").withColumn("nodes", intervals.tree_nodes(F.col("a"), F.col("b"))).collect()
    for r in made:
        got = sorted((n["node"] << n["level"], ((n["node"] + 1) << n["level"]) - 1) for n in r["nodes"])
        assert got[0][0] == r["a"] and got[-1][1] == r["b"]
        assert all(p[1] + 1 == q[0] for p, q in zip(got, got[1:]))
        assert len(got) <= 2 * math.log2(r["b"] - r["a"] + 2)


def test_mixture_rounds_read_rows_of_many_points(spark, monkeypatch):
    rng = np.random.default_rng(12)
    rows = [(s, n, float(x), float(y)) for s in ("a",) for n, (x, y) in enumerate(rng.uniform(0.05, 0.95, (60, 2)))] + [("a", 99, 0.4, None)]
    df = spark.createDataFrame(rows, "s string, pid long, x double, y double").repartition(3)
    sizes, found = [], []
    for points in (7, 2048):
        monkeypatch.setattr(posture, "POINTS", points)
        divided = posture._divided(3)
        monkeypatch.setattr(posture, "_divided", lambda n, f=divided: lambda held, mixture: sizes.append(held) or f(held, mixture))
        got = posture.grip_clusters(df, ["s"], (0.3, 0.7, 0.3, 0.7), rounds=1, min_points=20).collect()
        monkeypatch.undo()
        found.append({r["s"]: [v for c in r["clusters"] for v in list(c)[:8]] for r in got})
    assert [h.count() for h in sizes] == [9, 1]
    assert set(found[0]) == {"a"} and all(found[0][s] == pytest.approx(found[1][s], rel=1e-9) for s in found[0])


@pytest.mark.parametrize("points", [1, 2, 3])
def test_regions_by_summed_areas(spark, points):
    rng = np.random.default_rng(points)
    names = [(f"x{n}", f"y{n}") for n in range(points)]
    rows = []
    for _ in range(200):
        xy = [None if rng.random() < 0.1 else float(np.round(rng.uniform(0, 1), 1)) for _ in range(2 * points)]
        rows.append((float(rng.choice([m / points for m in range(points + 1)] + [0.123])), *xy))
    grid = {"x0": [0.3, 0.0, 0.5], "x1": [0.6, 1.0], "y0": [0.1, 0.4], "y1": [0.5, 0.9, 0.2]}
    cols = [c for p in names for c in p]
    df = spark.createDataFrame(rows, "truth double, " + ", ".join(f"{c} double" for c in cols))
    got = {(r["x0"], r["x1"], r["y0"], r["y1"]): (r["n_agree"], r["n"]) for r in posture.score_regions(df, names, "truth", grid).collect()}
    want = {}
    for x0, x1, y0, y1 in itertools.product(grid["x0"], grid["x1"], grid["y0"], grid["y1"]):
        held = lambda x, y: x is not None and y is not None and x0 <= x <= x1 and y0 <= y <= y1
        want[(x0, x1, y0, y1)] = (sum(sum(held(*r[1 + 2 * p : 3 + 2 * p]) for p in range(points)) / points == r[0] for r in rows), len(rows))
    assert got == want


@pytest.mark.parametrize("block", [4, 4096])
def test_bootstrap_by_blocks(spark, block):
    rng = np.random.default_rng(9)
    rows = [(s, e, [float(v) for v in rng.normal(size=5)]) for s, n in (("a", 19), ("b", 9), ("few", 3)) for e in range(0, 3 * n, 3)]
    got = stats.bootstrap_peak(spark.createDataFrame(rows, "s string, e long, r array<double>").repartition(3), ["s"], 2, 40, 7, 8, block)
    want = {}
    for s in ("a", "b"):
        own = [(e, np.array(r)) for q, e, r in rows if q == s]
        peaks = []
        for rep in range(1, 41):
            picks = [int(hashlib.md5(f"7|{s}|{rep}|{e}".encode()).hexdigest()[:12], 16) % len(own) for e, _ in own]
            peaks.append(int(np.argmax(np.mean([own[p][1] for p in picks], axis=0))) - 2)
        want[s] = tuple(np.quantile(peaks, [0.025, 0.975]))
    assert {r["s"]: (pytest.approx(r["lag_lo"]), pytest.approx(r["lag_hi"])) for r in got.collect()} == want


@pytest.mark.parametrize("block", [7, 65_536])
def test_largest_step_reads_its_steps_before_once(spark, block):
    from sessionloom.operators import blocks, clock

    rng = np.random.default_rng(17)
    logs = {s: np.round(rng.normal(size=n) + 3 * (np.arange(n) > n // 2), 3) for s, n in (("a", 61), ("b", 40), ("c", 10), ("d", 9))} | {"e": np.zeros(30)}
    rows = [(s, 500 * n, n / 2, float(v)) for s, vs in logs.items() for n, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "s string, ms long, x double, off double").repartition(3)
    out = clock.largest_step(blocks.index_rows(df, ["s"], ["ms"], blocks.chunk_of("ms", 4000.0)), ["s"], block=block)
    want = {}
    for s, vs in logs.items():
        steps = [(float(np.median(vs[p:]) - np.median(vs[:p])), p) for p in range(5, len(vs) - 4)]
        step, at = min(((v, p) for v, p in steps if v), key=lambda e: (-abs(e[0]), e[1]), default=(0.0, None))
        want[s] = (pytest.approx(step), None if at is None else at / 2)
    assert {r["s"]: (r["max_step_s"], r["step_at_s"]) for r in out.collect()} == want
    # the driver holds the whole plan, and a copy of it for every stage that ends
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 4
