"""The labelling rules on small synthetic drives."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import rules
from sessionloom.operators import events as E
from sessionloom.operators import runs

N = 400
# One second of 0.55 g with noise of 0.15 g, written out.
NOISY = [
    0.569, 0.530, 0.646, 0.566, 0.470, 0.604, 0.746, 0.692, 0.444, 0.360, 0.457, 0.556, 0.201, 0.517, 0.363, 0.440, 0.468,
    0.503, 0.612, 0.706, 0.531, 0.755, 0.450, 0.603, 0.686,
]
SLOWING = [50 - max(n - 150, 0) / 25 * 3.6 for n in range(N)]


def cases():
    def put(start, values):
        return {start + n: v for n, v in enumerate(values)}

    flip = [1 if n % 2 == 0 else -1 for n in range(50)]
    lat = {
        "spike 6.06": put(200, [6.06]),
        "spike 5.5": put(200, [5.5]),
        "burst 2 x 3.0": put(200, [3.0] * 2),
        "burst 3 x 2.0": put(200, [2.0] * 3),
        "burst 3 x 2.6": put(200, [2.6] * 3),
        "alternating 0.6": put(200, [0.6 * f for f in flip]),
        "alternating 1.0": put(200, [1.0 * f for f in flip]),
        "sustained noisy": put(200, NOISY),
        "sustained alternating": put(200, [0.55 + 0.3 * f for f in flip[:25]]),
        "0.40 s": put(200, [0.60] * 10),
        "0.60 s": put(200, [0.60] * 15),
        "0.52 s": put(200, [0.60] * 13),
    }
    lon = {"lon spike": put(200, [-3.38]), "braking": put(200, [-0.45] * 25)}
    rows = []
    for name, values in lat.items():
        rows += [(name, n, n / 25, 50.0, 50.0, 0.0, values.get(n, 0.0), 0.0) for n in range(N)]
    for name, values in lon.items():
        rows += [(name, n, n / 25, 50.0, SLOWING[n], 0.0, 0.0, values.get(n, 0.0)) for n in range(N)]
    return rows


# Published turning and braking events per case for V0 ... V6.
EXPECTED = {
    "spike 6.06": ("1110000", "0000000"),
    "spike 5.5": ("1000000", "0000000"),
    "burst 2 x 3.0": ("0000000", "0000000"),
    "burst 3 x 2.0": ("0000000", "0000000"),
    "burst 3 x 2.6": ("0000000", "0000000"),
    "alternating 0.6": ("1100000", "0000000"),
    "alternating 1.0": ("1100000", "0000000"),
    "sustained noisy": ("1111111", "0000000"),
    "sustained alternating": ("1111111", "0000000"),
    "0.40 s": ("0000000", "0000000"),
    "0.60 s": ("0000000", "0000000"),
    "0.52 s": ("0000000", "0000000"),
    "lon spike": ("0000000", "0000000"),
    "braking": ("0000000", "1111111"),
}


@pytest.fixture(scope="module")
def drives(spark):
    schema = "case string, i long, t double, gps_speed_kmh double, speed_kph double, throttle_pct double, lat_acc_g double, lon_acc_g double"
    return spark.createDataFrame(cases(), schema).repartition(4).cache()


@pytest.mark.parametrize("block", [100, 65_536])
def test_synthetic_cases(drives, block):
    labelled = rules.label_variants(drives, ["case"], rules.VARIANTS, block=block)
    got = {}
    for n in rules.VARIANTS:
        found = runs.event_table(labelled.select("case", "i", "t", f"label_{n}"), ["case"], "t", f"label_{n}", block=block)
        for r in found.groupBy("case", F.col(f"label_{n}").alias("label")).count().collect():
            got[(r["case"], n, r["label"])] = r["count"]
    for case, (turns, brakes) in EXPECTED.items():
        for n, turn, brake in zip(rules.VARIANTS, turns, brakes):
            assert got.get((case, n, rules.TURN), 0) == int(turn), (case, n)
            assert got.get((case, n, rules.BRAKE), 0) == int(brake), (case, n)
            assert got.get((case, n, rules.ACCEL), 0) == 0, (case, n)


def test_totals_count_each_session_on_its_own(drives):
    totals = {r["variant"]: (r["n_turn"], r["n_brake"]) for r in rules.variant_totals(drives, ["case"]).collect()}
    for place, n in enumerate(rules.VARIANTS):
        want = tuple(sum(int(v[side][place]) for v in EXPECTED.values()) for side in (0, 1))
        assert totals[n] == want


def test_heading_gate(spark):
    def run(name, heading):
        return [(name, n, heading(n), 20 <= n < 40) for n in range(60)]

    rows = (
        run("straight", lambda n: 90.0)
        + run("turning", lambda n: 90.0 + n)
        + run("wraps by 2", lambda n: 359.0 if n < 30 else 1.0)
        + run("unknown", lambda n: None)
        + [("edge", n, 90.0 + (n if n < 3 else 0), n < 10) for n in range(20)]
    )
    df = spark.createDataFrame(rows, "s string, i long, h double, m boolean")
    from sessionloom.operators import blocks

    ready = blocks.over_blocks(df, ["s"], 3, 3, lambda w: [rules.heading_ends(w, "h", 3)], block=8)
    kept = rules.heading_gate(ready, ["s"], "m", "_h_before", "_h_after", 5.0, block=8)
    got = {r["s"]: r["n"] for r in kept.groupBy("s").agg(F.sum(F.col("m").cast("int")).alias("n")).collect()}
    assert got == {"straight": 0, "turning": 20, "wraps by 2": 0, "unknown": 20, "edge": 0}


def test_missing_inputs_are_false(spark):
    rows = [("a", n, None, None, None, None, None) for n in range(60)]
    df = spark.createDataFrame(rows, "s string, i long, gps_speed_kmh double, speed_kph double, throttle_pct double, lat_acc_g double, lon_acc_g double")
    for labelled in (rules.label_v2(df, ["s"]), rules.label_v1(df, ["s"])):
        assert labelled.filter("label <> 'Normal' OR label IS NULL").count() == 0


def test_session_boundary_splits_events(spark):
    rows = [(s, n, n / 25, "x" if (s == "a" and n > 5) or (s == "b" and n < 5) else "Normal") for s in "ab" for n in range(10)]
    df = spark.createDataFrame(rows, "s string, i long, t double, label string")
    assert runs.event_table(df, ["s"], "t", "label").count() == 2


def test_peak_rule(drives):
    got = {
        (r["case"], r["label"]): r["count"]
        for r in runs.event_table(rules.label_v1(drives, ["case"], block=150), ["case"], "t", "label").groupBy("case", "label").count().collect()
    }
    assert got[("spike 6.06", rules.TURN)] == 1 and got[("braking", rules.BRAKE)] == 1
    assert got[("lon spike", rules.BRAKE)] == 1
    assert ("0.40 s", rules.BRAKE) not in got and got[("0.40 s", rules.TURN)] == 1


def test_diagnostics_of_the_braking_case(drives):
    headed = drives.withColumn("heading_deg", F.lit(90.0))
    labelled = rules.label_v2(headed, ["case"], replace(rules.ADOPTED, min_heading_deg=0.0))
    row = E.diagnose_events(labelled, ["case"], "label").filter("case = 'braking'").first()
    assert row["label"] == rules.BRAKE and abs(row["can_accel_min_ms2"] + 1.0) < 1e-6
    assert row["n_raw_above_thr"] <= 25 and abs(row["max_raw_g"] - 0.45) < 1e-9 and row["heading_change_deg"] == 0.0
    assert abs(row["rectification_ratio"] - 1.0) < 1e-9


def test_event_outcomes(spark):
    base = [("s", 0, 5, "T"), ("s", 10, 20, "T"), ("s", 30, 35, "T"), ("s", 40, 45, "T"), ("s", 50, 60, "T"), ("s", 70, 75, "T"), ("s", 80, 90, "B")]
    clipped = [("s", 0, 5, "T"), ("s", 10, 13, "T"), ("s", 16, 20, "T"), ("s", 30, 45, "T"), ("s", 51, 60, "T"), ("s", 82, 88, "T"), ("s", 95, 99, "T")]
    schema = "s string, i0 long, i1 long, label string"
    got = {(r["i0"], r["i1"]): r["outcome"] for r in E.clip_outcome(spark.createDataFrame(base, schema), spark.createDataFrame(clipped, schema), ["s"], 8.0).collect()}
    assert got == {
        (0, 5): "unchanged", (10, 20): "split", (30, 35): "merge", (40, 45): "merge", (50, 60): "boundary 1 samples", (70, 75): "disappears",
        (80, 90): "class change", (95, 99): "appears only after clipping",
    }


def test_label_sets_and_manoeuvres(drives):
    rule = replace(rules.ADOPTED, min_heading_deg=0.0)
    sets = rules.label_sets(drives, ["case"], rule, 1.2).filter("case = 'braking'")
    counts = sets.agg(*[F.sum((F.col(f"label_{n}") != rules.NORMAL).cast("int")).alias(n) for n in ("minus10", "base", "plus10", "clip")]).first()
    assert counts["minus10"] >= counts["base"] >= counts["plus10"] > 0 and counts["clip"] == counts["base"]
    # a drive without pedal data labels braking and turning as before
    table = E.manoeuvre_table(drives.withColumn("heading_deg", F.lit(90.0)), ["case"], rule, {"throttle_pct": F.lit(100.0)})
    found = {(r["case"], r["label"]) for r in table.collect()}
    assert ("braking", rules.BRAKE) in found and ("sustained noisy", rules.TURN) in found
