"""Readers and writers on files made by the test."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.operators import relations
from sessionloom.sources import device, digests, sessions, sinks
from sessionloom.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def test_session_scan_and_discovery(spark, tmp_path):
    put(tmp_path / "D1" / "Session_2" / "D1_S2_fused.csv", "a,b,c\n1,2.5,x\n2,3.5,y\n")
    put(tmp_path / "D12" / "Seesion 1" / "D12_S1_fused.csv", "a,b,c\n3,4.5,z\n")
    df = sessions.scan_sessions(spark, str(tmp_path), "*_fused.csv", "a int, b double, c string", ["b"])
    assert {tuple(r) for r in df.collect()} == {(1, 2, "D1_S2", 2.5), (1, 2, "D1_S2", 3.5), (12, 1, "D12_S1", 4.5)}
    found = {(r["driver"], r["session"]): r["n_files"] for r in sessions.discover_sessions(spark, str(tmp_path)).collect()}
    assert found == {(1, 2): 1, (12, 1): 1}


def test_native_telemetry(spark, tmp_path):
    head = "UTC time,Elapsed time (s),Latitude,Longitude,Speed (km/h),Label\n"
    put(tmp_path / "D3_S4_LABELED.csv", head + "235959.50,0.00,24°30.0 N,46°0.0 E,12.5,Normal\n000000.50,1.00,24°30.0 N,x,bad,Normal\n000001.50,,24°30.0 N,x,1,Normal\n")
    rows = sessions.load_native_telemetry(spark, str(tmp_path / "*.csv"), "2025-01-01").orderBy("elapsed_s").collect()
    assert [r["elapsed_s"] for r in rows] == [0.0, 1.0] and rows[0]["driver"] == 3 and rows[0]["lat"] == 24.5
    # anchored once: the midnight wrap of the clock does not move the second row
    assert rows[1]["unix_time"] - rows[0]["unix_time"] == 1.0 and rows[1]["lon"] is None and rows[1]["gps_speed_kmh"] is None


def test_packets_and_recordings(spark, tmp_path):
    folder = tmp_path / "D1" / "Session_1"
    log = put(
        folder / "2025-03-01_08-30-00.csv",
        "1000,1,2,EA,1,100,0.5,0.6\n1001,2,1,RB,1,100,9\nbad,3,1,EA,1,100,1\n1002,4,3,EA,1,100,1,2\n1003,5,1,HR,1,100,oops\n1004,6,1,ZZ,1,100,1\n1005,7,1,AX,1,100,-0.25\n7,8\n",
    )
    put(folder / "2025-03-01_08-00-00.csv", "1,1,1,EA,1,100,1\n")
    put(folder / "2025-03-01_08-00-00_timesyncs.csv", "RD,TS_received,TS_sent,AK,RoundTrip\n")
    pings = put(folder / "2025-03-01_08-30-00_timesyncs.csv", "RD,TS_received,TS_sent,AK,RoundTrip\nRD,5000,2025-03-01_08-30-05-250000,AK,20\n")
    put(folder / "2025-03-01_08-30-00_EA.csv", "LocalTimestamp,Other,EA\n100.5,7,0.25\n101.5,7,junk\n" + "x" * 900)
    put(folder / "2025-03-01_08-30-00_HR.csv", "LocalTimestamp,Beat\n100.0,61\n")
    keys = [F.lit(1).alias("driver"), F.lit(1).alias("session")]
    samples = device.scan_packets(spark, str(log), keys).orderBy("ts_ms").collect()
    assert [(r["tag"], round(r["ts_ms"], 3), r["value"]) for r in samples] == [("EA", 1000.0, 0.5), ("AX", 1005.0, -0.25), ("EA", 1066.667, 0.6)]
    files = sessions.list_files(spark, str(folder)).withColumn("d", F.lit(1))
    main = device.pick_main_recording(files, ["d"]).first()
    assert main["name"] == "2025-03-01_08-30-00.csv" and main["sync_name"] == "2025-03-01_08-30-00_timesyncs.csv" and main["n_candidates"] == 2
    ping = device.scan_pings(spark, str(pings), keys).first()
    assert ping["device_ms"] == 5000.0 and ping["rtt_ms"] == 20.0 and ping["sent_s"] == 1740807005.25
    channels = {(r["channel"], r["unix_time"], r["value"]) for r in device.scan_channel_files(spark, str(folder), keys).collect()}
    assert channels == {("EDA", 100.5, 0.25), ("HR", 100.0, 61.0)}


def test_maps_and_dictionaries(spark, tmp_path):
    put(tmp_path / "a_timeSyncMap.csv", "TE0,TE1,TL0,TL1\n0,10,100,110\n")
    assert tuple(device.scan_maps(spark, str(tmp_path / "*Map.csv"), [F.lit(1).alias("d")]).first()) == (1, 0.0, 10.0, 100.0, 110.0)
    schema = {"files": {"f.csv": {"columns": {"HR": {"dtype": "float", "plausible_range": [40, 200]}, "label": {"dtype": "string"}, "X": {"plausible_range": [None, 3]}}}}}
    put(tmp_path / "schema.json", json.dumps(schema, indent=1))
    assert [tuple(r) for r in device.load_ranges(spark, str(tmp_path / "schema.json")).collect()] == [("f.csv", "HR", 40.0, 200.0)]
    put(tmp_path / "meta.json", json.dumps({"sessions": [{"tag": "D1_S1", "drive_duration_s": 9.5}]}, indent=1))
    assert device.load_session_metadata(spark, str(tmp_path / "meta.json")).first()["drive_duration_s"] == 9.5


def test_series_round_trip(spark, tmp_path):
    df = spark.range(20).select((F.col("id") % 2).cast("int").alias("driver"), F.lit(1).alias("session"), F.col("id").alias("t"), (F.col("id") / 3).alias("v"))
    sinks.write_series(df, str(tmp_path / "csv"), "csv", t="t")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.filter("t = '1'").first()["v"] == "0.333333" and back.count() == 20
    sinks.write_series(df, str(tmp_path / "pq"), t="t")
    pruned = sessions.scan_parquet(spark, str(tmp_path / "pq"), ["v"], [1])
    assert pruned.count() == 10 and "PartitionFilters" in pruned._jdf.queryExecution().toString()
    cached = sinks.cache_columns(df, ["t", "v"], str(tmp_path / "cache"))
    assert cached.columns == ["t", "v"] and cached.count() == 20
    assert sinks.append_column(df, "w", F.lit(1)).columns == [*df.columns, "w"]


def test_manifest(spark, tmp_path):
    body = b"a,b\n1,2\n3,4\n"
    (tmp_path / "Raw_Dataset").mkdir()
    (tmp_path / "Raw_Dataset" / "x.csv").write_bytes(body)
    (tmp_path / "readme.txt").write_bytes(b"hello")
    rows = {r["relative_path"]: r for r in sinks.build_manifest(spark, str(tmp_path)).collect()}
    x = rows["Raw_Dataset/x.csv"]
    assert (x["tier"], x["rows"], x["size_bytes"], x["sha256"]) == ("raw", 2, len(body), hashlib.sha256(body).hexdigest())
    assert rows["readme.txt"]["tier"] == "release" and rows["readme.txt"]["rows"] is None
    first = sinks.build_manifest(spark, str(tmp_path))
    old = spark.createDataFrame(first.collect(), first.schema)
    (tmp_path / "readme.txt").write_bytes(b"hello again")
    listing = sessions.list_files(spark, str(tmp_path)).select(F.substring_index("path", f"{tmp_path}/", -1).alias("relative_path"), F.col("length").alias("size_bytes"))
    changed = sinks.changed_files(old, listing)
    assert [r["relative_path"] for r in changed.collect()] == ["readme.txt"]
    new = sinks.build_manifest(spark, str(tmp_path)).join(changed.select("relative_path"), "relative_path", "left_semi").select(*old.columns)
    assert sinks.upsert_manifest(old, new).filter("size_bytes = 11").count() == 1


@pytest.mark.parametrize("split", ["7k", "128m"])
def test_manifest_of_long_files(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(digests, "WHOLE", 1000)
    monkeypatch.setattr(digests, "STRETCH", 5000)
    monkeypatch.setattr(digests, "PIECE", 700)
    rng = np.random.default_rng(4)
    noise, mark = rng.bytes(60_000), b"\xef\xbb\xbf"
    bodies = {
        "noise.bin": noise, "ends.bin": noise + b"\n", "two.bin": noise + b"\n\n", "marked.bin": mark + noise, "marked ends.bin": mark + noise + b"\n",
        "twice marked.bin": mark + mark + b"\n" + noise, "Raw_Dataset/x.csv": b"a,b\r\n" * 9000, "Raw_Dataset/short.csv": b"a\n1\n",
        "zeros.bin": bytes(20_000), "words.txt": b"word " * 4000, "newlines.bin": b"\n" * 3000, "limit.bin": b"y" * 4998 + b"\n" + noise,
        "a#b %é.bin": noise[:9000], "packed.csv.gz": gzip.compress(noise), "packed.bz2": bz2.compress(noise), "not.zst": noise, "zeros.gz": bytes(6000),
        "manifest.csv": b"old\n" * 2000,
    }
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    # a longer file can't be read as one value
    limits = {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1k"}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        got = {r["relative_path"]: (r["size_bytes"], r["sha256"]) for r in sinks.build_manifest(spark, str(tmp_path)).collect()}
    finally:
        for name in limits:
            spark.conf.unset(name)
    want = {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items() if n != "manifest.csv"}
    assert got == want
    # without any separator it is one value
    (tmp_path / "one stretch.bin").write_bytes(b"x" * 20_000)
    got = {r["relative_path"]: (r["size_bytes"], r["sha256"]) for r in sinks.build_manifest(spark, str(tmp_path)).collect()}
    assert got == want | {"one stretch.bin": (20_000, hashlib.sha256(b"x" * 20_000).hexdigest())}


def test_resume(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "k long, v double"

    def run():
        ingest.resumable_ingest(spark, src, schema, out, mark, lambda d: d.withColumn("w", F.col("v") * 2)).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).drop("batch").collect())

    spark.createDataFrame([(1, 1.0), (2, 2.0)], schema).write.mode("append").parquet(src)
    assert run() == [(1, 1.0, 2.0), (2, 2.0, 4.0)]
    spark.createDataFrame([(2, 9.0), (3, 3.0)], schema).write.mode("append").parquet(src)
    # a second file of a key adds its rows, and a run without new files nothing
    assert run() == [(1, 1.0, 2.0), (2, 2.0, 4.0), (2, 9.0, 18.0), (3, 3.0, 6.0)]
    assert run() == [(1, 1.0, 2.0), (2, 2.0, 4.0), (2, 9.0, 18.0), (3, 3.0, 6.0)]
    todo = spark.createDataFrame([(3,), (4,)], "k long")
    assert [r["k"] for r in relations.skip_done(todo, spark.read.parquet(out), ["k"]).collect()] == [4]
