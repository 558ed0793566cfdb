"""Wearable device logs: packets, per-channel files, recordings, sync pings, dictionaries."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

# Nominal rate in Hz and channel name of each packet tag.
TAG_RATES = {
    "PI": 25.0, "PR": 25.0, "PG": 25.0,
    "AX": 25.0, "AY": 25.0, "AZ": 25.0,
    "GX": 25.0, "GY": 25.0, "GZ": 25.0,
    "MX": 25.0, "MY": 25.0, "MZ": 25.0,
    "EA": 15.0, "EL": 15.0, "SF": 3.0,
    "T1": 7.5, "TH": 7.5,
    "HR": 1.0, "BI": 1.0,
}
TAG_CHANNELS = {
    "PI": "PPG_IR", "PR": "PPG_RED", "PG": "PPG_GREEN",
    "EA": "EDA", "EL": "EDA_LEVEL", "SF": "SCR_FREQ",
    "T1": "TEMP_CONTACT", "TH": "TEMP_THERMOPILE",
    "HR": "HR", "BI": "IBI",
    "AX": "ACC_x", "AY": "ACC_y", "AZ": "ACC_z",
    "GX": "GYRO_x", "GY": "GYRO_y", "GZ": "GYRO_z",
    "MX": "MAG_x", "MY": "MAG_y", "MZ": "MAG_z",
}
# Status tags that carry no signal.
STATUS_TAGS = ("RB", "EM", "DC", "DO", "B%", "BV", "D+", "D-", "AK", "RD", "TL")


def constant_map(table: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for item in table.items() for x in item])


def parse_packets(
    lines: DataFrame, k: Sequence[str], tag_rates: Mapping[str, float] = TAG_RATES, skip_tags: Collection[str] = STATUS_TAGS
) -> DataFrame:
    """Samples of a ragged packet log (S4): k, tag, ts_ms, value.

    A line is ts_ms, sequence, count, tag, version, reliability, then `count` values. Lines with too
    few fields, bad numbers, unknown or status tags or a short payload are skipped; sample n of a
    packet lies n periods of its tag after the packet's time.
    """
    parts = F.split(F.regexp_replace("value", r"\r$", ""), ",")
    # the optimizer may run these filters in any order, so no step relies on an earlier one
    packets = (
        lines.withColumn("_p", parts)
        .filter(F.size("_p") >= 7)
        .select(
            *k,
            F.get("_p", F.lit(0)).try_cast("double").alias("_ts"),
            F.trim(F.get("_p", F.lit(2))).try_cast("int").alias("_count"),
            F.trim(F.get("_p", F.lit(3))).alias("tag"),
            "_p",
        )
        .filter(F.col("_ts").isNotNull() & F.col("_count").isNotNull())
        .filter(F.col("tag").isin(list(tag_rates)) & ~F.col("tag").isin(list(skip_tags)))
        .filter((F.col("_count") > 0) & (F.size("_p") >= F.col("_count") + 6))
        .withColumn("_v", F.transform(F.slice("_p", 7, F.greatest(F.col("_count"), F.lit(0))), lambda x: F.trim(x).try_cast("double")))
        .filter(~F.exists("_v", lambda x: x.isNull()))
        .withColumn("_dt", F.lit(1000.0) / constant_map(tag_rates)[F.col("tag")])
    )
    return packets.select(*k, "tag", "_ts", "_dt", F.posexplode("_v").alias("_n", "value")).select(
        *k, "tag", (F.col("_ts") + F.col("_n") * F.col("_dt")).alias("ts_ms"), "value"
    )


def scan_packets(spark: SparkSession, path: str, keys: Sequence[Column], **kw) -> DataFrame:
    """Packet logs as samples; `keys` are aliased expressions over the file path."""
    lines = spark.read.text(path).select("value", *keys)
    return parse_packets(lines, [c for c in lines.columns if c != "value"], **kw)


def name_channels(samples: DataFrame, channels: Mapping[str, str] = TAG_CHANNELS) -> DataFrame:
    """Channel of each tag; tags without one are dropped (P20)."""
    return samples.withColumn("channel", constant_map(channels)[F.col("tag")]).filter(F.col("channel").isNotNull()).drop("tag")


def scan_channel_files(spark: SparkSession, root: str, keys: Sequence[Column], channels: Mapping[str, str] = TAG_CHANNELS) -> DataFrame:
    """Per-channel CSV files named `*_<TAG>.csv` as long samples.

    The value is the column named like the tag, or else the last one. Lines are read as text with
    the header kept per file, because each file has its own columns.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_??.csv").text(root)
        .select("value", F.col("_metadata.file_path").alias("_f"), *keys)
        .withColumn("tag", F.regexp_extract("_f", r"_([A-Z0-9]{2})\.csv$", 1))
        .filter(F.col("tag").isin(list(channels)))
        .withColumn("_p", F.transform(F.split("value", ","), lambda x: F.trim(x)))
    )
    heads = lines.filter(F.array_contains("_p", "LocalTimestamp")).groupBy("_f").agg(F.first("_p").alias("_h"))
    at = F.array_position("_h", "LocalTimestamp").cast("int")
    own = F.array_position("_h", F.col("tag")).cast("int")
    place = F.when(own > 0, own).otherwise(F.size("_h"))
    kept = [c for c in lines.columns if c not in ("value", "_f", "_p", "tag")]
    samples = lines.join(heads, "_f").select(
        *kept, "tag", F.get("_p", at - 1).try_cast("double").alias("unix_time"), F.get("_p", place - 1).try_cast("double").alias("value")
    )
    return name_channels(samples.dropna(subset=["unix_time", "value"]), channels)


def pick_main_recording(files: DataFrame, k: Sequence[str], exclude_suffixes: Collection[str] = ()) -> DataFrame:
    """The largest main file per folder and the ping log with its own stem.

    files: k, name, length. A name with a channel, status or sync suffix is not a main file; a ping
    log belongs to a recording only by its stem, whatever else the folder holds.
    """
    suffixes = [*TAG_CHANNELS, *STATUS_TAGS, "timeSyncMap", "timesyncs", *exclude_suffixes]
    is_csv = F.col("name").endswith(".csv")
    other = F.regexp_extract("name", r"_([^_]+)\.csv$", 1).isin(suffixes) | F.col("name").contains("_info")
    stem = F.regexp_replace("name", r"\.csv$", "")
    main = (
        files.filter(is_csv & ~other)
        .groupBy(*k)
        .agg(F.max_by("name", F.struct("length", "name")).alias("name"), F.max("length").alias("length"), F.count(F.lit(1)).alias("n_candidates"))
        .withColumn("stem", stem)
    )
    syncs = files.filter(F.col("name").endswith("_timesyncs.csv")).select(
        *k, F.regexp_replace("name", r"_timesyncs\.csv$", "").alias("stem"), F.col("name").alias("sync_name")
    )
    return main.join(syncs, [*k, "stem"], "left").select(*k, "name", "length", "n_candidates", "sync_name")


def scan_pings(spark: SparkSession, path: str, keys: Sequence[Column]) -> DataFrame:
    """Sync-ping logs (S7): k, device_ms, sent_s (epoch seconds), rtt_ms."""
    schema = "RD string, TS_received string, TS_sent string, AK string, RoundTrip string, blank string"
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return raw.select(
        *keys,
        S.to_double("TS_received").alias("device_ms"),
        S.stamp_to_epoch("TS_sent", micros=True).alias("sent_s"),
        S.to_double("RoundTrip").alias("rtt_ms"),
    )


def scan_maps(spark: SparkSession, path: str, keys: Sequence[Column]) -> DataFrame:
    """Two-point clock maps (S7): k, TE0, TE1, TL0, TL1, the first row of each file."""
    raw = spark.read.option("header", True).csv(path)
    points = [S.to_double(c).alias(c) for c in ("TE0", "TE1", "TL0", "TL1")]
    return raw.select(*keys, *points).dropna()


def load_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Plausible ranges of a JSON data dictionary (S8): file, column, lo, hi, both bounds given."""
    schema = (
        "files map<string, struct<columns: map<string, struct<dtype: string, unit: string, "
        "plausible_range: array<double>>>>>"
    )
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("_d"))
    columns = text.select(F.explode("_d.files").alias("file", "_f")).select("file", F.explode("_f.columns").alias("column", "_c"))
    return columns.select(
        "file", "column", F.get("_c.plausible_range", F.lit(0)).alias("lo"), F.get("_c.plausible_range", F.lit(1)).alias("hi")
    ).dropna()


def load_session_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Session records of a JSON metadata file, one row each."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("sessions").alias("_s")).select("_s.*")


def recording_stamp(name: Column | str, utc_offset_h: int = 3) -> Column:
    """Epoch of the recording start in a file name (P6), whole seconds."""
    return S.stamp_to_epoch(name, utc_offset_h)


def start_anchor(samples: DataFrame, k: Sequence[str], started: DataFrame) -> DataFrame:
    """Fallback anchor of each recording: first packet time and file-name epoch."""
    first = samples.groupBy(*k).agg(F.min("ts_ms").alias("start_ms"))
    return first.join(started.select(*k, "start_s"), list(k))
