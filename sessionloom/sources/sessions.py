"""Session files: discovery, projection scans, native telemetry, aligned loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import asof, clock

TAG = r"D(\d+)_S(\d+)"


def path_keys(path: Column | None = None, pattern: str = TAG) -> list[Column]:
    """driver, session and tag read from a file path."""
    path = F.col("_metadata.file_path") if path is None else path
    driver = F.regexp_extract(path, pattern, 1).try_cast("int")
    session = F.regexp_extract(path, pattern, 2).try_cast("int")
    tag = F.concat(F.lit("D"), driver.cast("string"), F.lit("_S"), session.cast("string"))
    return [driver.alias("driver"), session.alias("session"), tag.alias("tag")]


def scan_sessions(spark: SparkSession, root: str, pattern: str, schema: T.StructType | str, columns: Sequence[str]) -> DataFrame:
    """Columns of all session CSV files below `root` (S1); the reader parses only those."""
    read = spark.read.schema(schema).option("header", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return read.csv(root).select(*path_keys(), *columns)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str], drivers: Sequence[int] | None = None) -> DataFrame:
    """The same table stored by driver and session; a driver list prunes its folders."""
    df = spark.read.parquet(path)
    if drivers is not None:
        df = df.filter(F.col("driver").isin(list(drivers)))
    return df.select("driver", "session", *columns)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, name and size of the files below `root`, without reading their contents."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    )
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def discover_sessions(spark: SparkSession, root: str, folder: str = r"D(\d+)/S(?:ession|eesion)[ _]?(\d+)/") -> DataFrame:
    """Sessions found as folders named after driver and session, spelling variants included."""
    # a path may hold the blank as %20
    path = F.regexp_replace("path", "%20", " ")
    return (
        list_files(spark, root)
        .select(
            F.regexp_extract(path, folder, 1).try_cast("int").alias("driver"),
            F.regexp_extract(path, folder, 2).try_cast("int").alias("session"),
            "length",
        )
        .dropna()
        .groupBy("driver", "session")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )


# Native header and the name each kept column gets.
NATIVE_COLUMNS = {
    "Speed (km/h)": "gps_speed_kmh",
    "Heading (Degrees)": "heading_deg",
    "Height (m)": "height_m",
    "Lateral acceleration (g)": "lat_acc_g",
    "Longitudinal acceleration (g)": "lon_acc_g",
    "Gradient (%)": "gradient_pct",
    "Engine_Speed (rpm)": "engine_rpm",
    "Accelerator_Pedal_Position (%)": "throttle_pct",
    "Brake_Pedal_Position (%)": "brake_pct",
    "Indicated_Vehicle_Speed_kph (km/h)": "speed_kph",
    "Wheel_Speed_FR_kph (km/h)": "wheel_fr_kph",
    "Wheel_Speed_FL_kph (km/h)": "wheel_fl_kph",
}


def parse_native(raw: DataFrame, k: Sequence[str], date: str | Column | None, order: str | None = None) -> DataFrame:
    """Native telemetry rows (all text) as typed columns with absolute time (S3).

    The date is an input: a recording's local file name may lie a day off. Without it time is
    relative. Rows without elapsed time are dropped. `order` names the file order where it is not
    the elapsed time.
    """
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    numbers = [S.to_double(F.col(f"`{c}`")).alias(n) for c, n in NATIVE_COLUMNS.items() if c in raw.columns]
    label = [F.col("Label").alias("label")] if "Label" in raw.columns else []
    typed = raw.select(
        *k,
        S.hhmmss_to_seconds("`UTC time`").alias("utc_tod_s"),
        S.to_double("`Elapsed time (s)`").alias("elapsed_s"),
        S.parse_degree_minutes("Latitude").alias("lat"),
        S.parse_degree_minutes("Longitude").alias("lon"),
        *numbers,
        *label,
        *([F.col(order).alias("_order")] if order else []),
        (F.lit(None).cast("date") if date is None else (F.lit(date).cast("date") if isinstance(date, str) else date)).alias("_date"),
    )
    by = "_order" if order else "elapsed_s"
    timed = clock.anchor_time(typed, k, "utc_tod_s", "elapsed_s", "_date", by)
    out = timed.filter(F.col("elapsed_s").isNotNull()).withColumn("unix_time", F.coalesce("unix_time", "elapsed_s"))
    return out.select(*k, "unix_time", "utc_tod_s", "elapsed_s", "lat", "lon", *[c for c in out.columns if c in NATIVE_COLUMNS.values()], *[c for c in ("label",) if c in out.columns])


def load_native_telemetry(spark: SparkSession, path: str, date: str | None) -> DataFrame:
    """Native telemetry CSV files, read as text and parsed (S3)."""
    raw = spark.read.option("header", True).csv(path)
    return parse_native(raw.select("*", *path_keys()), ["driver", "session"], date)


def align_modalities(
    fused: DataFrame, modalities: Mapping[str, DataFrame], k: Sequence[str], t: str, width: float,
    ranges: Mapping[str, tuple[float, float]], flags: Mapping[str, str],
) -> DataFrame:
    """A session's fused rows with validity columns and the nearest row of each modality (M2)."""
    ready = fused.withColumns(S.validity(ranges, flags))
    return reduce(
        lambda df, item: asof.asof_nearest(df, item[1], k, t, width, None, f"_{item[0]}"), modalities.items(), ready
    )


def load_aligned(
    spark: SparkSession, root: str, k: Sequence[str], t: str, width: float, modalities: Mapping[str, str],
    ranges: Mapping[str, tuple[float, float]], flags: Mapping[str, str], drivers: Sequence[int] | None = None,
) -> DataFrame:
    """The same from stored tables: `fused` and one table per modality below `root` (M2)."""

    def read(name: str) -> DataFrame:
        df = spark.read.parquet(f"{root}/{name}")
        return df if drivers is None else df.filter(F.col("driver").isin(list(drivers)))

    tables = {n: read(p) for n, p in modalities.items()}
    return align_modalities(read("fused"), tables, k, t, width, ranges, flags)
