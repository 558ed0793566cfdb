"""Writing series, caching columns, tiers, manifests and completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import relations, stats
from . import digests


def fixed_decimals(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Floating columns as text with a fixed number of decimals, other columns untouched."""
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.format_string(f"%.{decimals}f", F.col(c).cast("double")) for c in real}) if real else df


def write_series(df: DataFrame, path: str, fmt: str = "parquet", decimals: int = 6, by: Sequence[str] = ("driver", "session"), t: str | None = None) -> None:
    """Write a table by session (S9). CSV gets fixed decimals; rows are in time order when `t` is given.

    Files of a long session come from several tasks, so no task writes a whole session.
    """
    ready = relations.sort_series(df, list(by), t) if t else df
    if fmt == "csv":
        fixed_decimals(ready, decimals).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)
    else:
        ready.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def append_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The same columns in the same order and one more at the end."""
    return df.select(*[c for c in df.columns if c != name], value.alias(name))


def cache_columns(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """A projection written once as Parquet for repeated evaluations."""
    df.select(*columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_raw_tier(native: DataFrame, windows: DataFrame, k: Sequence[str], t: str = "unix_time", drop: Sequence[str] = ("label",), rebase: str = "first") -> DataFrame:
    """Native rows inside each session's fused window, without labels, elapsed time rebased.

    Telemetry starts at its own first row (`first`), device channels at the window (`window`).
    """
    inside = (
        native.join(windows.select(*k, "w_start", "w_end"), list(k))
        .filter(F.col(t).between(F.col("w_start"), F.col("w_end")))
        .drop(*drop)
    )
    if rebase == "window":
        return inside.withColumn("elapsed_s", F.col(t) - F.col("w_start")).drop("w_start", "w_end")
    first = inside.groupBy(*k).agg(F.min(t).alias("_t0"))
    return stats.attach(inside, first, k).withColumn("elapsed_s", F.col(t) - F.col("_t0")).drop("w_start", "w_end", "_t0")


def check_required_files(manifest: DataFrame, sessions: DataFrame, k: Sequence[str], kinds: Mapping[str, bool], source: DataFrame | None = None) -> DataFrame:
    """What is wrong with the files of each session (S14): missing session, missing required file,
    size other than in the source. kinds: file kind -> required. manifest and source: k, kind, size.
    """
    present = sessions.join(manifest.select(*k).distinct(), list(k), "left_anti").select(
        *k, F.lit(None).cast("string").alias("kind"), F.lit("missing session").alias("problem")
    )
    required = [n for n, needed in kinds.items() if needed]
    expected = relations.cross(sessions.join(manifest.select(*k).distinct(), list(k), "left_semi"), required, "kind")
    missing = expected.join(manifest.select(*k, "kind"), [*k, "kind"], "left_anti").select(
        *k, "kind", F.lit("missing required").alias("problem")
    )
    out = present.unionByName(missing)
    if source is not None:
        other = source.select(*k, "kind", F.col("size").alias("_size"))
        differs = manifest.join(other, [*k, "kind"]).filter(F.col("size") != F.col("_size"))
        out = out.unionByName(differs.select(*k, "kind", F.lit("size mismatch").alias("problem")))
    return out


# First folder of a path and the tier it stands for.
TIERS = {"Raw_Dataset": "raw", "Preprocessed_Dataset": "processed"}


def build_manifest(spark: SparkSession, root: str, tiers: Mapping[str, str] = TIERS) -> DataFrame:
    """Every file below `root` (S12): tier, relative path, size, data rows of CSV files, SHA-256.

    Long files are hashed in pieces; lines are counted by a splittable text scan.
    """
    base = root.rstrip("/") + "/"
    rel = F.substring_index(F.regexp_replace("path", "%20", " "), base, -1)
    files = digests.sha256_files(spark, root).select(rel.alias("relative_path"), F.col("length").alias("size_bytes"), "sha256")
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)
        .select(F.substring_index(F.regexp_replace(F.col("_metadata.file_path"), "%20", " "), base, -1).alias("relative_path"))
        .groupBy("relative_path").agg((F.count(F.lit(1)) - 1).alias("rows"))
    )
    first = F.element_at(F.split("relative_path", "/"), 1)
    tier = F.create_map(*[F.lit(x) for item in tiers.items() for x in item])[first]
    return files.filter(~F.col("relative_path").endswith("manifest.csv")).join(lines, "relative_path", "left").select(
        F.coalesce(tier, F.lit("release")).alias("tier"), "relative_path", "size_bytes", "rows", "sha256"
    )


def changed_files(old: DataFrame, listing: DataFrame) -> DataFrame:
    """Files whose size differs from the manifest, or that it lacks: only these are hashed again."""
    known = old.select("relative_path", F.col("size_bytes").alias("_size"))
    return listing.join(known, "relative_path", "left").filter(~F.col("size_bytes").eqNullSafe(F.col("_size"))).drop("_size")


def upsert_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Manifest with new and changed rows in place of the old ones."""
    return relations.upsert(old, new, ["relative_path"])
