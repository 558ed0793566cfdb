"""Column names: normalising headers, choosing candidates, keeping and renaming."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scalars as S

# The clean-up steps of a header, in order.
HEADER_STEPS = (
    (r"[^\w\s%()/.-]", ""),
    (r"\s+", "_"),
    (r"[()/%.-]", "_"),
    (r"_+", "_"),
)


def standard_name(header: str) -> str:
    name = header.strip()
    for pattern, by in HEADER_STEPS:
        name = re.sub(pattern, by, name)
    return name.strip("_")


def standardise_names(df: DataFrame) -> DataFrame:
    """All headers in one spelling."""
    return df.toDF(*[standard_name(c) for c in df.columns])


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a column."""
    return next((c for c in candidates if c in df.columns), None)


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as doubles, where they exist."""
    return df.withColumns({c: S.to_double(F.col(f"`{c}`")) for c in columns if c in df.columns})


def keep_rename(df: DataFrame, mapping: Mapping[str, str], first: Sequence[str] = ()) -> DataFrame:
    """Keep and rename the mapped columns that exist, `first` in front."""
    pairs = {new: old for old, new in mapping.items() if old in df.columns}
    order = [c for c in first if c in pairs] + [c for c in pairs if c not in first]
    return df.select(*[F.col(f"`{pairs[c]}`").alias(c) for c in order])


def map_channels(df: DataFrame, mapping: Mapping[str, str], tag: str = "tag", out: str = "channel") -> DataFrame:
    """Channel name of each device tag, from a constant map (P20)."""
    pairs = F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
    return df.withColumn(out, pairs[F.col(tag)])
