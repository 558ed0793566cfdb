"""The registry of queries over the given tables, and the tables as this package sees them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the statement that must agree with it."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as signals: `user_id` is the session, `t` its time in seconds."""
    # the subtraction stays within timestamps without zone, so no session setting moves it
    seconds = "CAST(CAST(ts - TIMESTAMP_NTZ'1970-01-01' AS INTERVAL SECOND) AS DECIMAL(18, 6))"
    micros = F.expr(f"CAST({seconds} * 1000000 AS BIGINT)")
    return table(spark, sf_dir, "events").withColumn("t_us", micros).withColumn("t", micros / F.lit(1e6))


@cache
def _width(session: str, sf_dir: str, k: tuple[str, ...]) -> float:
    spark = SparkSession.active()
    return blocks.pick_width(events(spark, sf_dir), k, "t")


def width(sf_dir: str, *k: str) -> float:
    """Chunk width in seconds for series keyed by `k`, measured once per table and application."""
    return _width(SparkSession.active().sparkContext.applicationId, sf_dir, k or ("user_id",))


def series(spark: SparkSession, sf_dir: str, *k: str) -> DataFrame:
    """Events numbered from 0 inside each series, in time order."""
    k = k or ("user_id",)
    return blocks.index_rows(
        events(spark, sf_dir), k, ["t_us", "event_id"], blocks.chunk_of("t", width(sf_dir, *k))
    )


# The same view in SQL; each statement starts with `WITH` and the parts it needs.
EV = (
    "ev AS (SELECT *, epoch_us(ts) AS t_us, epoch_us(ts) / 1e6 AS t FROM events)"
)
SER = EV + (
    ", ser AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t_us, event_id) - 1 AS i FROM ev)"
)
