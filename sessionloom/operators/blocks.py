"""Long series in bounded pieces.

A session may hold a third of all rows, so no window here is partitioned by the session
alone. Two cuts are used:

* a *chunk* is a stretch of time (`chunk_of`), a pure function of the row;
* a *block* is a fixed number of consecutive rows of an indexed series (`with_halo`), with
  copies of the neighbouring rows that bounded frames need.

What has to cross a cut (row numbers, running sums, the last value seen) travels through a
table with one row per chunk or block.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536
CHUNK_ROWS = 250_000


def pick_width(df: DataFrame, k: Sequence[str], t: str, rows: int = CHUNK_ROWS) -> float:
    """Chunk width, in units of `t`, that keeps the densest series near `rows` rows per chunk.

    One combinable aggregation over the key and time columns; one row reaches the driver.
    """
    per_key = df.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n"), (F.max(t) - F.min(t)).cast("double").alias("span")
    )
    width = per_key.agg(
        F.min(F.when(F.col("n") > rows, F.col("span") / F.ceil(F.col("n") / rows))).alias("narrow"),
        F.max("span").alias("span"),
    ).first()
    if width.narrow:
        return float(width.narrow)
    return math.ceil(float(width.span or 0.0)) + 1.0


def chunk_of(t: Column | str, width: float) -> Column:
    t = F.col(t) if isinstance(t, str) else t
    return F.floor(t / F.lit(width)).cast("bigint")


def index_rows(
    df: DataFrame, k: Sequence[str], order: Sequence[str | Column], chunk: Column, out: str = "i"
) -> DataFrame:
    """Dense 0-based position of each row in its series.

    Rows are numbered inside (key, chunk); a per-chunk count supplies the offset.
    """
    k = list(k)
    cut = df.withColumn("_c", chunk)
    offsets = (
        cut.groupBy(*k, "_c")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *k,
            "_c",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy(*k)
                    .orderBy("_c")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_before"),
        )
    )
    local = F.row_number().over(Window.partitionBy(*k, "_c").orderBy(*order))
    return (
        cut.withColumn("_r", local)
        .join(offsets, [*k, "_c"])
        .withColumn(out, (F.col("_before") + F.col("_r") - 1).cast("bigint"))
        .drop("_c", "_r", "_before")
    )


def with_halo(
    df: DataFrame, before: int, after: int, i: str = "i", block: int = BLOCK_ROWS
) -> DataFrame:
    """Cut an indexed series into blocks `_b`, each with copies of its neighbouring rows.

    `before` rows of the previous block and `after` rows of the next one are copied, and
    `_home` marks the originals. Series on uniform grids bring their own index.
    """
    block = max(block, before, after, 1)
    home = F.floor(F.col(i) / F.lit(block)).cast("bigint")
    place = F.pmod(F.col(i), F.lit(block))
    copies = [home]
    if before:
        copies.append(F.when(place >= block - before, home + 1))
    if after:
        copies.append(F.when((place < after) & (home > 0), home - 1))
    if len(copies) == 1:
        return df.withColumn("_b", home).withColumn("_home", F.lit(True))
    spread = df.withColumn("_b", F.explode(F.array_compact(F.array(*copies))))
    return spread.withColumn("_home", F.col("_b") == home)


def with_time_halo(df: DataFrame, t: str, before: float, after: float, width: float) -> DataFrame:
    """Cut a series into time chunks `_b` with copies of the rows within `before` / `after` of a
    chunk, for frames that are ranges of time. Units are those of `t`."""
    width = max(width, before, after)
    home = chunk_of(t, width)
    earliest = chunk_of(F.col(t) - F.lit(after), width)
    latest = chunk_of(F.col(t) + F.lit(before), width)
    spread = df.withColumn("_b", F.explode(F.sequence(earliest, latest)))
    return spread.withColumn("_home", F.col("_b") == home)


def block_window(k: Sequence[str], i: str = "i"):
    return Window.partitionBy(*k, "_b").orderBy(i)


def home(df: DataFrame) -> DataFrame:
    """Drop the halo copies once the frames have been read."""
    return df.filter("_home").drop("_home")


def over_blocks(
    df: DataFrame,
    k: Sequence[str],
    before: int,
    after: int,
    columns,
    i: str = "i",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add columns computed on frames that reach at most `before`/`after` rows.

    `columns` receives the window and returns a list of {name: Column} layers; a later layer
    may read the names of an earlier one, and the reaches add up. All layers share one shuffle.
    """
    w = block_window(k, i)
    out = with_halo(df, before, after, i, block)
    for layer in columns(w):
        out = out.withColumns(layer)
    return home(out)


def scan(
    df: DataFrame,
    k: Sequence[str],
    part: str,
    order: Sequence[str],
    prev: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Unbounded look-back, look-ahead and running sums over a cut series.

    prev       last non-null value at or before the row
    following  first non-null value at or after the row
    running    sum of everything up to and including the row

    Each is taken inside (key, part) and completed from a table with one row per part. The
    look-ahead sorts downwards: a frame that ends at `unbounded following` is quadratic.
    """
    k, order = list(k), list(order)
    prev, following, running = prev or {}, following or {}, running or {}
    up = Window.partitionBy(*k, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    down = (
        Window.partitionBy(*k, part)
        .orderBy(*[F.col(c).desc() for c in order])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rank = F.struct(*order)
    aggs = [F.max_by(e, F.when(e.isNotNull(), rank)).alias(f"_p_{n}") for n, e in prev.items()]
    aggs += [F.min_by(e, F.when(e.isNotNull(), rank)).alias(f"_f_{n}") for n, e in following.items()]
    aggs += [F.sum(e).alias(f"_s_{n}") for n, e in running.items()]
    earlier = Window.partitionBy(*k).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy(*k).orderBy(F.col(part).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = df.groupBy(*k, part).agg(*aggs).select(
        *k,
        part,
        *[F.last(f"_p_{n}", True).over(earlier).alias(f"_p_{n}") for n in prev],
        *[F.last(f"_f_{n}", True).over(later).alias(f"_f_{n}") for n in following],
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_s_{n}") for n in running],
    )
    local = df.withColumns(
        {f"_lp_{n}": F.last(e, True).over(up) for n, e in prev.items()}
        | {f"_ls_{n}": F.sum(e).over(up) for n, e in running.items()}
    )
    if following:
        local = local.withColumns(
            {f"_lf_{n}": F.last(e, True).over(down) for n, e in following.items()}
        )
    done = local.join(carried, [*k, part], "left").withColumns(
        {n: F.coalesce(f"_lp_{n}", f"_p_{n}") for n in prev}
        | {n: F.coalesce(f"_lf_{n}", f"_f_{n}") for n in following}
        | {n: F.coalesce(f"_ls_{n}", F.lit(0)) + F.coalesce(f"_s_{n}", F.lit(0)) for n in running}
    )
    temporary = [f"_{a}_{n}" for a, g in (("p", prev), ("f", following), ("s", running)) for n in g]
    return done.drop(*temporary, *[f"_l{c[1:]}" for c in temporary])
