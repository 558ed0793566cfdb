"""Runs of equal values, event tables, and run-length rules on masks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks


def mark_runs(
    df: DataFrame,
    k: Sequence[str],
    c: str,
    i: str = "i",
    at_start: Mapping[str, Column] | None = None,
    at_end: Mapping[str, Column] | None = None,
    block: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """Bounds of the run of equal (null-safe) `c` each row belongs to.

    Adds `run_i0`, `run_i1`, and for every expression in `at_start` / `at_end` its value on
    the first / last row of the run. The first index doubles as the run's id.
    """
    at_start, at_end = dict(at_start or {}), dict(at_end or {})
    w = blocks.block_window(k, i)
    cut = blocks.with_halo(df, 1, 1, i, block).withColumns(
        {
            "_first": ~(F.lag(c).over(w).eqNullSafe(F.col(c))) | F.lag(i).over(w).isNull(),
            "_last": ~(F.lead(c).over(w).eqNullSafe(F.col(c))) | F.lead(i).over(w).isNull(),
        }
    )
    begin = F.struct(F.col(i).alias("_i"), *[e.alias(n) for n, e in at_start.items()])
    end = F.struct(F.col(i).alias("_i"), *[e.alias(n) for n, e in at_end.items()])
    marked = blocks.scan(
        blocks.home(cut),
        k,
        "_b",
        [i],
        prev={"_begin": F.when(F.col("_first"), begin)},
        following={"_end": F.when(F.col("_last"), end)},
    )
    return marked.withColumns(
        {"run_i0": F.col("_begin._i"), "run_i1": F.col("_end._i")}
        | {n: F.col(f"_begin.{n}") for n in at_start}
        | {n: F.col(f"_end.{n}") for n in at_end}
    ).drop("_b", "_begin", "_end", "_first", "_last")


def run_table(
    df: DataFrame,
    k: Sequence[str],
    t: str,
    c: str,
    i: str = "i",
    block: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """One row per run of equal `c`: value, index and time bounds, number of samples."""
    marked = mark_runs(
        df.select(*k, t, c, i), k, c, i, {"start_t": F.col(t)}, {"end_t": F.col(t)}, block
    )
    return marked.filter(F.col(i) == F.col("run_i0")).select(
        *k,
        F.col(c),
        F.col("run_i0").alias("i0"),
        F.col("run_i1").alias("i1"),
        "start_t",
        "end_t",
        (F.col("run_i1") - F.col("run_i0") + 1).alias("n_samples"),
    )


def runs(df: DataFrame, k: Sequence[str], t: str, m: str, i: str = "i", **kw) -> DataFrame:
    """Runs of true (D1); a null counts as false."""
    mask = df.withColumn(m, F.coalesce(F.col(m), F.lit(False)))
    return run_table(mask, k, t, m, i, **kw).filter(m).drop(m)


def event_table(
    df: DataFrame, k: Sequence[str], t: str, label: str, normal: str = "Normal", i: str = "i", **kw
) -> DataFrame:
    """Runs of one class other than `normal` (D13): a change of class starts a new event."""
    return run_table(df, k, t, label, i, **kw).filter(F.col(label) != normal)


def event_counts(events: DataFrame, k: Sequence[str], label: str, classes: Sequence[str]) -> DataFrame:
    """Events per key and class, zero where a class never occurs.

    The classes are a constant list, so the zero rows come from exploding an array.
    """
    counted = [F.count(F.when(F.col(label) == c, 1)).alias(f"_{n}") for n, c in enumerate(classes)]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("cls"), F.col(f"_{n}").alias("n")) for n, c in enumerate(classes)]
    )
    return (
        events.groupBy(*k)
        .agg(*counted)
        .select(*k, F.inline(pairs).alias("cls", "n_events"))
    )


# Rules on masks below reach a bounded number of rows, so they are plain frames. They are
# written as layers for `blocks.over_blocks`, and several can share one shuffle.


def true_(m: Column | str) -> Column:
    m = F.col(m) if isinstance(m, str) else m
    return F.coalesce(m, F.lit(False))


def keep_long(w, m: Column, n: int, name: str) -> list[dict[str, Column]]:
    """Keep only runs of at least `n` (D4). Reach: n - 1 rows on either side."""
    if n <= 1:
        return [{name: true_(m)}]
    full = f"_{name}_full"
    return [
        {full: F.sum(true_(m).cast("int")).over(w.rowsBetween(-(n - 1), 0)) == n},
        {name: F.max(full).over(w.rowsBetween(0, n - 1))},
    ]


def fill_gaps(w, m: Column, n: int, name: str, i: str = "i") -> list[dict[str, Column]]:
    """Fill interior gaps of at most `n` rows between runs (first half of D6). Reach: n rows."""
    if n < 1:
        return [{name: true_(m)}]
    place = F.when(true_(m), F.col(i))
    left = F.max(place).over(w.rowsBetween(-n, 0))
    right = F.min(place).over(w.rowsBetween(0, n))
    return [{name: true_(m) | F.coalesce(right - left - 1 <= n, F.lit(False))}]


def close_then_keep(w, m: Column, close_n: int, min_n: int, name: str) -> list[dict[str, Column]]:
    """Fill short interior gaps, then drop short runs (D6). Reach: close_n + min_n - 1 rows."""
    filled = f"_{name}_filled"
    return fill_gaps(w, m, close_n, filled) + keep_long(w, F.col(filled), min_n, name)


def dilated(w, m: Column, n: int, name: str) -> list[dict[str, Column]]:
    """Dilation by `n` ones (D5): a true row p sets p - n//2 ... p + (n-1)//2."""
    if n < 1:
        return [{name: true_(m)}]
    return [{name: F.max(true_(m)).over(w.rowsBetween(-((n - 1) // 2), n // 2))}]


def closed(w, m: Column, n: int, name: str) -> list[dict[str, Column]]:
    """Closing by `n` ones with a false border (D3): dilation, then erosion by the same element."""
    if n <= 1:
        return [{name: true_(m)}]
    wide = f"_{name}_wide"
    # the erosion looks at p - n//2 ... p + (n-1)//2 and is false where the frame leaves the series
    inside = F.sum(F.col(wide).cast("int")).over(w.rowsBetween(-(n // 2), (n - 1) // 2)) == n
    return dilated(w, m, n, wide) + [{name: inside}]


def drop_short(df, k, m: str, min_len: int, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    return blocks.over_blocks(
        df, k, min_len, min_len, lambda w: keep_long(w, F.col(m), min_len, f"{m}_kept"), i, block
    )


def close_and_keep(
    df, k, m: str, close_n: int, min_n: int, i: str = "i", block: int = blocks.BLOCK_ROWS
) -> DataFrame:
    reach = close_n + min_n
    return blocks.over_blocks(
        df, k, reach, reach, lambda w: close_then_keep(w, F.col(m), close_n, min_n, f"{m}_clean"), i, block
    )


def dilate(df, k, m: str, n: int, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    return blocks.over_blocks(df, k, n, n, lambda w: dilated(w, F.col(m), n, f"{m}_wide"), i, block)


def closing(df, k, m: str, n: int, i: str = "i", block: int = blocks.BLOCK_ROWS) -> DataFrame:
    return blocks.over_blocks(df, k, n, n, lambda w: closed(w, F.col(m), n, f"{m}_closed"), i, block)
