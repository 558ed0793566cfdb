"""Set-like operators on whole tables: top-k, upsert, difference, folds, report joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_series(df: DataFrame, k: Sequence[str], t: str) -> DataFrame:
    """Rows in time order inside each session (O1), range-partitioned so that a long session
    spreads over several sorted partitions."""
    return df.repartitionByRange(*k, t).sortWithinPartitions(*k, t)


def top_k(df: DataFrame, by: Column, n: int, tie: Sequence[str]) -> DataFrame:
    """The n rows with the largest `by`, ties settled by `tie` (O2)."""
    return df.orderBy(by.desc_nulls_last(), *tie).limit(n)


def upsert(old: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `old` whose key is not in `new`, and all rows of `new` (O3)."""
    return old.join(new.select(*on).distinct(), list(on), "left_anti").unionByName(new)


def dedupe(df: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in `order` (O4, O6); a combinable minimum, not a sort."""
    rest = [c for c in df.columns if c not in on and c not in order]
    first = F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_r")
    return df.groupBy(*on).agg(first).select(*on, "_r.*").select(*df.columns)


first_per_group = dedupe


def key_diff(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """How many keys both tables, only the first and only the second hold."""
    sides = a.select(*on, F.lit(1).alias("_s")).unionByName(b.select(*on, F.lit(2).alias("_s")))
    seen = sides.groupBy(*on).agg(F.bit_or("_s").alias("_s"))
    return seen.agg(
        F.count(F.when(F.col("_s") == 3, 1)).alias("in_both"),
        F.count(F.when(F.col("_s") == 1, 1)).alias("only_first"),
        F.count(F.when(F.col("_s") == 2, 1)).alias("only_second"),
    )


def column_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Column names in both tables and in one only (O5); schemas live on the driver."""
    return {
        "in_both": [c for c in a.columns if c in b.columns],
        "only_first": [c for c in a.columns if c not in b.columns],
        "only_second": [c for c in b.columns if c not in a.columns],
    }


def identical_except(a: DataFrame, b: DataFrame, on: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Per column: rows that differ between two versions of a table, null-safe (Q12).

    Rows missing on one side count under `missing_rows`.
    """
    columns = [c for c in a.columns if c in b.columns and c not in on and c not in ignore]
    left = a.select(*on, F.lit(True).alias("_ina"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    right = b.select(*on, F.lit(True).alias("_inb"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    both = left.join(right, list(on), "full_outer")
    paired = F.col("_ina").isNotNull() & F.col("_inb").isNotNull()
    counts = both.agg(
        F.count(F.when(~paired, 1)).alias("missing_rows"),
        *[F.count(F.when(paired & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), 1)).alias(c) for c in columns],
    )
    names = ["missing_rows", *columns]
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("n_changed")) for n in names]))
    )


def compare_results(before: DataFrame, after: DataFrame, on: Sequence[str], verdict: str) -> DataFrame:
    """Full outer join of two result tables with a flag where the verdict flipped."""
    rest = [c for c in before.columns if c not in on]
    left = before.select(*on, *[F.col(c).alias(f"{c}_before") for c in rest])
    right = after.select(*on, *[F.col(c).alias(f"{c}_after") for c in rest])
    return left.join(right, list(on), "full_outer").withColumn(
        "flipped", ~F.col(f"{verdict}_before").eqNullSafe(F.col(f"{verdict}_after"))
    )


def join_reports(base: DataFrame, *reports: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join per-session reports to a base table."""
    return reduce(lambda a, b: a.join(b, list(on), "left"), reports, base)


def cross(df: DataFrame, constants: Sequence, name: str) -> DataFrame:
    """Every row with every value of a constant list (J10): cameras, lags, parameter sets.

    The list is part of the query, so this is an explode and not a join.
    """
    return df.withColumn(name, F.explode(F.array(*[F.lit(c) for c in constants])))


def attach_overrides(df: DataFrame, table: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace columns by the values of an override table where it has one."""
    renamed = table.select(*on, *[F.col(c).alias(f"_o_{c}") for c in columns])
    joined = df.join(renamed, list(on), "left")
    return joined.withColumns({c: F.coalesce(f"_o_{c}", c) for c in columns}).withColumn(
        "overridden", reduce(lambda a, b: a | b, [F.col(f"_o_{c}").isNotNull() for c in columns])
    ).drop(*[f"_o_{c}" for c in columns])


def attach_tags(df: DataFrame, table: DataFrame, on: Sequence[str], tag: str, out: str) -> DataFrame:
    """The list of exception tags of each session, empty when it has none."""
    lists = table.groupBy(*on).agg(F.sort_array(F.collect_set(tag)).alias(out))
    return df.join(lists, list(on), "left").withColumn(
        out, F.coalesce(F.col(out), F.array().cast("array<string>"))
    )


def skip_done(todo: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Work items whose key has no finished output yet."""
    return todo.join(done.select(*on).distinct(), list(on), "left_anti")


def leave_one_group_out(df: DataFrame, group: str, groups: Sequence) -> DataFrame:
    """One copy of the table per held-out group (M1): `fold`, `role` in train / test.

    Each fold names one group of the given list; rows of other groups are its training set.
    """
    folds = cross(df, groups, "fold")
    return folds.withColumn("role", F.when(F.col("fold") == F.col(group), "test").otherwise("train"))


def fold_sizes(df: DataFrame, group: str) -> DataFrame:
    """Rows in train and test of every leave-one-group-out fold, from per-group counts (M1).

    The folds are never written out: a fold's training set is the total without its group.
    """
    per_group = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_test"))
    total = per_group.agg(F.sum("n_test").alias("_all"), F.count(F.lit(1)).alias("_groups"))
    return per_group.crossJoin(F.broadcast(total)).select(
        F.col(group).alias("fold"),
        "n_test",
        (F.col("_all") - F.col("n_test")).alias("n_train"),
        (F.col("_groups") - 1).alias("train_groups"),
    )


def leaking_groups(folds: DataFrame, group: str) -> DataFrame:
    """Groups found on both sides of a fold (M1); empty when the split is sound."""
    return folds.groupBy("fold", group).agg(F.count_distinct("role").alias("roles")).filter("roles > 1")


def shuffled_ids(sample: DataFrame, items: Sequence[str], seed: int = 0, prefix: str = "F") -> DataFrame:
    """Ids F001, F002, ... in a seeded shuffle, so that strata are mixed and a rater can't tell them.

    `sample` is a drawn sample: its size is a number of items for each stratum, so its order is one small sort.
    """
    order = F.md5(F.concat_ws("|", F.lit(seed), *items))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order, *items))
    return sample.withColumn("frame_id", F.concat(F.lit(prefix), F.when(rank < 1000, F.lpad(rank.cast("string"), 3, "0")).otherwise(rank.cast("string"))))


def stratified_sample(
    df: DataFrame, k: Sequence[str], stratum: str, item: str, n: int, per_session: int = 2, seed: int = 0
) -> DataFrame:
    """A seeded sample of `n` items per stratum, spread over the sessions.

    Items are drawn in the order of an MD5: at most `per_session` candidates of each session and stratum, every session's
    first candidate before any second one. Only the best `n` of each of 256 parts of a stratum are ranked together.
    """
    keyed = df.select(*k, stratum, item).withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), *k, stratum, item)))
    first = keyed.groupBy(*k, stratum).agg(F.min(F.struct("_h", item)).alias("_x"))
    candidates = first.withColumn("_round", F.lit(1))
    rest = keyed
    for draw in range(2, per_session + 1):
        taken = first.select(*k, stratum, F.col("_x").alias("_last"))
        rest = rest.join(taken, [*k, stratum]).filter(F.struct("_h", item) > F.col("_last")).drop("_last")
        first = rest.groupBy(*k, stratum).agg(F.min(F.struct("_h", item)).alias("_x"))
        candidates = candidates.unionByName(first.withColumn("_round", F.lit(draw)))
    order = ("_round", "_x")
    salted = candidates.withColumn("_salt", F.substring("_x._h", 1, 2))
    best = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(stratum, "_salt").orderBy(*order))).filter(F.col("_rank") <= n)
    return (
        best.withColumn("_rank", F.row_number().over(Window.partitionBy(stratum).orderBy(*order)))
        .filter(F.col("_rank") <= n)
        .select(*k, stratum, F.col(f"_x.{item}").alias(item), F.col("_rank").alias("position"))
    )
