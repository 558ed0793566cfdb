"""Joins between intervals, and between points and intervals, inside one session.

Time is cut into chunks, and the chunks of a session are the leaves of a binary tree. An interval is
stored at the fewest nodes that make up its chunks, two a level at most, so one over a whole session
costs a logarithm of its chunks. A point looks up the nodes above its chunk, on the levels that
some interval uses: where intervals are shorter than a chunk that is one or two. Nodes of many
chunks are dealt into parts, so that neither a long session nor a dense one forms one join group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from . import blocks

#: Nodes from this level on are dealt into so many parts.
WIDE_LEVEL = 4
PARTS = 16


def tree_nodes(first: Column, last: Column) -> Column:
    """array<struct<level, node>>: the fewest nodes that make up the chunks first..last; node n of level l is the chunks n 2^l .. (n + 1) 2^l - 1."""
    span = F.struct(first.alias("a"), last.alias("b"))
    levels = F.sequence(F.lit(0), F.ceil(F.log2((last - first + 1).cast("double"))).cast("int"))

    def two(s: Column, level: Column) -> Column:
        # what is left of the span, in nodes of this level: nodes that are no pair go
        low = F.call_function("shiftright", s["a"] + F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1, level)
        high = F.call_function("shiftright", s["b"] + 1, level) - 1
        some = low <= high
        left = F.when(some & (F.pmod(low, F.lit(2)) == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when(some & (F.pmod(high, F.lit(2)) == 0), F.struct(level.alias("level"), high.alias("node")))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(levels, lambda level: two(span, level))))


def point_in_interval(
    points: DataFrame, intervals: DataFrame, k: Sequence[str], t: str, start: str, end: str, width: float
) -> DataFrame:
    """Pairs of an interval and a point inside it, both ends included.

    Column names other than the keys must differ between the two sides. The intervals are written.
    """
    k = list(k)
    valid = intervals.filter(F.col(start) <= F.col(end))
    # the intervals' own columns keep their names and values
    wide = valid.select("*", F.inline(tree_nodes(blocks.chunk_of(start, width), blocks.chunk_of(end, width))).alias("_l", "_c"))
    part = F.when(F.col("_l") >= WIDE_LEVEL, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    wide = settle(wide.withColumn("_part", F.explode(part)))
    # a level for each doubling of the longest interval at most
    used = sorted(r["_l"] for r in wide.select("_l").distinct().collect()) or [0]
    cut = points.withColumn("_chunk", blocks.chunk_of(t, width))
    if used == [0]:
        cut = cut.withColumns({"_l": F.lit(0), "_c": F.col("_chunk"), "_part": F.lit(0)})
    else:
        cut = cut.withColumn("_l", F.explode(F.array(*[F.lit(n) for n in used])))
        cut = cut.withColumns(
            {
                "_c": F.call_function("shiftright", F.col("_chunk"), F.col("_l")),
                "_part": F.when(F.col("_l") >= WIDE_LEVEL, F.pmod(F.col("_chunk"), F.lit(PARTS)).cast("int")).otherwise(0),
            }
        )
    found = cut.drop("_chunk").join(wide, [*k, "_l", "_part", "_c"]).filter(F.col(t).between(F.col(start), F.col(end)))
    return found.drop("_l", "_part", "_c")


def overlap_join(
    a: DataFrame, b: DataFrame, k: Sequence[str], a_bounds: tuple[str, str], b_bounds: tuple[str, str], width: float
) -> DataFrame:
    """Pairs of overlapping intervals (J5): the one that starts later starts inside the other. Both sides are written."""
    (a0, a1), (b0, b1) = a_bounds, b_bounds
    a, b = (settle(side.filter(F.col(lo) <= F.col(hi))) for side, (lo, hi) in ((a, a_bounds), (b, b_bounds)))
    columns = [*k, *(c for c in a.columns if c not in k), *(c for c in b.columns if c not in k)]
    later_b = point_in_interval(b, a, k, b0, a0, a1, width)
    later_a = point_in_interval(a, b, k, a0, b0, b1, width).filter(F.col(a0) > F.col(b0))
    return later_b.select(*columns).unionByName(later_a.select(*columns))


def match_events(
    a: DataFrame, b: DataFrame, k: Sequence[str], width: float, start: str = "i0", end: str = "i1", label: str = "label"
) -> DataFrame:
    """Each event of `a` with how many events of `b` it overlaps, and how many of its class (E3). Both tables of events are written once."""
    a = settle(a)
    other = b.select(*k, F.col(start).alias("_b0"), F.col(end).alias("_b1"), F.col(label).alias("_bl"))
    pairs = overlap_join(a.select(*k, start, end, label), other, k, (start, end), ("_b0", "_b1"), width)
    hits = pairs.groupBy(*k, start).agg(
        F.count(F.lit(1)).alias("n_any"),
        F.sum((F.col("_bl") == F.col(label)).cast("bigint")).alias("n_same"),
    )
    return a.join(hits, [*k, start], "left").fillna(0, ["n_any", "n_same"])


def lost_new(a: DataFrame, b: DataFrame, k: Sequence[str], width: float, **names) -> DataFrame:
    """Events of `a` without a partner in `b` and the reverse, any class or same class."""
    a, b = settle(a), settle(b)
    label = names.get("label", "label")
    kept = [*k, names.get("start", "i0"), label, "n_any", "n_same"]
    left = match_events(a, b, k, width, **names).select(*kept, F.lit("lost").alias("kind"))
    right = match_events(b, a, k, width, **names).select(*kept, F.lit("new").alias("kind"))
    return left.unionByName(right).filter("n_same = 0").withColumn(
        "kind", F.when(F.col("n_any") > 0, F.concat(F.col("kind"), F.lit("_class_changed"))).otherwise(F.col("kind"))
    )
