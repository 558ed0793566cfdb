"""Sharding by histogram sort: exact byte counts below candidate key boundaries are refined until every splitter meets its
tolerance; then all rows are exchanged once.

Native: DataFrame expressions only. The law is `bytes`: the shards' sizes are near equal. A row's key is 128 bits, the hash of
its text and then the hash of its id, so that equal texts stand side by side and share a shard, except where a group is larger
than the tolerance allows and a splitter has to fall inside it. Each round takes 12 further bits of the boundary cells only;
one row for each cell comes to the driver, at most 4096 for each splitter.

Defined cases: a null text has no bytes, a size of 8 and the checksum 0. Rows that repeat id and text have one key and share
a shard; each has its own slot. An empty table gives no rows. Only `id_col` and `text_col` are read, so other columns can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import query, settle, table

SHARDS = 24
#: A splitter is done when its bytes are within this part of a shard of the aim.
TOLERANCE = 0.002
BITS = 12


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text, flip = F.col(text_col), F.lit(-(1 << 63)).cast("long")
    bare = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(bare) + 8).cast("long").alias("size"),
        F.crc32(F.encode(bare, "UTF-8")).cast("long").alias("text_crc32"),
        # as signed numbers in the order of the unsigned hash
        F.xxhash64(bare).bitwiseXOR(flip).alias("k1"),
        F.xxhash64(F.col(id_col), F.lit(1)).bitwiseXOR(flip).alias("k2"),
    )


def _cell(depth: int):
    """The bits that round `depth` adds; six rounds read k1 (the last has 4 bits), six more k2."""
    col, at = (F.col("k1"), depth) if depth < 6 else (F.col("k2"), depth - 6)
    left = 64 - BITS * at
    bits = min(BITS, left)
    # the sign bit is flipped so that cells count upwards
    up = col.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return F.shiftrightunsigned(up, left - bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"), bits


def find_splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[list[int]]:
    """For each of the shards - 1 boundaries the cells (one number for each round) of the first key at or above it."""
    top = keys.agg(F.sum("size")).first()[0] or 0
    aims = [top * (n + 1) / shards for n in range(shards - 1)]
    slack = tolerance * top / shards
    # a boundary: the cells fixed so far, and the bytes below them
    open_at: dict[int, tuple[list[int], int]] = {n: ([], 0) for n in range(shards - 1)}
    done: dict[int, list[int]] = {}
    for depth in range(12):
        if not open_at or not top:
            break
        prefixes = sorted({tuple(cells) for cells, _ in open_at.values()})
        live = keys
        if depth:
            same = [reduce(lambda a, b: a & b, (_cell(d)[0] == c for d, c in enumerate(p))) for p in prefixes]
            number = reduce(lambda out, x: F.when(x[1], F.lit(x[0])).otherwise(out), enumerate(same), F.lit(None).cast("int"))
            live = keys.withColumn("prefix", number).where("prefix IS NOT NULL")
        else:
            live = keys.withColumn("prefix", F.lit(0))
        cell, bits = _cell(depth)
        counted = live.groupBy("prefix", cell.alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        sizes: list[dict[int, int]] = [{} for _ in prefixes]
        single: set[tuple[int, int]] = set()
        for r in counted:
            sizes[r["prefix"]][r["cell"]] = r["size"]
            if r["n"] == 1:
                single.add((r["prefix"], r["cell"]))
        for n, (cells, below) in list(open_at.items()):
            at = prefixes.index(tuple(cells))
            own = sizes[at]
            run, choice = below, None
            for c in sorted(own):
                if run + own[c] >= aims[n]:
                    choice = c
                    break
                run += own[c]
            if choice is None:  # the aim lies at the end of the prefix
                choice = max(own) + 1
            # the boundary before the cell or the one after it may be near enough
            if abs(run - aims[n]) <= slack:
                done[n] = cells + [choice]
            elif abs(run + own.get(choice, 0) - aims[n]) <= slack:
                done[n] = cells + [choice + 1]
            elif depth == 11 or (at, choice) in single:  # one key or row is left: the nearer side
                done[n] = cells + [choice + (run + own.get(choice, 0) - aims[n] < aims[n] - run)]
            else:
                open_at[n] = (cells + [choice], run)
                continue
            del open_at[n]
    done |= {n: cells for n, (cells, _) in open_at.items()}
    return [done[n] for n in sorted(done)]


def shard_of(splitters: list[list[int]]):
    """Number of splitters at or below the key."""

    def reached(cells: list[int]):
        out = F.lit(True)
        for d in reversed(range(len(cells))):
            cell = _cell(d)[0]
            out = (cell > cells[d]) | ((cell == cells[d]) & out)
        return out.cast("int")

    return reduce(lambda a, b: a + b, (reached(c) for c in splitters), F.lit(0)).cast("int")


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    keys = settle(keyed(docs, id_col, text_col), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    # one exchange: a shard is spread over many tasks, whatever its keys are, and numbered from the tasks' counts
    dealt = keys.withColumn("shard", shard_of(splitters)).repartition(F.col("shard"), F.xxhash64("k1", "k2", "doc_id"))
    dealt = dealt.sortWithinPartitions("shard", "k1", "k2", "doc_id").withColumn("mark", F.monotonically_increasing_id())
    # the marks depend on the tasks, so they are written before two consumers read them
    dealt = settle(dealt.select("doc_id", "size", "text_crc32", "shard", "mark"), "shard-rows")
    task = F.shiftright("mark", 33)
    part = dealt.groupBy("shard", task.alias("task")).agg(F.min("mark").alias("head"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("shard", "task", "head", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        dealt.withColumn("task", task)
        .join(part, ["shard", "task"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("mark") - F.col("head") + F.col("base")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


@query("op9_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))
