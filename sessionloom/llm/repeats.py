"""Where could a stretch of W symbols stand twice? The search that routes equal windows of all texts to one shard.

Symbols are bytes or word hashes. Every window of W symbols belongs to the k-gram with the smallest hash inside it (the leftmost of
equal ones), so equal windows belong to equal k-grams, wherever they stand. Windows that follow each other and belong to one k-gram
form a region; a region whose k-gram occurs nowhere else cannot repeat and is left behind after one count. Equal regions are stored
once. What is left is dealt by k-gram into shards, where an operator compares the regions' symbols themselves.

A k-gram with more than `HOT` different regions, such as a common line shorter than a window, is dealt on (`finer`): its regions are cut at fixed
distances from the k-gram into runs of few windows, which belong to the symbols that all of them share, and in the end into single windows.
At each depth equal runs are one row again, runs whose symbols stand nowhere else are left behind, and what is left goes to shards like
any other region. A single window has one row, so no group of a shard is larger than `HOT` regions, and every window is compared there.

Rows of one k-gram or region may be a third of all. `meet` joins them with what is known of it without sending them to one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prefix_sums, settle, stretch_hash

#: Different regions of a group at most; a larger group is dealt on.
HOT = 20_000
#: A key with more than this share of the rows of a join doesn't shuffle them; there are at most so many such keys.
SHARES = 4000


def text_key(text):
    """88 bits of the text's hash: enough to tell 10^11 texts apart, and a third less to shuffle than all of it. Null counts as empty."""
    return F.substring(F.unhex(F.md5(F.coalesce(text, F.lit("")))), 1, 11)


def text_classes(docs: DataFrame, id_col: str, text_col: str, least: int, null_leads: bool = True) -> DataFrame:
    """Distinct texts of at least `least` bytes: (key, text, n rows, lead smallest id), bucketed by key for the joins that follow.
    A null id is the smallest, or with `null_leads` off not looked at while there are others.

    Copies, however many, are one row from here on; partial aggregation collapses them before the shuffle.
    """
    spark = docs.sparkSession
    bare = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(text_key(bare).alias("key"), bare.alias("text"), F.col(id_col).alias("id")).where(F.octet_length("text") >= least)
    lead = F.min(F.struct("id")).getField("id") if null_leads else F.min("id")
    classes = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("n"), lead.alias("lead"))
    name = f"llm_classes_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes.write.bucketBy(buckets, "key").format("parquet").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def regions_of(symbols: np.ndarray, first: np.ndarray, window: int, k: int):
    """(owner, lo, n, anchor, fp, r): windows lo..lo+n-1 of text `owner` belong to one k-gram `fp` at `anchor`; r is the region's hash.

    first: where each text begins in `symbols`, and the end. lo and anchor count from the text's first symbol.
    """
    none = np.empty(0, np.int64)
    if len(symbols) < window:
        return none, none, none, none, none, none
    sums = prefix_sums(symbols)
    at = np.arange(len(symbols) - k + 1)
    gram = stretch_hash(sums, at, at + k)
    packed = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    span, width = window - k + 1, 1
    while 2 * width <= span:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    if width < span:
        packed = np.minimum(packed[: len(packed) - (span - width)], packed[span - width :])
    least = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the window that starts here
    size = np.diff(first)
    many = np.maximum(size - window + 1, 0)
    own = np.repeat(np.arange(len(size)), many)
    start = np.arange(len(own)) + np.repeat(first[:-1] - np.cumsum(many) + many, many)
    least = least[start]
    if len(start) == 0:
        return none, none, none, none, none, none
    head = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (own[1:] != own[:-1])]))
    n = np.diff(np.append(head, len(start)))
    lo, anchor, own = start[head], least[head], own[head]
    fp = gram[anchor].view(np.int64)
    r = stretch_hash(sums, lo, lo + n + window - 1).view(np.int64)
    return own, lo - first[own], n, anchor - first[own], fp, r


def place(w):
    """(lo, many, at) packed in w: the first window, their number, and the k-gram's distance from the first. Arrays or columns.

    The lowest bit tells whether the text has copies. Few bytes matter here, as every region of the corpus is one row.
    """
    if isinstance(w, np.ndarray):
        return w >> 23, (w >> 12) & 2047, (w >> 1) & 2047
    return F.shiftright(w, 23), F.shiftright(w, 12).bitwiseAND(F.lit(2047)), F.shiftright(w, 1).bitwiseAND(F.lit(2047))


def times():
    """Places a region row stands for: two stand for any number of copies."""
    return F.sum(F.col("w").bitwiseAND(F.lit(1)) + 1)


Splitter = Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def find_regions(classes: DataFrame, symbols: Splitter, window: int, k: int) -> DataFrame:
    """All regions of all classes, written: (key, lead, w, fp, r); see `place`."""
    if window >= 1 << 11:
        raise ValueError("a window has at most 2047 symbols")

    def run(batches):
        for batch in batches:
            for base, syms, first in symbols(batch.column(1)):
                own, lo, many, anchor, fp, r = regions_of(syms, first, window, k)
                row = pa.array(own + base)
                copies = (batch.column(2).to_numpy() > 1)[own + base]
                w = (lo << 23) | (many << 12) | ((anchor - lo) << 1) | copies
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(3).take(row), pa.array(w, pa.int64()), pa.array(fp), pa.array(r)], names=["key", "lead", "w", "fp", "r"])

    kind = classes.schema["lead"].dataType.simpleString()
    found = classes.select("key", "text", "n", "lead").mapInArrow(run, f"key binary, lead {kind}, w long, fp long, r long")
    return settle(found, "regions")


def meet(left: DataFrame, right: DataFrame, on: list[str], rows: str) -> DataFrame:
    """`left` joined with `right`, which has one row a key and in `rows` the number of left rows of the key. Both are written tables, or cheap to read twice.

    Keys with more than 1 / `SHARES` of all left rows are `SHARES` at most, so their right rows go to every task and their left rows stay where
    they are; the others are shuffled as usual.
    """
    size = right.agg(F.sum(rows).alias("all"), F.max(rows).alias("most")).first()
    limit = max((size["all"] or 0) // SHARES, 100)
    if (size["most"] or 0) <= limit:
        return left.join(right, on)
    heavy, light = right.where(F.col(rows) > limit), right.where(F.col(rows) <= limit)
    few = left.join(F.broadcast(heavy), on)
    many = left.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light, on)
    return few.unionByName(many)


def repeated(regions: DataFrame) -> DataFrame:
    """The regions (a written table) whose k-gram occurs more than once, counting copies of a text; written."""
    count = regions.groupBy("fp").agg(times().alias("total"), F.count("*").alias("rows")).where("total > 1")
    return settle(meet(regions, settle(count.select("fp", "rows"), "grams"), ["fp"], "rows").drop("rows"), "repeated")


def bundled(members: DataFrame) -> DataFrame:
    """(fp, r, items): the members (key, w) of a region that a batch of rows holds, as one row. The written members lie together by k-gram, so a region that
    many texts share meets what is known of it in few rows; the batch bounds them."""

    def run(batches):
        for batch in batches:
            fp, r = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.lexsort((r, fp))
            fp, r = fp[order], r[order]
            head = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (r[1:] != r[:-1])])) if len(fp) else np.empty(0, np.int64)
            at = pa.array(order)
            items = pa.StructArray.from_arrays([batch.column(2).take(at), batch.column(3).take(at)], names=["key", "w"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(fp)), pa.int32()), items)
            yield pa.RecordBatch.from_arrays([pa.array(fp[head]), pa.array(r[head]), lists], names=["fp", "r", "items"])

    return members.select("fp", "r", "key", "w").mapInArrow(run, "fp long, r long, items array<struct<key: binary, w: long>>")


def distinct_regions(members: DataFrame, order: list[str]) -> DataFrame:
    """One row for each (fp, r), written: places, the number of its members, and the member that comes first by `order`, which ends with key and w."""
    one = members.groupBy("fp", "r").agg(times().alias("total"), F.count("*").alias("rows"), F.min(F.struct(*order)).alias("rep"))
    return settle(one, "distinct")


def split_hot(distinct: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The regions of k-grams with `HOT` different regions or fewer, and the others, if there are any."""
    busy = settle(distinct.groupBy("fp").agg(F.count("*").alias("n")).where(F.col("n") > HOT), "hot")
    if busy.limit(1).count() == 0:
        return distinct, None
    each = settle(distinct.groupBy("fp").agg(F.count("*").alias("n")), "sizes")
    all_ = meet(distinct, each, ["fp"], "n")
    return all_.where(F.col("n") <= HOT).drop("n"), all_.where(F.col("n") > HOT).drop("n")


def with_text(classes: DataFrame, distinct: DataFrame) -> DataFrame:
    """(text, parts): the regions that are cut from each text; their number is bounded by its length."""
    wanted = distinct.groupBy("rep.key").agg(F.collect_list(F.struct("fp", "r", "total", "rows", "rep")).alias("parts"))
    return classes.select("key", "text").join(wanted, "key").select("text", "parts")


def region_symbols(classes: DataFrame, distinct: DataFrame, symbols: Splitter, window: int, dtype: str) -> DataFrame:
    """The symbols of every distinct region, dealt into shards: (shard_key, fp, r, many, body binary, total, rows, rep)."""
    rep_type = distinct.schema["rep"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            parts = batch.column(1)
            cut = parts.offsets.to_numpy() - parts.offsets[0].as_py()
            flat = parts.flatten()
            rep, fps = flat.field("rep"), flat.field("fp")
            los, manys, _ = place(rep.field("w").to_numpy())
            rows, bodies = [], []

            def flush():
                at = pa.array(rows, pa.int64())
                made = pa.RecordBatch.from_arrays(
                    [fps.take(at), fps.take(at), flat.field("r").take(at), pa.array(manys[rows], pa.int32()), pa.array(bodies, pa.binary()), flat.field("total").take(at), flat.field("rows").take(at), rep.take(at)],
                    names=["shard_key", "fp", "r", "many", "body", "total", "rows", "rep"],
                )
                rows.clear()
                bodies.clear()
                return made

            for base, syms, first in symbols(batch.column(0)):
                for i in range(len(first) - 1):
                    for p in range(cut[base + i], cut[base + i + 1]):
                        lo, many = int(los[p]) + int(first[i]), int(manys[p])
                        rows.append(p)
                        bodies.append(syms[lo : lo + many + window - 1].astype(dtype, copy=False).tobytes())
                    if len(rows) >= 4000:
                        yield flush()
            if rows:
                yield flush()

    schema = f"shard_key long, fp long, r long, many int, body binary, total long, rows long, rep {rep_type}"
    return with_text(classes, distinct).mapInArrow(run, schema)


def finer(classes: DataFrame, distinct: DataFrame, symbols: Splitter, window: int, sub: int) -> DataFrame:
    """Regions of `sub` windows at most, cut from the first members of `distinct`, written: (fp, r, key, [lead,] w, off, top). fp stands for the symbols that all windows
    of the region share; off is its distance from the region `top` (fp, r, rows, key, w) it is cut from, whose copies count."""
    rep_type = distinct.schema["rep"].dataType.simpleString()
    lead = "lead" in distinct.schema["rep"].dataType.names

    def run(batches):
        for batch in batches:
            parts = batch.column(1)
            cut = parts.offsets.to_numpy() - parts.offsets[0].as_py()
            flat = parts.flatten()
            rep = flat.field("rep")
            los, manys, ats = place(rep.field("w").to_numpy())
            copied = (flat.field("total").to_numpy() > 1).astype(np.int64)
            for base, syms, first in symbols(batch.column(0)):
                from_, to = cut[base], cut[base + len(first) - 1]
                if from_ == to:
                    continue
                sums = prefix_sums(syms)
                text_at = np.repeat(first[:-1], np.diff(cut[base : base + len(first)]))
                many = manys[from_:to]
                own = np.repeat(np.arange(to - from_), many)
                off = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
                # cut at fixed distances before the k-gram, so equal windows fall into regions that share these symbols
                away = ats[from_:to][own] - off
                nth = away // sub
                head = np.flatnonzero(np.concatenate([[True], (nth[1:] != nth[:-1]) | (own[1:] != own[:-1])]))
                count = np.diff(np.append(head, len(own)))
                mine = own[head]
                lo = los[from_:to][mine] + off[head]
                begin = text_at[mine] + lo
                last = begin + away[head] - nth[head] * sub
                core = (stretch_hash(sums, last, last - sub + 1 + window) + nth[head].astype(np.uint64)).view(np.int64)
                r = stretch_hash(sums, begin, begin + count + window - 1).view(np.int64)
                w = (lo << 23) | (count << 12) | (away[head] << 1) | copied[from_:to][mine]
                at = pa.array(mine + from_)
                for a in range(0, len(head), 8000):
                    s = slice(a, a + 8000)
                    own_ = at[s]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core[s]), pa.array(r[s]), pa.array(w[s]), pa.array(off[head[s]], pa.int32()), flat.field("fp").take(own_), flat.field("r").take(own_), flat.field("rows").take(own_), rep.take(own_)],
                        names=["fp", "r", "w", "off", "top_fp", "top_r", "top_rows", "rep"],
                    )

    made = with_text(classes, distinct).mapInArrow(run, f"fp long, r long, w long, off int, top_fp long, top_r long, top_rows long, rep {rep_type}")
    top = F.struct(F.col("top_fp").alias("fp"), F.col("top_r").alias("r"), F.col("top_rows").alias("rows"), F.col("rep.key").alias("key"), F.col("rep.w").alias("w"))
    return settle(made.select("fp", "r", F.col("rep.key").alias("key"), *(["rep.lead"] if lead else []), "w", "off", top.alias("top")), "finer")


def shards(parts: DataFrame, solve, schema: str, limit: int, key: str = "shard_key") -> DataFrame:
    """`solve(pa.Table)` on whole groups of `key`, as many together as make about `limit` bytes. A larger group is one call."""
    dealt = parts.repartition(F.col(key)).sortWithinPartitions(key)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < limit:
                continue
            all_ = pa.Table.from_batches(held)
            keys = all_[key].to_numpy()
            # the last group may go on in the next batch
            done, end = 0, int(np.searchsorted(keys, keys[-1], side="left"))
            step = max(1, len(keys) * limit // size)
            while done < end:
                last = keys[min(done + step, end) - 1]
                stop = int(np.searchsorted(keys, last, side="right"))
                yield from solve(all_.slice(done, stop - done)).to_batches()
                done = stop
            rest = all_.slice(done).combine_chunks()
            held, size = rest.to_batches(), rest.nbytes
        if held:
            yield from solve(pa.Table.from_batches(held)).to_batches()

    return dealt.mapInArrow(run, schema)
