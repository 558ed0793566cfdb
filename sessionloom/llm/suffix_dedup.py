"""Suffix-array dedup: every byte under a string of `window` bytes that also starts anywhere else is removed, in all its places.

`repeats` routes equal windows to one shard; there a suffix array is made by induced sorting, permuted common prefixes are computed,
and neighbours in the array with a common prefix of a window or more form groups. Every start in a group that stands for two
places or more is a repeat. Spans are judged on the input, not on what is left.

Defined cases: null and empty texts, and texts shorter than a window, lose nothing. Copies of a text, or repeated rows, lose every byte if
they are as long as a window. Matches never cross documents. Spans are bytes and may cut a character of several bytes: `kept_text` leaves
out what remains of it. Columns of the input travel in one struct, so their names can't clash with those added here.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, query, settle, stretch_hash, table, texts
from .repeats import bundled, distinct_regions, find_regions, finer, meet, place, region_symbols, repeated, shards, split_hot, text_classes, text_key
from .suffix import common_prefixes, suffix_array

WINDOW = 400
GRAM = 100
SHARD_BYTES = 1 << 20


def byte_symbols(column):
    for t in texts(column):
        yield t.first, t.data, t.at


def repeated_starts(bodies: list[bytes], weight: np.ndarray, many: np.ndarray, window: int) -> np.ndarray:
    """For every place of the shard's string (bodies, each after an end mark): does a repeated window start there?"""
    size = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(size + 1) - size  # a mark before each body
    s = np.ones(int(size.sum()) + len(bodies) + 1, np.uint16)
    s[-1] = 0
    data = np.frombuffer(b"".join(bodies), np.uint8)
    at = np.arange(len(data)) + np.repeat(begin - (np.cumsum(size) - size), size)
    s[at] = data.astype(np.uint16) + 2
    sa = suffix_array(s, 258, len(s))
    sums = prefix_sums(s)
    plcp = common_prefixes(s, sa, begin, window, int(size.max()) + 1, lambda i, j, n: stretch_hash(sums, i, i + n) == stretch_hash(sums, j, j + n))
    places = np.zeros(len(s), np.int64)
    start = np.arange(int(many.sum())) + np.repeat(begin - (np.cumsum(many) - many), many)
    places[start] = np.repeat(np.minimum(weight, 2), many)
    head = np.flatnonzero(np.concatenate([[True], plcp[sa[1:]] < window]))
    total = np.add.reduceat(places[sa], head)
    out = np.empty(len(s), bool)
    out[sa] = np.repeat(total > 1, np.diff(np.append(head, len(s))))
    return out[start]


def runs(on: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the maximal true stretches that stay within an owner."""
    if len(on) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.concatenate([[True], owner[1:] != owner[:-1]])
    begin = on & (edge | np.concatenate([[True], ~on[:-1]]))
    end = on & (np.append(edge[1:], True) | np.append(~on[1:], True))
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


RESULT = "fp long, r long, rows long, key binary, w long, stretches array<struct<start: int, stop: int>>"


def solve_shard(rows: pa.Table, window: int = WINDOW) -> pa.Table:
    """The regions with repeated windows, as stretches of starts counted from the region's first window."""
    rows = rows.combine_chunks()
    many = rows["many"].to_numpy().astype(np.int64)
    on = repeated_starts(rows["body"].to_pylist(), rows["total"].to_numpy(), many, window)
    owner = np.repeat(np.arange(len(many)), many)
    begin, end = runs(on, owner)
    own = owner[begin] if len(begin) else np.empty(0, np.int64)
    base = (np.cumsum(many) - many)[own]
    found, first = np.unique(own, return_index=True)
    stretch = pa.StructArray.from_arrays([pa.array(begin - base, pa.int32()), pa.array(end - base, pa.int32())], names=["start", "stop"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(own)), pa.int32()), stretch)
    at, rep = pa.array(found, pa.int64()), rows["rep"].combine_chunks()
    rows = rows.take(at)
    return pa.table({"fp": rows["fp"], "r": rows["r"], "rows": rows["rows"], "key": rep.field("key").take(at), "w": rep.field("w").take(at), "stretches": lists})


def moved(stretches, by):
    return F.transform(stretches, lambda s: F.struct((s["start"] + by).alias("start"), (s["stop"] + by).alias("stop")))


def repeated_regions(classes: DataFrame, members: DataFrame, window: int, subs: tuple[int, ...]) -> DataFrame:
    """(fp, r, rows, key, w, stretches), written: one row for each different region with repeated windows. Groups too large for a shard are dealt on into
    regions of `subs[0]` windows, and so on."""
    cold, hot = split_hot(distinct_regions(members, ["key", "w"]))
    found = shards(region_symbols(classes, cold, byte_symbols, window, "u1"), lambda rows: solve_shard(rows, window), RESULT, SHARD_BYTES)
    if hot is None or not subs:
        return settle(found, "repeats")
    smaller = finer(classes, hot, byte_symbols, window, subs[0])
    inner = repeated_regions(classes, repeated(smaller), window, subs[1:]).select("fp", "r", F.col("rows").alias("n"), "stretches")
    back = meet(smaller, inner, ["fp", "r"], "n").select("top", moved("stretches", F.col("off")).alias("s"))
    whole = back.groupBy("top.fp", "top.r").agg(F.first("top").alias("top"), F.flatten(F.collect_list("s")).alias("stretches"))
    return settle(found.unionByName(whole.select("top.*", "stretches")), "repeats")


def spans_of_members(batches):
    """(key, s) from (items, stretches): the stretches of each member, counted from the start of its text; regions of one text that a batch holds make one row."""
    for batch in batches:
        items, stretches = batch.column(0), batch.column(1)
        many, each = (np.diff(c.offsets.to_numpy()) for c in (items, stretches))
        row = np.repeat(np.arange(len(many)), many)
        count = each[row]
        item = np.repeat(np.arange(len(row)), count)
        first = np.cumsum(each) - each
        nth = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count) + first[row][item]
        key = items.flatten().field("key").dictionary_encode()
        lo = place(items.flatten().field("w").to_numpy())[0][item]
        a, b = (lo + stretches.flatten().field(c).to_numpy()[nth] for c in ("start", "stop"))
        code = key.indices.to_numpy()[item]
        order = np.argsort(code, kind="stable")
        code = code[order]
        head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
        spans = pa.StructArray.from_arrays([pa.array(a[order], pa.int32()), pa.array(b[order], pa.int32())], names=["start", "stop"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(code)), pa.int32()), spans)
        yield pa.RecordBatch.from_arrays([key.dictionary.take(pa.array(code[head])), lists], names=["key", "s"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"):
    """(classes, spans): the distinct texts, and for each key with repeats its spans as flat pairs of starts and stops of windows."""
    classes = text_classes(docs, id_col, text_col, window)
    members = repeated(find_regions(classes, byte_symbols, window, gram))
    found = repeated_regions(classes, members, window, (max(1, window // 16), 1))
    # most regions stand in one place, which is known; only those that equal another are looked up by member, one row a region
    stretch = moved("stretches", place(F.col("w"))[0].cast("int"))
    known = found.where("rows = 1").select("key", stretch.alias("s"))
    shared = meet(bundled(members), found.where("rows > 1").select("fp", "r", "rows", "stretches"), ["fp", "r"], "rows")
    shared = shared.select("items", "stretches").mapInArrow(spans_of_members, "key binary, s array<struct<start: int, stop: int>>")
    flat = F.transform(F.flatten(F.collect_list("s")), lambda x: F.struct(x["start"].alias("a"), x["stop"].alias("b")))
    spans = known.unionByName(shared).groupBy("key").agg(flat.alias("spans"))
    return classes, spans


def covered(n: int, starts: np.ndarray, stops: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches under windows that start in [start, stop)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, stops - 1 + window, -1)
    on = np.cumsum(step)[:n] > 0
    return runs(on, np.zeros(n, np.int64))


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, with_text: bool = True) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of every row; row: struct of the columns `keep`, all by default."""
    classes, spans = repeated_spans(docs, window, gram, id_col, text_col)

    def cut(batches):
        for batch in batches:
            out = {n: [] for n in ("removed", "spans", "sha", "text")}
            list_ = batch.column(2)
            at = list_.offsets.to_numpy() - list_.offsets[0].as_py()
            a, b = (list_.flatten().field(c).to_numpy() for c in ("a", "b"))
            for t in texts(batch.column(1)):
                for i in range(len(t)):
                    row = t.first + i
                    raw = t.raw(i)
                    begin, end = covered(len(raw), a[at[row] : at[row + 1]], b[at[row] : at[row + 1]], window)
                    edges = np.concatenate([[0], np.column_stack([begin, end]).reshape(-1), [len(raw)]]).tolist()
                    kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    out["removed"].append(len(raw) - len(kept))
                    out["spans"].append(len(begin))
                    out["sha"].append(hashlib.sha256(kept).hexdigest())
                    out["text"].append(kept.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["removed"], pa.int64()), pa.array(out["spans"], pa.int64()), pa.array(out["sha"], pa.string()), pa.array(out["text"], pa.string())],
                names=["key", "removed", "spans", "sha", "kept"],
            )

    done = classes.select("key", "text").join(spans, "key").mapInArrow(cut, "key binary, removed long, spans long, sha string, kept string")
    bare = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(c) for c in keep or docs.columns]).alias("row"), text_key(F.col(text_col)).alias("key"),
        F.octet_length(bare).cast("long").alias("n_bytes"), F.sha2(bare, 256).alias("whole"), *([F.col(text_col).alias("text")] if with_text else []),
    )
    zero = F.lit(0).cast("long")
    return rows.join(done, "key", "left").select(
        "row", "n_bytes", F.coalesce("removed", zero).alias("n_removed"), F.coalesce("spans", zero).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
        *([F.coalesce("kept", "text").alias("kept_text")] if with_text else []),
    )


@query("op2_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False)
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
